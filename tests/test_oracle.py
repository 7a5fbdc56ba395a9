"""Every registered query against its DuckDB twin on the smallest tables
(the driver runs the same comparison at sf0.01)."""
import duckdb
import pytest

import __spark_entry__ as E
from tools_check import TABLES, rows_key

from varzea.plans.catalog import QUERIES

from .conftest import SF_SMOKE

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(E.oracle_sql()) >= set(QUERIES)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["temporada", "clube"]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMOKE)
    srows, scols = df.collect(), df.columns
    cur = duck.execute(E.oracle_sql()[name])
    drows, dcols = cur.fetchall(), [d[0] for d in cur.description]
    assert sorted(scols) == sorted(dcols)
    assert rows_key(scols, srows) == rows_key(dcols, drows)
