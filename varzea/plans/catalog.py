"""Registry of named queries (Spark plan + DuckDB twin).

Each entry is ``name -> (spark, sf_dir) -> DataFrame``; ``ORACLES[name]`` is
the equivalent DuckDB SQL over the driver's tables.  Entries without an
oracle are checked by row count only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from varzea.plans.oracle import q
from varzea.sources.fixtures import Lake, gold_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
# the same queries as functions of a lake (raw or materialised silver)
LAKE_QUERIES: dict[str, Callable[[Lake], DataFrame]] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Callable[[Lake], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from varzea.session import configure
            configure(spark)
            return fn(Lake(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        LAKE_QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def gold_table(name: str):
    register(name, q(f"SELECT * FROM {name}"))(lambda lk: gold_of(lk)[name])


for _t in ["campeonato_historico", "artilharia_historica", "desempenho_clubes", "fair_play",
           "classificacao_historica", "rebaixamento_acesso", "v_artilharia_geral", "v_campeoes",
           "v_rebaixados", "v_desempenho_geral", "v_media_gols_temporada"]:
    gold_table(_t)

# the rest of the catalogue registers itself on import
from varzea.plans import registry_library  # noqa: E402,F401
