"""Rows are shuffled and written once, and no wider than they need be."""

import glob
import re

from pyspark.sql import functions as F

from varzea.operators import payloads as J
from varzea.operators.upsert import last_wins
from varzea.plans import registry_runs
from varzea.sources import feeds as FD
from varzea.sources import files as FS
from varzea.sources.fixtures import Lake, gold_of
from varzea.sources.sinks import export_json

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_last_wins_carries_its_order_once(spark):
    rows = [(1, 5, "a", 2.0), (1, 5, "b", 1.0), (1, None, "z", 9.0), (None, 3, "x", 0.0), (None, 3, "x", 4.0)]
    df = spark.createDataFrame(rows, "k long, seq long, name string, v double")
    got = last_wins(df, ["k"], ["seq"])
    assert got.columns == df.columns and {tuple(r) for r in got.collect()} == {(1, 5, "b", 1.0), (None, 3, "x", 4.0)}
    assert "_o0" not in plan(got)


def test_matches_are_merged_narrow(spark):
    text = plan(Lake(spark, SF).partidas)
    merges = re.findall(r"max\(struct\((.*?)\)\)", text)
    assert merges and not any(c in m for m in merges for c in ("arena", "status", "fonte", "rodada"))


def test_clubs_join_after_the_shuffle(spark):
    text = Lake(spark, SF).partidas_bruto._jdf.queryExecution().optimizedPlan().toString()
    names = [line.index("n_name") and len(line) - len(line.lstrip(" :+-")) for line in text.split("\n") if "Relation" in line and "n_name" in line]
    lines = [len(line) - len(line.lstrip(" :+-")) for line in text.split("\n") if "Relation" in line and "l_orderkey" in line]
    assert len(names) == 2 and min(names) < min(lines)


def test_stored_matches_are_the_matches(spark):
    lk = Lake(spark, SF)
    stored, n = registry_runs.with_stored_matches(lk)
    assert n == lk.partidas.count() and stored.partidas.schema.names == lk.partidas.schema.names
    assert stored.partidas.exceptAll(lk.partidas).isEmpty() and "Join" not in plan(stored.partidas)
    assert "Join" not in plan(stored.estatisticas)


def test_json_export_compressed(spark, tmp_path):
    rows = spark.range(50).select("id", F.lit("x").alias("nome"))
    export_json(rows, f"{tmp_path}/out", ["id DESC"], "gzip")
    assert glob.glob(f"{tmp_path}/out/*.json.gz") and not glob.glob(f"{tmp_path}/out/*.json")
    assert [r["id"] for r in spark.read.schema(rows.schema).json(f"{tmp_path}/out").collect()] == list(range(49, -1, -1))


def test_team_lists_are_built_after_the_grouping(spark):
    rows = [(1, 2000, 3, "B", 7, 2, 51.0, 9, 4), (1, 2000, 3, "A", 5, 1, 49.0, 8, None)]
    df = spark.createDataFrame(rows, "partida_id long, temporada int, rodada int, clube string, chutes long, "
                                     "chutes_no_alvo long, posse_de_bola double, faltas long, escanteios long")
    docs = FD.team_stats_docs(df)
    payload = docs.first()["payload"]
    assert payload.index('"name":"A"') < payload.index('"name":"B"') and '"value":"51%"' in payload
    assert not [m for m in re.findall(r"collect_list\((.*)", plan(docs)) if "Total Shots" in m]


def test_served_tables_are_written_in_the_buckets_of_the_matches(spark, tmp_path):
    lk, buckets = Lake(spark, SF), 8
    served = registry_runs.with_served_matches(lk, "varzea_buckets", buckets, f"{tmp_path}/db")
    assert len(glob.glob(f"{tmp_path}/db/partidas/*.parquet")) == buckets == registry_runs.bucket_count(lk)
    matches = spark.table("varzea_buckets.partidas")
    assert matches.columns == lk.partidas.columns and lk.partidas.count() == matches.count()
    assert matches.exceptAll(lk.partidas).isEmpty()
    for rows in (served.estatisticas, gold_of(served)["campeonato_historico"]):
        by_bucket = plan(rows.repartition(buckets, "partida_id"))
        assert "Exchange" not in by_bucket and "Bucketed: true" in by_bucket
    name = registry_runs.served_database(lk)
    (where,) = spark.sql(f"DESCRIBE DATABASE {name}").filter("info_name = 'Location'").select("info_value").first()
    for table in ("partidas", "estatisticas", "campeonato_historico"):
        assert len(glob.glob(f"{where.removeprefix('file:')}/{table}/*.parquet")) == buckets
    assert spark.table(f"{name}.estatisticas").exceptAll(lk.estatisticas).isEmpty()
    assert spark.table(f"{name}.estatisticas").count() == lk.estatisticas.count()


def test_matches_are_shuffled_into_buckets_narrow(spark):
    text = Lake(spark, SF).partidas_in(8)._jdf.queryExecution().optimizedPlan().toString()
    at = text.index("RepartitionByExpression")
    assert "Arena" in text[:at] and "Arena" not in text[at:] and "notStarted" not in text[at:]


def test_documents_are_parsed_once(spark, tmp_path):
    fixture = '{"fixture":{"id":%d},"goals":{"home":1,"away":0}}'
    lines = ['{"response":[%s,null,%s]}' % (fixture % 1, fixture % 2), '{"response":[]}', '{"response":null}', "{}", "[", ""]
    spark.createDataFrame([(x,) for x in lines], "payload string").write.text(f"{tmp_path}/lines")
    rows = J.flatten_fixtures(FS.read_payloads(spark, f"{tmp_path}/lines", whole_file=False).select("payload"))
    assert rows._jdf.queryExecution().executedPlan().toString().count("from_json(") == 1
    assert sorted(rows.select("partida_id", "gols_mandante").collect(), key=str) == [(1, 1), (2, 1), (None, None)]


def test_statistics_map_is_made_once_a_team(spark):
    items = [("Fouls", "3"), ("Fouls", "4"), (None, "9"), ("Ball Possession", " 55% "), ("Passes %", "x%")]
    listed = ",".join("{%s\"value\":\"%s\"}" % (f'"type":"{k}",' if k else "", v) for k, v in items)
    docs = [('{"response":[{"team":{"name":"A"},"statistics":[%s]},{"team":{"name":"B"}},null]}' % listed,), ('{"response":[]}',)]
    rows = J.flatten_team_stats(spark.createDataFrame(docs, "payload string"))
    assert plan(rows).count("map_from_entries(") == 1
    got = [(r.clube, r.faltas, r.posse_de_bola, r.precisao_passes, r.chutes) for r in rows.collect()]
    assert sorted(got, key=str) == [("A", 4, 55.0, None, None), ("B", None, None, None, None), (None,) * 5]
