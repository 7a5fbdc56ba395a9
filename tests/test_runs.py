"""Commits of whole seasons, refresh through gold, runs that go on where they stopped."""
import json
import os

import pytest
from pyspark.sql import functions as F

from varzea.plans import pipeline
from varzea.plans.ledger import Ledger
from varzea.sources import feeds as FD
from varzea.sources import files as FS
from varzea.sources.seasons import commit_seasons, current, notes, read_seasons, vacuum, versions
from varzea.sources.sinks import write_table
from varzea.streaming.refresh import conform, merge_rows, refresh_lake, refresh_stream


def _rows(spark, *rows):
    return spark.createDataFrame(list(rows), "partida_id long, temporada int, gols long")


def _set(df):
    return {tuple(r) for r in df.select("partida_id", "temporada", "gols").collect()}


def test_a_commit_is_seen_whole_or_not_at_all(spark, tmp_dir):
    table = f"{tmp_dir}/t"
    commit_seasons(_rows(spark, (1, 2000, 1), (2, 2001, 1), (3, 2002, 1)), table)
    held = read_seasons(spark, table)
    broken = _rows(spark, (1, 2000, 9), (2, 2001, 9)).withColumn(  # lost after the first season's files are there
        "gols", F.when(F.col("temporada") == 2001, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("gols")))
    with pytest.raises(Exception, match="lost"):
        commit_seasons(broken, table)
    old = {(1, 2000, 1), (2, 2001, 1), (3, 2002, 1)}
    assert _set(held) == old == _set(read_seasons(spark, table))
    # the driver was lost between the tasks and the mark: files, but no _SUCCESS
    (_rows(spark, (1, 2000, 7)).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
     .partitionBy("temporada").mode("overwrite").parquet(f"{table}/v=00000005"))
    assert _set(read_seasons(spark, table)) == old
    assert commit_seasons(_rows(spark, (1, 2000, 2), (2, 2001, 2)), table) == {"version": 6, "rows": 2}
    new = {(1, 2000, 2), (2, 2001, 2), (3, 2002, 1)}
    assert _set(read_seasons(spark, table)) == new
    assert _set(held) == old  # a reader keeps what it planned
    vacuum(spark, table, keep=1)
    assert _set(read_seasons(spark, table)) == new
    assert sorted(d for d in os.listdir(table)) == ["v=00000001", "v=00000006"]


def test_a_plain_table_takes_commits(spark, tmp_dir):
    table = f"{tmp_dir}/t"
    write_table(_rows(spark, (1, 2000, 1), (2, 2001, 1)), table, partition_by=["temporada"])
    assert merge_rows(spark, table, _rows(spark, (2, 2001, 5), (4, 2001, 4), (9, 1999, 3)), ["partida_id"]) == [1999, 2001]
    want = {(1, 2000, 1), (2, 2001, 5), (4, 2001, 4), (9, 1999, 3)}
    assert _set(read_seasons(spark, table)) == want
    assert current(spark, table) == {"1999": 1, "2000": 0, "2001": 1}
    assert merge_rows(spark, table, _rows(spark).filter("false"), ["partida_id"]) == []
    for _ in range(2):
        merge_rows(spark, table, _rows(spark, (2, 2001, 6)), ["partida_id"])
    vacuum(spark, table)
    assert versions(spark, table) == {"1999": [1], "2000": [0], "2001": [2, 3]}
    assert _set(read_seasons(spark, table)) == want - {(2, 2001, 5)} | {(2, 2001, 6)}


def test_few_files_a_season(spark, tmp_dir):
    rows = spark.range(0, 20_000, 1, 16).select(F.col("id").alias("partida_id"), (F.col("id") % 5 + 2000).cast("int").alias("temporada"),
                                                F.col("id").alias("gols"))
    commit_seasons(rows, f"{tmp_dir}/t")
    write_table(rows, f"{tmp_dir}/w", partition_by=["temporada"])
    for top in ("t/v=00000001", "w"):
        for season in range(2000, 2005):
            names = os.listdir(f"{tmp_dir}/{top}/temporada={season}")
            assert len([n for n in names if n.endswith(".parquet")]) == 1


def _season_docs(rows):
    return FD.in_envelope(FD.fixture_docs(rows), "fixtures", season=F.col("temporada")).select("payload")


def test_many_seasons_in_one_stream(spark, lake, tmp_dir):
    """A mixed backlog gives the same table in one batch, file by file, and replayed."""
    seasons = (1999, 2000, 2001)
    true = lake.partidas.filter(F.col("temporada").isin(*seasons) & (F.col("rodada") <= 3))
    early = true.withColumn("gols_mandante", F.col("gols_mandante") + 5)
    landing = f"{tmp_dir}/landing"
    for docs in (early, true):  # one after the other; the later files win
        _season_docs(docs).repartition(3).write.mode("append").text(landing)
    stored = []
    for name, split in (("one", None), ("many", 1)):
        table, state = f"{tmp_dir}/{name}", f"{tmp_dir}/state-{name}"
        commit_seasons(conform(lake.partidas.filter("rodada > 3 OR temporada < 1998")), table)
        refresh_stream(spark, landing, table, state, max_files_per_trigger=split)
        stored.append(read_seasons(spark, table))
    assert stored[0].exceptAll(stored[1]).count() == stored[1].exceptAll(stored[0]).count() == 0
    before = current(spark, f"{tmp_dir}/one")
    refresh_stream(spark, landing, f"{tmp_dir}/one", f"{tmp_dir}/another-state")  # replayed from the start
    again = read_seasons(spark, f"{tmp_dir}/one")
    assert again.exceptAll(stored[1]).count() == 0 and again.count() == stored[1].count()
    after = current(spark, f"{tmp_dir}/one")
    assert {s for s in after if after[s] != before[s]} == {str(s) for s in seasons}  # the other seasons stay where they are
    got = stored[0].join(true.select("partida_id", F.col("gols_mandante").alias("g")), "partida_id")
    assert got.count() == true.count() and got.filter("NOT gols_mandante <=> g").count() == 0


def test_documents_without_a_season_are_left_out(spark, lake, tmp_dir):
    commit_seasons(conform(lake.partidas.filter("temporada = 2000")), f"{tmp_dir}/t")
    FD.fixture_docs(lake.partidas.filter("temporada = 2001")).select("payload").write.text(f"{tmp_dir}/landing")
    refresh_stream(spark, f"{tmp_dir}/landing", f"{tmp_dir}/t", f"{tmp_dir}/state")
    assert set(current(spark, f"{tmp_dir}/t")) == {"2000"}


def test_last_line_wins_in_a_file_of_many_splits(spark, tmp_dir):
    doc = '{"response":[{"fixture":{"id":%d,"date":"2001-05-01T16:00:00+00:00","status":{"short":"FT"},"venue":{"name":"%s"}},' \
          '"league":{"round":"Regular Season - 1","season":2001},"teams":{"home":{"id":1,"name":"A"},"away":{"id":2,"name":"B"}},' \
          '"goals":{"home":%d,"away":0}}]}'
    os.makedirs(f"{tmp_dir}/landing")
    with open(f"{tmp_dir}/landing/docs.jsonl", "w") as f:
        for k in range(6000):
            f.write(doc % (k % 7, "x" * 40, 6000 - k) + "\n")  # later lines have fewer goals
    want = {i: 6000 - max(k for k in range(6000 - 7, 6000) if k % 7 == i) for i in range(7)}
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        raw = FS.read_payloads(spark, f"{tmp_dir}/landing", whole_file=False)
        assert raw.rdd.getNumPartitions() > 10
        from varzea.operators import payloads as J
        from varzea.operators.upsert import TABLE_KEYS, merge_documents
        rows = merge_documents(None, J.flatten_fixtures(raw.select("payload", "_doc")), TABLE_KEYS["partidas"])
        assert {r.partida_id: r.gols_mandante for r in rows.collect()} == want
        commit_seasons(conform(spark.createDataFrame([(99, 2001)], "partida_id long, temporada int")), f"{tmp_dir}/t")
        refresh_stream(spark, f"{tmp_dir}/landing", f"{tmp_dir}/t", f"{tmp_dir}/state")
        got = read_seasons(spark, f"{tmp_dir}/t").filter("partida_id <> 99")
        assert {r.partida_id: r.gols_mandante for r in got.collect()} == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


@pytest.fixture()
def small_lake(spark, lake, tmp_dir):
    some = lake.partidas.filter("temporada IN (1998, 1999, 2000)")
    commit_seasons(conform(some), f"{tmp_dir}/silver/partidas")
    for name in ("gols", "cartoes"):
        commit_seasons(getattr(lake, name).filter("temporada IN (1998, 1999, 2000)"), f"{tmp_dir}/silver/{name}")
    pipeline.refresh_gold(spark, f"{tmp_dir}/silver", f"{tmp_dir}/gold")
    return some


def test_refresh_goes_on_to_gold_of_the_changed_seasons(spark, small_lake, tmp_dir, monkeypatch):
    silver, gold = f"{tmp_dir}/silver", f"{tmp_dir}/gold"
    first = {t: current(spark, f"{gold}/{t}") for t in pipeline.GOLD_TABLES}
    assert pipeline.refresh_gold(spark, silver, gold) == []  # nothing new
    changed = small_lake.filter("temporada IN (1999, 2000) AND rodada = 2").withColumn("gols_mandante", F.lit(30).cast("long"))
    _season_docs(changed).write.text(f"{tmp_dir}/landing")
    plans = []
    build = pipeline.build_gold

    def watched(*args):
        out = build(*args)
        plans.extend(df._jdf.queryExecution().toString() for df in out.values())
        return out
    monkeypatch.setattr(pipeline, "build_gold", watched)
    assert refresh_lake(spark, f"{tmp_dir}/landing", silver, gold, f"{tmp_dir}/state") == [1999, 2000]
    for t in pipeline.GOLD_TABLES:
        now = current(spark, f"{gold}/{t}")
        assert now["1998"] == first[t]["1998"] and now["1999"] > first[t]["1999"] and now["2000"] > first[t]["2000"]
    scans = [line for plan in plans for line in plan.splitlines() if "FileScan parquet" in line]
    assert scans and all("PartitionFilters: [temporada" in line and "IN (1999,2000)" in line for line in scans)
    whole = pipeline.build_gold(read_seasons(spark, f"{silver}/partidas"), read_seasons(spark, f"{silver}/gols"),
                                read_seasons(spark, f"{silver}/cartoes"))
    for t, want in whole.items():
        got = read_seasons(spark, f"{gold}/{t}").select(*want.columns)
        assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()


def test_gold_that_was_not_finished_is_made_good(spark, small_lake, tmp_dir, monkeypatch):
    silver, gold = f"{tmp_dir}/silver", f"{tmp_dir}/gold"
    merge_rows(spark, f"{silver}/partidas", conform(small_lake.filter("temporada = 2000").limit(3)), ["partida_id"])
    commit = pipeline.commit_seasons

    def lost(df, path, note=None):
        if path.endswith("rebaixamento_acesso"):
            raise RuntimeError("driver lost")
        return commit(df, path, note)
    monkeypatch.setattr(pipeline, "commit_seasons", lost)
    with pytest.raises(RuntimeError):
        pipeline.refresh_gold(spark, silver, gold)
    monkeypatch.setattr(pipeline, "commit_seasons", commit)
    assert pipeline.refresh_gold(spark, silver, gold) == [2000]
    assert notes(spark, f"{gold}/rebaixamento_acesso")["2000"]["2000"] == {"partidas": 2, "gols": 1, "cartoes": 1}
    assert pipeline.refresh_gold(spark, silver, gold) == []


def test_a_run_goes_on_where_it_stopped(spark, tmp_dir, monkeypatch):
    from tests.conftest import SF_SMOKE
    dest = f"{tmp_dir}/lake"
    write = pipeline.export_json

    def full(df, path, order=None):
        if path.endswith("/fair_play"):
            raise RuntimeError("disk full")
        write(df, path, order)
    monkeypatch.setattr(pipeline, "export_json", full)
    with pytest.raises(RuntimeError):
        pipeline.build_all(spark, raw_root=SF_SMOKE, dest=dest)
    monkeypatch.setattr(pipeline, "export_json", write)
    second = pipeline.build_all(spark, raw_root=SF_SMOKE, dest=dest)
    assert second["skipped"][:2] == ["silver", "gold"] and second["ran"][0] == "export_fair_play"
    assert second["silver_counts"]["partidas"] > 0 and os.path.exists(f"{dest}/json/fair_play/_SUCCESS")
    third = pipeline.build_all(spark, raw_root=SF_SMOKE, dest=dest)
    assert third["ran"] == [] and third["gold_counts"] == second["gold_counts"]


def test_a_step_runs_again_when_its_inputs_change(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    source = f"{tmp_dir}/in/a.txt"
    with open(source, "w") as f:
        f.write("1")
    seen = []

    def run():
        ledger = Ledger(spark, f"{tmp_dir}/steps")
        ledger.step("first", lambda: seen.append("first"))
        ledger.step("second", lambda: seen.append("second") or {"n": 1}, [f"{tmp_dir}/in"])
        assert ledger.step("third", lambda: seen.append("third") or [3]) == [3]
    run()
    run()
    assert seen == ["first", "second", "third"]
    with open(source, "w") as f:
        f.write("22")
    run()
    assert seen == ["first", "second", "third", "second", "third"]  # what comes after runs again too
    assert json.load(open(f"{tmp_dir}/steps/second.json"))["result"] == {"n": 1}


def test_the_bytes_of_a_csv_file_decide(spark, tmp_dir):
    d = f"{tmp_dir}/c s[v]"
    os.makedirs(d)
    files = {"utf8.csv": 'a,b\n1,"São�\nPaulo ""x"""\n2,plain\n'.encode(), "latin.csv": "a,b\n3,São\n4,pão\n".encode("latin-1"),
             "both.csv": 'a,b\n5,"é\nê"\n'.encode("latin-1"), "empty.csv": b"", "bom.csv": "﻿a,b\n6,ção\n".encode()}
    for name, raw in files.items():
        with open(f"{d}/{name}", "wb") as f:
            f.write(raw)
    got = FS.read_csv_any(spark, d.replace("[", "\\[").replace("]", "\\]"), ["a", "b"])
    assert {(r.a, r.b) for r in got.collect()} == {("1", 'São�\nPaulo "x"'), ("2", "plain"), ("3", "São"), ("4", "pão"),
                                                   ("5", "é\nê"), ("6", "ção")}


@pytest.mark.parametrize("buckets", [4, 16])
def test_served_tables_join_bucket_by_bucket(spark, lake, buckets, tmp_dir):
    from varzea.plans.queries import medias_estatisticas
    from varzea.sources.sinks import MATCH_BUCKETS, publish_catalog
    base = f"varzea_k05_{buckets}"
    publish_catalog(spark, {"partidas": lake.partidas, "estatisticas": lake.estatisticas}, base, bucket_by=MATCH_BUCKETS,
                    buckets=buckets, location=f"{tmp_dir}/db")
    files = [n for n in os.listdir(f"{tmp_dir}/db/partidas") if n.endswith(".parquet")]
    assert len(files) == buckets
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = medias_estatisticas(spark.table(f"{base}.estatisticas"), spark.table(f"{base}.partidas"))
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1  # the last aggregate's
        want = medias_estatisticas(lake.estatisticas, lake.partidas)
        assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_published_views_follow_their_tables(spark, lake, tmp_dir):
    from varzea.operators.gold import VIEW_BUILDERS
    from varzea.sources.fixtures import gold_of
    from varzea.sources.sinks import publish_catalog, publish_views
    gold = gold_of(lake)
    tables = {n: gold[n] for n in pipeline.GOLD_TABLES}
    for times in range(2):  # replaced, in order, while they are there
        publish_catalog(spark, tables, "varzea_v06", location=f"{tmp_dir}/db")
        assert publish_views(spark, "varzea_v06") == list(VIEW_BUILDERS)
    other = spark.newSession()
    for name, (source, build) in VIEW_BUILDERS.items():
        got, want = other.table(f"varzea_v06.{name}"), build(other.table(f"varzea_v06.{source}"))
        assert got.columns == want.columns
        assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()


def test_long_integers_keep_their_digits(spark):
    from varzea.functions.columns import safe_int
    rows = [("9007199254740993", 9007199254740993), (" -12 ", -12), ("3.0", 3), ("nan", 0), ("x", 0), (None, 0), ("1e3", 1000),
            ("99999999999999999999", 0)]
    df = spark.createDataFrame(rows, "t string, want long")
    assert df.filter(safe_int("t") != F.col("want")).count() == 0
