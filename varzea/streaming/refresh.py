"""Incremental refresh jobs.

Stored tables are Parquet partitioned by season (``varzea.sources.seasons``).
A refresh merges new provider rows into the seasons they belong to and commits
those seasons whole: readers see the old rows or the new ones, never a mixture,
and seasons without new rows are neither read nor written.

A merge is a deterministic function of its inputs, so a replayed micro-batch or
a retried job stores the same rows (idempotent).  The streaming variant (U7) is
a file-source stream of payload documents with ``trigger(availableNow=True)``
and ``foreachBatch``; no state store is needed because the merge state *is* the
table.  ``refresh_lake`` goes on to gold: it rebuilds the gold rows of the
seasons whose silver rows are newer, and those alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varzea.operators import payloads as J
from varzea.operators.upsert import TABLE_KEYS, last_synced_rounds, merge_documents, new_or_changed, update_season
from varzea.sources.seasons import commit_seasons, has_seasons, read_seasons


def run_update_season(spark: SparkSession, table_dir: str, fixtures_raw: DataFrame, season: int,
                      staging: str | None = None, mode: str = "differs") -> int:
    """U5 job: provider fixture documents (``payload`` column, optional
    ``temporada`` context) -> merged into the stored season.  Returns the
    number of rows now stored for the season.  (``staging`` is not needed any
    more: a commit is a folder of its own.)"""
    existing = read_seasons(spark, table_dir)
    merged = update_season(existing, J.flatten_fixtures(fixtures_raw), season, mode=mode)
    return commit_seasons(merged.select(*_table_order(existing, merged)), table_dir)["rows"]


def _table_order(existing: DataFrame, merged: DataFrame) -> list:
    """The stored schema is the contract: keep its columns and order (a
    column the table does not have is not written, so every season folder
    keeps one schema).  Build the table with ``conform`` to carry all silver
    match columns."""
    return [F.col(c) if c in merged.columns else F.lit(None).cast(existing.schema[c].dataType).alias(c)
            for c in existing.columns]


# The silver match columns (catalogue order).
MATCH_SCHEMA = ("partida_id BIGINT, temporada INT, rodada INT, data DATE, hora STRING, mandante STRING, "
                "visitante STRING, formacao_mandante STRING, formacao_visitante STRING, tecnico_mandante STRING, "
                "tecnico_visitante STRING, vencedor STRING, arena STRING, gols_mandante BIGINT, "
                "gols_visitante BIGINT, estado_mandante STRING, estado_visitante STRING, status STRING, "
                "fonte STRING, mandante_id BIGINT, visitante_id BIGINT")


def conform(df: DataFrame, schema: str = MATCH_SCHEMA) -> DataFrame:
    """Cast / fill ``df`` to the silver match schema (missing -> null)."""
    st = df.sparkSession.createDataFrame([], schema).schema
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in st.fields])


def _lines(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None) -> DataFrame:
    """Stream of the lines of landed files, a file read in as many splits as
    its size asks for, with the file's time and name and the split's place."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(source_dir).select(
        F.col("value").alias("payload"), F.col("_metadata.file_modification_time").alias("_time"),
        F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_block_start").alias("_start"))


def _documents(batch: DataFrame) -> DataFrame:
    """payload and ``_doc`` (what orders the documents) of a micro-batch."""
    return J.with_place(batch).filter(F.trim("payload") != "")


def _run(stream: DataFrame, checkpoint: str, merge_batch: Callable[[DataFrame, int], None]) -> None:
    q = (stream.writeStream.foreachBatch(merge_batch).option("checkpointLocation", f"{checkpoint.rstrip('/')}/state")
         .trigger(availableNow=True).start())
    q.awaitTermination()


def merge_rows(spark: SparkSession, table_dir: str, new: DataFrame, keys: list[str]) -> list[int]:
    """Last-wins merge of ``new`` into every season it has rows of (the table
    is created when absent): one merge, one commit.  Returns the seasons; only
    their folders are read."""
    touched = sorted(r[0] for r in new.select("temporada").filter("temporada IS NOT NULL").distinct().collect())
    if not touched:
        return []
    new = new.filter(F.col("temporada").isin(touched))
    if has_seasons(spark, table_dir):
        existing = read_seasons(spark, table_dir)
        merged = merge_documents(existing.filter(F.col("temporada").isin(touched)), new, keys)
        merged = merged.select(*_table_order(existing, merged))
    else:
        merged = merge_documents(None, new, keys)
    commit_seasons(merged, table_dir)
    return touched


def _merge_fixtures(spark: SparkSession, table_dir: str, documents: DataFrame, season: int | None, mode: str) -> list[int]:
    """U5 for documents of any seasons; ``season`` stands in for documents that do not tell theirs."""
    if mode not in ("differs", "source"):
        raise ValueError(f"unknown mode {mode!r}")
    rows = J.flatten_fixtures(documents, with_season=True)
    if season is not None:
        rows = rows.withColumn("temporada", F.coalesce("temporada", F.lit(season).cast("int")))
    rows = rows.withColumn("fonte", F.lit(J.FONTE_A))
    if mode == "source":
        rows = new_or_changed(rows, last_synced_rounds(read_seasons(spark, table_dir)))
    return merge_rows(spark, table_dir, rows, TABLE_KEYS["partidas"])


def refresh_stream(spark: SparkSession, source_dir: str, table_dir: str, checkpoint: str,
                   season: int | None = None, max_files_per_trigger: int | None = None, mode: str = "differs",
                   max_malformed: float = 0.0) -> None:
    """Fixture documents landing as JSON Lines in ``source_dir`` are
    merged into ``table_dir`` as they arrive.  Runs every available file and
    stops (``availableNow``); call again (or with a different trigger) for
    the next round.  ``checkpoint`` must be on the shared file system.
    ``max_files_per_trigger`` splits a backlog into several micro-batches;
    each one is merged in turn.

    A document's season is its own (``league.season`` or
    ``parameters.season``), so a backlog may mix seasons: all seasons of a
    micro-batch are merged and committed together.  ``season`` is for
    documents that tell none; without it they are left out.

    Of several documents of one match the one of the latest file wins, then
    the last line, whatever the splits (the source takes files in time order).
    ``mode`` as in U5; a batch with more than ``max_malformed`` of its
    documents malformed stops the stream."""
    def merge_batch(batch: DataFrame, epoch_id: int) -> None:
        documents = _documents(batch)
        J.reject_malformed(documents, max_malformed)
        _merge_fixtures(spark, table_dir, documents, season, mode)

    _run(_lines(spark, source_dir, max_files_per_trigger), checkpoint, merge_batch)


def merge_documents_into_silver(spark: SparkSession, documents: DataFrame, silver_root: str,
                                season: int | None = None, mode: str = "differs") -> dict[str, list[int]]:
    """Provider A documents of all kinds (``payload``, ``_doc``; the envelope
    tells the endpoint and the match) merged into the silver tables: matches
    first, then goals and cards of finished matches, tagged with the stored
    match's season and round.  Returns the seasons that each table committed."""
    root = silver_root.rstrip("/")
    opened = J.with_envelope(documents)

    def of(endpoint: str) -> DataFrame:
        return opened.filter(F.col("endpoint") == endpoint)

    out = {"partidas": _merge_fixtures(spark, f"{root}/partidas", of("fixtures").select("payload", J.DOC), season, mode)}
    events = of("fixtures/events").select(F.col("params")["fixture"].try_cast("bigint").alias("partida_id"), "payload", J.DOC)
    if events.isEmpty():
        return out
    parents = J.finished(read_seasons(spark, f"{root}/partidas")).select("partida_id", "temporada", "rodada")
    gols, cartoes = J.flatten_events(events)
    for table, rows in (("gols", gols), ("cartoes", cartoes)):
        tagged = rows.join(parents, "partida_id").withColumn("fonte", F.lit(J.FONTE_A))
        out[table] = merge_rows(spark, f"{root}/{table}", tagged, TABLE_KEYS[table])
    return out


def refresh_lake(spark: SparkSession, source_dir: str, silver_root: str, gold_root: str, checkpoint: str,
                 season: int | None = None, max_files_per_trigger: int | None = None, mode: str = "differs",
                 max_malformed: float = 0.0, api_mode: str = "prefer") -> list[int]:
    """U7 + G7, the weekly run: every document that has landed is merged into
    silver, then the six gold tables are brought up to date.  Gold knows from
    which silver versions each season was built, so a run that stopped between
    the two is made good by the next one, and a season without news is neither
    read nor written.  Returns the seasons rebuilt."""
    from varzea.plans.pipeline import refresh_gold

    def merge_batch(batch: DataFrame, epoch_id: int) -> None:
        documents = _documents(batch)
        J.reject_malformed(documents, max_malformed)
        merge_documents_into_silver(spark, documents, silver_root, season, mode)

    _run(_lines(spark, source_dir, max_files_per_trigger), checkpoint, merge_batch)
    return refresh_gold(spark, silver_root, gold_root, api_mode)


def backfill_events(gols: DataFrame, cartoes: DataFrame, incidents_raw: DataFrame,
                    matches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Provider incidents of past seasons -> goals and cards merged into
    the stored tables by their keys (last wins), matches untouched.  Club and
    season come from the provider's own match rows (``matches``: partida_id,
    temporada, rodada, mandante, visitante); the provider ids do not join to
    historical CSV ids, so these rows drop out of inner joins with matches."""
    g_new, c_new = J.flatten_incidents(incidents_raw)
    g_new = J.tag(g_new, matches, J.FONTE_B, sides=True).drop("lado")
    c_new = J.tag(c_new, matches, J.FONTE_B, sides=True).drop("lado")
    return (merge_documents(gols, g_new, TABLE_KEYS["gols"]),
            merge_documents(cartoes, c_new, TABLE_KEYS["cartoes"]))


__all__ = ["backfill_events", "conform", "ingest_season", "ingest_season_b", "merge_documents_into_silver", "merge_rows",
           "merge_season", "refresh_lake", "refresh_stream", "run_update_season"]


def merge_season(spark: SparkSession, table_dir: str, new_rows: DataFrame, keys: list[str], season: int,
                 staging: str | None = None) -> int:
    """Last-wins merge of ``new_rows`` into one season of a season-partitioned
    table (created when absent); returns the season's row count."""
    merge_rows(spark, table_dir, new_rows.filter(F.col("temporada") == season), keys)
    if not has_seasons(spark, table_dir):
        return 0
    return read_seasons(spark, table_dir).filter(F.col("temporada") == season).count()


def ingest_season(spark: SparkSession, landing: str, silver_root: str, season: int,
                  staging_root: str | None = None, fixtures_only: bool = False, max_malformed: float = 0.0) -> dict[str, int]:
    """U5, complete: one season of provider A payload files (the API cache
    layout, ``{endpoint}__{params}.json``) merged into the silver tables.

    fixtures -> matches (U3/U4/J1/U1, season folder only); standings ->
    ``classificacao`` by (season, club); per-fixture statistics / events /
    line-ups of *finished* fixtures (J10), tagged with season and round from
    their fixture (J11), merged by the table keys (U2).  ``fixtures_only``
    stops after the matches.  Returns the row count of each touched season
    folder."""
    from varzea.sources.files import read_payloads
    root = silver_root.rstrip("/")
    raw = read_payloads(spark, landing)
    prm = F.col("params")
    J.reject_malformed(raw, max_malformed)
    fx_raw = (raw.filter((F.col("endpoint") == "fixtures") & (prm["season"] == str(season)))
              .select(F.lit(season).cast("int").alias("temporada"), "payload", J.DOC))
    out = {"partidas": run_update_season(spark, f"{root}/partidas", fx_raw, season)}
    if fixtures_only:
        return out
    parents = (J.finished(merge_documents(None, J.flatten_fixtures(fx_raw), TABLE_KEYS["partidas"]))
               .select("partida_id", "temporada", "rodada", "mandante", "visitante"))

    def detail(endpoint: str) -> DataFrame:
        return (raw.filter(F.col("endpoint") == endpoint)
                .select(prm["fixture"].cast("bigint").alias("partida_id"), "payload", J.DOC))

    def tagged(df: DataFrame) -> DataFrame:
        return J.tag(df, parents, J.FONTE_A)

    stats = tagged(J.flatten_team_stats(detail("fixtures_statistics")))
    gols, cartoes = J.flatten_events(detail("fixtures_events"))
    lineups = tagged(J.flatten_lineups(detail("fixtures_lineups")))
    standings = (J.flatten_standings(raw.filter((F.col("endpoint") == "standings")
                                                & (prm["season"] == str(season))).select("payload", J.DOC))
                 .withColumn("temporada", F.lit(season).cast("int")).withColumn("fonte", F.lit(J.FONTE_A)))
    for table, df in [("estatisticas", stats), ("gols", tagged(gols)), ("cartoes", tagged(cartoes)),
                      ("escalacoes", lineups), ("classificacao", standings)]:
        out[table] = merge_season(spark, f"{root}/{table}", df, TABLE_KEYS[table], season)
    return out


# Season -> the provider's own season number.
SEASON_IDS_B = {
    2003: 90151, 2004: 90149, 2005: 10050, 2006: 90145, 2007: 89936, 2008: 1223, 2009: 2079, 2010: 2684,
    2011: 3311, 2012: 4438, 2013: 6075, 2014: 7778, 2015: 10173, 2016: 11429, 2017: 13100, 2018: 16183,
    2019: 22931, 2020: 27591, 2021: 36166, 2022: 40557, 2023: 48982, 2024: 58766, 2025: 72034, 2026: 87678,
}


def ingest_season_b(spark: SparkSession, landing: str, silver_root: str, season: int,
                    staging_root: str | None = None, canonical: dict[str, str] | None = None,
                    fixtures_only: bool = False, max_malformed: float = 0.0, only_round: int | None = None,
                    season_ids: dict[int, int] | None = None) -> dict[str, int]:
    """Provider B season ingest.  Landing layout: the provider's cache files
    (``read_payloads``; its own season numbers come from ``season_ids``), or
    ``round__season{S}_round{R}.json`` (the round's event list) and
    ``event_statistics|event_incidents|event_lineups__match{id}.json`` per
    match.  ``only_round`` takes one round's matches and their details.

    Round lists -> matches (J6, club names canonicalised, season/round from
    the file) merged by id; details of *finished* matches (J10) -> J7/J8/J9,
    side labels turned into the match's club names (J11), merged by the table
    keys into the season's folders only."""
    from varzea.sources.files import read_payloads
    root = silver_root.rstrip("/")
    raw = read_payloads(spark, landing)
    prm = F.col("params")
    J.reject_malformed(raw, max_malformed)
    own_id = (SEASON_IDS_B if season_ids is None else season_ids).get(season)
    of_season = F.coalesce(prm["season"] == str(season), prm["season_id"] == str(own_id), F.lit(False))
    if only_round is not None:
        of_season = of_season & (prm["round"].cast("int") == only_round)
    rounds = (raw.filter((F.col("endpoint") == "round") & of_season)
              .select(F.lit(season).cast("int").alias("temporada"), prm["round"].cast("int").alias("rodada"),
                      "payload", J.DOC))
    matches = J.flatten_matches(rounds, canonical=canonical if canonical is not None else {})
    out = {"partidas": merge_season(spark, f"{root}/partidas", matches, TABLE_KEYS["partidas"], season)}
    if fixtures_only:
        return out
    last = merge_documents(None, matches, TABLE_KEYS["partidas"])
    parents = J.finished(last).select("partida_id", "temporada", "rodada", "mandante", "visitante")

    def detail(endpoint: str) -> DataFrame:
        return (raw.filter(F.col("endpoint") == endpoint)
                .select(prm["match"].cast("bigint").alias("partida_id"), "payload", J.DOC))

    def tagged(df: DataFrame) -> DataFrame:
        return J.tag(df, parents, J.FONTE_B, sides=True).drop("lado")

    gols, cartoes = J.flatten_incidents(detail("event_incidents"))
    for table, df in [("estatisticas", tagged(J.flatten_stats(detail("event_statistics")))),
                      ("gols", tagged(gols)), ("cartoes", tagged(cartoes)),
                      ("escalacoes", tagged(J.flatten_squads(detail("event_lineups"))))]:
        out[table] = merge_season(spark, f"{root}/{table}", df, TABLE_KEYS[table], season)
    return out
