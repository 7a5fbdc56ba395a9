"""G7 / U8 jobs: materialise silver and gold, publish.

The lake's layers talk through Parquet: silver tables are written once
(matches partitioned by season, so season filters prune folders), and the
gold builders, views, queries and exports read them.  Writing a layer also
cuts the lineage: a lost executor re-reads Parquet instead of recomputing
the raw joins.  Folders live under the cluster's ``spark.checkpoint.dir``
unless the caller names one.
"""

from __future__ import annotations

from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varzea.operators.gold import VIEW_BUILDERS, build_gold
from varzea.plans.exports import EXPORT_ORDER, all_exports
from varzea.session import scratch_dir
from varzea.sources import sinks, storage
from varzea.sources.fixtures import Lake
from varzea.sources.seasons import commit_seasons, current, has_seasons, notes, read_seasons, vacuum
from varzea.sources.sinks import write_table

SILVER_TABLES = ["partidas_bruto", "partidas", "gols", "cartoes", "estatisticas", "escalacoes"]
# every silver table is partitioned by season: a refresh rewrites one season folder
PARTITION_BY = {t: ["temporada"] for t in SILVER_TABLES + ["classificacao"]}


#: For rows that come by season already.
commit_as_they_come = partial(commit_seasons, cluster=False)


def export_json(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """K3 as the build does it: gzip."""
    sinks.export_json(df, path, order, "gzip")


def build_silver(lk: Lake, dest: str | None = None) -> tuple[str, dict[str, int]]:
    """Write every silver table of ``lk``; returns (folder, row counts).

    Staged so the raw joins run once: the raw match rows are written first,
    the one-row-per-match table is merged from that folder, and the
    statistics are derived from the written matches."""
    from varzea.sources.fixtures import merged_matches
    dest = dest or scratch_dir(lk.spark, "silver")
    counts = {}
    counts["partidas_bruto"] = write_table(lk.partidas_bruto, f"{dest}/partidas_bruto",
                                           partition_by=PARTITION_BY["partidas_bruto"], cluster=False)
    bruto = lk.spark.read.parquet(f"{dest}/partidas_bruto")
    partidas = merged_matches(bruto, ["partida_id"], F.col("partida_id"))
    counts["partidas"] = write_table(partidas, f"{dest}/partidas", partition_by=PARTITION_BY["partidas"], cluster=False)
    staged = SilverLake(lk.spark, dest, lk.root)
    counts["estatisticas"] = write_table(Lake.estatisticas.func(staged), f"{dest}/estatisticas",
                                         partition_by=PARTITION_BY["estatisticas"], cluster=False)
    for name in ["gols", "cartoes", "escalacoes"]:
        counts[name] = write_table(getattr(lk, name), f"{dest}/{name}", partition_by=PARTITION_BY[name])
    return dest, counts


def build_silver_from_csv(spark: SparkSession, csv_root: str, dest: str | None = None,
                          sep: str = ",") -> tuple[str, dict[str, int]]:
    """The historical CSV path (T7-T11): ``csv_root/{partidas,estatisticas,
    gols,cartoes}/*.csv`` in any of the accepted encodings.  Matches are
    written first, in the full silver match schema (provider columns such as
    ``status`` null), so later provider merges keep their columns; the other
    tables take their season from the written matches (T11), as the source
    orders its transforms."""
    from varzea.operators import silver as S
    from varzea.sources.files import read_csv_any
    dest = dest or scratch_dir(spark, "silver-csv")
    root = csv_root.rstrip("/")
    from varzea.streaming.refresh import conform
    matches = conform(S.silver_partidas(read_csv_any(spark, f"{root}/partidas", S.MATCH_COLUMNS, sep)))
    counts = {"partidas": write_table(matches, f"{dest}/partidas", partition_by=PARTITION_BY["partidas"])}
    partidas = spark.read.parquet(f"{dest}/partidas")
    S.assert_unique(partidas.filter("partida_id <> 0"), ["partida_id"])
    for name, fn, names, optional in [("estatisticas", S.silver_estatisticas, S.STATS_COLUMNS, 0),
                                      ("gols", S.silver_gols, S.GOALS_COLUMNS, 1),
                                      ("cartoes", S.silver_cartoes, S.CARDS_COLUMNS, 0)]:
        counts[name] = write_table(fn(read_csv_any(spark, f"{root}/{name}", names, sep, optional=optional), partidas),
                                   f"{dest}/{name}", partition_by=PARTITION_BY[name])
    return dest, counts


class SilverLake(Lake):
    """A lake whose silver tables are read from written Parquet folders;
    ``raw`` still reads the source tables (dimensions).  Each table is read
    once per lake (one relation instance), so plans that use a table twice
    can share its scans and shuffles."""

    def __init__(self, spark: SparkSession, silver_root: str, raw_root: str):
        super().__init__(spark, raw_root)
        self.silver_root = silver_root.rstrip("/")

    def _silver(self, name: str) -> DataFrame:
        return read_seasons(self.spark, f"{self.silver_root}/{name}")

    @cached_property
    def partidas_bruto(self) -> DataFrame:  # type: ignore[override]
        return self._silver("partidas_bruto")

    @cached_property
    def partidas(self) -> DataFrame:  # type: ignore[override]
        return self._silver("partidas")

    @cached_property
    def gols(self) -> DataFrame:  # type: ignore[override]
        return self._silver("gols")

    @cached_property
    def cartoes(self) -> DataFrame:  # type: ignore[override]
        return self._silver("cartoes")

    @cached_property
    def estatisticas(self) -> DataFrame:  # type: ignore[override]
        return self._silver("estatisticas")

    @cached_property
    def escalacoes(self) -> DataFrame:  # type: ignore[override]
        return self._silver("escalacoes")

    @cached_property
    def classificacao(self) -> DataFrame | None:
        """Provider standings, if any season has them."""
        if not has_seasons(self.spark, f"{self.silver_root}/classificacao"):
            return None
        return self._silver("classificacao")


class _DedupLake(SilverLake):
    """A silver lake whose matches come from the de-duplicated folder."""

    def __init__(self, spark: SparkSession, silver_root: str, raw_root: str, matches: str):
        super().__init__(spark, silver_root, raw_root)
        self._matches = matches

    @cached_property
    def partidas(self) -> DataFrame:  # type: ignore[override]
        return self.spark.read.parquet(self._matches)


GOLD_TABLES = ["campeonato_historico", "artilharia_historica", "desempenho_clubes", "fair_play",
               "classificacao_historica", "rebaixamento_acesso"]
#: What gold is built from; provider standings may be missing.
GOLD_SOURCES = ["partidas", "gols", "cartoes", "classificacao"]


def build_gold_tables(lk: Lake, dest: str | None = None, api_mode: str = "prefer",
                      note: dict | None = None) -> tuple[str, dict[str, int]]:
    """G7 job: the six gold tables, committed season by season in dependency
    order.  Provider standings are used when the lake has them: ``prefer``
    takes them season by season, ``replace`` (the source's rule) drops seasons
    without them.  ``note`` (what gold was built from) goes with the last
    table, so it is there only when all six are."""
    from varzea.operators.gold import GOLD_INPUT_COLUMNS, rebaixamento_acesso, require_tables
    dest = dest or scratch_dir(lk.spark, "gold")
    require_tables({"partidas": lk.partidas, "gols": lk.gols, "cartoes": lk.cartoes},
                   columns=GOLD_INPUT_COLUMNS)
    require_tables({"partidas": lk.partidas}, required=("partidas",), non_empty=True)
    gold = build_gold(lk.partidas, lk.gols, lk.cartoes, getattr(lk, "classificacao", None), api_mode)
    # G1 is the matches row by row, which come by season
    counts = {name: (commit_as_they_come if name == "campeonato_historico" else commit_seasons)(gold[name], f"{dest}/{name}")["rows"]
              for name in GOLD_TABLES[:-1]}
    # G6 reads G5 from its written folder, as the source does
    seasons = [r[0] for r in lk.partidas.select("temporada").distinct().collect()]  # one value a season
    classif = read_seasons(lk.spark, f"{dest}/classificacao_historica").filter(F.col("temporada").isin(seasons))
    counts["rebaixamento_acesso"] = commit_seasons(rebaixamento_acesso(classif), f"{dest}/rebaixamento_acesso", note)["rows"]
    return dest, counts


class _SeasonLake(SilverLake):
    """Some seasons of a silver lake; the other folders are not read."""

    def __init__(self, spark: SparkSession, silver_root: str, seasons: list[int]):
        super().__init__(spark, silver_root, silver_root)
        self._seasons = seasons

    def _silver(self, name: str) -> DataFrame:
        return super()._silver(name).filter(F.col("temporada").isin(self._seasons))


def stale_seasons(spark: SparkSession, silver_root: str, gold_root: str) -> tuple[list[int], dict]:
    """Seasons whose gold was not built from the silver versions that readers
    now take, and those versions (season -> table -> version)."""
    silver: dict[str, dict[str, int]] = {}
    for name in GOLD_SOURCES:
        if has_seasons(spark, f"{silver_root.rstrip('/')}/{name}"):
            for season, version in current(spark, f"{silver_root.rstrip('/')}/{name}").items():
                silver.setdefault(season, {})[name] = version
    built = notes(spark, f"{gold_root.rstrip('/')}/{GOLD_TABLES[-1]}")
    stale = [s for s, now in silver.items() if "partidas" in now and (built.get(s) or {}).get(s) != now]
    return sorted(int(s) for s in stale if s.isdigit()), silver


def refresh_gold(spark: SparkSession, silver_root: str, gold_root: str, api_mode: str = "prefer") -> list[int]:
    """G7, incremental: the six gold tables of the seasons that silver has
    changed since, from those seasons' rows.  Returns the seasons."""
    stale, silver = stale_seasons(spark, silver_root, gold_root)
    if stale:
        note = {str(s): silver[str(s)] for s in stale}
        build_gold_tables(_SeasonLake(spark, silver_root, stale), gold_root.rstrip("/"), api_mode, note)
        for root, names in ((silver_root, GOLD_SOURCES), (gold_root, GOLD_TABLES)):
            for name in names:
                vacuum(spark, f"{root.rstrip('/')}/{name}")
    return stale


def read_gold(spark: SparkSession, gold_root: str) -> dict[str, DataFrame]:
    g = {n: read_seasons(spark, f"{gold_root.rstrip('/')}/{n}") for n in GOLD_TABLES}
    for name, (src, fn) in VIEW_BUILDERS.items():
        g[name] = fn(g[src])
    return g


def build_all(spark: SparkSession, raw_root: str | None = None, dest: str | None = None,
              exports: bool = True, csv_root: str | None = None, landing_a: str | None = None,
              landing_b: str | None = None, seasons: tuple[int, ...] = (),
              dedup_matches: bool = False, api_mode: str = "prefer", resume: bool = True) -> dict[str, object]:
    """U8: land -> silver -> provider ingest -> gold -> views -> exports, in
    order; an exception stops the run (nothing later is written).

    Silver comes from the historical CSV files (``csv_root``, landed to
    bronze first) or from the driver's tables (``raw_root``).  ``landing_a`` /
    ``landing_b`` with ``seasons`` merge provider payloads season by season
    before gold is built.  ``dedup_matches`` (off by default) keeps one row
    per (season, round, home, away) when two sources filed the same match
    under different ids.  ``api_mode`` as in ``build_gold_tables``.

    A ledger in ``dest`` remembers the steps that finished; a second run over
    the same folder goes on from the first step that did not, or whose input
    files have changed (``resume``).  Returns the folders and row counts, and
    the names of the steps that ran and that were skipped."""
    from varzea.plans.ledger import Ledger
    from varzea.sources.files import land_raw
    from varzea.streaming.refresh import ingest_season, ingest_season_b
    dest = (dest or scratch_dir(spark, "lake")).rstrip("/")
    ledger = Ledger(spark, f"{dest}/_steps", resume)
    out: dict[str, object] = {}
    silver_root = f"{dest}/silver"

    def afresh() -> None:
        """Later commits to the seasons would hide what the step writes."""
        storage.delete(spark, silver_root)

    if csv_root:
        files = [f"{csv_root.rstrip('/')}/*/*.csv"]
        out["bronze_rows"] = ledger.step("bronze", lambda: land_raw(spark, files[0], f"{dest}/bronze", "csv").count(), files)
        silver_counts = ledger.step("silver", lambda: afresh() or build_silver_from_csv(spark, csv_root, silver_root)[1], files)
    elif raw_root:
        silver_counts = ledger.step("silver", lambda: afresh() or build_silver(Lake(spark, raw_root), silver_root)[1], [raw_root])
    else:
        raise ValueError("build_all needs csv_root or raw_root")
    out.update({"silver": silver_root, "silver_counts": silver_counts})
    for season in seasons:
        for provider, landing, ingest in (("a", landing_a, ingest_season), ("b", landing_b, ingest_season_b)):
            if landing:
                out[f"ingest_{provider}_{season}"] = ledger.step(
                    f"ingest_{provider}_{season}",
                    lambda season=season, landing=landing, ingest=ingest: ingest(spark, landing, silver_root, season), [landing])
    slk = SilverLake(spark, silver_root, raw_root or csv_root)
    if dedup_matches:
        from varzea.operators.upsert import dedup_matches as _dedup
        matches = f"{dest}/silver_dedup/partidas"
        out["dedup_matches"] = ledger.step("dedup_matches", lambda: write_table(_dedup(slk.partidas), matches,
                                                                                partition_by=["temporada"]))
        slk = _DedupLake(spark, silver_root, raw_root or csv_root, matches)
    gold_root = f"{dest}/gold"
    # the note lets a later refresh tell which seasons are new; a table of de-duplicated matches has no versions
    note = None if dedup_matches else stale_seasons(spark, silver_root, gold_root)[1]
    gold_counts = ledger.step("gold", lambda: build_gold_tables(slk, gold_root, api_mode, note)[1])
    gold = read_gold(spark, gold_root)
    for name, df in gold.items():
        df.createOrReplaceTempView(name)
    out.update({"gold": gold_root, "gold_counts": gold_counts})
    if exports:
        silver = {n: getattr(slk, n) for n in ["gols", "cartoes", "estatisticas"]}
        for name, df in all_exports(gold, silver).items():
            ledger.step(f"export_{name}", lambda name=name, df=df: export_json(df, f"{dest}/json/{name}", EXPORT_ORDER.get(name)))
        out["json"] = f"{dest}/json"
    out.update({"ran": ledger.ran, "skipped": ledger.skipped})
    return out
