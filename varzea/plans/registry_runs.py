"""Registrations: whole runs.  The weekly refresh (U7 + G7) and the complete
build (U8) write a lake into scratch folders; every table they leave has an
entry of its own, which reads it back.  The entries of one run share it: it is
made once per Spark application and folder of source tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varzea.plans.catalog import ORACLES, register
from varzea.plans.oracle import q, with_ctes
from varzea.session import scratch_dir
from varzea.sources import feeds as FD
from varzea.sources.fixtures import Lake
from varzea.sources.seasons import commit_seasons, read_seasons
from varzea.sources.sinks import write_table

_runs: dict[tuple, object] = {}


def _once(make: Callable[[Lake], object]) -> Callable[[Lake], object]:
    def run(lk: Lake):
        key = make.__name__, lk.spark.sparkContext.applicationId, lk.root
        if key not in _runs:
            _runs[key] = make(lk)
        return _runs[key]
    return run


def with_stored_matches(lk: Lake) -> tuple[Lake, int]:
    """The lake with its matches written once, by season: what reads them many
    times does not join and merge the source tables each time.  Also their number."""
    path = scratch_dir(lk.spark, "matches")
    n = write_table(lk.partidas, path, partition_by=["temporada"], cluster=False)
    stored = Lake(lk.spark, lk.root)
    stored.partidas = lk.spark.read.schema(lk.partidas.schema).parquet(path).select(*lk.partidas.columns)
    return stored, n


# ---- U7 + G7 ----------------------------------------------------------------------------------
REFRESHED, ROUNDS = (1999, 2000), (5, 6)
_IS_NEW = f"temporada IN {REFRESHED} AND rodada IN {ROUNDS}"


@_once
def refreshed_lake(lk: Lake) -> str:
    """A stored lake in which two rounds of two seasons have wrong scores and
    no goals or cards; then both rounds land as documents of both seasons, one
    round after the other, and each is carried through to gold.  Returns the
    gold folder."""
    from varzea.plans.pipeline import refresh_gold
    from varzea.streaming.refresh import conform, refresh_lake
    spark = lk.spark
    silver, gold, landing, state = (scratch_dir(spark, f"u07c-{n}") for n in ("silver", "gold", "landing", "state"))
    source, (lk, _) = lk, with_stored_matches(lk)
    new = F.expr(_IS_NEW)
    wrong = lk.partidas.withColumn("gols_mandante", F.when(new, F.col("gols_mandante") + 5).otherwise(F.col("gols_mandante")))
    commit_seasons(conform(wrong), f"{silver}/partidas", cluster=False)
    ids = lk.partidas.filter(new).select("partida_id")
    for name in ("gols", "cartoes"):
        commit_seasons(getattr(lk, name).join(ids, "partida_id", "left_anti"), f"{silver}/{name}")
    refresh_gold(spark, silver, gold)
    played = lk.partidas.filter(new)
    for rodada in ROUNDS:
        # documents land in the order of the merge: of several without a match id the last one wins
        landed = source.partidas.filter(new & (F.col("rodada") == rodada))
        fixtures = FD.in_envelope(FD.fixture_docs(landed), "fixtures", season=F.col("temporada"))
        here = played.filter(F.col("rodada") == rodada).select("partida_id")
        events = FD.in_envelope(FD.event_docs(lk.gols.join(here, "partida_id", "left_semi"), lk.cartoes.join(here, "partida_id", "left_semi")),
                                "fixtures/events", fixture=F.col("partida_id"))
        fixtures.select("payload").unionByName(events.select("payload")).write.mode("append").text(landing)
        refresh_lake(spark, landing, silver, gold, state)
    return gold


_NEW_ROWS = f"""
neu AS (SELECT partida_id, temporada, rodada FROM partidas WHERE {_IS_NEW}),
gols_neu AS (
  SELECT g.atleta, g.clube, coalesce(n.temporada, g.temporada) AS temporada,
         CASE WHEN n.partida_id IS NOT NULL AND g.tipo_de_gol = 'Gol Contra' THEN 'Own Goal' ELSE g.tipo_de_gol END AS tipo
  FROM gols g LEFT JOIN neu n USING (partida_id)),
cartoes_neu AS (
  SELECT c.partida_id, c.clube, c.cartao, coalesce(n.temporada, c.temporada) AS temporada
  FROM cartoes c LEFT JOIN neu n USING (partida_id))"""
_HORA = "lpad(CAST(10 + rodada AS VARCHAR), 2, '0') || ':00'"
_NULL = "CAST(NULL AS VARCHAR)"

_AFTER_REFRESH = {
    "campeonato_historico": q(f"""
SELECT partida_id, temporada, rodada, data, CASE WHEN neu THEN {_HORA} END AS hora, mandante, visitante,
       gols_mandante, gols_visitante, CASE WHEN NOT neu THEN vencedor END AS vencedor, arena,
       {_NULL} AS formacao_mandante, {_NULL} AS formacao_visitante, {_NULL} AS tecnico_mandante,
       {_NULL} AS tecnico_visitante, CASE WHEN NOT neu THEN estado_mandante END AS estado_mandante,
       CASE WHEN NOT neu THEN estado_visitante END AS estado_visitante,
       CASE WHEN gols_mandante > gols_visitante THEN 'mandante' WHEN gols_mandante < gols_visitante THEN 'visitante'
            ELSE 'empate' END AS resultado,
       gols_mandante + gols_visitante AS total_gols, CASE WHEN neu THEN 'api_football' ELSE fonte END AS fonte
FROM (SELECT *, {_IS_NEW} AS neu FROM partidas) p"""),
    "artilharia_historica": with_ctes(_NEW_ROWS, """
SELECT temporada, atleta, clube, count(*) AS total_gols, count(*) FILTER (tipo = 'Penalty') AS penaltis,
       CAST(0 AS BIGINT) AS gols_contra
FROM gols_neu WHERE tipo IS DISTINCT FROM 'Gol Contra' GROUP BY temporada, atleta, clube"""),
    "fair_play": with_ctes(_NEW_ROWS, """
SELECT temporada, clube, count(*) FILTER (cartao = 'Amarelo') AS amarelos, count(*) FILTER (cartao = 'Vermelho') AS vermelhos,
       CAST(sum(CASE cartao WHEN 'Amarelo' THEN 1 WHEN 'Vermelho' THEN 3 ELSE 0 END) AS BIGINT) AS pontos_fair_play,
       count(DISTINCT partida_id) AS partidas_com_cartao
FROM cartoes_neu GROUP BY temporada, clube"""),
}

for _t in ["campeonato_historico", "artilharia_historica", "desempenho_clubes", "fair_play", "classificacao_historica",
           "rebaixamento_acesso"]:
    # scores end as they were, so the tables of the clubs do too
    register(f"u07c_refreshed_{_t}", _AFTER_REFRESH.get(_t, ORACLES[_t]))(
        lambda lk, t=_t: read_seasons(lk.spark, f"{refreshed_lake(lk)}/{t}"))


#: Matches of a bucket, at most: its sort fits a task's memory, its file stays small.
BUCKET_ROWS = 1_000_000


# ---- K5 + V6 -----------------------------------------------------------------------------------
def bucket_count(lk: Lake) -> int:
    """Buckets for the matches of a lake.  A match is a line of an order, so
    there are no more of them than lines, whose number the files' footers tell."""
    return max(8, -(-lk.raw("lineitem").count() // BUCKET_ROWS))


def with_served_matches(lk: Lake, database: str, buckets: int, location: str) -> Lake:
    """The lake over its matches in ``database``, bucketed by match.  The one
    shuffle into buckets is that of the narrow matches; what follows from them
    row by row reads its bucket and is written to the same one."""
    from varzea.sources.sinks import MATCH_BUCKETS, bucket_reader, publish_catalog
    publish_catalog(lk.spark, {"partidas": lk.partidas_in(buckets)}, database, bucket_by=MATCH_BUCKETS, buckets=buckets,
                    location=location)
    served = Lake(bucket_reader(lk.spark), lk.root)
    served.partidas = served.spark.table(f"{database}.partidas")
    return served


@_once
def served_database(lk: Lake) -> str:
    """Matches and statistics bucketed by match, and the gold tables with
    their views, in a database of the catalog.  Returns its name."""
    from varzea.sources.fixtures import gold_of
    from varzea.sources.sinks import MATCH_BUCKETS, publish_catalog, publish_views
    name, buckets, location = f"varzea_{len(_runs)}", bucket_count(lk), scratch_dir(lk.spark, "k05-database")
    served = with_served_matches(lk, name, buckets, location)
    tables = {"estatisticas": served.estatisticas, **{n: df for n, df in gold_of(served).items() if not n.startswith("v_")}}
    publish_catalog(served.spark, tables, name, bucket_by=MATCH_BUCKETS, buckets=buckets, location=location)
    publish_views(lk.spark, name)
    return name


def _means_of_buckets(lk: Lake) -> DataFrame:
    """Q22 from the bucketed tables: the join reads buckets side by side."""
    from varzea.plans.queries import medias_estatisticas
    name = served_database(lk)
    return medias_estatisticas(lk.spark.table(f"{name}.estatisticas"), lk.spark.table(f"{name}.partidas"))


register("k05_medias_do_catalogo", ORACLES["q22_medias_estatisticas"])(_means_of_buckets)

for _view in ["v_artilharia_geral", "v_campeoes", "v_rebaixados", "v_desempenho_geral", "v_media_gols_temporada"]:
    # another session than the one that made the views
    register(f"v06_catalog_{_view}", ORACLES[_view])(
        lambda lk, v=_view: lk.spark.newSession().table(f"{served_database(lk)}.{v}"))


# ---- U8 ---------------------------------------------------------------------------------------
@_once
def built_lake(lk: Lake) -> dict:
    """The whole lake from the driver's tables into fresh folders."""
    from varzea.plans.pipeline import build_all
    return build_all(lk.spark, raw_root=lk.root, dest=scratch_dir(lk.spark, "u08-lake"), exports=True)


for _t in ["campeonato_historico", "artilharia_historica", "desempenho_clubes", "fair_play", "classificacao_historica",
           "rebaixamento_acesso"]:
    _name = "u08_build_all" if _t == "classificacao_historica" else f"u08_{_t}"
    register(_name, ORACLES[_t])(lambda lk, t=_t: read_seasons(lk.spark, f"{built_lake(lk)['gold']}/{t}"))


def _exported(lk: Lake, name: str) -> DataFrame:
    """An export as its JSON file has it; a file does not tell types, so they come from the table exported."""
    from varzea.plans.exports import all_exports
    from varzea.plans.pipeline import SilverLake, read_gold
    out = built_lake(lk)
    slk = SilverLake(lk.spark, out["silver"], lk.root)
    table = all_exports(read_gold(lk.spark, out["gold"]), {n: getattr(slk, n) for n in ["gols", "cartoes", "estatisticas"]})[name]
    return lk.spark.read.schema(table.schema).option("dateFormat", "yyyy-MM-dd").json(f"{out['json']}/{name}")


#: Export -> the entry whose result its file must hold.
EXPORTED = {"classificacao": "e01_classificacao", "campeoes": "e02_campeoes", "partidas_resumo": "e03_partidas_resumo",
            "artilharia": "e04_artilharia", "fair_play": "e05_fair_play", "desempenho_clubes": "e06_desempenho_clubes",
            "rebaixamento_acesso": "e07_rebaixamento_acesso", "gols": "e08_gols", "cartoes": "e08b_cartoes",
            "estatisticas": "e08c_estatisticas", "clubes": "e09_clubes", "temporadas_meta": "e10_temporadas_meta"}


for _export, _entry in EXPORTED.items():
    register(f"u08_json_{_export}", ORACLES[_entry])(lambda lk, name=_export: _exported(lk, name))
