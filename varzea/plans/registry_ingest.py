"""Registrations: silver transforms (T*), payload flattening (J*), merges
(U*) — round trips from feeds derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from varzea.operators import payloads as J
from varzea.operators import silver as S
from varzea.operators import upsert as U
from varzea.operators.gold import fair_play
from varzea.plans.catalog import register
from varzea.plans.oracle import q
from varzea.plans.registry_library import RUNNING
from varzea.sources import feeds as FD
from varzea.sources.fixtures import gold_of

_HORA = "lpad(CAST(10 + rodada AS VARCHAR), 2, '0') || ':00'"
_NULL_S = "CAST(NULL AS VARCHAR)"
_NUM = "CAST(regexp_extract(atleta, '(\\d+)$', 1) AS BIGINT)"

# ---- silver transforms -----------------------------------------------------------------------
register("t07_silver_partidas", q(f"""
SELECT partida_id, temporada, rodada, data, {_HORA} AS hora, mandante, visitante,
       {_NULL_S} AS formacao_mandante, {_NULL_S} AS formacao_visitante, {_NULL_S} AS tecnico_mandante,
       {_NULL_S} AS tecnico_visitante, vencedor, arena,
       COALESCE(gols_mandante, 0) AS gols_mandante, COALESCE(gols_visitante, 0) AS gols_visitante,
       estado_mandante, estado_visitante, 'historico_csv' AS fonte
FROM partidas"""))(lambda lk: S.silver_partidas(FD.dirty_match_rows(lk.partidas)))

register("t08_silver_estatisticas", q("""
SELECT e.partida_id, CAST(e.rodada AS INT) AS rodada, e.clube, e.chutes, e.chutes_no_alvo,
       CAST(CAST(e.posse_de_bola AS BIGINT) AS DOUBLE) AS posse_de_bola, CAST(0 AS BIGINT) AS passes,
       CAST(NULL AS DOUBLE) AS precisao_passes, e.faltas, CAST(0 AS BIGINT) AS cartao_amarelo,
       CAST(0 AS BIGINT) AS cartao_vermelho, CAST(0 AS BIGINT) AS impedimentos, e.escanteios,
       p.temporada, 'historico_csv' AS fonte
FROM estatisticas e LEFT JOIN partidas p ON e.partida_id = p.partida_id"""))(
    lambda lk: S.silver_estatisticas(FD.dirty_stats_rows(lk.estatisticas), lk.partidas))

_GOLS_CSV = """
SELECT g.partida_id, g.rodada, g.clube, g.atleta, g.minuto, {tipo} AS tipo_de_gol, p.temporada, 'historico_csv' AS fonte
FROM gols g LEFT JOIN partidas p ON g.partida_id = p.partida_id"""
register("t09_silver_gols", q(_GOLS_CSV.format(tipo="g.tipo_de_gol")))(
    lambda lk: S.silver_gols(FD.dirty_goal_rows(lk.gols, True), lk.partidas))
register("t09b_silver_gols_5_colunas", q(_GOLS_CSV.format(tipo=_NULL_S)))(
    lambda lk: S.silver_gols(FD.dirty_goal_rows(lk.gols, False), lk.partidas))

_CARDS_CSV = """
SELECT c.partida_id, c.rodada, c.clube, CASE WHEN c.minuto % 2 = 0 THEN upper(c.cartao) ELSE lower(c.cartao) END AS cartao,
       c.atleta, c.num_camisa, CAST(NULL AS VARCHAR) AS posicao, c.minuto, p.temporada, 'historico_csv' AS fonte
FROM cartoes c LEFT JOIN partidas p ON c.partida_id = p.partida_id"""
register("t10_silver_cartoes", q(_CARDS_CSV))(
    lambda lk: S.silver_cartoes(FD.dirty_card_rows(lk.cartoes), lk.partidas))

register("t10b_fair_play_csv", q(f"""
SELECT temporada, clube,
       COUNT(*) FILTER (WHERE lower(cartao) = 'amarelo') AS amarelos,
       COUNT(*) FILTER (WHERE lower(cartao) = 'vermelho') AS vermelhos,
       COUNT(*) FILTER (WHERE lower(cartao) = 'amarelo') + COUNT(*) FILTER (WHERE lower(cartao) = 'vermelho') * 3 AS pontos_fair_play,
       COUNT(DISTINCT partida_id) AS partidas_com_cartao
FROM ({_CARDS_CSV}) x WHERE clube IS NOT NULL GROUP BY temporada, clube"""))(
    lambda lk: fair_play(S.silver_cartoes(FD.dirty_card_rows(lk.cartoes), lk.partidas)))

register("t12_canonical_club", q("""
SELECT partida_id, CASE WHEN mandante = 'NATION_3' THEN 'Sao Paulo' ELSE mandante END AS mandante FROM partidas"""))(
    lambda lk: lk.partidas.select(
        "partida_id", S.canonical_club(F.when(F.col("mandante") == "NATION_3", F.lit("São Paulo"))
                                       .otherwise(F.col("mandante"))).alias("mandante")))

# ---- provider A ----------------------------------------------------------------------------------
register("j01_fixtures", q(f"""
SELECT temporada, partida_id, rodada, data, {_HORA} AS hora,
       CASE WHEN status = 'finished' THEN 'FT' ELSE 'NS' END AS status, arena, mandante, visitante,
       CAST(regexp_extract(mandante, '(\\d+)$', 1) AS BIGINT) AS mandante_id,
       CAST(regexp_extract(visitante, '(\\d+)$', 1) AS BIGINT) AS visitante_id,
       gols_mandante, gols_visitante
FROM partidas"""))(lambda lk: J.flatten_fixtures(FD.fixture_docs(lk.partidas)))

register("j02_team_stats", q("""
SELECT partida_id, temporada, rodada, clube, chutes, chutes_no_alvo,
       CAST(CAST(posse_de_bola AS BIGINT) AS DOUBLE) AS posse_de_bola, CAST(NULL AS BIGINT) AS passes,
       CAST(NULL AS DOUBLE) AS precisao_passes, faltas, CAST(NULL AS BIGINT) AS cartao_amarelo,
       CAST(NULL AS BIGINT) AS cartao_vermelho, CAST(NULL AS BIGINT) AS impedimentos, escanteios
FROM estatisticas"""))(lambda lk: J.flatten_team_stats(FD.team_stats_docs(lk.estatisticas)))

register("j03_events_gols", q("""
SELECT partida_id, temporada, rodada, clube, atleta, minuto,
       CASE WHEN tipo_de_gol = 'Penalty' THEN 'Penalty' WHEN tipo_de_gol = 'Gol Contra' THEN 'Own Goal'
            ELSE 'Normal' END AS tipo_de_gol
FROM gols"""))(lambda lk: J.flatten_events(FD.event_docs(lk.gols, lk.cartoes))[0])

register("j03b_events_cartoes", q(f"""
SELECT partida_id, temporada, rodada, clube, atleta, minuto, cartao,
       CAST({_NUM} AS VARCHAR) AS num_camisa, {_NULL_S} AS posicao
FROM cartoes"""))(lambda lk: J.flatten_events(FD.event_docs(lk.gols, lk.cartoes))[1])

register("j04_lineups", q(f"""
SELECT partida_id, temporada, rodada, clube, 'Coach ' || clube AS tecnico, '4-4-2' AS formacao, atleta,
       num_camisa, {_NULL_S} AS posicao, titular
FROM escalacoes"""))(lambda lk: J.flatten_lineups(FD.lineup_docs(lk.escalacoes)))

register("j05_standings", q("""
SELECT temporada, posicao, clube, CAST(pontos AS INT) AS pontos, CAST(jogos AS INT) AS jogos,
       CAST(vitorias AS INT) AS vitorias, CAST(empates AS INT) AS empates, CAST(derrotas AS INT) AS derrotas,
       CAST(gols_pro AS INT) AS gols_pro, CAST(gols_contra AS INT) AS gols_contra,
       CAST(saldo_gols AS INT) AS saldo_gols, 'WDLWW' AS forma
FROM classificacao_historica"""))(
    lambda lk: J.flatten_standings(FD.standings_docs(gold_of(lk)["classificacao_historica"])))

# ---- provider B ----------------------------------------------------------------------------------
register("j06_matches_b", q(f"""
SELECT temporada, rodada, partida_id, data, {_HORA} AS hora, mandante, visitante,
       CAST(regexp_extract(mandante, '(\\d+)$', 1) AS BIGINT) AS mandante_id,
       CAST(regexp_extract(visitante, '(\\d+)$', 1) AS BIGINT) AS visitante_id,
       gols_mandante, gols_visitante, arena, status,
       CASE WHEN gols_mandante IS NOT NULL AND gols_visitante IS NOT NULL AND status = 'finished' THEN
            CASE WHEN gols_mandante > gols_visitante THEN mandante WHEN gols_visitante > gols_mandante THEN visitante
                 ELSE '-' END END AS vencedor,
       'sofascore' AS fonte
FROM partidas"""))(lambda lk: J.flatten_matches(FD.round_docs(lk.partidas)))

register("j07_stats_b", q("""
SELECT e.partida_id, e.clube, e.chutes, e.chutes_no_alvo, CAST(CAST(e.posse_de_bola AS BIGINT) AS DOUBLE) AS posse_de_bola,
       CAST(NULL AS BIGINT) AS passes, CAST(NULL AS DOUBLE) AS precisao_passes, e.faltas,
       CAST(NULL AS BIGINT) AS cartao_amarelo, CAST(NULL AS BIGINT) AS cartao_vermelho,
       CAST(NULL AS BIGINT) AS impedimentos, e.escanteios, p.temporada, p.rodada, 'sofascore' AS fonte
FROM estatisticas e JOIN partidas p ON e.partida_id = p.partida_id"""))(
    lambda lk: J.tag(J.flatten_stats(FD.stats_b_docs(lk.estatisticas, lk.partidas)), lk.partidas,
                     J.FONTE_B, sides=True).drop("lado"))

register("j08_incidents_gols", q(f"""
SELECT partida_id, CASE WHEN {_NUM} % 2 = 0 THEN 'mandante' ELSE 'visitante' END AS lado, atleta, minuto,
       CASE WHEN tipo_de_gol = 'Penalty' THEN 'Pênalti' WHEN tipo_de_gol = 'Gol Contra' THEN 'Gol Contra'
            ELSE 'Normal' END AS tipo_de_gol, 'sofascore' AS fonte
FROM gols"""))(lambda lk: J.flatten_incidents(FD.incident_docs(lk.gols, lk.cartoes))[0])

register("j08b_incidents_cartoes", q(f"""
SELECT partida_id, CASE WHEN {_NUM} % 2 = 0 THEN 'mandante' ELSE 'visitante' END AS lado, atleta, minuto, cartao,
       CASE WHEN {_NUM} % 3 <> 0 THEN 'M' END AS posicao,
       CASE WHEN {_NUM} % 3 <> 0 THEN CAST({_NUM} % 30 AS VARCHAR) END AS num_camisa, 'sofascore' AS fonte
FROM cartoes"""))(lambda lk: J.flatten_incidents(FD.incident_docs(lk.gols, lk.cartoes))[1])

register("j09_squads", q(f"""
SELECT partida_id, CASE WHEN {_NUM} % 2 = 0 THEN 'mandante' ELSE 'visitante' END AS lado, '4-3-3' AS formacao,
       atleta, num_camisa, 'M' AS posicao, ({_NUM} % 5 <> 0 AND titular) AS titular, 'sofascore' AS fonte
FROM escalacoes"""))(lambda lk: J.flatten_squads(FD.squad_docs(lk.escalacoes)))

register("j10_finished", q(f"""
SELECT temporada, partida_id, rodada, data, {_HORA} AS hora, 'FT' AS status, arena, mandante, visitante,
       CAST(regexp_extract(mandante, '(\\d+)$', 1) AS BIGINT) AS mandante_id,
       CAST(regexp_extract(visitante, '(\\d+)$', 1) AS BIGINT) AS visitante_id, gols_mandante, gols_visitante
FROM partidas WHERE status = 'finished'"""))(
    lambda lk: J.finished(J.flatten_fixtures(FD.fixture_docs(lk.partidas))))

# ---- merges -----------------------------------------------------------------------------------------
_PB_COLS = ("partida_id, temporada, rodada, data, mandante, visitante, estado_mandante, estado_visitante, "
            "gols_mandante, gols_visitante, status, arena, fonte")
register("u01_upsert_partidas", q(f"""
SELECT {_PB_COLS} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY partida_id
            ORDER BY CASE WHEN year(seq1) >= 1998 THEN 2 ELSE 1 END DESC, seq1 DESC, seq2 DESC, seq3 DESC,
                     seq4 DESC, gols_mandante DESC NULLS LAST) AS rn
  FROM partidas_bruto) t WHERE rn = 1"""))(lambda lk: _upsert_two_batches(lk))


def _upsert_two_batches(lk):
    """Rows shipped from 1998 on arrive as a second batch; within a batch the
    sequence is (seq1..seq4, home goals)."""
    b = lk.partidas_bruto
    late = F.year("seq1") >= 1998
    seq = lambda batch: F.struct(F.lit(batch).alias("b"), "seq1", "seq2", "seq3", "seq4", "gols_mandante")
    first = b.filter(~late).withColumn(U.SEQ, seq(1)).drop("seq1", "seq2", "seq3", "seq4")
    second = b.filter(late).withColumn(U.SEQ, seq(2)).drop("seq1", "seq2", "seq3", "seq4")
    return U.upsert(first, second, U.TABLE_KEYS["partidas"])


register("u03_last_synced_round", q(f"""
SELECT CAST(COALESCE(MAX(rodada), 0) AS INT) AS ultima_rodada FROM partidas
WHERE temporada = {RUNNING} AND status IN ('FT', 'finished')"""))(
    lambda lk: U.last_synced_round(lk.partidas, RUNNING))

_U04 = f"""
SELECT temporada, partida_id, rodada, data, {_HORA} AS hora,
       CASE WHEN status = 'finished' THEN 'FT' ELSE 'NS' END AS status, arena, mandante, visitante,
       CAST(regexp_extract(mandante, '(\\d+)$', 1) AS BIGINT) AS mandante_id,
       CAST(regexp_extract(visitante, '(\\d+)$', 1) AS BIGINT) AS visitante_id, gols_mandante, gols_visitante
FROM partidas
WHERE temporada = {RUNNING}
  AND (rodada > (SELECT COALESCE(MAX(rodada), 0) FROM partidas WHERE temporada = {RUNNING} AND status = 'finished')
       OR status <> 'finished')"""
register("u04_changed_fixtures", q(_U04))(
    lambda lk: U.changed_fixtures(
        J.flatten_fixtures(FD.fixture_docs(lk.partidas)).filter(F.col("temporada") == RUNNING),
        U.last_synced_round(lk.partidas, RUNNING).scalar()))

U05_SQL = q(f"""
SELECT partida_id, temporada, rodada, data, CAST(NULL AS VARCHAR) AS hora, mandante, visitante, estado_mandante,
       estado_visitante, gols_mandante, gols_visitante, status, arena, fonte, vencedor,
       CAST(NULL AS BIGINT) AS mandante_id, CAST(NULL AS BIGINT) AS visitante_id
FROM partidas
WHERE temporada = {RUNNING}
  AND NOT (rodada > (SELECT COALESCE(MAX(rodada), 0) FROM partidas WHERE temporada = {RUNNING} AND status = 'finished')
           OR status <> 'finished')
UNION ALL
SELECT partida_id, temporada, rodada, data, hora, mandante, visitante, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
       gols_mandante, gols_visitante, status, arena, 'api_football', CAST(NULL AS VARCHAR), mandante_id, visitante_id
FROM ({_U04.replace("SELECT temporada,", "SELECT CAST(temporada AS INT) AS temporada,", 1)}) c""")
register("u05_update_season", U05_SQL)(
    lambda lk: U.update_season(lk.partidas, J.flatten_fixtures(FD.fixture_docs(lk.partidas)), RUNNING, mode="source"))

# the notebook analyses register themselves on import
from varzea.plans import registry_legacy  # noqa: E402,F401

# ---- optional duplicate-match merge and provider standings (G5 modes) ---------------------------
from varzea.operators.gold import classificacao_historica as _classif  # noqa: E402
from varzea.plans import queries as _Q  # noqa: E402

register("u02_dedup_matches", q("""
SELECT partida_id, temporada, rodada, data, mandante, visitante, estado_mandante, estado_visitante,
       gols_mandante, gols_visitante, status, arena, fonte, vencedor FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY temporada, rodada, mandante, visitante
                               ORDER BY partida_id DESC) AS rn FROM partidas) t
WHERE rn = 1"""))(lambda lk: U.dedup_matches(lk.partidas))

register("g05b_classificacao_api_replace", q("""
SELECT * FROM classificacao_historica WHERE temporada IN (2000, 2001)"""))(
    lambda lk: _classif(lk.partidas, lk.classificacao_api((2000, 2001)), "replace"))

register("g05c_classificacao_api_prefer", q("""
SELECT temporada, clube, jogos, vitorias, empates, derrotas,
       CASE WHEN temporada = 2000 THEN pontos + 100 ELSE pontos END AS pontos,
       gols_pro, gols_contra, saldo_gols, posicao
FROM classificacao_historica"""))(
    lambda lk: _classif(lk.partidas, lk.classificacao_api((2000,)).withColumn("pontos", F.col("pontos") + 100),
                        "prefer"))

register("q25b_campeao_vs_vice_row_number", q("""
SELECT c.temporada, c.clube AS campeao, c.pontos AS pts_campeao, v.clube AS vice, v.pontos AS pts_vice,
       c.pontos - v.pontos AS diferenca
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY temporada ORDER BY pontos DESC, saldo_gols DESC, gols_pro DESC, clube) AS pos
      FROM classificacao_historica) c
JOIN (SELECT *, ROW_NUMBER() OVER (PARTITION BY temporada ORDER BY pontos DESC, saldo_gols DESC, gols_pro DESC, clube) AS pos
      FROM classificacao_historica) v
  ON c.temporada = v.temporada AND c.pos = 1 AND v.pos = 2"""))(
    lambda lk: _Q.campeao_vs_vice(gold_of(lk)["classificacao_historica"], "row_number"))

# ---- U6: provider incidents backfilled into goals and cards -------------------------------------
from varzea.streaming.refresh import backfill_events  # noqa: E402


def _backfill(lk):
    parents = (lk.gols.select("partida_id", "temporada", "rodada", "clube")
               .unionByName(lk.cartoes.select("partida_id", "temporada", "rodada", "clube"))
               .select("partida_id", "temporada", "rodada", F.col("clube").alias("mandante"),
                       F.col("clube").alias("visitante")))
    return backfill_events(lk.gols, lk.cartoes, FD.incident_docs(lk.gols, lk.cartoes), parents)


register("u06_backfill_gols", q("""
SELECT partida_id, clube, atleta, minuto,
       CASE WHEN tipo_de_gol = 'Penalty' THEN 'Pênalti' WHEN tipo_de_gol = 'Gol Contra' THEN 'Gol Contra'
            ELSE 'Normal' END AS tipo_de_gol,
       temporada, rodada, 'sofascore' AS fonte
FROM gols"""))(lambda lk: _backfill(lk)[0])

register("u06b_backfill_cartoes", q(f"""
SELECT partida_id, clube, cartao, atleta, minuto, temporada, rodada, 'sofascore' AS fonte,
       CASE WHEN {_NUM} % 3 <> 0 THEN CAST({_NUM} % 30 AS VARCHAR) END AS num_camisa,
       CASE WHEN {_NUM} % 3 <> 0 THEN 'M' END AS posicao
FROM cartoes"""))(lambda lk: _backfill(lk)[1])

# ---- U7 / U8 run as jobs into fresh folders under the checkpoint dir ---------------------------
from varzea.session import scratch_dir  # noqa: E402
from varzea.sources.seasons import read_seasons  # noqa: E402


def _stream_refresh(lk):
    """The stored matches (all seasons) + fixture documents of the running
    season landing as files, merged by the file-source stream; returns the
    table as stored afterwards."""
    from varzea.streaming.refresh import conform, refresh_stream
    spark = lk.spark
    table, landing, ckpt = (scratch_dir(spark, n) for n in ("u07-table", "u07-landing", "u07-ckpt"))
    conform(lk.partidas).write.mode("overwrite").partitionBy("temporada").parquet(table)
    FD.fixture_docs(lk.partidas.filter(F.col("temporada") == RUNNING)).select("payload") \
        .write.mode("overwrite").text(landing)
    refresh_stream(spark, landing, table, ckpt, RUNNING, mode="source")
    return read_seasons(spark, table)


_BASE = """
SELECT partida_id, temporada, rodada, data, CAST(NULL AS VARCHAR) AS hora, mandante, visitante,
       CAST(NULL AS VARCHAR) AS formacao_mandante, CAST(NULL AS VARCHAR) AS formacao_visitante,
       CAST(NULL AS VARCHAR) AS tecnico_mandante, CAST(NULL AS VARCHAR) AS tecnico_visitante, vencedor, arena,
       gols_mandante, gols_visitante, estado_mandante, estado_visitante, status, fonte,
       CAST(NULL AS BIGINT) AS mandante_id, CAST(NULL AS BIGINT) AS visitante_id
FROM partidas"""
_CHANGED = f"""(rodada > (SELECT COALESCE(MAX(rodada), 0) FROM partidas WHERE temporada = {RUNNING} AND status = 'finished')
              OR status <> 'finished')"""
register("u07_refresh_stream", q(f"""
SELECT * FROM ({_BASE}) b WHERE temporada <> {RUNNING} OR NOT {_CHANGED}
UNION ALL
SELECT partida_id, temporada, rodada, data, {_HORA} AS hora, mandante, visitante,
       CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
       CAST(NULL AS VARCHAR) AS vencedor, arena, gols_mandante, gols_visitante,
       CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
       CASE WHEN status = 'finished' THEN 'FT' ELSE 'NS' END AS status, 'api_football' AS fonte,
       CAST(regexp_extract(mandante, '(\\d+)$', 1) AS BIGINT), CAST(regexp_extract(visitante, '(\\d+)$', 1) AS BIGINT)
FROM partidas WHERE temporada = {RUNNING} AND {_CHANGED}"""))(_stream_refresh)


def _conflicting_documents(lk):
    """Two files tell of each match of the running season, first with five
    home goals too many and a later date; the later file must win."""
    from varzea.streaming.refresh import conform, refresh_stream
    spark = lk.spark
    table, landing, ckpt = (scratch_dir(spark, n) for n in ("u07b-table", "u07b-landing", "u07b-ckpt"))
    conform(lk.partidas).write.mode("overwrite").partitionBy("temporada").parquet(table)
    now = lk.partidas.filter(F.col("temporada") == RUNNING)
    early = (now.withColumn("gols_mandante", F.col("gols_mandante") + 5)
             .withColumn("data", F.date_add("data", 40)))
    for docs in (early, now):  # written one after the other
        FD.fixture_docs(docs).select("payload").write.mode("append").text(landing)
    refresh_stream(spark, landing, table, ckpt, RUNNING)
    return read_seasons(spark, table)


register("u07b_refresh_conflicting", q(f"""
SELECT * FROM ({_BASE}) b WHERE temporada <> {RUNNING}
UNION ALL
SELECT partida_id, temporada, rodada, data, {_HORA} AS hora, mandante, visitante,
       CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
       CAST(NULL AS VARCHAR) AS vencedor, arena, gols_mandante, gols_visitante,
       CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
       CASE WHEN status = 'finished' THEN 'FT' ELSE 'NS' END AS status, 'api_football' AS fonte,
       CAST(regexp_extract(mandante, '(\\d+)$', 1) AS BIGINT), CAST(regexp_extract(visitante, '(\\d+)$', 1) AS BIGINT)
FROM partidas WHERE temporada = {RUNNING}"""))(_conflicting_documents)

# ---- X2: case/accent-insensitive club names unified before the standings -------------------------


def _standings_mixed_case(lk):
    """Half the matches spell the clubs in lower case; after unifying the
    spellings under a case/accent-insensitive collation the standings equal
    the regular ones."""
    p = lk.partidas
    odd = F.col("partida_id") % 2 == 1
    mixed = (p.withColumn("mandante", F.when(odd, F.lower("mandante")).otherwise(F.col("mandante")))
              .withColumn("visitante", F.when(~odd, F.lower("visitante")).otherwise(F.col("visitante"))))
    return _classif(S.unify_spelling(mixed, ["mandante", "visitante"]))


register("x02_classificacao_collation", q("SELECT * FROM classificacao_historica"))(_standings_mixed_case)
