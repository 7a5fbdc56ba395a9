"""Registrations: exports (E*), dashboard metrics (D*), outcome model (P*),
silver views — each with a DuckDB twin where SQL can express it."""

from __future__ import annotations

from pyspark.sql import functions as F

from varzea.operators import predict as P
from varzea.plans import dashboard as D
from varzea.plans import exports as E
from varzea.plans.catalog import register
from varzea.plans.oracle import q, with_ctes
from varzea.plans.registry_library import CLUB_A, CLUB_B, RUNNING, SEASON
from varzea.sources.fixtures import gold_of


def G(lk, name):
    return gold_of(lk)[name]


# ---- silver views --------------------------------------------------------------------------
for _name in ["partidas", "gols", "cartoes", "estatisticas", "escalacoes"]:
    register(f"silver_{_name}", q(f"SELECT * FROM {_name}"))(lambda lk, _n=_name: getattr(lk, _n))

register("silver_partidas_bruto", q("SELECT * FROM partidas_bruto"))(lambda lk: lk.partidas_bruto)

# ---- exports -----------------------------------------------------------------------------------
register("e02_campeoes", q("""
SELECT temporada, clube, pontos FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY temporada ORDER BY pontos DESC, vitorias DESC, saldo_gols DESC, clube ASC) AS p
  FROM classificacao_historica) t WHERE p = 1"""))(
    lambda lk: E.export_campeoes(G(lk, "classificacao_historica")))

register("e03_partidas_resumo", q("""
SELECT partida_id, temporada, rodada, CAST(data AS VARCHAR) AS data, mandante, gols_mandante, gols_visitante,
       visitante, arena, fonte FROM campeonato_historico"""))(
    lambda lk: E.export_partidas_resumo(G(lk, "campeonato_historico")))

register("e04_artilharia", q("""
SELECT temporada, atleta, clube, total_gols AS gols, penaltis, gols_contra FROM artilharia_historica"""))(
    lambda lk: E.export_artilharia(G(lk, "artilharia_historica")))

register("e09_clubes", q("SELECT DISTINCT mandante AS clube FROM campeonato_historico"))(
    lambda lk: E.export_clubes(G(lk, "campeonato_historico")))

_META = """
temporadas_meta AS (
  SELECT temporada, COUNT(*) AS total_partidas,
         CAST(SUM(CASE WHEN gols_mandante IS NOT NULL THEN gols_mandante + gols_visitante ELSE 0 END) AS BIGINT) AS total_gols,
         MIN(CAST(data AS VARCHAR)) AS inicio, MAX(CAST(data AS VARCHAR)) AS fim,
         COUNT(gols_mandante) AS partidas_disputadas
  FROM campeonato_historico GROUP BY temporada
)"""
register("e10_temporadas_meta", with_ctes(_META, "SELECT * FROM temporadas_meta"))(
    lambda lk: E.export_temporadas_meta(G(lk, "campeonato_historico")))


def _meta(lk):
    return E.export_temporadas_meta(G(lk, "campeonato_historico"))


# ---- dashboard ---------------------------------------------------------------------------------
_PLAYED_EXPR = "COALESCE(NULLIF(partidas_disputadas, 0), total_partidas)"
register("d01_kpis", with_ctes(_META, f"""
SELECT COUNT(*) AS temporadas, CAST(SUM(total_partidas) AS BIGINT) AS partidas,
       CAST(SUM({_PLAYED_EXPR}) AS BIGINT) AS disputadas, CAST(SUM(COALESCE(total_gols, 0)) AS BIGINT) AS gols,
       ROUND(CAST(SUM(COALESCE(total_gols, 0)) AS DOUBLE) / SUM({_PLAYED_EXPR}), 2) AS media_gols
FROM temporadas_meta"""))(lambda lk: D.kpis(_meta(lk)))

register("d02_titulos", q("""
SELECT clube, COUNT(*) AS titulos FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY temporada ORDER BY pontos DESC, vitorias DESC, saldo_gols DESC, clube ASC) AS p
  FROM classificacao_historica) t WHERE p = 1
GROUP BY clube ORDER BY titulos DESC, clube LIMIT 8"""))(
    lambda lk: D.titulos(E.export_campeoes(G(lk, "classificacao_historica")), 8))

register("d03_serie_gols", with_ctes(_META, f"""
SELECT temporada AS ano, total_gols AS gols,
       COALESCE(ROUND(CAST(total_gols AS DOUBLE) / NULLIF(total_partidas, 0), 2), 0.0) AS media,
       ROUND(CAST(total_gols AS DOUBLE) / NULLIF({_PLAYED_EXPR}, 0), 2) AS media_disputadas
FROM temporadas_meta"""))(lambda lk: D.serie_gols(_meta(lk)))

register("d04_tabela_temporada", q(f"""
SELECT CAST(ROW_NUMBER() OVER (ORDER BY c.pontos DESC, c.clube ASC) AS INT) AS pos, c.clube, c.pontos,
       c.vitorias + c.empates + c.derrotas AS jogos, c.vitorias, c.empates, c.derrotas, c.gols_pro, c.gols_contra,
       c.gols_pro - c.gols_contra AS saldo, COALESCE(r.situacao, '') AS situacao
FROM classificacao_historica c
LEFT JOIN (SELECT clube, situacao FROM rebaixamento_acesso WHERE temporada = {SEASON}) r ON c.clube = r.clube
WHERE c.temporada = {SEASON}"""))(
    lambda lk: D.tabela_temporada(G(lk, "classificacao_historica"), G(lk, "rebaixamento_acesso"), SEASON))

register("d05_artilheiros_temporada", q(f"""
SELECT atleta, clube, total_gols AS gols FROM artilharia_historica WHERE temporada = {SEASON}
ORDER BY gols DESC, atleta, clube LIMIT 15"""))(
    lambda lk: D.artilheiros_temporada(G(lk, "artilharia_historica"), SEASON, 15))

register("d05b_rodadas", q(f"""
SELECT rodada, COUNT(*) AS jogos,
       rodada = (SELECT MAX(rodada) FROM partidas WHERE temporada = {RUNNING}) AS ultima
FROM partidas WHERE temporada = {RUNNING} GROUP BY rodada"""))(
    lambda lk: D.rodadas(lk.partidas, RUNNING))

register("d05c_jogos_da_rodada", q(f"""
SELECT partida_id, rodada, CAST(data AS VARCHAR) AS data, mandante, gols_mandante, gols_visitante, visitante
FROM partidas WHERE temporada = {SEASON}
  AND rodada = (SELECT MAX(rodada) FROM partidas WHERE temporada = {SEASON})"""))(
    lambda lk: D.jogos_da_rodada(lk.partidas, SEASON))

register("d06_buscar_clube", q("""
SELECT clube FROM (SELECT DISTINCT mandante AS clube FROM campeonato_historico) c
WHERE contains(lower(clube), 'tion_1')"""))(
    lambda lk: D.buscar_clube(E.export_clubes(G(lk, "campeonato_historico")), "TION_1"))

register("d07_perfil_clubes", q("""
SELECT clube, CAST(SUM(jogos) AS BIGINT) AS jogos, CAST(SUM(vitorias) AS BIGINT) AS vitorias,
       CAST(SUM(empates) AS BIGINT) AS empates, CAST(SUM(derrotas) AS BIGINT) AS derrotas,
       CAST(SUM(gols_pro) AS BIGINT) AS gols_pro, CAST(SUM(gols_contra) AS BIGINT) AS gols_contra
FROM desempenho_clubes GROUP BY clube"""))(
    lambda lk: D.perfil_clubes(G(lk, "desempenho_clubes")))

register("d07b_aproveitamento_serie", q("""
SELECT clube, temporada AS ano,
       COALESCE(ROUND(CAST(pontos AS DOUBLE) / NULLIF(jogos * 3, 0) * 100, 1), 0.0) AS aprov
FROM desempenho_clubes"""))(
    lambda lk: D.aproveitamento_serie(G(lk, "desempenho_clubes")))

# shared CTEs of the model --------------------------------------------------------------------
_MODEL = """
played AS (SELECT * FROM partidas WHERE gols_mandante IS NOT NULL AND gols_visitante IS NOT NULL),
psides AS (
  SELECT partida_id, temporada, rodada, data, mandante AS clube, visitante AS adversario,
         gols_mandante AS gp, gols_visitante AS gc, TRUE AS em_casa FROM played
  UNION ALL
  SELECT partida_id, temporada, rodada, data, visitante, mandante, gols_visitante, gols_mandante, FALSE FROM played
),
wsides AS (
  SELECT s.*, pow(0.82, CAST(({year}) - s.temporada AS DOUBLE)) AS w FROM psides s
),
lastg AS (
  SELECT *, CASE WHEN gp > gc THEN 'V' WHEN gp < gc THEN 'D' ELSE 'E' END AS res
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY clube ORDER BY temporada DESC, rodada DESC, data DESC, partida_id DESC) AS rn
        FROM psides) t
  WHERE rn <= {form_n}
),
form AS (
  SELECT clube, COUNT(*) FILTER (WHERE res = 'V') AS wins, COUNT(*) FILTER (WHERE res = 'E') AS draws,
         COUNT(*) FILTER (WHERE res = 'D') AS losses, string_agg(res, '' ORDER BY rn) AS resultados, COUNT(*) AS n
  FROM lastg GROUP BY clube
),
ha_raw AS (
  SELECT clube,
         SUM(CASE WHEN em_casa AND gp > gc THEN w ELSE 0.0 END) AS hw, SUM(CASE WHEN em_casa AND gp = gc THEN w ELSE 0.0 END) AS hd,
         SUM(CASE WHEN em_casa AND gp < gc THEN w ELSE 0.0 END) AS hl, SUM(CASE WHEN em_casa THEN w ELSE 0.0 END) AS h_t,
         SUM(CASE WHEN NOT em_casa AND gp > gc THEN w ELSE 0.0 END) AS aw, SUM(CASE WHEN NOT em_casa AND gp = gc THEN w ELSE 0.0 END) AS ad,
         SUM(CASE WHEN NOT em_casa AND gp < gc THEN w ELSE 0.0 END) AS al, SUM(CASE WHEN NOT em_casa THEN w ELSE 0.0 END) AS a_t,
         COUNT(*) FILTER (WHERE em_casa) AS home_total, COUNT(*) FILTER (WHERE NOT em_casa) AS away_total
  FROM wsides GROUP BY clube
),
ha AS (
  SELECT clube,
         ROUND(hw / greatest(h_t, 0.001) * 100, 1) AS home_pct, ROUND(aw / greatest(a_t, 0.001) * 100, 1) AS away_pct,
         ROUND(hd / greatest(h_t, 0.001) * 100, 1) AS home_draw_pct, ROUND(ad / greatest(a_t, 0.001) * 100, 1) AS away_draw_pct,
         CAST(floor(hw + 0.5) AS BIGINT) AS home_w, CAST(floor(hd + 0.5) AS BIGINT) AS home_d, CAST(floor(hl + 0.5) AS BIGINT) AS home_l,
         CAST(floor(aw + 0.5) AS BIGINT) AS away_w, CAST(floor(ad + 0.5) AS BIGINT) AS away_d, CAST(floor(al + 0.5) AS BIGINT) AS away_l,
         home_total, away_total
  FROM ha_raw
),
h2h_raw AS (
  SELECT clube AS clube1, adversario AS clube2,
         SUM(CASE WHEN gp > gc THEN w ELSE 0.0 END) AS w1, SUM(CASE WHEN gp = gc THEN w ELSE 0.0 END) AS wd,
         SUM(CASE WHEN gp < gc THEN w ELSE 0.0 END) AS w2, COUNT(*) AS total,
         COUNT(*) FILTER (WHERE gp > gc) AS vit1, COUNT(*) FILTER (WHERE gp < gc) AS vit2
  FROM wsides WHERE {h2h_filter} GROUP BY clube, adversario
),
h2h AS (
  SELECT clube1, clube2, w1 / tw AS pct1, wd / tw AS pct_draw, w2 / tw AS pct2, tw AS total_w, total, vit1, vit2
  FROM (SELECT *, CASE WHEN w1 + w2 + wd = 0 THEN 1.0 ELSE w1 + w2 + wd END AS tw FROM h2h_raw) t
),
per_season AS (
  SELECT clube, temporada, SUM(CASE WHEN gp > gc THEN 3 WHEN gp = gc THEN 1 ELSE 0 END) AS pts, COUNT(*) AS games
  FROM psides GROUP BY clube, temporada
),
strength AS (
  SELECT clube, CAST(pts AS DOUBLE) / games AS ppg, temporada AS last_year, games,
         least(CAST(pts AS DOUBLE) / games / 3, 1.0) *
           CASE ({year}) - temporada WHEN 0 THEN 1.0 WHEN 1 THEN 0.82 WHEN 2 THEN 0.60 WHEN 3 THEN 0.42 ELSE 0.28 END AS score,
         ({year}) - temporada AS gap
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY clube ORDER BY temporada DESC) AS r FROM per_season) t
  WHERE r = 1
)"""

_YEAR_PLAYED = "SELECT CAST(greatest(2003, MAX(temporada)) AS INT) FROM partidas WHERE gols_mandante IS NOT NULL AND gols_visitante IS NOT NULL"
_YEAR_ALL = "SELECT CAST(greatest(2003, MAX(temporada)) AS INT) FROM partidas"


def _model_ctes(form_n=5, h2h_filter="TRUE", year=_YEAR_PLAYED):
    return _MODEL.format(form_n=form_n, h2h_filter=h2h_filter, year=year)


def _prob_sql(fixtures_cte: str, extra_cols: str, mando: str, h2h_w: float) -> str:
    base_w = 0.75
    hf, ff = h2h_w * base_w, (1 - h2h_w) * base_w
    t1 = f"h.pct1 * {hf!r} * 100 + (COALESCE(f1.wins, 0) / tot1) * 100 * {ff!r}"
    dr = (f"h.pct_draw * {hf!r} * 100 + ((COALESCE(f1.draws, 0) / tot1 + COALESCE(f2.draws, 0) / tot2) / 2) "
          f"* 100 * {ff!r}")
    t2 = f"h.pct2 * {hf!r} * 100 + (COALESCE(f2.wins, 0) / tot2) * 100 * {ff!r}"
    shift = "(s1 / (CASE WHEN s1 + s2 = 0 THEN 0.001 ELSE s1 + s2 END) - 0.5) * 2 * 0.25 * 100"
    t1, t2 = f"({t1}) + {shift}", f"({t2}) - {shift}"
    if mando == "t1_casa":
        t1 = f"({t1}) * 0.75 + COALESCE(a1.home_pct, 0) * 0.25"
        t2 = f"({t2}) * 0.75 + COALESCE(a2.away_pct, 0) * 0.25"
        dr = f"({dr}) * 0.75 + ((COALESCE(a1.home_draw_pct, 0) + COALESCE(a2.away_draw_pct, 0)) / 2) * 0.25"
    elif mando == "t2_casa":
        t1 = f"({t1}) * 0.75 + COALESCE(a1.away_pct, 0) * 0.25"
        t2 = f"({t2}) * 0.75 + COALESCE(a2.home_pct, 0) * 0.25"
        dr = f"({dr}) * 0.75 + ((COALESCE(a1.away_draw_pct, 0) + COALESCE(a2.home_draw_pct, 0)) / 2) * 0.25"
    return f""",
{fixtures_cte.strip()},
mix AS (
  SELECT x.*, h.pct1, h.pct_draw, h.pct2, h.total_w, h.total, h.vit1, h.vit2,
         greatest({t1}, 0.0) AS _t1, greatest({dr}, 0.0) AS _dr, greatest({t2}, 0.0) AS _t2
  FROM (SELECT fx.*, greatest(COALESCE(f1.wins, 0) + COALESCE(f1.draws, 0) + COALESCE(f1.losses, 0), 1) AS tot1,
               greatest(COALESCE(f2.wins, 0) + COALESCE(f2.draws, 0) + COALESCE(f2.losses, 0), 1) AS tot2,
               COALESCE(st1.score, 0.3) AS s1, COALESCE(st2.score, 0.3) AS s2
        FROM fixtures fx
        LEFT JOIN form f1 ON f1.clube = fx.clube1 LEFT JOIN form f2 ON f2.clube = fx.clube2
        LEFT JOIN strength st1 ON st1.clube = fx.clube1 LEFT JOIN strength st2 ON st2.clube = fx.clube2) x
  LEFT JOIN h2h h ON h.clube1 = x.clube1 AND h.clube2 = x.clube2
  LEFT JOIN form f1 ON f1.clube = x.clube1 LEFT JOIN form f2 ON f2.clube = x.clube2
  LEFT JOIN ha a1 ON a1.clube = x.clube1 LEFT JOIN ha a2 ON a2.clube = x.clube2
)
SELECT {extra_cols} clube1, clube2,
       CASE WHEN COALESCE(total, 0) > 0 THEN ROUND(_t1 / greatest(_t1 + _dr + _t2, 0.001) * 100, 1) END AS p_clube1,
       CASE WHEN COALESCE(total, 0) > 0 THEN ROUND(_dr / greatest(_t1 + _dr + _t2, 0.001) * 100, 1) END AS p_empate,
       CASE WHEN COALESCE(total, 0) > 0 THEN ROUND(_t2 / greatest(_t1 + _dr + _t2, 0.001) * 100, 1) END AS p_clube2,
       CASE WHEN COALESCE(total, 0) > 0 THEN vit1 END AS vit1,
       CASE WHEN COALESCE(total, 0) > 0 THEN total - vit1 - vit2 END AS emps,
       CASE WHEN COALESCE(total, 0) > 0 THEN vit2 END AS vit2,
       COALESCE(total, 0) AS total,
       CASE WHEN COALESCE(total, 0) > 0 THEN ROUND(pct1 * 100, 1) END AS h2h_pct1,
       CASE WHEN COALESCE(total, 0) > 0 THEN ROUND(pct_draw * 100, 1) END AS h2h_pct_empate,
       CASE WHEN COALESCE(total, 0) > 0 THEN ROUND(pct2 * 100, 1) END AS h2h_pct2,
       CASE WHEN COALESCE(total, 0) > 0 THEN ROUND(total_w, 1) END AS h2h_total_w
FROM mix"""


def _played_year(lk):
    return P.max_year(P.played(lk.partidas))


register("p1_home_away_stats", with_ctes(_model_ctes(), "SELECT * FROM ha"))(
    lambda lk: P.home_away_stats(P.played(lk.partidas), _played_year(lk)))

register("p2_recent_form", with_ctes(_model_ctes(form_n=5), "SELECT * FROM form"))(
    lambda lk: P.recent_form(P.played(lk.partidas), 5))

register("p2b_recent_form_reserva", with_ctes(_model_ctes(form_n=12), "SELECT * FROM form"))(
    lambda lk: P.recent_form(P.played(lk.partidas), 12))

register("p2c_form_games", with_ctes(_model_ctes(form_n=5), """
SELECT clube, CAST(rn - 1 AS INT) AS pos, res, adversario, gp, gc, temporada, rodada FROM lastg"""))(
    lambda lk: P.recent_form(P.played(lk.partidas), 5, details=True)
    .select("clube", F.posexplode("jogos").alias("pos", "j")).select("clube", "pos", "j.*"))

register("p3_weighted_h2h", with_ctes(_model_ctes(), """
SELECT clube1, clube2, ROUND(pct1, 6) AS pct1, ROUND(pct_draw, 6) AS pct_draw, ROUND(pct2, 6) AS pct2,
       ROUND(total_w, 6) AS total_w, total, vit1, vit2 FROM h2h"""))(
    lambda lk: P.weighted_h2h(P.played(lk.partidas), _played_year(lk), "todos").select(
        "clube1", "clube2", *[F.round(c, 6).alias(c) for c in ("pct1", "pct_draw", "pct2", "total_w")],
        "total", "vit1", "vit2"))

register("p4_team_strength", with_ctes(_model_ctes(), """
SELECT clube, ROUND(score, 6) AS score, last_year, ROUND(ppg, 2) AS pts_per_game, games,
       CASE WHEN gap = 0 THEN '' WHEN gap = 1 THEN 'Última temp. Série A: ' || CAST(last_year AS VARCHAR)
            ELSE 'Fora da Série A desde ' || CAST(last_year AS VARCHAR) END AS warning,
       CASE WHEN score >= 0.75 THEN 5 WHEN score >= 0.58 THEN 4 WHEN score >= 0.42 THEN 3 WHEN score >= 0.25 THEN 2 ELSE 1 END AS stars
FROM strength"""))(
    lambda lk: P.team_strength(P.played(lk.partidas), _played_year(lk)).withColumn("score", F.round("score", 6)))

_PAIRS = "fixtures AS (SELECT DISTINCT clube AS clube1, adversario AS clube2 FROM psides)"
register("p5_match_probabilities", with_ctes(_model_ctes(form_n=5), _prob_sql(_PAIRS, "", "todos", 0.55)))(
    lambda lk: P.match_probabilities(P.pairs_that_met(lk.partidas), lk.partidas, "todos", "titular"))

register("p5b_match_probabilities_t2_casa_misto",
         with_ctes(_model_ctes(form_n=8, h2h_filter="NOT em_casa"), _prob_sql(_PAIRS, "", "t2_casa", 0.70)))(
    lambda lk: P.match_probabilities(P.pairs_that_met(lk.partidas), lk.partidas, "t2_casa", "misto"))

# head-to-head pages ------------------------------------------------------------------------------------
_MEET = (f"((mandante = '{CLUB_A}' AND visitante = '{CLUB_B}') OR (mandante = '{CLUB_B}' AND visitante = '{CLUB_A}')) "
         "AND gols_mandante IS NOT NULL AND gols_visitante IS NOT NULL")

register("d08_ultimas_partidas", with_ctes(_model_ctes(form_n=10), """
SELECT clube, CAST(rn AS INT) AS rn, partida_id, temporada, rodada, adversario, gp, gc, res AS resultado FROM lastg"""))(
    lambda lk: D.ultimas_partidas(lk.partidas, 10))

register("d09_confrontos", q(f"""
SELECT partida_id, temporada, rodada, mandante, gols_mandante, gols_visitante, visitante FROM partidas
WHERE {_MEET} AND mandante = '{CLUB_A}'"""))(
    lambda lk: D.confrontos(lk.partidas, CLUB_A, CLUB_B, "t1_casa"))

register("d10_gols_confronto", q(f"""
SELECT CAST(SUM(gols_mandante + gols_visitante) AS BIGINT) AS gols_totais,
       ROUND(CAST(SUM(gols_mandante + gols_visitante) AS DOUBLE) / COUNT(*), 2) AS media
FROM partidas WHERE {_MEET}"""))(
    lambda lk: D.gols_confronto(lk.partidas, CLUB_A, CLUB_B))

register("d11_historico_confronto", q(f"""
SELECT partida_id, temporada, rodada, mandante, gols_mandante, gols_visitante, visitante,
       CASE WHEN gols_mandante = gols_visitante THEN 'E'
            WHEN (mandante = '{CLUB_A}' AND gols_mandante > gols_visitante)
              OR (mandante <> '{CLUB_A}' AND gols_visitante > gols_mandante) THEN 'V' ELSE 'D' END AS resultado,
       CAST(floor(pow(0.82, CAST(({_YEAR_PLAYED}) - temporada AS DOUBLE)) * 100 + 0.5) AS BIGINT) AS peso_pct
FROM partidas WHERE {_MEET}"""))(
    lambda lk: D.historico_confronto(lk.partidas, CLUB_A, CLUB_B))

_NEXT = f"""
nxt AS (
  SELECT MIN(rodada) AS rodada FROM (
    SELECT rodada FROM partidas WHERE temporada = {RUNNING} GROUP BY rodada
    HAVING COUNT(*) = COUNT(*) FILTER (WHERE gols_mandante IS NULL)) t
)"""
register("d12_proxima_rodada", with_ctes(_NEXT, f"""
SELECT {RUNNING} AS temporada, rodada FROM nxt WHERE rodada IS NOT NULL"""))(
    lambda lk: D.proxima_rodada(lk.partidas, RUNNING))

_NEXT_FIX = _NEXT + f""",
fixtures AS (
  SELECT p.partida_id, p.rodada, p.mandante AS clube1, p.visitante AS clube2
  FROM partidas p JOIN nxt ON p.rodada = nxt.rodada WHERE p.temporada = {RUNNING}
)"""
_D13_SQL = with_ctes(_model_ctes(form_n=5, h2h_filter="em_casa", year=_YEAR_ALL),
                     _prob_sql(_NEXT_FIX, "partida_id, rodada,", "t1_casa", 0.55))
register("d13_previsao_rodada", _D13_SQL)(lambda lk: D.previsao_rodada(lk.partidas, RUNNING))

register("d13b_contexto_rodada", with_ctes(_model_ctes(form_n=5, year=_YEAR_ALL), ",\n" + _NEXT_FIX.strip() + """,
lados AS (
  SELECT partida_id, rodada, 1 AS lado, clube1 AS clube FROM fixtures
  UNION ALL SELECT partida_id, rodada, 2, clube2 FROM fixtures
)
SELECT l.partida_id, l.rodada, l.lado, l.clube, COALESCE(f.wins, 0) AS wins, COALESCE(f.draws, 0) AS draws,
       COALESCE(f.losses, 0) AS losses, COALESCE(f.resultados, '') AS resultados,
       ROUND(COALESCE(s.score, 0.3), 6) AS score, COALESCE(s.last_year, 0) AS last_year,
       COALESCE(ROUND(s.ppg, 2), 0.0) AS pts_per_game,
       CASE WHEN s.score >= 0.75 THEN 5 WHEN s.score >= 0.58 THEN 4 WHEN s.score >= 0.42 THEN 3
            WHEN s.score >= 0.25 THEN 2 ELSE 1 END AS stars
FROM lados l LEFT JOIN form f ON f.clube = l.clube LEFT JOIN strength s ON s.clube = l.clube"""))(
    lambda lk: D.contexto_rodada(lk.partidas, RUNNING).withColumn("score", F.round("score", 6)))

_D14_BODY = _D13_SQL.split("\nSELECT partida_id, rodada, clube1, clube2,")[0]
register("d14_favorito", _D14_BODY + """,
prev AS (
SELECT partida_id, rodada, clube1, clube2,""" + _D13_SQL.split("\nSELECT partida_id, rodada, clube1, clube2,")[1] + """
),
scored AS (
  SELECT partida_id, clube1, clube2, p_clube1, p_empate, p_clube2,
         ROUND(greatest(p_clube1, p_clube2) - p_empate, 1) AS gap
  FROM prev WHERE p_clube1 IS NOT NULL
)
SELECT s.*, COALESCE(b.fav, FALSE) AS favorito FROM scored s
LEFT JOIN (SELECT partida_id, TRUE AS fav FROM scored ORDER BY gap DESC, partida_id LIMIT 1) b
  ON s.partida_id = b.partida_id""")(
    lambda lk: D.favorito(D.previsao_rodada(lk.partidas, RUNNING)))

# the ingestion families register themselves on import
from varzea.plans import registry_ingest  # noqa: E402,F401

# ---- remaining export dumps (E1, E5-E8) ----------------------------------------------------------
register("e01_classificacao", q("SELECT * FROM classificacao_historica"))(
    lambda lk: E.export_classificacao(G(lk, "classificacao_historica")))
register("e05_fair_play", q("SELECT * FROM fair_play"))(lambda lk: E.export_fair_play(G(lk, "fair_play")))
register("e06_desempenho_clubes", q("SELECT * FROM desempenho_clubes"))(
    lambda lk: E.export_desempenho(G(lk, "desempenho_clubes")))
register("e07_rebaixamento_acesso", q("SELECT * FROM rebaixamento_acesso"))(
    lambda lk: E.export_rebaixamento(G(lk, "rebaixamento_acesso")))
register("e08_gols", q("SELECT * FROM gols"))(lambda lk: E.export_silver(lk.gols))
register("e08b_cartoes", q("SELECT * FROM cartoes"))(lambda lk: E.export_silver(lk.cartoes))
register("e08c_estatisticas", q("SELECT * FROM estatisticas"))(lambda lk: E.export_silver(lk.estatisticas))
