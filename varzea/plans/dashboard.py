"""The dashboard's derived metrics as set-wise DataFrames.

The pages compute these per club or per pair in the browser; here each one
covers every club (or pair) in one job, so a UI only filters the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varzea.operators import predict as P


def kpis(meta: DataFrame) -> DataFrame:
    """Seasons, matches, matches played (falls back to the total when a
    season reports 0/null), goals and goals per played match."""
    played = F.coalesce(F.nullif(F.col("partidas_disputadas"), F.lit(0)), F.col("total_partidas"))
    return meta.agg(
        F.count(F.lit(1)).alias("temporadas"),
        F.sum("total_partidas").alias("partidas"),
        F.sum(played).alias("disputadas"),
        F.sum(F.coalesce("total_gols", F.lit(0))).alias("gols"),
        F.round(F.sum(F.coalesce("total_gols", F.lit(0))).cast("double") / F.sum(played), 2).alias("media_gols"))


def titulos(campeoes: DataFrame, n: int = 8) -> DataFrame:
    """Titles ranking, top n."""
    return (campeoes.groupBy("clube").agg(F.count(F.lit(1)).alias("titulos"))
            .orderBy(F.col("titulos").desc(), "clube").limit(n))


def serie_gols(meta: DataFrame) -> DataFrame:
    """D3: goals per season, mean over all matches (home page) and mean over
    played matches (seasons page)."""
    played = F.coalesce(F.nullif(F.col("partidas_disputadas"), F.lit(0)), F.col("total_partidas"))
    return meta.select(
        F.col("temporada").alias("ano"), F.col("total_gols").alias("gols"),
        F.coalesce(F.round(F.try_divide(F.col("total_gols").cast("double"), F.nullif(F.col("total_partidas"), F.lit(0))), 2),
                   F.lit(0.0)).alias("media"),
        F.round(F.try_divide(F.col("total_gols").cast("double"), F.nullif(played, F.lit(0))), 2).alias("media_disputadas"))


def tabela_temporada(classif: DataFrame, rebaixamento: DataFrame, ano: int) -> DataFrame:
    """Season page table — order by points (club name breaks ties),
    games = V+E+D, goal difference, outcome label by left lookup."""
    c = classif.filter(F.col("temporada") == ano)
    r = rebaixamento.filter(F.col("temporada") == ano).select("clube", "situacao")
    w = Window.partitionBy("temporada").orderBy(F.col("pontos").desc(), F.col("clube").asc())
    return (c.join(r, "clube", "left")
            .select(F.row_number().over(w).alias("pos"), "clube", "pontos",
                    (F.col("vitorias") + F.col("empates") + F.col("derrotas")).alias("jogos"),
                    "vitorias", "empates", "derrotas", "gols_pro", "gols_contra",
                    (F.col("gols_pro") - F.col("gols_contra")).alias("saldo"),
                    F.coalesce(F.col("situacao"), F.lit("")).alias("situacao")))


def artilheiros_temporada(artilharia: DataFrame, ano: int, n: int = 15) -> DataFrame:
    """Season top-n scorers."""
    return (artilharia.filter(F.col("temporada") == ano)
            .select("atleta", "clube", F.col("total_gols").alias("gols"))
            .orderBy(F.col("gols").desc(), "atleta", "clube").limit(n))


def rodadas(partidas: DataFrame, ano: int) -> DataFrame:
    """Rounds of a season, with the latest flagged (one aggregate; the
    flag compares with a scalar subquery, no window over the table)."""
    p = partidas.filter(F.col("temporada") == ano)
    latest = p.select(F.max("rodada")).scalar()
    return (p.groupBy("rodada").agg(F.count(F.lit(1)).alias("jogos"))
            .withColumn("ultima", F.col("rodada") == latest))


def jogos_da_rodada(partidas: DataFrame, ano: int, rodada: int | Column | None = None) -> DataFrame:
    """Games of one round (default: the latest round of the season)."""
    p = partidas.filter(F.col("temporada") == ano)
    r = rodada if rodada is not None else p.select(F.max("rodada")).scalar()
    r = r if isinstance(r, Column) else F.lit(r)
    return (p.filter(F.col("rodada") == r)
            .select("partida_id", "rodada", F.col("data").cast("string").alias("data"), "mandante",
                    "gols_mandante", "gols_visitante", "visitante"))


def buscar_clube(clubes: DataFrame, texto: str) -> DataFrame:
    """Case-insensitive contains."""
    return clubes.filter(F.lower(F.col("clube")).contains(texto.lower()))


def perfil_clubes(desempenho: DataFrame) -> DataFrame:
    """Club profile totals for every club."""
    return desempenho.groupBy("clube").agg(
        F.sum("jogos").alias("jogos"), F.sum("vitorias").alias("vitorias"),
        F.sum("empates").alias("empates"), F.sum("derrotas").alias("derrotas"),
        F.sum("gols_pro").alias("gols_pro"), F.sum("gols_contra").alias("gols_contra"))


def aproveitamento_serie(desempenho: DataFrame) -> DataFrame:
    """Points rate per club and season = points / (games * 3), 0 when
    there are no games."""
    return desempenho.select(
        "clube", F.col("temporada").alias("ano"),
        F.coalesce(F.round(F.try_divide(F.col("pontos").cast("double"), F.nullif(F.col("jogos") * 3, F.lit(0))) * 100, 1),
                   F.lit(0.0)).alias("aprov"))


def ultimas_partidas(partidas: DataFrame, n: int = 10) -> DataFrame:
    """Last n played games of every club with V/E/D from its side."""
    g = P.last_games(P.played(partidas), n)
    return g.select("clube", "rn", "partida_id", "temporada", "rodada", F.col("adversario"),
                    F.col("gp"), F.col("gc"), F.col("res").alias("resultado"))


def _meetings(partidas: DataFrame, a: str, b: str, mando: str = "todos") -> DataFrame:
    m, v = F.col("mandante"), F.col("visitante")
    pair = ((m == a) & (v == b)) | ((m == b) & (v == a))
    if mando == "t1_casa":
        pair = pair & (m == a)
    elif mando == "t2_casa":
        pair = pair & (m == b)
    return P.played(partidas).filter(pair)


def confrontos(partidas: DataFrame, a: str, b: str, mando: str = "todos") -> DataFrame:
    """Played meetings with venue filter."""
    return _meetings(partidas, a, b, mando).select(
        "partida_id", "temporada", "rodada", "mandante", "gols_mandante", "gols_visitante", "visitante")


def gols_confronto(partidas: DataFrame, a: str, b: str, mando: str = "todos") -> DataFrame:
    """Total goals and mean per meeting."""
    g = F.coalesce("gols_mandante", F.lit(0)) + F.coalesce("gols_visitante", F.lit(0))
    return _meetings(partidas, a, b, mando).agg(
        F.sum(g).alias("gols_totais"), F.round(F.sum(g).cast("double") / F.count(F.lit(1)), 2).alias("media"))


def historico_confronto(partidas: DataFrame, a: str, b: str) -> DataFrame:
    """Every meeting with the result from ``a``'s side and its yearly
    weight in % (decay 0.82 per year from the reference year)."""
    year = P.max_year(P.played(partidas))
    gm, gv = F.col("gols_mandante"), F.col("gols_visitante")
    a_home = F.col("mandante") == a
    a_won = F.when(a_home, gm > gv).otherwise(gv > gm)
    return _meetings(partidas, a, b).select(
        "partida_id", "temporada", "rodada", "mandante", "gols_mandante", "gols_visitante", "visitante",
        F.when(gm == gv, "E").when(a_won, "V").otherwise("D").alias("resultado"),
        F.floor(F.pow(F.lit(P.DECAY), (year - F.col("temporada")).cast("double")) * 100 + 0.5)
         .cast("bigint").alias("peso_pct"))


def proxima_rodada(partidas: DataFrame, temporada: int) -> DataFrame:
    """Smallest round of the season where no game has a result yet
    (empty when there is none)."""
    return (partidas.filter(F.col("temporada") == temporada).groupBy("rodada")
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("gols_mandante").isNull()).alias("sem"))
            .filter(F.col("n") == F.col("sem"))
            .agg(F.min("rodada").alias("rodada"))
            .filter(F.col("rodada").isNotNull())
            .select(F.lit(temporada).alias("temporada"), "rodada"))


def previsao_rodada(partidas: DataFrame, temporada: int, elenco: str = "titular") -> DataFrame:
    """Score every game of the next round (home club = clube1, head-to-
    head from games with the same home club, form over 5 games).  The
    reference year is the latest season of *all* matches, as on that page.
    The distinct pairs are scored, and the games take their pair's score."""
    nxt = proxima_rodada(partidas, temporada)
    games = (partidas.filter(F.col("temporada") == temporada)
             .join(nxt.select("rodada"), "rodada")
             .select("partida_id", "rodada", F.col("mandante").alias("clube1"), F.col("visitante").alias("clube2")))
    pairs = games.select("clube1", "clube2").distinct()
    scored = P.match_probabilities(pairs, partidas, mando="t1_casa", elenco=elenco, year=P.max_year(partidas))
    named = scored.withColumnsRenamed({"clube1": "_c1", "clube2": "_c2"})
    return (games.join(named, F.col("clube1").eqNullSafe(F.col("_c1")) & F.col("clube2").eqNullSafe(F.col("_c2")))
            .drop("_c1", "_c2"))


def contexto_rodada(partidas: DataFrame, temporada: int, n: int = 5) -> DataFrame:
    """D13, beside the forecast: one row per game of the next round and club
    (``lado`` 1 at home, 2 away) with the club's form over ``n`` games and its
    strength (score, stars, warning).  The clubs of the round are few rows
    that meet the per-club tables once."""
    nxt = proxima_rodada(partidas, temporada)
    sides = F.inline(F.array(F.struct(F.lit(1).alias("lado"), F.col("mandante").alias("clube")),
                             F.struct(F.lit(2).alias("lado"), F.col("visitante").alias("clube"))))
    games = (partidas.filter(F.col("temporada") == temporada).join(nxt.select("rodada"), "rodada")
             .select("partida_id", "rodada", sides))
    played = P.played(partidas)
    form = P.recent_form(played, n)
    strength = P.team_strength(played, P.max_year(partidas))
    known = P.strength_for(games.select("clube").distinct(), strength).join(form, "clube", "left")
    return games.join(known, "clube").select(
        "partida_id", "rodada", "lado", "clube", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("wins", "draws", "losses")],
        F.coalesce("resultados", F.lit("")).alias("resultados"), "score", "last_year", "pts_per_game", "stars")


def favorito(previsao: DataFrame) -> DataFrame:
    """Per game the gap max(p1, p2) - draw and a flag on the single
    clearest favourite (largest gap; lower match id on ties)."""
    scored = previsao.filter(F.col("p_clube1").isNotNull())
    gap = F.round(F.greatest("p_clube1", "p_clube2") - F.col("p_empate"), 1)
    best = scored.select("partida_id", gap.alias("gap")).orderBy(F.col("gap").desc(), "partida_id").limit(1)
    return (scored.select("partida_id", "clube1", "clube2", "p_clube1", "p_empate", "p_clube2", gap.alias("gap"))
            .join(best.select("partida_id", F.lit(True).alias("favorito")), "partida_id", "left")
            .withColumn("favorito", F.coalesce("favorito", F.lit(False))))
