"""Q1-Q42: the parametrised query library.

Each function takes DataFrames (silver / gold tables) plus parameters that
replace the literals of the original SQL, and returns a DataFrame.  Top-k
queries always end with a total-order tie-break so results repeat; they plan
as ``TakeOrderedAndProject`` (per-partition top-k, then an n-row merge).
Windows that were global in the source (``ROW_NUMBER() OVER (ORDER BY …)``
after a season filter) are partitioned by season so they never pull a whole
table into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varzea.functions.columns import club_match
from varzea.operators.gold import v_campeoes, v_rebaixados


class _Cols:
    """Column shorthands built on first use (a Column needs a live session)."""

    @property
    def gm(self):
        return F.col("gols_mandante")

    @property
    def gv(self):
        return F.col("gols_visitante")

    @property
    def played(self):
        return F.col("gols_mandante").isNotNull()


_C = _Cols()


def _pair(a: str, b: str, collation: str | None = None):
    return ((club_match("mandante", a, collation) & club_match("visitante", b, collation))
            | (club_match("mandante", b, collation) & club_match("visitante", a, collation)))


# ---- 1. exploration ---------------------------------------------------------------

def partidas_por_temporada(partidas: DataFrame) -> DataFrame:
    """Q1."""
    return partidas.groupBy("temporada").agg(F.count(F.lit(1)).alias("total"))


def classificacao_temporada(classif: DataFrame, temporada: int) -> DataFrame:
    """Q2."""
    return (classif.filter(F.col("temporada") == temporada)
            .select("clube", "pontos", "vitorias", "empates", "derrotas"))


def campeoes(rebaixamento: DataFrame) -> DataFrame:
    """Champions list."""
    return v_campeoes(rebaixamento)


def top_jogos_gols(partidas: DataFrame, n: int = 10) -> DataFrame:
    """Q4: the n highest-scoring matches (ties: lower match id first)."""
    return (partidas.filter(_C.played)
            .select("partida_id", "data", "mandante", "gols_mandante", "gols_visitante", "visitante",
                    (_C.gm + _C.gv).alias("total_gols"))
            .orderBy(F.col("total_gols").desc(), F.col("partida_id").asc()).limit(n))


def confrontos(partidas: DataFrame, a: str, b: str, collation: str | None = None) -> DataFrame:
    """Q5: every meeting of two clubs, either venue."""
    return (partidas.filter(_pair(a, b, collation))
            .select("partida_id", "temporada", "data", "rodada", "gols_mandante", "gols_visitante"))


def total_partidas(partidas: DataFrame) -> DataFrame:
    """Q6."""
    return partidas.agg(F.count(F.lit(1)).alias("total_partidas"))


def rodada(partidas: DataFrame, temporada: int, numero: int) -> DataFrame:
    """Q7: one round of one season (prunes on the season partition when the
    table is stored partitioned by season)."""
    return (partidas.filter((F.col("temporada") == temporada) & (F.col("rodada") == numero))
            .select("partida_id", "rodada", "data", "mandante", "gols_mandante", "gols_visitante",
                    "visitante", "arena"))


def jogos_clube(partidas: DataFrame, clube: str, temporada: int) -> DataFrame:
    """Q8: one club's games of one season."""
    return (partidas.filter((F.col("temporada") == temporada)
                            & ((F.col("mandante") == clube) | (F.col("visitante") == clube)))
            .select("partida_id", "data", "rodada", "mandante", "gols_mandante", "gols_visitante", "visitante"))


def ultimos_finalizados(partidas: DataFrame, n: int = 20) -> DataFrame:
    """Q9: last n finished matches (newest date, then highest id)."""
    return (partidas.filter(F.col("status") == "finished")
            .select("partida_id", "temporada", "data", "mandante", "gols_mandante", "gols_visitante", "visitante")
            .orderBy(F.col("data").desc(), F.col("partida_id").desc()).limit(n))


# ---- 2. aggregates -----------------------------------------------------------------

def _season_table(classif: DataFrame, temporada: int, full: bool) -> DataFrame:
    w = Window.partitionBy("temporada").orderBy(F.col("pontos").desc(), F.col("vitorias").desc(),
                                                F.col("clube").asc())
    c = classif.filter(F.col("temporada") == temporada).withColumn("pos", F.row_number().over(w))
    cols = [F.col("pos"), "clube", "pontos", F.col("vitorias").alias("V"), F.col("empates").alias("E"),
            F.col("derrotas").alias("D")]
    if full:
        cols += [F.col("gols_pro").alias("GP"), F.col("gols_contra").alias("GC"),
                 (F.col("gols_pro") - F.col("gols_contra")).alias("SG")]
    return c.select(*cols)


def tabela_temporada(classif: DataFrame, temporada: int) -> DataFrame:
    """Q10: season table with position by points then wins."""
    return _season_table(classif, temporada, True)


def tabela_parcial(classif: DataFrame, temporada: int) -> DataFrame:
    """Q11: partial table of the running season."""
    return _season_table(classif, temporada, False)


def titulos_por_clube(rebaixamento: DataFrame) -> DataFrame:
    """Titles per club."""
    return v_campeoes(rebaixamento).groupBy("clube").agg(F.count(F.lit(1)).alias("titulos"))


def gols_temporada(partidas: DataFrame) -> DataFrame:
    """Q14: goals, matches and mean per season (played matches)."""
    tot = F.sum(_C.gm + _C.gv)
    return (partidas.filter(_C.played).groupBy("temporada")
            .agg(tot.alias("total_gols"), F.count(F.lit(1)).alias("partidas"),
                 F.round(tot.cast("double") / F.count(F.lit(1)), 2).alias("media")))


def top_artilheiros(artilharia_geral: DataFrame, n: int = 20) -> DataFrame:
    """Q15: top-n all-time scorers (view V1 + order + limit)."""
    return artilharia_geral.orderBy(F.col("gols_historico").desc(), "atleta", "clube").limit(n)


def artilharia_temporada_bruta(gols: DataFrame, temporada: int, n: int = 20) -> DataFrame:
    """Q16: season scorers from raw goals (own goals counted)."""
    return (gols.filter(F.col("temporada") == temporada)
            .groupBy("atleta", "clube", "temporada").agg(F.count(F.lit(1)).alias("gols"))
            .orderBy(F.col("gols").desc(), "atleta", "clube").limit(n))


def aproveitamento_historico(classif: DataFrame, pts_possiveis: int = 114, n: int = 20) -> DataFrame:
    """Q17: all-time points and % of the possible points (``pts_possiveis``
    per season)."""
    return (classif.groupBy("clube")
            .agg(F.sum("pontos").alias("pontos_total"), F.sum("vitorias").alias("vitorias"),
                 F.sum("empates").alias("empates"), F.sum("derrotas").alias("derrotas"),
                 F.count(F.lit(1)).alias("temporadas"),
                 F.round(F.sum("pontos").cast("double") / (F.count(F.lit(1)) * pts_possiveis) * 100, 1)
                  .alias("aproveitamento_pct"))
            .orderBy(F.col("pontos_total").desc(), "clube").limit(n))


def evolucao_clube(classif: DataFrame, clube: str) -> DataFrame:
    """Q18."""
    return (classif.filter(F.col("clube") == clube)
            .select("temporada", "pontos", "vitorias", "empates", "derrotas", "gols_pro", "gols_contra",
                    (F.col("gols_pro") - F.col("gols_contra")).alias("saldo")))


def mais_rebaixados(rebaixamento: DataFrame, n: int = 15) -> DataFrame:
    """Q19 / Q37c."""
    return (v_rebaixados(rebaixamento).groupBy("clube").agg(F.count(F.lit(1)).alias("rebaixamentos"))
            .orderBy(F.col("rebaixamentos").desc(), "clube").limit(n))


def mandante_vs_visitante(partidas: DataFrame) -> DataFrame:
    """Q20: home / draw / away wins and home-win % per season."""
    hw = F.count_if(_C.gm > _C.gv)
    return (partidas.filter(_C.played).groupBy("temporada")
            .agg(F.count(F.lit(1)).alias("partidas"), hw.alias("vit_mandante"),
                 F.count_if(_C.gm == _C.gv).alias("empates"), F.count_if(_C.gm < _C.gv).alias("vit_visitante"),
                 F.round(hw.cast("double") / F.count(F.lit(1)) * 100, 1).alias("pct_casa")))


def melhor_visitante(partidas: DataFrame, min_jogos: int = 50, status: str | None = "finished",
                     n: int = 15) -> DataFrame:
    """Q21: best away win rate with at least ``min_jogos`` away games.
    ``status=None`` drops the status filter (all played matches)."""
    f = _C.played if status is None else _C.played & (F.col("status") == status)
    wins = F.count_if(_C.gv > _C.gm)
    return (partidas.filter(f).groupBy(F.col("visitante").alias("clube"))
            .agg(F.count(F.lit(1)).alias("jogos_fora"), wins.alias("vitorias_fora"),
                 F.round(wins.cast("double") / F.count(F.lit(1)) * 100, 1).alias("pct_vitoria_fora"))
            .filter(F.col("jogos_fora") >= min_jogos)
            .orderBy(F.col("pct_vitoria_fora").desc(), "clube").limit(n))


# ---- 3. joins and windows ---------------------------------------------------------------

def medias_estatisticas(estatisticas: DataFrame, partidas: DataFrame, por_temporada: bool = False) -> DataFrame:
    """Q22: mean possession / shots / corners / fouls per season (inner join
    to matches; statistics without a match drop out).  Statistics that are
    stored by their match's season may be joined ``por_temporada`` too: a filter
    on the matches then leaves out the folders of other seasons, when the query
    is planned or, for other columns than the season, when it runs."""
    keys = ["partida_id", "temporada"] if por_temporada else ["partida_id"]
    e = estatisticas.select(*keys, "posse_de_bola", "chutes", "escanteios", "faltas")
    p = partidas.select("partida_id", "temporada")
    return (e.join(p, keys).groupBy("temporada")
            .agg(F.round(F.avg("posse_de_bola"), 1).alias("media_posse"),
                 F.round(F.avg("chutes"), 1).alias("media_chutes"),
                 F.round(F.avg("escanteios"), 1).alias("media_escanteios"),
                 F.round(F.avg("faltas"), 1).alias("media_faltas")))


def partidas_mais_cartoes(cartoes: DataFrame, partidas: DataFrame, n: int = 10) -> DataFrame:
    """Q23: matches with most cards.  Cards are aggregated per match *before*
    the join (one row per match crosses the shuffle instead of every card)."""
    per_match = (cartoes.filter(F.col("partida_id").isNotNull()).groupBy("partida_id")
                 .agg(F.count(F.lit(1)).alias("total_cartoes"),
                      F.count_if(F.col("cartao") == "Vermelho").alias("vermelhos")))
    p = partidas.select("partida_id", "data", "mandante", "gols_mandante", "gols_visitante", "visitante")
    return (per_match.join(p, "partida_id")
            .select("partida_id", "data", "mandante", "gols_mandante", "gols_visitante", "visitante",
                    "total_cartoes", "vermelhos")
            .orderBy(F.col("total_cartoes").desc(), F.col("partida_id").asc()).limit(n))


# Zone thresholds of the ranking query (by rank, not position).
ZONE_RANK_LIBERTADORES = 4
ZONE_RANK_SULAMERICANA = 6
ZONE_RANK_RELEGATION = 17


def ranking_zonas(classif: DataFrame, temporada: int) -> DataFrame:
    """Q24: rank by points inside the season + zone label (rank computed once)."""
    r = F.rank().over(Window.partitionBy("temporada").orderBy(F.col("pontos").desc()))
    c = classif.filter(F.col("temporada") == temporada).select("temporada", "clube", "pontos", r.alias("posicao"))
    p = F.col("posicao")
    return c.withColumn("zona", F.when(p <= ZONE_RANK_LIBERTADORES, "Libertadores")
                        .when(p <= ZONE_RANK_SULAMERICANA, "Sul-Americana")
                        .when(p >= ZONE_RANK_RELEGATION, "Rebaixamento").otherwise(""))


def campeao_vs_vice(classif: DataFrame, rank_fn: str = "rank") -> DataFrame:
    """Q25: champion vs runner-up points gap per season.  ``rank`` (the
    source): a tie at the top leaves no rank 2 and the season drops out;
    ``row_number``: always one champion and one runner-up (ties broken by
    goal difference, goals for, club name)."""
    if rank_fn == "row_number":
        r = F.row_number().over(Window.partitionBy("temporada").orderBy(
            F.col("pontos").desc(), F.col("saldo_gols").desc(), F.col("gols_pro").desc(), F.col("clube")))
    else:
        r = F.rank().over(Window.partitionBy("temporada").orderBy(F.col("pontos").desc()))
    ranked = classif.select("temporada", "clube", "pontos", r.alias("pos"))
    c = ranked.filter(F.col("pos") == 1).select("temporada", F.col("clube").alias("campeao"),
                                                 F.col("pontos").alias("pts_campeao"))
    v = ranked.filter(F.col("pos") == 2).select("temporada", F.col("clube").alias("vice"),
                                                 F.col("pontos").alias("pts_vice"))
    return (c.join(v, "temporada")
            .select("temporada", "campeao", "pts_campeao", "vice", "pts_vice",
                    (F.col("pts_campeao") - F.col("pts_vice")).alias("diferenca")))


# ---- 4. special -----------------------------------------------------------------------

def retrospecto(partidas: DataFrame, a: str, b: str) -> DataFrame:
    """Q26: tally of two clubs (played meetings)."""
    def wins(club):
        return F.count_if(((F.col("mandante") == club) & (_C.gm > _C.gv)) | ((F.col("visitante") == club) & (_C.gv > _C.gm)))
    return (partidas.filter(_pair(a, b) & _C.played)
            .agg(F.count(F.lit(1)).alias("jogos"), wins(a).alias("vitorias_a"),
                 F.count_if(_C.gm == _C.gv).alias("empates"), wins(b).alias("vitorias_b"),
                 F.sum(_C.gm + _C.gv).alias("total_gols")))


def retrospecto_todos(partidas: DataFrame) -> DataFrame:
    """Q26, set-wise: the same tally for every pair of clubs in one
    aggregate (a = the alphabetically first club)."""
    a = F.least("mandante", "visitante")
    b = F.greatest("mandante", "visitante")
    a_home = F.col("mandante") == a
    win_a = (a_home & (_C.gm > _C.gv)) | (~a_home & (_C.gv > _C.gm))
    win_b = (a_home & (_C.gv > _C.gm)) | (~a_home & (_C.gm > _C.gv))
    return (partidas.filter(_C.played).groupBy(a.alias("clube_a"), b.alias("clube_b"))
            .agg(F.count(F.lit(1)).alias("jogos"), F.count_if(win_a).alias("vitorias_a"),
                 F.count_if(_C.gm == _C.gv).alias("empates"), F.count_if(win_b).alias("vitorias_b"),
                 F.sum(_C.gm + _C.gv).alias("total_gols")))


def confronto_direto(partidas: DataFrame, time1: str, time2: str) -> DataFrame:
    """Q27: played meetings of two parameter clubs."""
    return (partidas.filter(_pair(time1, time2) & _C.played)
            .select("partida_id", "temporada", "data", "rodada", "mandante", "gols_mandante",
                    "gols_visitante", "visitante"))


def maiores_goleadas(partidas: DataFrame, n: int = 10) -> DataFrame:
    """Biggest margins, then most goals."""
    return (partidas.filter(_C.played)
            .select("partida_id", "temporada", "data", "mandante", "gols_mandante", "gols_visitante", "visitante",
                    F.abs(_C.gm - _C.gv).alias("diferenca"), (_C.gm + _C.gv).alias("_tot"))
            .orderBy(F.col("diferenca").desc(), F.col("_tot").desc(), F.col("partida_id").asc())
            .limit(n).drop("_tot"))


def vezes_no_g4(rebaixamento: DataFrame, n: int = 10) -> DataFrame:
    """Q29."""
    return (rebaixamento.filter(F.col("posicao") <= 4).groupBy("clube")
            .agg(F.count(F.lit(1)).alias("vezes_no_g4"))
            .orderBy(F.col("vezes_no_g4").desc(), "clube").limit(n))


def gols_por_rodada(partidas: DataFrame, n: int = 15) -> DataFrame:
    """Q30."""
    return (partidas.filter(_C.played).groupBy("temporada", "rodada")
            .agg(F.sum(_C.gm + _C.gv).alias("gols_rodada"), F.count(F.lit(1)).alias("partidas"))
            .orderBy(F.col("gols_rodada").desc(), "temporada", "rodada").limit(n))


def tabela_mandante(partidas: DataFrame, temporada: int) -> DataFrame:
    """Q31: home-only table of a season.  ``pos_ref`` orders by the source's
    score 3·(wins+draws)+draws (a draw weighs 4); ``pontos`` is the usual
    3V+E beside it.  Aggregate first, then rank per season."""
    agg = (partidas.filter((F.col("temporada") == temporada) & (F.col("status") == "finished"))
           .groupBy("temporada", F.col("mandante").alias("clube"))
           .agg(F.count(F.lit(1)).alias("jogos"), F.count_if(_C.gm > _C.gv).alias("V"),
                F.count_if(_C.gm == _C.gv).alias("E"), F.count_if(_C.gm < _C.gv).alias("D")))
    score_ref = (F.col("V") + F.col("E")) * 3 + F.col("E")
    w = Window.partitionBy("temporada").orderBy(score_ref.desc(), F.col("clube").asc())
    return agg.select(F.row_number().over(w).alias("pos_ref"), "clube", "jogos", "V", "E", "D",
                      score_ref.alias("pontos_ref"), (F.col("V") * 3 + F.col("E")).alias("pontos"))


def forma_mandante(partidas: DataFrame, temporada: int, clubes: Sequence[str],
                   n: int | None = None) -> DataFrame:
    """Q32: home results (V/E/D) of the named clubs; ``n`` keeps the last n
    rounds per club (planned as a per-group limit, not a full sort)."""
    p = (partidas.filter((F.col("temporada") == temporada) & (F.col("status") == "finished")
                         & F.col("mandante").isin(*clubes))
         .select("partida_id", F.col("mandante").alias("clube"), "rodada", F.col("gols_mandante").alias("gf"),
                 F.col("gols_visitante").alias("gc"),
                 F.when(_C.gm > _C.gv, "V").when(_C.gm == _C.gv, "E").otherwise("D").alias("resultado")))
    if n is None:
        return p
    w = Window.partitionBy("clube").orderBy(F.col("rodada").desc(), F.col("partida_id").desc())
    return p.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def por_status(partidas: DataFrame, status: str | None) -> DataFrame:
    """Q33: ``finished`` / ``notStarted`` / None (all)."""
    return partidas if status is None else partidas.filter(F.col("status") == status)


def clubes_distintos(partidas: DataFrame) -> DataFrame:
    """Distinct home clubs."""
    return partidas.select(F.col("mandante").alias("clube")).distinct()


def template_clube(classif: DataFrame, rebaixamento: DataFrame, clube: str) -> DataFrame:
    """Q35: one club's seasons with the final position (left join)."""
    c = classif.filter(F.col("clube") == clube)
    r = rebaixamento.select("temporada", "clube", F.col("posicao").alias("classificacao_final"))
    return (c.join(r, ["temporada", "clube"], "left")
            .select("temporada", "pontos", F.col("vitorias").alias("V"), F.col("empates").alias("E"),
                    F.col("derrotas").alias("D"), F.col("gols_pro").alias("GP"),
                    F.col("gols_contra").alias("GC"), (F.col("gols_pro") - F.col("gols_contra")).alias("SG"),
                    "classificacao_final"))


# ---- gold demo / console queries (Q36-Q42) ----------------------------------------------

def top_artilheiros_gold(artilharia: DataFrame, n: int = 10) -> DataFrame:
    """Q36a."""
    return (artilharia.groupBy("atleta", "clube").agg(F.sum("total_gols").alias("gols"))
            .orderBy(F.col("gols").desc(), "atleta", "clube").limit(n))


def artilheiros_temporada(artilharia: DataFrame, temporada: int, n: int = 10) -> DataFrame:
    """Q36b / Q42b."""
    return (artilharia.filter(F.col("temporada") == temporada)
            .select("atleta", "clube", F.col("total_gols").alias("gols"))
            .orderBy(F.col("gols").desc(), "atleta", "clube").limit(n))


def desempenho_clube(desempenho: DataFrame, clube: str) -> DataFrame:
    """Q38."""
    return (desempenho.filter(F.col("clube") == clube)
            .select("temporada", "pontos", "vitorias", "empates", "derrotas", "saldo_gols", "aproveitamento_pct"))


def pior_disciplina(fair: DataFrame, n: int = 10) -> DataFrame:
    """Q39: worst discipline over all seasons."""
    return (fair.groupBy("clube")
            .agg(F.sum("amarelos").alias("total_amarelos"), F.sum("vermelhos").alias("total_vermelhos"),
                 F.sum("pontos_fair_play").alias("score_punicao"))
            .orderBy(F.col("score_punicao").desc(), "clube").limit(n))


def top_partidas_gold(campeonato: DataFrame, n: int = 10) -> DataFrame:
    """No null filter — null totals sort last (DESC NULLS LAST)."""
    return (campeonato.select("partida_id", "temporada", "rodada", "mandante", "visitante", "gols_mandante",
                              "gols_visitante", "total_gols", "arena")
            .orderBy(F.col("total_gols").desc_nulls_last(), F.col("partida_id").asc()).limit(n))


def media_gols_gold(campeonato: DataFrame) -> DataFrame:
    """Q40b."""
    return campeonato.groupBy("temporada").agg(
        F.count(F.lit(1)).alias("partidas"), F.round(F.avg("total_gols"), 2).alias("media_gols_por_jogo"),
        F.sum("total_gols").alias("total_gols"))


def partidas_temporada(partidas: DataFrame, temporada: int) -> DataFrame:
    """Q41."""
    return (partidas.filter(F.col("temporada") == temporada)
            .select("partida_id", "rodada", "data", "mandante", "visitante", "gols_mandante", "gols_visitante"))


def console_classificacoes(classif: DataFrame) -> DataFrame:
    """Q42a (labelled "champions" but returns every standings row)."""
    return classif.select("temporada", "clube", "pontos")


def mais_disciplinados(fair: DataFrame, temporada: int, n: int = 10) -> DataFrame:
    """Q42d: most disciplined clubs of a season (ascending score)."""
    return (fair.filter(F.col("temporada") == temporada)
            .select("clube", "temporada", "amarelos", "vermelhos", "pontos_fair_play")
            .orderBy(F.col("pontos_fair_play").asc(), "clube").limit(n).drop("pontos_fair_play"))


def console_confronto(campeonato: DataFrame, a: str, b: str) -> DataFrame:
    """Q42e."""
    return (campeonato.filter(_pair(a, b))
            .select("partida_id", "temporada", "mandante", "gols_mandante", "gols_visitante", "visitante"))
