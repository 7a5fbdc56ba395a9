"""The dashboard exports (gold/silver -> JSON-ready DataFrames).

Write them with ``varzea.sources.sinks.export_json``.  Row order is applied
by the writer, not here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def export_classificacao(classif: DataFrame) -> DataFrame:
    """E1."""
    return classif


def export_campeoes(classif: DataFrame) -> DataFrame:
    """Season winner = best points; ties (arbitrary in the source) are
    broken by wins, goal difference, then club name.  The running season also
    gets a "champion", as in the published file."""
    w = Window.partitionBy("temporada").orderBy(F.col("pontos").desc(), F.col("vitorias").desc(),
                                                F.col("saldo_gols").desc(), F.col("clube").asc())
    return (classif.withColumn("_pos", F.row_number().over(w)).filter(F.col("_pos") == 1)
            .select("temporada", "clube", "pontos"))


def export_partidas_resumo(campeonato: DataFrame) -> DataFrame:
    """Match summary with the date as ISO text."""
    return campeonato.select("partida_id", "temporada", "rodada", F.col("data").cast("string").alias("data"),
                             "mandante", "gols_mandante", "gols_visitante", "visitante", "arena", "fonte")


def export_artilharia(artilharia: DataFrame) -> DataFrame:
    """E4."""
    return artilharia.select("temporada", "atleta", "clube", F.col("total_gols").alias("gols"),
                             "penaltis", "gols_contra")


def export_fair_play(fair: DataFrame) -> DataFrame:
    """E5."""
    return fair


def export_desempenho(desempenho: DataFrame) -> DataFrame:
    """E6."""
    return desempenho


def export_rebaixamento(rebaixamento: DataFrame) -> DataFrame:
    """E7."""
    return rebaixamento


def export_silver(table: DataFrame) -> DataFrame:
    """Goals / cards / statistics dumps."""
    return table


def export_clubes(campeonato: DataFrame) -> DataFrame:
    """Distinct home clubs."""
    return campeonato.select(F.col("mandante").alias("clube")).distinct()


def export_temporadas_meta(campeonato: DataFrame) -> DataFrame:
    """Per season — matches, goals (null-safe), first and last date,
    and matches played (``partidas_disputadas``, read by the pages)."""
    gm, gv = F.col("gols_mandante"), F.col("gols_visitante")
    d = F.col("data").cast("string")
    return campeonato.groupBy("temporada").agg(
        F.count(F.lit(1)).alias("total_partidas"),
        F.sum(F.when(gm.isNotNull(), gm + gv).otherwise(F.lit(0))).alias("total_gols"),
        F.min(d).alias("inicio"), F.max(d).alias("fim"),
        F.count(gm).alias("partidas_disputadas"))


# Export names and their row order in the written files
# (nulls last in both directions, as the source's engine orders them).
EXPORT_ORDER = {
    "classificacao": ["temporada DESC NULLS LAST", "pontos DESC NULLS LAST"],
    "campeoes": ["temporada DESC NULLS LAST"],
    "partidas_resumo": ["temporada DESC NULLS LAST", "rodada ASC NULLS LAST", "data ASC NULLS LAST"],
    "artilharia": ["temporada DESC NULLS LAST", "gols DESC NULLS LAST"],
    "fair_play": ["temporada DESC NULLS LAST", "pontos_fair_play DESC NULLS LAST"],
    "desempenho_clubes": ["temporada DESC NULLS LAST"],
    "rebaixamento_acesso": ["temporada DESC NULLS LAST", "posicao ASC NULLS LAST"],
    "gols": ["temporada DESC NULLS LAST", "partida_id ASC NULLS LAST", "minuto ASC NULLS LAST"],
    "cartoes": ["temporada DESC NULLS LAST", "partida_id ASC NULLS LAST", "minuto ASC NULLS LAST"],
    "estatisticas": ["temporada DESC NULLS LAST", "partida_id ASC NULLS LAST"],
    "clubes": ["clube ASC NULLS LAST"],
    "temporadas_meta": ["temporada DESC NULLS LAST"],
}


def all_exports(gold: dict[str, DataFrame], silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All twelve exports by file name."""
    return {
        "classificacao": export_classificacao(gold["classificacao_historica"]),
        "campeoes": export_campeoes(gold["classificacao_historica"]),
        "partidas_resumo": export_partidas_resumo(gold["campeonato_historico"]),
        "artilharia": export_artilharia(gold["artilharia_historica"]),
        "fair_play": export_fair_play(gold["fair_play"]),
        "desempenho_clubes": export_desempenho(gold["desempenho_clubes"]),
        "rebaixamento_acesso": export_rebaixamento(gold["rebaixamento_acesso"]),
        "gols": export_silver(silver["gols"]),
        "cartoes": export_silver(silver["cartoes"]),
        "estatisticas": export_silver(silver["estatisticas"]),
        "clubes": export_clubes(gold["campeonato_historico"]),
        "temporadas_meta": export_temporadas_meta(gold["campeonato_historico"]),
    }
