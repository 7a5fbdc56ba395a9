"""G1-G7 gold builders and V1-V6 served views.

Every builder is a DataFrame -> DataFrame function; nothing is collected.
Stored row order is not part of a result, so the builders do not sort —
``write_table`` sorts within partitions when it writes.

Scale notes
* G3/G5 read the match table once (``sides``) and aggregate with a map-side
  partial aggregate; a club holding a third of all matches costs one partial
  row per map task.
* The ranking windows of G5/G6 run on the aggregated standings
  (seasons x clubs rows), never on match rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varzea.operators.sides import side_counts, sides

# Outcome zones of the final table.
ZONE_CHAMPION = "Campeão"
ZONE_LIBERTADORES = "Libertadores"
ZONE_SULAMERICANA = "Sul-Americana"
ZONE_RELEGATED = "Rebaixado"
ZONE_STAY = "Manutenção"
LIBERTADORES_MAX_POS = 4
SULAMERICANA_MAX_POS = 6
RELEGATION_SPOTS = 4


def campeonato_historico(partidas: DataFrame) -> DataFrame:
    """G1: all matches + ``resultado`` + ``total_gols``.  Unplayed matches
    (null goals) fall into ``empate`` and a null total, as in the source."""
    gm, gv = F.col("gols_mandante"), F.col("gols_visitante")
    cols = [c for c in ["partida_id", "temporada", "rodada", "data", "hora", "mandante", "visitante",
                        "gols_mandante", "gols_visitante", "vencedor", "arena",
                        "formacao_mandante", "formacao_visitante", "tecnico_mandante",
                        "tecnico_visitante", "estado_mandante", "estado_visitante"]
            if c in partidas.columns]
    return partidas.select(
        *cols,
        F.when(gm > gv, "mandante").when(gm < gv, "visitante").otherwise("empate").alias("resultado"),
        (gm + gv).alias("total_gols"),
        *([F.col("fonte")] if "fonte" in partidas.columns else []))


# Accented letters folded by the accent-insensitive option.
ACCENTED = "ÁÀÂÃÉÊÍÓÔÕÚÇáàâãéêíóôõúç"
UNACCENTED = "AAAAEEIOOOUCaaaaeeiooouc"


def _goal_type_flags(accent_insensitive: bool) -> tuple:
    t = F.lower(F.col("tipo_de_gol"))
    if accent_insensitive:
        t = F.lower(F.translate(F.col("tipo_de_gol"), ACCENTED, UNACCENTED))
    penalty = t.like("%penalty%") | t.like("%penalti%")
    own = t.like("%contra%")
    return penalty, own


def artilharia_historica(gols: DataFrame, accent_insensitive: bool = False) -> DataFrame:
    """Goals per season / player / club.  A null goal type is a normal
    goal.  Own goals are filtered out first, so ``gols_contra`` is 0 (kept
    for the published schema).  ``accent_insensitive`` also matches
    ``Pênalti``."""
    pen, own = _goal_type_flags(accent_insensitive)
    tipo = F.col("tipo_de_gol")
    g = gols.filter(F.col("atleta").isNotNull() & (F.col("atleta") != "") & (tipo.isNull() | ~own))
    return (g.groupBy("temporada", "atleta", "clube")
             .agg(F.count(F.lit(1)).alias("total_gols"),
                  F.count_if(tipo.isNotNull() & pen).alias("penaltis"),
                  F.count_if(tipo.isNotNull() & own).alias("gols_contra")))


def desempenho_clubes(partidas: DataFrame) -> DataFrame:
    """Season totals per club.  ``aproveitamento_pct`` is the *win* rate."""
    agg = sides(partidas, ["temporada"]).groupBy("temporada", "clube").agg(*side_counts())
    return agg.select(
        "temporada", "clube", "jogos", "vitorias", "empates", "derrotas",
        (F.col("vitorias") * 3 + F.col("empates")).alias("pontos"),
        "gols_pro", "gols_contra",
        (F.col("gols_pro") - F.col("gols_contra")).alias("saldo_gols"),
        F.round(F.col("vitorias").cast("double") / F.nullif(F.col("jogos"), F.lit(0)) * 100, 1)
         .alias("aproveitamento_pct"))


def fair_play(cartoes: DataFrame) -> DataFrame:
    """Yellow, red, score Y + 3R, distinct matches with a card."""
    c = F.lower(F.col("cartao"))
    y, r = F.count_if(c == "amarelo"), F.count_if(c == "vermelho")
    return (cartoes.filter(F.col("clube").isNotNull())
            .groupBy("temporada", "clube")
            .agg(y.alias("amarelos"), r.alias("vermelhos"), (y + r * 3).alias("pontos_fair_play"),
                 F.countDistinct("partida_id").alias("partidas_com_cartao")))


def standings_order() -> list:
    """Points, goal difference, goals for; club name as the final tie-break."""
    return [F.col("pontos").desc_nulls_last(), F.col("saldo_gols").desc_nulls_last(),
            F.col("gols_pro").desc_nulls_last(), F.col("clube").asc_nulls_last()]


def classificacao_historica(partidas: DataFrame, api: DataFrame | None = None,
                            api_mode: str = "replace") -> DataFrame:
    """Final table per season by points, goal difference, goals for
    (club name as last tie-break so positions repeat).

    ``api`` (provider standings): ``replace`` — when given, it is the whole
    result (the source's behaviour); ``prefer`` — provider rows replace the
    computed ones season by season.
    """
    d = desempenho_clubes(partidas).drop("aproveitamento_pct")
    w = Window.partitionBy("temporada").orderBy(*standings_order())
    computed = d.withColumn("posicao", F.row_number().over(w))
    cols = ["temporada", "clube", "jogos", "vitorias", "empates", "derrotas", "pontos",
            "gols_pro", "gols_contra", "saldo_gols", "posicao"]
    computed = computed.select(*cols)
    if api is None:
        return computed
    api = api.select(*[F.col(c).cast(computed.schema[c].dataType) for c in cols])
    if api_mode == "replace":
        return api
    if api_mode == "prefer":
        seasons = api.select("temporada").distinct()
        return computed.join(seasons, "temporada", "left_anti").unionByName(api)
    raise ValueError(f"unknown api_mode {api_mode!r}")


def rebaixamento_acesso(classificacao: DataFrame, spots: int = RELEGATION_SPOTS) -> DataFrame:
    """Season outcome per club.  Branch order matters: a champion of a
    tiny season is still "Campeão" even if it is also in the last ``spots``."""
    total = F.max("posicao").over(Window.partitionBy("temporada"))
    pos = F.col("posicao")
    ranked = classificacao.select("temporada", "clube", "posicao", "pontos", total.alias("_n"))
    return ranked.select(
        "temporada", "clube", "posicao", "pontos",
        F.when(pos == 1, ZONE_CHAMPION)
         .when(pos <= LIBERTADORES_MAX_POS, ZONE_LIBERTADORES)
         .when(pos <= SULAMERICANA_MAX_POS, ZONE_SULAMERICANA)
         .when(pos > F.col("_n") - spots, ZONE_RELEGATED)
         .otherwise(ZONE_STAY).alias("situacao"))


# The columns each gold input must carry.
GOLD_INPUT_COLUMNS = {
    "partidas": ["partida_id", "temporada", "rodada", "mandante", "visitante", "gols_mandante", "gols_visitante"],
    "gols": ["temporada", "atleta", "clube", "tipo_de_gol"],
    "cartoes": ["partida_id", "temporada", "clube", "cartao"],
}


def require_tables(tables: dict[str, DataFrame], required=("partidas", "gols", "cartoes"),
                   columns: dict[str, list[str]] | None = None, non_empty: bool = False) -> None:
    """Fail early when an input table, one of its columns or (with
    ``non_empty``) its rows are missing.  The row check is ``limit(1)`` per
    table: one small job, a boolean to the driver."""
    missing = [t for t in required if tables.get(t) is None]
    if missing:
        raise ValueError(f"missing silver tables: {missing}")
    for t, cols in (columns or {}).items():
        absent = [c for c in cols if c not in tables[t].columns]
        if absent:
            raise ValueError(f"table {t} lacks columns {absent}")
    if non_empty:
        empty = [t for t in required if tables[t].limit(1).count() == 0]
        if empty:
            raise ValueError(f"silver tables without rows: {empty}")


def build_gold(partidas: DataFrame, gols: DataFrame, cartoes: DataFrame,
               api_standings: DataFrame | None = None, api_mode: str = "replace") -> dict[str, DataFrame]:
    """The six gold tables, in dependency order (G6 reads G5's plan)."""
    require_tables({"partidas": partidas, "gols": gols, "cartoes": cartoes}, columns=GOLD_INPUT_COLUMNS)
    classif = classificacao_historica(partidas, api_standings, api_mode)
    return {
        "campeonato_historico": campeonato_historico(partidas),
        "artilharia_historica": artilharia_historica(gols),
        "desempenho_clubes": desempenho_clubes(partidas),
        "fair_play": fair_play(cartoes),
        "classificacao_historica": classif,
        "rebaixamento_acesso": rebaixamento_acesso(classif),
    }


# ---- V1..V6 served views ------------------------------------------------------

def v_artilharia_geral(artilharia: DataFrame) -> DataFrame:
    """V1: all-time goals per player and club."""
    return artilharia.groupBy("atleta", "clube").agg(F.sum("total_gols").alias("gols_historico"))


def v_campeoes(rebaixamento: DataFrame) -> DataFrame:
    """V2."""
    return (rebaixamento.filter(F.col("situacao") == ZONE_CHAMPION)
            .select("temporada", "clube", "pontos", "posicao"))


def v_rebaixados(rebaixamento: DataFrame) -> DataFrame:
    """V3."""
    return (rebaixamento.filter(F.col("situacao") == ZONE_RELEGATED)
            .select("temporada", "clube", "posicao", "pontos"))


def v_desempenho_geral(desempenho: DataFrame) -> DataFrame:
    """V4: seasons played, totals and mean win rate per club."""
    return desempenho.groupBy("clube").agg(
        F.countDistinct("temporada").alias("temporadas"),
        F.sum("pontos").alias("pontos_total"),
        F.sum("vitorias").alias("vitorias_total"),
        F.sum("gols_pro").alias("gols_pro_total"),
        F.sum("gols_contra").alias("gols_contra_total"),
        F.round(F.avg("aproveitamento_pct"), 1).alias("aproveitamento_medio"))


def v_media_gols_temporada(campeonato: DataFrame) -> DataFrame:
    """V5: matches (played or not), mean and total goals per season."""
    return campeonato.groupBy("temporada").agg(
        F.count(F.lit(1)).alias("partidas"),
        F.round(F.avg("total_gols"), 2).alias("media_gols"),
        F.sum("total_gols").alias("total_gols"))


VIEW_BUILDERS = {
    "v_artilharia_geral": ("artilharia_historica", v_artilharia_geral),
    "v_campeoes": ("rebaixamento_acesso", v_campeoes),
    "v_rebaixados": ("rebaixamento_acesso", v_rebaixados),
    "v_desempenho_geral": ("desempenho_clubes", v_desempenho_geral),
    "v_media_gols_temporada": ("campeonato_historico", v_media_gols_temporada),
}

# The same views as text, for a catalog: view -> (table, SELECT).
VIEW_SQL = {
    "v_artilharia_geral": ("artilharia_historica", "SELECT atleta, clube, SUM(total_gols) AS gols_historico "
                                                   "FROM {table} GROUP BY atleta, clube"),
    "v_campeoes": ("rebaixamento_acesso", "SELECT temporada, clube, pontos, posicao FROM {table} "
                                          f"WHERE situacao = '{ZONE_CHAMPION}'"),
    "v_rebaixados": ("rebaixamento_acesso", "SELECT temporada, clube, posicao, pontos FROM {table} "
                                            f"WHERE situacao = '{ZONE_RELEGATED}'"),
    "v_desempenho_geral": ("desempenho_clubes", "SELECT clube, COUNT(DISTINCT temporada) AS temporadas, "
                           "SUM(pontos) AS pontos_total, SUM(vitorias) AS vitorias_total, SUM(gols_pro) AS gols_pro_total, "
                           "SUM(gols_contra) AS gols_contra_total, ROUND(AVG(aproveitamento_pct), 1) AS aproveitamento_medio "
                           "FROM {table} GROUP BY clube"),
    "v_media_gols_temporada": ("campeonato_historico", "SELECT temporada, COUNT(*) AS partidas, "
                               "ROUND(AVG(total_gols), 2) AS media_gols, SUM(total_gols) AS total_gols "
                               "FROM {table} GROUP BY temporada"),
}


def create_views(gold: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """V6: (re)create every gold table and served view as a temp view."""
    out = dict(gold)
    for name, (src, fn) in VIEW_BUILDERS.items():
        out[name] = fn(gold[src])
    for name, df in out.items():
        df.createOrReplaceTempView(name)
    return out
