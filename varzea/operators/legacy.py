"""The notebook analyses of the yearly legacy sheets, as Spark jobs.

The notebooks loop over rows and clubs in pandas; here each analysis is one
scan with a grouped aggregate (or a broadcast join to a small, fixed
dimension).  Legacy sheet columns: ``Clube 1``, ``Clube 2``, ``Placar``
(``2x1``), ``Vencedor`` (``-`` = draw), ``Data``, ``Dia``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varzea.functions.columns import capitalize_first

C1, C2, WIN = "Clube 1", "Clube 2", "Vencedor"

# Club -> state dictionary of the analysis notebook (odd codes
# such as vitória -> ES and bahia -> BH are kept as they are).
CLUB_STATES = {
    "vasco": "RJ", "vitória": "ES", "fluminense": "RJ", "américa-mg": "MG", "guarani": "SP",
    "cruzeiro": "MG", "botafogo": "RJ", "goiás": "GO", "juventude": "RS", "coritiba": "PR",
    "gama": "DF", "santos": "SP", "bahia": "BH", "ponte preta": "SP", "internacional": "RS",
    "flamengo": "RJ", "palmeiras": "SP", "atlético-pr": "PR", "corinthians": "SP", "portuguesa": "SP",
    "atlético-mg": "MG", "são paulo": "SP", "grêmio": "RS", "santa cruz": "PE", "sport": "PE",
    "paraná": "PR", "remo": "PA", "malutrom": "PR", "são caetano": "SP", "botafogo-rj": "RJ",
    "botafogo-sp": "SP", "figueirense": "SC", "paysandu": "PA", "criciúma": "SC", "fortaleza": "CE",
    "brasiliense": "DF", "américa-rn": "RN", "náutico": "PE", "ipatinga": "MG", "avaí": "SC",
    "santo andré": "SP", "barueri": "SP", "atlético-go": "GO", "ceará": "CE", "grêmio prudente": "SP",
    "chapecoense": "SC", "joinville": "SC",
}

# Manual point adjustments of the yearly tables
# (season, club, points, draws, losses).
ADJUSTMENTS = [
    (2016, "atlético-mg", -1, -1, 1),
    (2016, "chapecoense", -1, -1, 1),
    (2018, "sport", -3, 0, 0),
]


def _q(c: str):
    return F.col(f"`{c}`")


def trim_all(df: DataFrame) -> DataFrame:
    """Trim every text column."""
    return df.select(*[F.trim(_q(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else _q(f.name)
                       for f in df.schema.fields])


def split_score(df: DataFrame, col: str = "Placar") -> DataFrame:
    """Trim all text columns, split ``2x1`` into ``p1``/``p2`` (numbers;
    not a number -> null) and drop the score text."""
    t = trim_all(df)
    parts = F.split(_q(col), "x")
    return (t.withColumn("p1", F.trim(F.get(parts, 0)).try_cast("bigint"))
             .withColumn("p2", F.trim(F.get(parts, 1)).try_cast("bigint")).drop(col))


def null_profile(df: DataFrame) -> DataFrame:
    """Null count of every column — one aggregate pass, then unpivot to
    (coluna, nulos)."""
    counts = df.agg(*[F.count_if(_q(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], [_q(c) for c in df.columns], "coluna", "nulos")


def club_list(df: DataFrame) -> DataFrame:
    """Every club name of both columns, lower-cased, distinct."""
    return (df.select(F.explode(F.array(F.lower(F.trim(_q(C1))), F.lower(F.trim(_q(C2))))).alias("clube"))
            .distinct())


def state_dimension(spark: SparkSession, mapping: dict[str, str] | None = None) -> DataFrame:
    """The fixed club -> state dictionary as a small DataFrame."""
    m = CLUB_STATES if mapping is None else mapping
    return spark.createDataFrame(sorted(m.items()), "clube string, estado string")


def with_states(df: DataFrame, states: DataFrame) -> DataFrame:
    """State of home club, away club and winner by lookup on the lower-
    cased trimmed name; a winner without a state (a draw) is ``Empate``.
    ``states`` is a club dictionary; the planner broadcasts it when its
    measured size is under the threshold (three map-side joins, no shuffle of
    the match rows), otherwise it shuffles."""
    dim = states.select(F.lower(F.trim("clube")).alias("_k"), F.col("estado").alias("_e"))

    def look(out, src, empty=None):
        nonlocal df
        df = (df.join(dim, F.lower(F.trim(_q(src))) == F.col("_k"), "left")
              .withColumn(out, F.coalesce(F.col("_e"), F.lit(empty)) if empty else F.col("_e"))
              .drop("_k", "_e"))
    look("C1 Estado", C1)
    look("C2 Estado", C2)
    look("Vencedor Estado", WIN, "Empate")
    return df


def wins_by_state(df: DataFrame) -> DataFrame:
    """Matches per winner state (bar data)."""
    return df.groupBy(_q("Vencedor Estado").alias("estado")).agg(F.count(F.lit(1)).alias("partidas"))


def goal_histogram(df: DataFrame, side: str = "home", bins: int = 50, by: str = "estado") -> DataFrame:
    """Histogram of the winner's goals when the winning side's state is
    the winner's state (home: ``C1 Estado``/``p1``; away: ``C2``/``p2``) —
    the notebook's rule, under which a same-state game counts for both sides.
    ``by="clube"`` selects on the winning club instead (home win / away win).
    Equal-width bins over [min, max] as a plotting library draws them; the
    bounds come from a scalar subquery over the counts per goal value, which
    the bins then add up."""
    st, club, g = ("C1 Estado", C1, "p1") if side == "home" else ("C2 Estado", C2, "p2")
    if by == "clube":
        cond = F.lower(F.trim(_q(club))) == F.lower(F.trim(_q(WIN)))
    else:
        cond = _q(st) == _q("Vencedor Estado")
    f = df.filter(cond).select(_q(g).cast("double").alias("v")).filter(F.col("v").isNotNull())
    f = f.groupBy("v").agg(F.count(F.lit(1)).alias("k"))  # a row per goal count
    bounds = f.select(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi"))).scalar()
    lo_raw, hi_raw = bounds.getField("lo"), bounds.getField("hi")
    same = lo_raw == hi_raw
    lo = F.when(same, lo_raw - 0.5).otherwise(lo_raw)
    hi = F.when(same, hi_raw + 0.5).otherwise(hi_raw)
    width = (hi - lo) / bins
    b = F.least(F.floor((F.col("v") - lo) / width).cast("int"), F.lit(bins - 1))
    counts = f.groupBy(b.alias("bin")).agg(F.sum("k").alias("n"))
    return counts.select("bin", F.round(lo + F.col("bin") * width, 6).alias("de"),
                         F.round(lo + (F.col("bin") + 1) * width, 6).alias("ate"), "n")


def goals_by_weekday(df: DataFrame) -> DataFrame:
    """Home-win goals per weekday (counts behind the category plot)."""
    return (df.filter(_q("C1 Estado") == _q("Vencedor Estado"))
            .groupBy(_q("Dia").alias("dia"), F.col("p1")).agg(F.count(F.lit(1)).alias("partidas")))


def season_slice(df: DataFrame, start: str, end: str, col: str = "Data") -> DataFrame:
    """Rows with ``start <= date <= end`` (inclusive, compared as DATE)."""
    d = F.to_date(_q(col))
    return df.filter(d.between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))


def table_from_winner(df: DataFrame) -> DataFrame:
    """Table per club from the winner column (``-`` = draw,
    case-insensitive) and goals from the score text.  A missing winner reads
    as the text ``nan``, i.e. a loss for both clubs, as in the notebooks.
    One scan, sides exploded, one aggregate (the notebooks scan per club)."""
    t = trim_all(df)
    parts = F.split(_q("Placar"), "x")
    g1, g2 = F.trim(F.get(parts, 0)).try_cast("bigint"), F.trim(F.get(parts, 1)).try_cast("bigint")
    win = F.coalesce(F.lower(_q(WIN)), F.lit("nan"))
    s = t.select(win.alias("w"), F.inline(F.array(
        F.struct(F.lower(_q(C1)).alias("clube"), g1.alias("gp"), g2.alias("gc")),
        F.struct(F.lower(_q(C2)).alias("clube"), g2.alias("gp"), g1.alias("gc")))))
    w, c = F.col("w"), F.col("clube")
    agg = s.groupBy("clube").agg(
        F.count(F.lit(1)).alias("J"), F.count_if(w == c).alias("V"), F.count_if(w == "-").alias("E"),
        F.count_if((w != c) & (w != "-")).alias("D"),
        F.sum("gp").alias("GP"), F.sum("gc").alias("GC"))
    return agg.select(F.col("clube").alias("Clubes"), (F.col("V") * 3 + F.col("E")).alias("PG"), "J", "V", "E",
                      "D", "GP", "GC", (F.col("GP") - F.col("GC")).alias("SG"))


def adjustments_dimension(spark: SparkSession, season: int, rows=None) -> DataFrame:
    """N11 input: the fixed adjustments of one season."""
    r = [(c, p, e, d) for s, c, p, e, d in (ADJUSTMENTS if rows is None else rows) if s == season]
    return spark.createDataFrame(r, "Clubes string, dPG int, dE int, dD int")


def apply_adjustments(table: DataFrame, adj: DataFrame) -> DataFrame:
    """Add point / draw / loss corrections (left join on the club)."""
    j = table.join(adj, "Clubes", "left")

    def z(c):
        return F.coalesce(F.col(c), F.lit(0))
    return (j.withColumn("PG", F.col("PG") + z("dPG")).withColumn("E", F.col("E") + z("dE"))
             .withColumn("D", F.col("D") + z("dD")).drop("dPG", "dE", "dD"))


def final_table(table: DataFrame, keys=("PG", "J", "V", "E", "D", "GP")) -> DataFrame:
    """First letter capitalised (not every word), ordered by ``keys``
    descending, club name breaking remaining ties (a distributed sort)."""
    t = table.withColumn("Clubes", capitalize_first(F.col("Clubes")))
    return t.orderBy(*[F.col(k).desc() for k in keys], F.col("Clubes").asc())
