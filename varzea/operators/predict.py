"""The match-outcome probability model, set-wise.

The dashboard scores one pair at a time in a loop; here every feature is a
DataFrame over *all* clubs or *all* ordered pairs, built by one aggregate over
the home/away side rows, and a fixture list is scored by joining the
features.  No loop over clubs, no cross join, no collect.

Scale notes
* the weighted features come from one pre-aggregate of the side rows per
  (club, opponent, season, venue) — map-side partial aggregation, so a club
  holding a third of all matches does not make one big task, and the model
  reads the matches twice in all (this pre-aggregate and the form);
* the last-N form uses ``row_number() <= n`` per club, which Spark plans as
  a ``WindowGroupLimit`` — each map task keeps only its top-n per club before
  the shuffle;
* the per-club feature tables have one row per club; the final joins let
  AQE broadcast them only when their measured size is under the threshold;
* the feature joins use null-safe keys, so no inferred ``IS NOT NULL``
  filter is pushed into one branch and not the other: the pre-aggregate's
  shuffle is identical in every branch and computed once (stage reuse).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varzea.operators.sides import sides

# Fixed values of the model.
DECAY = 0.82            # weight per year of age
STR_W = 0.25            # weight of the strength shift
VENUE_W = 0.25          # weight of the home/away blend
# squad mode -> (games of form, share of head-to-head in the base mix)
ELENCO = {"titular": (5, 0.55), "misto": (8, 0.70), "reserva": (12, 0.82)}
# years since the club's latest season -> recency factor (older: 0.28)
RECENCY = [(0, 1.0), (1, 0.82), (2, 0.60), (3, 0.42)]
RECENCY_OLDER = 0.28
# score thresholds for 5, 4, 3, 2 stars (else 1)
STARS = [(0.75, 5), (0.58, 4), (0.42, 3), (0.25, 2)]
NO_DATA_SCORE = 0.3
NO_DATA_WARNING = "Sem dados"
WARNING_LAST_SEASON = "Última temp. Série A: "
WARNING_OUT_SINCE = "Fora da Série A desde "
MIN_MAX_YEAR = 2003     # floor of the reference year


def played(partidas: DataFrame) -> DataFrame:
    """Matches with a result (the model's input)."""
    return partidas.filter(F.col("gols_mandante").isNotNull() & F.col("gols_visitante").isNotNull())


def max_year(partidas: DataFrame, floor: int = MIN_MAX_YEAR) -> Column:
    """Reference year = latest season in ``partidas`` (floored), as a scalar
    subquery: computed once by its own small job, then inlined as a literal —
    no global window and no cross join."""
    return F.greatest(F.lit(floor), partidas.select(F.max("temporada")).scalar()).cast("int")


def _weight(year: Column) -> Column:
    return F.pow(F.lit(DECAY), (year - F.col("temporada")).cast("double"))


def _round1(c: Column) -> Column:
    return F.round(c, 1)


def _round_half_up(c: Column) -> Column:
    return F.floor(c + 0.5).cast("bigint")


# ---- shared pre-aggregate --------------------------------------------------------------------

def pair_season(played_df: DataFrame) -> DataFrame:
    """Wins / draws / games per (club, opponent, season, venue).

    The decay weight depends only on the season, so every weighted feature
    (P1, P3, P4) is a sum over these rows — bounded by clubs² x seasons x 2,
    whatever the number of matches.  Losses are ``n - v - e`` (played
    matches only), so every consumer reads the same three counters and the
    pre-aggregate's shuffle is identical — computed once — in every branch."""
    s = sides(played_df, ["temporada"])
    gp, gc = F.col("gp"), F.col("gc")
    return s.groupBy("clube", "adversario", "temporada", "em_casa").agg(
        F.count_if(gp > gc).alias("v"), F.count_if(gp == gc).alias("e"), F.count(F.lit(1)).alias("n"))


def _losses(prefix: str = "") -> Column:
    return F.col(prefix + "n") - F.col(prefix + "v") - F.col(prefix + "e")


# ---- P1 + P4: one per-club feature table -------------------------------------------------------

def club_features(played_df: DataFrame, year: Column, ps: DataFrame | None = None) -> DataFrame:
    """Every per-club feature of the model from the pair-season counts:
    decay-weighted home/away rates (P1) and strength of the latest season
    (P4).  Two small aggregates (club-season, then club) over the
    pre-aggregate, so the model reads the matches once for all of them."""
    ps = ps if ps is not None else pair_season(played_df)
    home = F.col("em_casa")

    def split(c, at_home):
        return F.sum(F.when(home if at_home else ~home, F.col(c)).otherwise(F.lit(0)))
    cs = ps.groupBy("clube", "temporada").agg(
        *[split(c, True).alias("h" + c) for c in ("v", "e", "n")],
        *[split(c, False).alias("a" + c) for c in ("v", "e", "n")]
    ).withColumns({"hd": _losses("h"), "ad": _losses("a")})
    w = _weight(year)

    def wsum(c):
        return F.sum(F.col(c) * w)
    pts = (F.col("hv") + F.col("av")) * 3 + F.col("he") + F.col("ae")
    agg = cs.groupBy("clube").agg(
        wsum("hv").alias("hw"), wsum("he").alias("hd"), wsum("hd").alias("hl"), wsum("hn").alias("ht"),
        wsum("av").alias("aw"), wsum("ae").alias("ad"), wsum("ad").alias("al"), wsum("an").alias("at"),
        F.sum("hn").alias("home_total"), F.sum("an").alias("away_total"),
        F.max(F.struct(F.col("temporada").alias("last_year"), pts.alias("pts"),
                       (F.col("hn") + F.col("an")).alias("games"))).alias("l"))
    ht = F.greatest(F.col("ht"), F.lit(0.001))
    at = F.greatest(F.col("at"), F.lit(0.001))
    ppg = F.col("l.pts") / F.col("l.games")
    gap = year - F.col("l.last_year")
    rec = F.lit(RECENCY_OLDER)
    for g, f in reversed(RECENCY):
        rec = F.when(gap == g, F.lit(f)).otherwise(rec)
    warning = (F.when(gap == 0, F.lit(""))
                .when(gap == 1, F.concat(F.lit(WARNING_LAST_SEASON), F.col("l.last_year").cast("string")))
                .otherwise(F.concat(F.lit(WARNING_OUT_SINCE), F.col("l.last_year").cast("string"))))
    out = agg.select(
        "clube",
        _round1(F.col("hw") / ht * 100).alias("home_pct"),
        _round1(F.col("aw") / at * 100).alias("away_pct"),
        _round1(F.col("hd") / ht * 100).alias("home_draw_pct"),
        _round1(F.col("ad") / at * 100).alias("away_draw_pct"),
        _round_half_up(F.col("hw")).alias("home_w"), _round_half_up(F.col("hd")).alias("home_d"),
        _round_half_up(F.col("hl")).alias("home_l"), _round_half_up(F.col("aw")).alias("away_w"),
        _round_half_up(F.col("ad")).alias("away_d"), _round_half_up(F.col("al")).alias("away_l"),
        "home_total", "away_total",
        (F.least(ppg / 3, F.lit(1.0)) * rec).alias("score"), F.col("l.last_year").alias("last_year"),
        F.round(ppg, 2).alias("pts_per_game"), F.col("l.games").alias("games"), warning.alias("warning"))
    stars = F.lit(1)
    for cut, st in reversed(STARS):
        stars = F.when(F.col("score") >= cut, F.lit(st)).otherwise(stars)
    return out.withColumn("stars", stars)


HOME_AWAY_COLUMNS = ["clube", "home_pct", "away_pct", "home_draw_pct", "away_draw_pct", "home_w", "home_d",
                     "home_l", "away_w", "away_d", "away_l", "home_total", "away_total"]
STRENGTH_COLUMNS = ["clube", "score", "last_year", "pts_per_game", "games", "warning", "stars"]


def home_away_stats(played_df: DataFrame, year: Column, ps: DataFrame | None = None) -> DataFrame:
    """Decay-weighted home and away win/draw % per club (1 decimal),
    rounded weighted counts and raw game counts."""
    return club_features(played_df, year, ps).select(*HOME_AWAY_COLUMNS)


# ---- P2 -------------------------------------------------------------------------------------

def last_games(played_df: DataFrame, n: int) -> DataFrame:
    """The last ``n`` games of every club (season, round, date, id — newest
    first), one row each with ``rn`` = 1 for the newest."""
    s = sides(played_df, ["partida_id", "temporada", "rodada", "data"])
    w = Window.partitionBy("clube").orderBy(F.col("temporada").desc(), F.col("rodada").desc(),
                                            F.col("data").desc(), F.col("partida_id").desc())
    gp, gc = F.col("gp"), F.col("gc")
    return (s.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n)
            .withColumn("res", F.when(gp > gc, "V").when(gp < gc, "D").otherwise("E")))


def recent_form(played_df: DataFrame, n: int, details: bool = False) -> DataFrame:
    """Form over the last ``n`` games: W/D/L counts and the ordered result
    string (newest first); with ``details`` also ``jogos``, each game's
    result, opponent, goals, season and round.  The per-club list is bounded
    by ``n``."""
    g = last_games(played_df, n)
    per_game = [F.col("adversario"), "gp", "gc", "temporada", "rodada"] if details else []
    ordered = F.array_sort(F.collect_list(F.struct("rn", "res", *per_game)))
    more = [F.transform(ordered, lambda x: x.dropFields("rn")).alias("jogos")] if details else []
    return g.groupBy("clube").agg(
        F.count_if(F.col("res") == "V").alias("wins"),
        F.count_if(F.col("res") == "E").alias("draws"),
        F.count_if(F.col("res") == "D").alias("losses"),
        F.array_join(F.transform(ordered, lambda x: x["res"]), "").alias("resultados"),
        F.count(F.lit(1)).alias("n"), *more)


# ---- P3 -------------------------------------------------------------------------------------

def weighted_h2h(played_df: DataFrame, year: Column, mando: str = "todos",
                 ps: DataFrame | None = None) -> DataFrame:
    """Per ordered pair (clube1, clube2) that met: decay-weighted shares of
    clube1 win / draw / clube2 win, total weight (0 -> 1), and raw counts.

    ``mando``: ``todos`` all meetings; ``t1_casa`` only with clube1 at home;
    ``t2_casa`` only with clube2 at home.
    """
    ps = ps if ps is not None else pair_season(played_df)
    if mando == "t1_casa":
        ps = ps.filter(F.col("em_casa"))
    elif mando == "t2_casa":
        ps = ps.filter(~F.col("em_casa"))
    elif mando != "todos":
        raise ValueError(f"unknown mando {mando!r}")
    w = _weight(year)
    agg = ps.groupBy(F.col("clube").alias("clube1"), F.col("adversario").alias("clube2")).agg(
        F.sum(F.col("v") * w).alias("w1"), F.sum(F.col("e") * w).alias("wd"),
        F.sum(_losses() * w).alias("w2"), F.sum("n").alias("total"),
        F.sum("v").alias("vit1"), F.sum(_losses()).alias("vit2"))
    tw = F.col("w1") + F.col("w2") + F.col("wd")
    tw = F.when(tw == 0, F.lit(1.0)).otherwise(tw)
    return agg.select("clube1", "clube2",
                      (F.col("w1") / tw).alias("pct1"), (F.col("wd") / tw).alias("pct_draw"),
                      (F.col("w2") / tw).alias("pct2"), tw.alias("total_w"),
                      "total", "vit1", "vit2")


# ---- P4 -------------------------------------------------------------------------------------

def team_strength(played_df: DataFrame, year: Column, ps: DataFrame | None = None) -> DataFrame:
    """Points per game in the club's latest season / 3 (cap 1) x recency
    factor; warning text; 1-5 stars."""
    return club_features(played_df, year, ps).select(*STRENGTH_COLUMNS)


def strength_for(clubs: DataFrame, strength: DataFrame) -> DataFrame:
    """Strength of a club list; clubs without played games get the no-data
    row (score 0.3, 1 star)."""
    return (clubs.join(strength, "clube", "left")
            .select("clube", F.coalesce("score", F.lit(NO_DATA_SCORE)).alias("score"),
                    F.coalesce("last_year", F.lit(0)).alias("last_year"),
                    F.coalesce("pts_per_game", F.lit(0.0)).alias("pts_per_game"),
                    F.coalesce("games", F.lit(0)).alias("games"),
                    F.coalesce("warning", F.lit(NO_DATA_WARNING)).alias("warning"),
                    F.coalesce("stars", F.lit(1)).alias("stars")))


# ---- P5 -------------------------------------------------------------------------------------

def match_probabilities(fixtures: DataFrame, partidas: DataFrame, mando: str = "todos",
                        elenco: str = "titular", year: Column | None = None) -> DataFrame:
    """Score every fixture ``(clube1, clube2[, extra columns])``.

    Base mix 75%: head-to-head share ``h2hW`` vs recent form; strength shift
    added before the clamp; optional venue blend (25%); clamp at 0;
    normalise to 100, one decimal.  Pairs that never met (for the chosen
    ``mando``) give null probabilities.
    """
    form_n, h2h_w = ELENCO[elenco]
    p = played(partidas)
    year = year if year is not None else max_year(partidas)
    ps = pair_season(p)
    h2h = weighted_h2h(p, year, mando, ps)
    form = recent_form(p, form_n)
    feats = club_features(p, year, ps)

    def feat(df: DataFrame, side: str, cols: list[str]) -> DataFrame:
        return df.select(F.col("clube").alias("_k" + side[-1]),
                         *[F.col(c).alias(f"{c}_{side[-1]}") for c in cols])

    def join_club(left: DataFrame, right: DataFrame, side: str) -> DataFrame:
        # null-safe keys: no inferred IS NOT NULL filter reaches the shared
        # pre-aggregate, so its shuffle is computed once and reused
        k = "_k" + side[-1]
        return left.join(right, F.col(side).eqNullSafe(F.col(k)), "left").drop(k)

    h = h2h.select(F.col("clube1").alias("_h1"), F.col("clube2").alias("_h2"),
                   *[c for c in h2h.columns if c not in ("clube1", "clube2")])
    j = fixtures.join(h, F.col("clube1").eqNullSafe(F.col("_h1")) & F.col("clube2").eqNullSafe(F.col("_h2")),
                      "left").drop("_h1", "_h2")
    for side, df, cols in [("clube1", form, ["wins", "draws", "losses"]), ("clube2", form, ["wins", "draws", "losses"]),
                           ("clube1", feats, ["home_pct", "away_pct", "home_draw_pct", "away_draw_pct", "score"]),
                           ("clube2", feats, ["home_pct", "away_pct", "home_draw_pct", "away_draw_pct", "score"])]:
        j = join_club(j, feat(df, side, cols), side)

    def z(c):
        return F.coalesce(F.col(c), F.lit(0))

    tot1 = F.greatest(z("wins_1") + z("draws_1") + z("losses_1"), F.lit(1))
    tot2 = F.greatest(z("wins_2") + z("draws_2") + z("losses_2"), F.lit(1))
    base_w = 1 - STR_W
    h2h_f, form_f = h2h_w * base_w, (1 - h2h_w) * base_w
    t1 = F.col("pct1") * h2h_f * 100 + (z("wins_1") / tot1) * 100 * form_f
    dr = F.col("pct_draw") * h2h_f * 100 + ((z("draws_1") / tot1 + z("draws_2") / tot2) / 2) * 100 * form_f
    t2 = F.col("pct2") * h2h_f * 100 + (z("wins_2") / tot2) * 100 * form_f
    s1 = F.coalesce(F.col("score_1"), F.lit(NO_DATA_SCORE))
    s2 = F.coalesce(F.col("score_2"), F.lit(NO_DATA_SCORE))
    st = s1 + s2
    st = F.when(st == 0, F.lit(0.001)).otherwise(st)
    shift = (s1 / st - 0.5) * 2 * STR_W * 100
    t1, t2 = t1 + shift, t2 - shift
    if mando == "t1_casa":
        t1 = t1 * (1 - VENUE_W) + z("home_pct_1") * VENUE_W
        t2 = t2 * (1 - VENUE_W) + z("away_pct_2") * VENUE_W
        dr = dr * (1 - VENUE_W) + ((z("home_draw_pct_1") + z("away_draw_pct_2")) / 2) * VENUE_W
    elif mando == "t2_casa":
        t1 = t1 * (1 - VENUE_W) + z("away_pct_1") * VENUE_W
        t2 = t2 * (1 - VENUE_W) + z("home_pct_2") * VENUE_W
        dr = dr * (1 - VENUE_W) + ((z("away_draw_pct_1") + z("home_draw_pct_2")) / 2) * VENUE_W
    t1, dr, t2 = F.greatest(t1, F.lit(0.0)), F.greatest(dr, F.lit(0.0)), F.greatest(t2, F.lit(0.0))
    j = j.withColumns({"_t1": t1, "_dr": dr, "_t2": t2})
    soma = F.greatest(F.col("_t1") + F.col("_dr") + F.col("_t2"), F.lit(0.001))
    met = F.coalesce(F.col("total"), F.lit(0)) > 0

    def out(c):
        return F.when(met, c)
    extra = [c for c in fixtures.columns if c not in ("clube1", "clube2")]
    return j.select(
        *extra, "clube1", "clube2",
        out(F.round(F.col("_t1") / soma * 100, 1)).alias("p_clube1"),
        out(F.round(F.col("_dr") / soma * 100, 1)).alias("p_empate"),
        out(F.round(F.col("_t2") / soma * 100, 1)).alias("p_clube2"),
        out(F.col("vit1")).alias("vit1"),
        out(F.col("total") - F.col("vit1") - F.col("vit2")).alias("emps"),
        out(F.col("vit2")).alias("vit2"),
        F.coalesce(F.col("total"), F.lit(0)).alias("total"),
        out(F.round(F.col("pct1") * 100, 1)).alias("h2h_pct1"),
        out(F.round(F.col("pct_draw") * 100, 1)).alias("h2h_pct_empate"),
        out(F.round(F.col("pct2") * 100, 1)).alias("h2h_pct2"),
        out(F.round(F.col("total_w"), 1)).alias("h2h_total_w"))


def pairs_that_met(partidas: DataFrame) -> DataFrame:
    """Every ordered pair of clubs with at least one played meeting (from the
    pair-season pre-aggregate, so the model's plan shares its shuffle)."""
    return (pair_season(played(partidas)).select(F.col("clube").alias("clube1"),
                                                 F.col("adversario").alias("clube2")).distinct())


def model_config(spark) -> DataFrame:
    """The model constants as a small table (for display / joins)."""
    rows = [(k, n, w, DECAY, STR_W, VENUE_W) for k, (n, w) in ELENCO.items()]
    return spark.createDataFrame(rows, "elenco string, form_n int, h2h_w double, decay double, "
                                       "str_w double, venue_w double")
