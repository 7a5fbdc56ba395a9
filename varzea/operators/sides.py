"""One-scan home/away expansion.

Every match is seen from both clubs: one row for the home side, one for the
away side.  Built with ``inline(array(struct, struct))`` over a single scan,
so the per-club aggregations downstream (standings, form, strength, the
outcome model) read the match table once instead of scanning it twice and
unioning, and the following ``groupBy`` does a map-side partial aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIDE_COLUMNS = ["clube", "adversario", "gp", "gc", "em_casa"]


def sides(partidas: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Rows (keep..., clube, adversario, gp, gc, em_casa).

    ``gp``/``gc`` are goals for/against from the club's point of view and stay
    null for matches without a result.
    """
    keep = list(keep if keep is not None else ["partida_id", "temporada", "rodada", "data"])
    home = F.struct(F.col("mandante").alias("clube"), F.col("visitante").alias("adversario"),
                    F.col("gols_mandante").alias("gp"), F.col("gols_visitante").alias("gc"),
                    F.lit(True).alias("em_casa"))
    away = F.struct(F.col("visitante").alias("clube"), F.col("mandante").alias("adversario"),
                    F.col("gols_visitante").alias("gp"), F.col("gols_mandante").alias("gc"),
                    F.lit(False).alias("em_casa"))
    return partidas.select(*keep, F.inline(F.array(home, away)))


def side_counts(prefix: str = "") -> list:
    """Aggregates of one club over its side rows (null scores count as a game
    but not as a win, draw or loss)."""
    gp, gc = F.col("gp"), F.col("gc")
    return [
        F.count(F.lit(1)).alias(prefix + "jogos"),
        F.count_if(gp > gc).alias(prefix + "vitorias"),
        F.count_if(gp == gc).alias(prefix + "empates"),
        F.count_if(gp < gc).alias(prefix + "derrotas"),
        F.sum(gp).alias(prefix + "gols_pro"),
        F.sum(gc).alias(prefix + "gols_contra"),
    ]
