"""A key holding a third of all rows: results stay whole and the plans
combine map-side before the shuffle."""
import datetime as dt

from pyspark.sql import functions as F

from varzea.operators import gold as G
from varzea.operators import predict as P
from varzea.operators.upsert import last_wins


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_merge(spark):
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("seq"), (F.col("id") * 7 % 11).alias("v")).repartition(8)
    out = last_wins(df, ["k"], ["seq"])
    hot = out.filter("k = -1").first()
    assert hot.seq == max(i for i in range(n) if i % 3 == 0)
    assert out.count() == 1 + (n - n // 3)
    plan = _plan(out)
    # partial aggregate below the exchange: one row per key and task crosses the shuffle
    assert "partial_max" in plan
    assert plan.index("partial_max") > plan.index("Exchange")


def test_hot_club_standings_and_form(spark):
    d = dt.date(2020, 1, 1)
    rows = []
    for i in range(3000):
        home = "HOT" if i % 3 == 0 else f"C{i % 17}"
        away = f"C{(i + 5) % 17}" if home == "HOT" else ("HOT" if i % 7 == 0 else f"C{(i + 3) % 17}")
        if home == away:
            continue
        rows.append((i, 2020, 1 + i % 38, d, home, away, i % 4, i % 3, "finished"))
    m = spark.createDataFrame(rows, "partida_id bigint, temporada int, rodada int, data date, mandante string, "
                                    "visitante string, gols_mandante bigint, gols_visitante bigint, status string")
    d3 = G.desempenho_clubes(m)
    hot = d3.filter("clube = 'HOT'").first()
    assert hot.jogos == m.filter("mandante = 'HOT' OR visitante = 'HOT'").count()
    assert "partial_count" in _plan(d3) or "partial_sum" in _plan(d3)
    form = P.last_games(P.played(m), 5)
    assert form.filter("clube = 'HOT'").count() == 5
    assert "WindowGroupLimit" in _plan(form)
