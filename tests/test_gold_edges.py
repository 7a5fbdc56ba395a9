"""Gold builders, ranking and the outcome model on hand-written frames."""
import datetime as dt

from pyspark.sql import functions as F

from varzea.operators import gold as G
from varzea.operators import predict as P
from varzea.operators.upsert import last_wins, upsert

MATCH = ("partida_id bigint, temporada int, rodada int, data date, mandante string, visitante string, "
         "gols_mandante bigint, gols_visitante bigint, status string")


def matches(spark, rows):
    return spark.createDataFrame(rows, MATCH)


def test_null_goals_count_as_game_not_result(spark):
    d = dt.date(2020, 1, 1)
    m = matches(spark, [(1, 2020, 1, d, "A", "B", 2, 1, "finished"),
                        (2, 2020, 2, d, "B", "A", None, None, "notStarted"),
                        (3, 2020, 3, d, "A", "B", 1, None, "finished")])
    r = {x.clube: x for x in G.desempenho_clubes(m).collect()}
    assert r["A"].jogos == 3 and r["A"].vitorias == 1 and r["A"].empates == 0 and r["A"].derrotas == 0
    assert r["A"].gols_pro == 3 and r["A"].pontos == 3
    assert r["B"].derrotas == 1 and r["B"].gols_contra == 3
    camp = {x.partida_id: x for x in G.campeonato_historico(m).collect()}
    assert camp[2].resultado == "empate" and camp[2].total_gols is None


def test_ties_break_by_goal_difference_then_goals_then_name(spark):
    d = dt.date(2020, 1, 1)
    m = matches(spark, [(1, 2020, 1, d, "A", "B", 2, 2, "f"), (2, 2020, 1, d, "C", "D", 1, 1, "f"),
                        (3, 2020, 2, d, "A", "C", 0, 0, "f"), (4, 2020, 2, d, "B", "D", 0, 0, "f")])
    pos = {x.clube: x.posicao for x in G.classificacao_historica(m).collect()}
    # all 2 points, difference 0; goals for A=2,B=2,C=1,D=1 -> A,B by name then C,D
    assert pos == {"A": 1, "B": 2, "C": 3, "D": 4}


def test_small_season_champion_branch_first(spark):
    d = dt.date(2020, 1, 1)
    m = matches(spark, [(1, 2020, 1, d, "A", "B", 1, 0, "f"), (2, 2020, 1, d, "C", "A", 0, 1, "f")])
    sit = {x.clube: x.situacao for x in G.rebaixamento_acesso(G.classificacao_historica(m)).collect()}
    assert sit["A"] == "Campeão"
    assert set(sit.values()) <= {"Campeão", "Libertadores"}


def test_api_standings_modes(spark):
    d = dt.date(2020, 1, 1)
    m = matches(spark, [(1, 2020, 1, d, "A", "B", 1, 0, "f"), (2, 2021, 1, d, "A", "B", 0, 1, "f")])
    api = G.classificacao_historica(m).filter("temporada = 2021").withColumn("pontos", F.lit(99))
    rep = G.classificacao_historica(m, api, "replace")
    assert {r.temporada for r in rep.collect()} == {2021}
    pref = G.classificacao_historica(m, api, "prefer").collect()
    assert {r.temporada for r in pref} == {2020, 2021}
    assert all(r.pontos == 99 for r in pref if r.temporada == 2021)


def test_scorers_own_goals_and_penalties(spark):
    g = spark.createDataFrame(
        [(1, 2020, "A", "x", "Penalty"), (2, 2020, "A", "x", None), (3, 2020, "A", "x", "Gol Contra"),
         (4, 2020, "A", "x", "Pênalti"), (5, 2020, "A", None, "Normal"), (6, 2020, "A", "", "Normal")],
        "partida_id bigint, temporada int, clube string, atleta string, tipo_de_gol string")
    r = G.artilharia_historica(g).first()
    assert r.total_gols == 3 and r.penaltis == 1 and r.gols_contra == 0
    r2 = G.artilharia_historica(g, accent_insensitive=True).first()
    assert r2.penaltis == 2


def test_upsert_last_wins_and_idempotent(spark):
    old = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (None, "n1", 1)], "k bigint, v string, s int")
    new = spark.createDataFrame([(1, "c", 0), (2, "d", 0), (None, "n2", 0)], "k bigint, v string, s int")
    a = old.withColumn("_seq", F.struct(F.lit(0).alias("b"), F.col("s").alias("p"))).drop("s")
    b = new.withColumn("_seq", F.struct(F.lit(1).alias("b"), F.col("s").alias("p"))).drop("s")
    once = {(r.k, r.v) for r in upsert(a, b, ["k"]).collect()}
    assert once == {(1, "c"), (2, "d"), (None, "n2")}
    twice = upsert(a, b.unionByName(b), ["k"])
    assert {(r.k, r.v) for r in twice.collect()} == once
    dedup_old = {(r.k, r.v) for r in upsert(None, a, ["k"]).collect()}
    assert dedup_old == {(1, "b"), (None, "n1")}


def test_two_goals_same_minute_collapse(spark):
    g = spark.createDataFrame([(1, "x", 10, "Normal"), (1, "x", 10, "Penalty")],
                              "partida_id bigint, atleta string, minuto bigint, tipo_de_gol string")
    out = last_wins(g, ["partida_id", "atleta", "minuto"], ["tipo_de_gol"]).collect()
    assert len(out) == 1


def test_model_pair_never_met_is_null_and_probabilities_sum(spark):
    d = dt.date(2020, 1, 1)
    rows = []
    pid = 0
    for season in (2019, 2020):
        for h, a, gh, ga in [("A", "B", 2, 0), ("B", "A", 1, 1), ("A", "C", 0, 1), ("C", "B", 3, 3)]:
            pid += 1
            rows.append((pid, season, pid, d, h, a, gh, ga, "finished"))
    m = matches(spark, rows)
    fx = spark.createDataFrame([("A", "B"), ("B", "C"), ("A", "D")], "clube1 string, clube2 string")
    r = {(x.clube1, x.clube2): x for x in P.match_probabilities(fx, m, "todos", "titular").collect()}
    assert r[("A", "D")].p_clube1 is None and r[("A", "D")].total == 0
    for k in [("A", "B"), ("B", "C")]:
        x = r[k]
        assert abs(x.p_clube1 + x.p_empate + x.p_clube2 - 100) <= 0.2
        assert x.vit1 + x.emps + x.vit2 == x.total


def test_strength_recency_and_no_data(spark):
    d = dt.date(2000, 1, 1)
    rows = [(1, 2003, 1, d, "A", "B", 1, 0, "f"), (2, 2002, 1, d, "C", "B", 1, 0, "f"),
            (3, 2001, 1, d, "D", "B", 1, 0, "f"), (4, 2000, 1, d, "E", "B", 1, 0, "f"),
            (5, 1999, 1, d, "F", "B", 1, 0, "f")]
    m = matches(spark, rows)
    s = {x.clube: x for x in P.team_strength(m, F.lit(2003)).collect()}
    assert abs(s["A"].score - 1.0) < 1e-9 and s["A"].warning == "" and s["A"].stars == 5
    assert abs(s["C"].score - 0.82) < 1e-9 and s["C"].warning.endswith("2002")
    assert abs(s["D"].score - 0.60) < 1e-9 and abs(s["E"].score - 0.42) < 1e-9
    assert abs(s["F"].score - 0.28) < 1e-9 and s["F"].stars == 2
    clubs = spark.createDataFrame([("A",), ("Z",)], "clube string")
    nd = {x.clube: x for x in P.strength_for(clubs, P.team_strength(m, F.lit(2003))).collect()}
    assert nd["Z"].score == 0.3 and nd["Z"].stars == 1 and nd["Z"].warning == "Sem dados"


def test_recent_form_order(spark):
    d = dt.date(2020, 1, 1)
    m = matches(spark, [(1, 2020, 1, d, "A", "B", 1, 0, "f"), (2, 2020, 2, d, "B", "A", 1, 0, "f"),
                        (3, 2020, 3, d, "A", "B", 0, 0, "f")])
    f = {x.clube: x for x in P.recent_form(m, 2).collect()}
    assert f["A"].resultados == "ED" and f["A"].n == 2 and f["B"].resultados == "EV"


def test_tie_for_first_place(spark):
    from varzea.plans.queries import campeao_vs_vice
    c = spark.createDataFrame(
        [(2020, "A", 70, 10, 30), (2020, "B", 70, 12, 31), (2020, "C", 60, 0, 20),
         (2021, "A", 80, 5, 40), (2021, "B", 75, 3, 30)],
        "temporada int, clube string, pontos bigint, saldo_gols bigint, gols_pro bigint")
    by_rank = {r.temporada: r for r in campeao_vs_vice(c).collect()}
    assert set(by_rank) == {2021}                       # the tie at the top leaves no rank 2 in 2020
    by_row = {r.temporada: r for r in campeao_vs_vice(c, "row_number").collect()}
    assert by_row[2020].campeao == "B" and by_row[2020].vice == "A" and by_row[2020].diferenca == 0


def test_require_tables_gate(spark):
    import pytest
    m = spark.createDataFrame([(1, 2020)], "partida_id bigint, temporada int")
    with pytest.raises(ValueError, match="missing silver tables"):
        G.require_tables({"partidas": m})
    with pytest.raises(ValueError, match="lacks columns"):
        G.require_tables({"partidas": m, "gols": m, "cartoes": m}, columns=G.GOLD_INPUT_COLUMNS)
    with pytest.raises(ValueError, match="without rows"):
        G.require_tables({"partidas": m, "gols": m.limit(0), "cartoes": m}, non_empty=True)
