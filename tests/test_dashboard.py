"""Dashboard metrics on hand-written frames."""
import datetime as dt

from varzea.plans import dashboard as D

MATCH = ("partida_id bigint, temporada int, rodada int, data date, mandante string, visitante string, "
         "gols_mandante bigint, gols_visitante bigint, status string")


def test_next_round(spark):
    d = dt.date(2024, 1, 1)
    m = spark.createDataFrame([
        (1, 2024, 1, d, "A", "B", 1, 0, "finished"), (2, 2024, 2, d, "B", "A", None, None, "notStarted"),
        (3, 2024, 2, d, "C", "D", 2, 2, "finished"),            # round 2 partly played -> not "next"
        (4, 2024, 3, d, "A", "C", None, None, "notStarted"), (5, 2024, 4, d, "B", "D", None, None, "notStarted"),
    ], MATCH)
    assert [r.rodada for r in D.proxima_rodada(m, 2024).collect()] == [3]
    assert D.proxima_rodada(m.filter("rodada <= 2"), 2024).count() == 0
    prev = D.previsao_rodada(m, 2024)
    rows = prev.collect()
    assert len(rows) == 1 and rows[0].clube1 == "A" and rows[0].p_clube1 is None   # never met with A at home


def test_favourite_flag_and_search(spark):
    prev = spark.createDataFrame(
        [(1, "A", "B", 60.0, 20.0, 20.0), (2, "C", "D", 30.0, 35.0, 35.0), (3, "E", "F", None, None, None)],
        "partida_id bigint, clube1 string, clube2 string, p_clube1 double, p_empate double, p_clube2 double")
    fav = {r.partida_id: r for r in D.favorito(prev).collect()}
    assert set(fav) == {1, 2} and fav[1].favorito and not fav[2].favorito and fav[1].gap == 40.0
    clubes = spark.createDataFrame([("Flamengo",), ("Fluminense",), ("Bahia",)], "clube string")
    assert {r.clube for r in D.buscar_clube(clubes, "FL").collect()} == {"Flamengo", "Fluminense"}


def test_kpis_fall_back_to_total(spark):
    meta = spark.createDataFrame([(2023, 380, 900, 380), (2024, 100, 200, 0)],
                                 "temporada int, total_partidas bigint, total_gols bigint, partidas_disputadas bigint")
    k = D.kpis(meta).first()
    assert k.disputadas == 480 and k.gols == 1100 and k.media_gols == round(1100 / 480, 2)
