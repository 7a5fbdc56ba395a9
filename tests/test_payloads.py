"""Provider payload flattening on hand-written documents (FIXTURES §D)."""
import json

import pytest
from varzea.operators import payloads as J


def docs(spark, payloads, **ctx):
    rows = [tuple(ctx.values()) + (json.dumps(p),) for p in payloads]
    ddl = ", ".join([f"{k} bigint" for k in ctx] + ["payload string"])
    return spark.createDataFrame(rows, ddl)


def test_fixtures_round_and_dates(spark):
    fx = {"response": [
        {"fixture": {"id": 1, "date": "2024-04-13T21:30:00+00:00", "status": {"short": "FT"}, "venue": {"name": "X"}},
         "league": {"round": "Regular Season - 3"}, "teams": {"home": {"id": 1, "name": "A"}, "away": {"id": 2, "name": "B"}},
         "goals": {"home": 2, "away": 1}},
        {"fixture": {"id": 2, "date": "2024-04-14T16:00:00+00:00", "status": {"short": "NS"}, "venue": {}},
         "league": {"round": "Quarter-finals"}, "teams": {"home": {"name": "C"}, "away": {"name": "D"}},
         "goals": {"home": None, "away": None}},
        {"fixture": {"id": 3, "date": "2024-04-15T16:00:00+00:00", "status": {"short": "NS"}},
         "league": {"round": "Regular Season - x"}, "teams": {}, "goals": {}}]}
    out = {r.partida_id: r for r in J.flatten_fixtures(docs(spark, [fx], temporada=2024)).collect()}
    assert out[1].rodada == 3 and str(out[1].data) == "2024-04-13" and out[1].hora == "21:30"
    assert out[2].rodada is None and out[2].gols_mandante is None and out[2].arena is None
    assert out[3].rodada is None
    assert J.finished(J.flatten_fixtures(docs(spark, [fx], temporada=2024))).count() == 1


def test_empty_and_missing_response(spark):
    d = docs(spark, [{"response": []}, {}, {"errors": ["quota"]}], temporada=2024)
    assert J.flatten_fixtures(d).count() == 0
    assert J.flatten_standings(d).count() == 0


def test_team_stats_duplicate_key_last_wins(spark):
    st = {"response": [{"team": {"name": "A"}, "statistics": [
        {"type": "Total Shots", "value": 5}, {"type": "Ball Possession", "value": "55%"},
        {"type": "Total Shots", "value": 7}, {"type": "Passes %", "value": None}]}]}
    r = J.flatten_team_stats(docs(spark, [st], partida_id=1)).first()
    assert r.chutes == 7 and r.posse_de_bola == 55.0 and r.precisao_passes is None


def test_events_split(spark):
    ev = {"response": [
        {"team": {"name": "A"}, "player": {"id": 9, "name": "p"}, "time": {"elapsed": 10}, "type": "Goal", "detail": "Normal Goal"},
        {"team": {"name": "A"}, "player": {"id": 9, "name": "p"}, "time": {"elapsed": 20}, "type": "Goal", "detail": "Missed Penalty"},
        {"team": {"name": "B"}, "player": {"id": 8, "name": "q"}, "time": {"elapsed": 30}, "type": "Goal", "detail": "Own Goal"},
        {"team": {"name": "B"}, "player": {"id": 8, "name": "q"}, "time": {"elapsed": 40}, "type": "Card", "detail": "Second Yellow card"},
        {"team": {"name": "B"}, "player": {"id": 7, "name": "r"}, "time": {"elapsed": 41}, "type": "Card", "detail": "Red Card"},
        {"team": {"name": "B"}, "player": {"id": 7, "name": "r"}, "time": {"elapsed": 42}, "type": "subst", "detail": "Substitution 1"}]}
    g, c = J.flatten_events(docs(spark, [ev], partida_id=1))
    assert sorted((r.minuto, r.tipo_de_gol) for r in g.collect()) == [(10, "Normal"), (30, "Own Goal")]
    assert sorted((r.minuto, r.cartao, r.num_camisa) for r in c.collect()) == [(40, "Amarelo", "8"), (41, "Vermelho", "7")]


def test_lineups_and_squads(spark):
    lu = {"response": [{"team": {"name": "A"}, "coach": {"name": "T"}, "formation": "4-3-3",
                        "startXI": [{"player": {"name": "p1", "number": 1, "pos": "G"}}],
                        "substitutes": [{"player": {"name": "p2", "number": 12, "pos": "D"}}]}]}
    rows = {r.atleta: r for r in J.flatten_lineups(docs(spark, [lu], partida_id=1)).collect()}
    assert rows["p1"].titular and not rows["p2"].titular and rows["p2"].num_camisa == "12"
    sq = {"home": {"formation": "4-4-2", "players": [{"player": {"name": "h1"}, "substitute": False},
                                                       {"player": {"name": "h2"}}]},
          "away": {"players": [{"player": {"name": "a1"}, "substitute": True}]}}
    r = {x.atleta: x for x in J.flatten_squads(docs(spark, [sq], partida_id=1)).collect()}
    assert r["h1"].titular and not r["h2"].titular and not r["a1"].titular and r["a1"].lado == "visitante"


def test_stats_b_all_period_only(spark):
    st = {"statistics": [
        {"period": "1ST", "groups": [{"statisticsItems": [{"key": "fouls", "homeValue": "9", "awayValue": "9"}]}]},
        {"period": "ALL", "groups": [{"statisticsItems": [{"key": "ballPossession", "homeValue": "60%", "awayValue": "40%"}]},
                                     {"statisticsItems": [{"key": "fouls", "homeValue": "12", "awayValue": "14"}]}]}]}
    r = {x.lado: x for x in J.flatten_stats(docs(spark, [st], partida_id=1)).collect()}
    assert r["mandante"].faltas == 12 and r["visitante"].posse_de_bola == 40.0
    none = {"statistics": [{"period": "1ST", "groups": []}]}
    empty = J.flatten_stats(docs(spark, [none], partida_id=2)).collect()  # two rows, as the source gives
    assert [(x.lado, x.faltas) for x in empty] == [("mandante", None), ("visitante", None)]


def test_incidents_and_matches_b(spark):
    inc = {"incidents": [
        {"incidentType": "goal", "incidentClass": "penalty", "player": {"name": "p"}, "time": 10, "isHome": True},
        {"incidentType": "goal", "playerName": "q", "time": 20, "isHome": False},
        {"incidentType": "card", "incidentClass": "yellowRed", "player": {"name": "r", "jerseyNumber": "5"}, "time": 30},
        {"incidentType": "period", "time": 45}]}
    g, c = J.flatten_incidents(docs(spark, [inc], partida_id=1))
    gg = {r.atleta: r for r in g.collect()}
    assert gg["p"].tipo_de_gol == "Pênalti" and gg["q"].tipo_de_gol == "Normal" and gg["q"].lado == "visitante"
    cc = c.first()
    assert cc.cartao == "Vermelho" and cc.lado == "mandante" and cc.num_camisa == "5"
    ev = {"events": [{"id": 5, "homeTeam": {"id": 1, "name": "São Paulo"}, "awayTeam": {"id": 2, "name": "Grêmio"},
                      "homeScore": {"current": 1}, "awayScore": {"current": 1}, "venue": {"name": "V", "stadium": {"name": ""}},
                      "startTimestamp": 1700000000, "status": {"type": "finished"}},
                     {"id": 6, "homeTeam": {"name": "X"}, "awayTeam": {"name": "Y"}, "homeScore": {}, "awayScore": {},
                      "startTimestamp": 1700003600, "status": {"type": "notstarted"}}]}
    m = {r.partida_id: r for r in J.flatten_matches(docs(spark, [ev], temporada=2023), canonical={}).collect()}
    assert m[5].mandante == "Sao Paulo" and m[5].visitante == "Gremio" and m[5].vencedor == "-"
    assert m[5].arena == "V" and str(m[5].data) == "2023-11-14" and m[5].hora == "22:13"
    assert m[6].vencedor is None


def test_malformed_documents_stop_an_ingest(spark):
    df = spark.createDataFrame([('{"response": []}',), ("{broken",), (None,)], "payload string")
    with pytest.raises(ValueError, match="1 of 3"):
        J.reject_malformed(df)
    assert J.reject_malformed(df, max_share=0.5) == 1


def test_last_document_then_last_place_wins(spark):
    from varzea.operators.upsert import merge_documents
    rows = [(1, "9-9", (1, 0)), (1, "1-0", (2, 0)), (1, "2-1", (2, 1)), (2, "0-0", (1, 5))]
    new = spark.createDataFrame(rows, "partida_id int, placar string, _doc struct<time:int,at:int>")
    old = spark.createDataFrame([(1, "x"), (3, "y")], "partida_id int, placar string")
    want = {(1, "2-1"), (2, "0-0"), (3, "y")}
    assert {tuple(r) for r in merge_documents(old, new, ["partida_id"]).collect()} == want
