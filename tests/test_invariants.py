"""Invariants over the fixture tables (sf0.001)."""
from pyspark.sql import functions as F

from varzea.operators import gold as G
from varzea.operators import legacy as N
from varzea.operators import predict as P
from varzea.sources import feeds as FD


def test_standings_invariants(lake):
    d = G.desempenho_clubes(lake.partidas)
    per = d.groupBy("temporada").agg(F.sum("vitorias").alias("v"), F.sum("derrotas").alias("l"),
                                     F.sum("jogos").alias("j"), F.sum("saldo_gols").alias("s")).collect()
    matches = {r.temporada: r.n for r in lake.partidas.groupBy("temporada").agg(F.count("*").alias("n")).collect()}
    for r in per:
        assert r.v == r.l
        assert r.j == 2 * matches[r.temporada]
        assert r.s == 0
    c = G.classificacao_historica(lake.partidas)
    for r in c.groupBy("temporada").agg(F.count("*").alias("n"), F.max("posicao").alias("m"),
                                        F.countDistinct("posicao").alias("d")).collect():
        assert r.n == r.m == r.d


def test_probabilities_sum_to_100(lake):
    p = P.match_probabilities(P.pairs_that_met(lake.partidas), lake.partidas)
    bad = p.filter(F.abs(F.col("p_clube1") + F.col("p_empate") + F.col("p_clube2") - 100) > 0.2).count()
    assert bad == 0


def test_table_from_winner_equals_standings(lake):
    """N9 over legacy sheets of played matches = G3 over the same matches."""
    played = P.played(lake.partidas).filter("temporada = 1998")
    n9 = {r.Clubes: r for r in N.table_from_winner(FD.legacy_sheet_rows(played)).collect()}
    g3 = {r.clube.lower(): r for r in G.desempenho_clubes(played).collect()}
    assert set(n9) == set(g3)
    for k, r in g3.items():
        assert (n9[k].J, n9[k].V, n9[k].E, n9[k].D, n9[k].GP, n9[k].GC, n9[k].PG) == \
               (r.jogos, r.vitorias, r.empates, r.derrotas, r.gols_pro, r.gols_contra, r.pontos)


def test_upsert_view_equals_fixture_view(lake):
    from varzea.operators.upsert import last_wins
    a = last_wins(lake.partidas_bruto, ["partida_id"], ["seq1", "seq2", "seq3", "seq4", "gols_mandante"])
    cols = ["partida_id", "gols_mandante", "gols_visitante", "visitante", "arena"]
    assert a.select(*cols).exceptAll(lake.partidas.select(*cols)).count() == 0
    assert a.count() == lake.partidas.count()
