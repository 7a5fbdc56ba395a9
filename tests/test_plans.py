"""Plan checks on the materialised silver layer: partition pruning,
predicate pushdown, column pruning, top-k, no shuffle for the merge."""
import pytest

from varzea.plans import queries as Q
from varzea.plans.pipeline import SilverLake, build_silver


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def slake(spark, lake, tmp_path_factory):
    root, _ = build_silver(lake, str(tmp_path_factory.mktemp("silver")))
    return SilverLake(spark, root, lake.root)


def test_season_filter_prunes_partitions(slake):
    plan = _plan(Q.rodada(slake.partidas, 2000, 1))
    assert "PartitionFilters: [isnotnull(temporada" in plan and "(temporada" in plan and "= 2000)" in plan
    assert "PushedFilters: [IsNotNull(rodada), EqualTo(rodada,1)]" in plan


def test_status_filter_pushed_and_columns_pruned(slake):
    plan = _plan(Q.ultimos_finalizados(slake.partidas, 20))
    assert "EqualTo(status,finished)" in plan
    assert "TakeOrderedAndProject" in plan
    read = plan[plan.index("ReadSchema"):].split("\n")[0]
    for unused in ("estado_mandante", "arena", "vencedor", "fonte"):
        assert unused not in read


def test_standings_read_only_needed_columns(slake):
    from varzea.operators.gold import classificacao_historica
    plan = _plan(classificacao_historica(slake.partidas))
    read = plan[plan.index("ReadSchema"):].split("\n")[0]
    assert "mandante" in read and "gols_visitante" in read
    assert "arena" not in read and "data" not in read


def test_merge_of_raw_rows_needs_no_extra_shuffle(spark, lake):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # the joins shuffle on supplier, customer and order keys; the merge
        # groups on (order key, line number) inside the order-key partitioning
        ex = lake.partidas._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(l_orderkey" in ex and "hashpartitioning(o_orderkey" in ex
        assert "hashpartitioning(_ok" not in ex and "hashpartitioning(partida_id" not in ex
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_model_pre_aggregate_identical_in_every_branch(slake):
    """Every copy of the pair-season exchange is the same plan, so AQE runs
    it once (stage reuse) for head-to-head and the club features."""
    import re

    from varzea.operators import predict as P
    df = P.match_probabilities(P.pairs_that_met(slake.partidas), slake.partidas)
    init = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].split("\n")
    idx = [i for i, line in enumerate(init) if "Exchange hashpartitioning(clube" in line and "em_casa" in line]
    assert len(idx) >= 2

    def norm(line):
        line = re.sub(r"_common_expr_\d+", "_c", re.sub(r"#\d+L?", "", re.sub(r"plan_id=\d+", "", line)))
        return line.strip(" :+-")
    subtrees = {tuple(norm(x) for x in init[i:i + 6]) for i in idx}
    assert len(subtrees) == 1


def test_a_filter_on_matches_prunes_the_seasons_of_statistics(slake):
    stats, partidas = slake.estatisticas, slake.partidas
    rows = lambda df: sorted(map(tuple, df.collect()))
    one_season, one_round = partidas.filter("temporada = 2000"), partidas.filter("rodada = 1")
    for matches in (partidas, one_season, one_round):
        assert rows(Q.medias_estatisticas(stats, matches, por_temporada=True)) == rows(Q.medias_estatisticas(stats, matches))

    def scan(df):  # the line of the statistics' scan
        return next(line for line in _plan(df).split("\n") if "/estatisticas" in line)

    assert "= 2000)" in scan(Q.medias_estatisticas(stats, one_season, por_temporada=True))
    assert "dynamicpruning" in scan(Q.medias_estatisticas(stats, one_round, por_temporada=True))
    assert "dynamicpruning" not in scan(Q.medias_estatisticas(stats, one_round))
