"""Raw feeds derived from the silver-shaped tables, for round-trip checks.

Turns the matches / goals / cards / statistics / line-ups derived from the
driver's tables back into what the source ingests: dirty positional CSV rows
(all text) and provider JSON documents.  Every generator is a Spark job over
the whole table (``to_json`` / ``date_format`` / ``concat``), so the
round-trip queries grow with the data.  Documents are per match (the detail
endpoints are per fixture), so no document grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def club_id(name: Column) -> Column:
    """Provider club id: the trailing number of the fixture club name."""
    return F.regexp_extract(name, r"(\d+)$", 1).cast("bigint")


def kickoff_hour(rodada: Column) -> Column:
    """Kick-off time used by the generated feeds: ``HH:00`` with HH = 10 + round."""
    return F.concat(F.lpad((F.lit(10) + rodada).cast("string"), 2, "0"), F.lit(":00"))


def _txt(c: Column) -> Column:
    """Text as pandas would write a missing value: ``nan``."""
    return F.coalesce(c.cast("string"), F.lit("nan"))


# ---- dirty CSV rows (all STRING, positional) ---------------------------------------------

def dirty_match_rows(partidas: DataFrame) -> DataFrame:
    """16 positional text columns: day/month/year dates, padded names, goals
    as text, missing values as ``nan``."""
    return partidas.select(
        F.col("partida_id").cast("string").alias("ID"), F.col("rodada").cast("string").alias("Rodada"),
        F.date_format("data", "dd/MM/yyyy").alias("data"), kickoff_hour(F.col("rodada")).alias("hora"),
        F.concat(F.lit("  "), F.col("mandante"), F.lit(" ")).alias("mandante"),
        F.concat(F.col("visitante"), F.lit("   ")).alias("visitante"),
        F.lit("nan").alias("formacao_mandante"), F.lit("nan").alias("formacao_visitante"),
        F.lit(None).cast("string").alias("tecnico_mandante"), F.lit(" nan ").alias("tecnico_visitante"),
        _txt(F.col("vencedor")).alias("vencedor"), F.col("arena"),
        _txt(F.col("gols_mandante")).alias("mandante_Placar"),
        F.when(F.col("gols_visitante").isNull(), F.lit(None).cast("string"))
         .otherwise(F.concat(F.col("gols_visitante").cast("string"), F.lit(".0"))).alias("visitante_Placar"),
        F.col("estado_mandante"), F.col("estado_visitante"))


def dirty_stats_rows(estatisticas: DataFrame) -> DataFrame:
    """13 positional text columns; possession as ``55%``; blanks for the
    columns the fixture table lacks."""
    blank = F.lit(None).cast("string")
    return estatisticas.select(
        F.col("partida_id").cast("string"), F.col("rodada").cast("string"), F.concat(F.col("clube"), F.lit(" ")),
        F.col("chutes").cast("string"), F.col("chutes_no_alvo").cast("string"),
        F.concat(F.col("posse_de_bola").cast("bigint").cast("string"), F.lit("%")),
        blank, F.lit(" - "), F.col("faltas").cast("string"), blank, blank, blank,
        F.col("escanteios").cast("string")).toDF(
        "partida_id", "rodada", "clube", "chutes", "chutes_no_alvo", "posse_de_bola", "passes", "precisao_passes",
        "faltas", "cartao_amarelo", "cartao_vermelho", "impedimentos", "escanteios")


def dirty_goal_rows(gols: DataFrame, with_type: bool = True) -> DataFrame:
    """5 or 6 positional columns; minute written ``m+2`` when it ends in 5."""
    m = F.col("minuto")
    minute = F.when(m % 10 == 5, F.concat(m.cast("string"), F.lit("+2"))).otherwise(m.cast("string"))
    cols = [F.col("partida_id").cast("string").alias("partida_id"), F.col("rodada").cast("string").alias("rodada"),
            F.col("clube"), F.concat(F.lit(" "), F.col("atleta")).alias("atleta"), minute.alias("minuto")]
    if with_type:
        cols.append(F.col("tipo_de_gol"))
    return gols.select(*cols)


def dirty_card_rows(cartoes: DataFrame) -> DataFrame:
    """8 positional columns; card colour in mixed case, minute as ``m'``."""
    c = F.col("cartao")
    mixed = F.when(F.col("minuto") % 2 == 0, F.upper(c)).otherwise(F.lower(c))
    return cartoes.select(
        F.col("partida_id").cast("string").alias("partida_id"), F.col("rodada").cast("string").alias("rodada"),
        F.col("clube"), mixed.alias("cartao"), F.col("atleta"), F.col("num_camisa"),
        F.lit(None).cast("string").alias("posicao"), F.concat(F.col("minuto").cast("string"), F.lit("'")).alias("minuto"))


# ---- provider A documents ---------------------------------------------------------------------

def fixture_docs(partidas: DataFrame) -> DataFrame:
    """One fixtures document per match (``response`` of one fixture)."""
    date = F.concat(F.date_format("data", "yyyy-MM-dd"), F.lit("T"), kickoff_hour(F.col("rodada")),
                    F.lit(":00+00:00"))
    fx = F.struct(
        F.struct(F.col("partida_id").alias("id"), date.alias("date"),
                 F.struct(F.when(F.col("status") == "finished", "FT").otherwise("NS").alias("short")).alias("status"),
                 F.struct(F.col("arena").alias("name")).alias("venue")).alias("fixture"),
        F.struct(F.concat(F.lit("Regular Season - "), F.col("rodada").cast("string")).alias("round")).alias("league"),
        F.struct(F.struct(club_id(F.col("mandante")).alias("id"), F.col("mandante").alias("name")).alias("home"),
                 F.struct(club_id(F.col("visitante")).alias("id"), F.col("visitante").alias("name")).alias("away")
                 ).alias("teams"),
        F.struct(F.col("gols_mandante").alias("home"), F.col("gols_visitante").alias("away")).alias("goals"))
    return partidas.select("temporada", F.to_json(F.struct(F.array(fx).alias("response"))).alias("payload"))


def in_envelope(docs: DataFrame, endpoint: str, **params) -> DataFrame:
    """The documents as the provider sends them: with the endpoint and the request's parameters."""
    asked = F.to_json(F.struct(*[c.cast("string").alias(k) for k, c in params.items()]))
    head = F.concat(F.lit(f'{{"get":"{endpoint}","parameters":'), asked, F.lit(","))
    return docs.withColumn("payload", F.concat(head, F.expr("substring(payload, 2)")))


def team_stats_docs(estatisticas: DataFrame) -> DataFrame:
    """One statistics document per match: both teams, key/value lists
    (possession as ``NN%``)."""
    def item(name, value):
        return F.struct(F.lit(name).alias("type"), value.cast("string").alias("value"))
    def team(x):
        return F.struct(
            F.struct(x["clube"].alias("name")).alias("team"),
            F.array(item("Total Shots", x["chutes"]), item("Shots on Goal", x["chutes_no_alvo"]),
                    item("Ball Possession", F.concat(x["posse_de_bola"].cast("bigint").cast("string"), F.lit("%"))),
                    item("Fouls", x["faltas"]), item("Corner Kicks", x["escanteios"])).alias("statistics"))
    # plain values are grouped; the lists, many times as wide, are made from them afterwards
    per_match = estatisticas.groupBy("partida_id", "temporada", "rodada").agg(F.collect_list(F.struct(
        "clube", "chutes", "chutes_no_alvo", "posse_de_bola", "faltas", "escanteios")).alias("xs"))
    teams = F.transform("xs", lambda x: F.struct(x["clube"].alias("k"), team(x).alias("t")))
    return per_match.select("partida_id", "temporada", "rodada", F.to_json(F.struct(
        F.transform(F.sort_array(teams), lambda x: x["t"]).alias("response"))).alias("payload"))


# Goal type of the fixture table -> provider A event detail.
A_GOAL_DETAIL = {"Normal": "Normal Goal", "Penalty": "Penalty", "Gol Contra": "Own Goal"}


def event_docs(gols: DataFrame, cartoes: DataFrame) -> DataFrame:
    """One events document per match id: goals, cards, and one extra
    missed-penalty and substitution event per match that must be ignored."""
    det = F.create_map(*[F.lit(x) for kv in A_GOAL_DETAIL.items() for x in kv])

    def ev(typ, detail, atleta, pid_col="user_pid"):
        return F.struct(F.struct(F.col("clube").alias("name")).alias("team"),
                        F.struct(F.col(pid_col).alias("id"), atleta.alias("name")).alias("player"),
                        F.struct(F.col("minuto").alias("elapsed")).alias("time"),
                        F.lit(typ).alias("type"), detail.alias("detail"))
    pid = F.regexp_extract("atleta", r"(\d+)$", 1).cast("bigint").alias("user_pid")
    g = gols.select("partida_id", "temporada", "rodada", "clube", "atleta", "minuto", "tipo_de_gol", pid)
    c = cartoes.select("partida_id", "temporada", "rodada", "clube", "atleta", "minuto", "cartao", pid)
    goal_ev = g.select("partida_id", "temporada", "rodada", F.col("minuto").alias("_m"), F.lit(0).alias("_k"),
                       ev("Goal", F.coalesce(det[F.col("tipo_de_gol")], F.lit("Normal Goal")), F.col("atleta")).alias("e"))
    miss_ev = g.select("partida_id", "temporada", "rodada", F.col("minuto").alias("_m"), F.lit(1).alias("_k"),
                       ev("Goal", F.lit("Missed Penalty"), F.col("atleta")).alias("e"))
    card_ev = c.select("partida_id", "temporada", "rodada", F.col("minuto").alias("_m"), F.lit(2).alias("_k"),
                       ev("Card", F.when(F.col("cartao") == "Amarelo", "Yellow Card").otherwise("Red Card"),
                          F.col("atleta")).alias("e"))
    subst_ev = c.select("partida_id", "temporada", "rodada", F.col("minuto").alias("_m"), F.lit(3).alias("_k"),
                        ev("subst", F.lit("Substitution 1"), F.col("atleta")).alias("e"))
    allev = goal_ev.unionByName(miss_ev).unionByName(card_ev).unionByName(subst_ev)
    per = allev.groupBy("partida_id", "temporada", "rodada").agg(
        F.array_sort(F.collect_list(F.struct("_m", "_k", "e"))).alias("es"))
    return per.select("partida_id", "temporada", "rodada",
                      F.to_json(F.struct(F.transform("es", lambda x: x["e"]).alias("response"))).alias("payload"))


def lineup_docs(escalacoes: DataFrame) -> DataFrame:
    """One line-ups document per (match, club): starters and substitutes."""
    p = F.struct(F.struct(F.col("atleta").alias("name"), F.col("num_camisa").alias("number"),
                          F.lit(None).cast("string").alias("pos")).alias("player"))
    per = escalacoes.groupBy("partida_id", "temporada", "rodada", "clube").agg(
        F.array_sort(F.collect_list(F.when(F.col("titular"), F.struct(F.col("atleta").alias("k"), p.alias("p"))))).alias("xi"),
        F.array_sort(F.collect_list(F.when(~F.col("titular"), F.struct(F.col("atleta").alias("k"), p.alias("p"))))).alias("bench"))
    team = F.struct(F.struct(F.col("clube").alias("name")).alias("team"),
                    F.struct(F.concat(F.lit("Coach "), F.col("clube")).alias("name")).alias("coach"),
                    F.lit("4-4-2").alias("formation"),
                    F.transform("xi", lambda x: x["p"]).alias("startXI"),
                    F.transform("bench", lambda x: x["p"]).alias("substitutes"))
    return per.select("partida_id", "temporada", "rodada",
                      F.to_json(F.struct(F.array(team).alias("response"))).alias("payload"))


def standings_docs(classif: DataFrame) -> DataFrame:
    """One standings document per season (rows bounded by clubs per season)."""
    row = F.struct(
        F.col("posicao").alias("rank"), F.struct(F.col("clube").alias("name")).alias("team"),
        F.col("pontos").alias("points"), F.col("saldo_gols").alias("goalsDiff"), F.lit("WDLWW").alias("form"),
        F.struct(F.col("jogos").alias("played"), F.col("vitorias").alias("win"), F.col("empates").alias("draw"),
                 F.col("derrotas").alias("lose"),
                 F.struct(F.col("gols_pro").alias("for"), F.col("gols_contra").alias("against")).alias("goals")
                 ).alias("all"))
    per = classif.groupBy("temporada").agg(F.array_sort(F.collect_list(F.struct(F.col("posicao").alias("k"),
                                                                                 row.alias("r")))).alias("rows"))
    doc = F.struct(F.array(F.struct(F.struct(F.array(F.transform("rows", lambda x: x["r"])).alias("standings"))
                                    .alias("league"))).alias("response"))
    return per.select("temporada", F.to_json(doc).alias("payload"))


# ---- provider B documents ----------------------------------------------------------------------

def round_docs(partidas: DataFrame) -> DataFrame:
    """One round-events document per match; start as epoch seconds (UTC)."""
    ts = F.unix_timestamp(F.to_timestamp(F.concat(F.date_format("data", "yyyy-MM-dd"), F.lit(" "),
                                                  kickoff_hour(F.col("rodada")))), "yyyy-MM-dd HH:mm")
    ev = F.struct(
        F.col("partida_id").alias("id"),
        F.struct(club_id(F.col("mandante")).alias("id"), F.col("mandante").alias("name")).alias("homeTeam"),
        F.struct(club_id(F.col("visitante")).alias("id"), F.col("visitante").alias("name")).alias("awayTeam"),
        F.struct(F.col("gols_mandante").alias("current")).alias("homeScore"),
        F.struct(F.col("gols_visitante").alias("current")).alias("awayScore"),
        F.struct(F.col("arena").alias("name"),
                 F.when(F.col("partida_id") % 2 == 0, F.struct(F.col("arena").alias("name"))).alias("stadium")
                 ).alias("venue"),
        ts.alias("startTimestamp"), F.struct(F.col("status").alias("type")).alias("status"))
    return partidas.select("temporada", "rodada", F.to_json(F.struct(F.array(ev).alias("events"))).alias("payload"))


def stats_b_docs(estatisticas: DataFrame, partidas: DataFrame) -> DataFrame:
    """One statistics document per match: an ``ALL`` period with two groups
    and a first-half period that must be ignored.  Home values are the home
    club's row (joined from the match)."""
    cols = ["chutes", "chutes_no_alvo", "posse_de_bola", "faltas", "escanteios"]
    e = estatisticas.join(partidas.select("partida_id", "mandante"), "partida_id")
    is_home = F.col("clube") == F.col("mandante")
    per = e.groupBy("partida_id").agg(
        F.max(F.when(is_home, F.struct(*cols))).alias("x"),
        F.max(F.when(~is_home, F.struct(*cols))).alias("y"))

    def item(key, h, a):
        return F.struct(F.lit(key).alias("key"), F.lit(key).alias("name"), h.cast("string").alias("homeValue"),
                        a.cast("string").alias("awayValue"))
    pct = lambda c: F.concat(c.cast("bigint").cast("string"), F.lit("%"))
    g1 = F.struct(F.array(item("ballPossession", pct(F.col("x.posse_de_bola")), pct(F.col("y.posse_de_bola"))),
                          item("totalShotsOnGoal", F.col("x.chutes"), F.col("y.chutes"))).alias("statisticsItems"))
    g2 = F.struct(F.array(item("shotsOnTarget", F.col("x.chutes_no_alvo"), F.col("y.chutes_no_alvo")),
                          item("fouls", F.col("x.faltas"), F.col("y.faltas")),
                          item("cornerKicks", F.col("x.escanteios"), F.col("y.escanteios"))).alias("statisticsItems"))
    first = F.struct(F.lit("1ST").alias("period"),
                     F.array(F.struct(F.array(item("fouls", F.lit(99), F.lit(99))).alias("statisticsItems"))).alias("groups"))
    allp = F.struct(F.lit("ALL").alias("period"), F.array(g1, g2).alias("groups"))
    return per.select("partida_id", F.to_json(F.struct(F.array(first, allp).alias("statistics"))).alias("payload"))


def incident_docs(gols: DataFrame, cartoes: DataFrame) -> DataFrame:
    """One incidents document per match id: goals and cards; even players
    are home; every third incident carries only ``playerName``."""
    gclass = F.when(F.col("tipo_de_gol") == "Penalty", "penalty").when(F.col("tipo_de_gol") == "Gol Contra", "ownGoal") \
        .when(F.col("tipo_de_gol").isNull(), F.lit(None)).otherwise("regular")
    num = F.regexp_extract("atleta", r"(\d+)$", 1).cast("bigint")

    def inc(typ, cls):
        full = F.struct(F.col("atleta").alias("name"), F.lit("M").alias("position"),
                        (num % 30).cast("string").alias("jerseyNumber"))
        return F.struct(F.lit(typ).alias("incidentType"), cls.alias("incidentClass"),
                        F.when(num % 3 != 0, full).alias("player"),
                        F.when(num % 3 == 0, F.col("atleta")).alias("playerName"),
                        F.col("minuto").alias("time"), (num % 2 == 0).alias("isHome"))
    g = gols.select("partida_id", F.col("minuto").alias("_m"), inc("goal", gclass).alias("i"))
    c = cartoes.select("partida_id", F.col("minuto").alias("_m"),
                       inc("card", F.when(F.col("cartao") == "Amarelo", "yellow").otherwise("yellowRed")).alias("i"))
    per = g.unionByName(c).groupBy("partida_id").agg(F.array_sort(F.collect_list(F.struct("_m", "i"))).alias("is"))
    return per.select("partida_id", F.to_json(F.struct(F.transform("is", lambda x: x["i"]).alias("incidents"))).alias("payload"))


def squad_docs(escalacoes: DataFrame) -> DataFrame:
    """One line-ups document per match id; even players home; every fifth
    player has no ``substitute`` flag."""
    num = F.regexp_extract("atleta", r"(\d+)$", 1).cast("bigint")
    pl = F.struct(F.struct(F.col("atleta").alias("name"), F.col("num_camisa").alias("jerseyNumber"),
                           F.lit("M").alias("position")).alias("player"),
                  F.when(num % 5 != 0, ~F.col("titular")).alias("substitute"))
    e = escalacoes.select("partida_id", (num % 2 == 0).alias("home"), F.struct(F.col("atleta").alias("k"), pl.alias("p")).alias("x"))
    per = e.groupBy("partida_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("home"), F.col("x")))).alias("h"),
        F.array_sort(F.collect_list(F.when(~F.col("home"), F.col("x")))).alias("a"))
    side = lambda c: F.struct(F.lit("4-3-3").alias("formation"), F.transform(c, lambda x: x["p"]).alias("players"))
    return per.select("partida_id", F.to_json(F.struct(side("h").alias("home"), side("a").alias("away"))).alias("payload"))


# ---- legacy yearly sheets ----------------------------------------------------------------------

def legacy_sheet_rows(partidas: DataFrame) -> DataFrame:
    """The yearly-sheet layout: padded, capitalised club names, score text
    `` 2x1 `` (null for an unplayed match), winner name or ``-`` (null when
    unplayed), ISO date text and weekday name."""
    def name(c):
        return F.concat(F.lit(" "), F.initcap(F.lower(c)), F.lit(" "))
    gm, gv = F.col("gols_mandante"), F.col("gols_visitante")
    winner = (F.when(gm > gv, name(F.col("mandante"))).when(gm < gv, name(F.col("visitante")))
              .when(gm == gv, F.lit(" - ")))
    return partidas.select(
        F.date_format("data", "yyyy-MM-dd").alias("Data"), F.date_format("data", "EEEE").alias("Dia"),
        name(F.col("mandante")).alias("Clube 1"), name(F.col("visitante")).alias("Clube 2"),
        F.when(gm.isNotNull(), F.concat(F.lit(" "), gm.cast("string"), F.lit("x"), gv.cast("string"), F.lit(" ")))
         .alias("Placar"),
        winner.alias("Vencedor"), F.col("arena").alias("Arena"))
