"""Provider payloads (nested JSON text) -> silver rows.

The source parses one document at a time in Python loops.  Here a payload
column is parsed by ``from_json`` with an explicit schema and flattened with
``explode`` / ``inline`` / higher-order functions, so millions of documents
are parsed in parallel inside the JVM; nothing is collected.

Input of every flattener: a DataFrame with a ``payload`` STRING column plus
context columns that came with the document (file-name parameters such as
the season, or the id of the match the detail document belongs to).
Context columns are kept on every output row (J11).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varzea.functions.columns import safe_float

# ---- schemas (fixed by the providers' formats) ---------------------------------------------

_TEAM = "STRUCT<id: BIGINT, name: STRING>"
A_FIXTURES = ("parameters STRUCT<season: STRING>, "
              "response ARRAY<STRUCT<fixture: STRUCT<id: BIGINT, date: STRING, status: STRUCT<short: STRING>, "
              f"venue: STRUCT<name: STRING>>, league: STRUCT<round: STRING, season: INT>, teams: STRUCT<home: {_TEAM}, "
              f"away: {_TEAM}>, goals: STRUCT<home: BIGINT, away: BIGINT>>>")
A_STATISTICS = ("response ARRAY<STRUCT<team: STRUCT<name: STRING>, "
                "statistics: ARRAY<STRUCT<type: STRING, value: STRING>>>>")
A_EVENTS = ("response ARRAY<STRUCT<team: STRUCT<name: STRING>, player: STRUCT<id: BIGINT, name: STRING>, "
            "time: STRUCT<elapsed: BIGINT>, type: STRING, detail: STRING>>")
_A_PLAYERS = "ARRAY<STRUCT<player: STRUCT<name: STRING, number: STRING, pos: STRING>>>"
A_LINEUPS = (f"response ARRAY<STRUCT<team: STRUCT<name: STRING>, coach: STRUCT<name: STRING>, formation: STRING, "
             f"startXI: {_A_PLAYERS}, substitutes: {_A_PLAYERS}>>")
A_STANDINGS = ("response ARRAY<STRUCT<league: STRUCT<standings: ARRAY<ARRAY<STRUCT<rank: INT, "
               "team: STRUCT<name: STRING>, points: INT, goalsDiff: INT, form: STRING, all: STRUCT<played: INT, "
               "win: INT, draw: INT, lose: INT, goals: STRUCT<`for`: INT, against: INT>>>>>>>>")

B_EVENTS = (f"events ARRAY<STRUCT<id: BIGINT, homeTeam: {_TEAM}, awayTeam: {_TEAM}, "
            "homeScore: STRUCT<current: BIGINT>, awayScore: STRUCT<current: BIGINT>, "
            "venue: STRUCT<name: STRING, stadium: STRUCT<name: STRING>>, startTimestamp: BIGINT, "
            "status: STRUCT<type: STRING>>>")
B_STATISTICS = ("statistics ARRAY<STRUCT<period: STRING, groups: ARRAY<STRUCT<statisticsItems: "
                "ARRAY<STRUCT<key: STRING, name: STRING, homeValue: STRING, awayValue: STRING>>>>>>")
B_INCIDENTS = ("incidents ARRAY<STRUCT<incidentType: STRING, incidentClass: STRING, "
               "player: STRUCT<name: STRING, position: STRING, jerseyNumber: STRING>, playerName: STRING, "
               "time: BIGINT, isHome: BOOLEAN>>")
_B_SIDE = ("STRUCT<formation: STRING, players: ARRAY<STRUCT<player: STRUCT<name: STRING, jerseyNumber: STRING, "
           "position: STRING>, substitute: BOOLEAN>>>")
B_LINEUPS = f"home {_B_SIDE}, away {_B_SIDE}"

# Statistic names of each provider -> silver column.
A_STAT_NAMES = {
    "chutes": "Total Shots", "chutes_no_alvo": "Shots on Goal", "posse_de_bola": "Ball Possession",
    "passes": "Total passes", "precisao_passes": "Passes %", "faltas": "Fouls",
    "cartao_amarelo": "Yellow Cards", "cartao_vermelho": "Red Cards", "impedimentos": "Offsides",
    "escanteios": "Corner Kicks",
}
B_STAT_KEYS = {
    "chutes": "totalShotsOnGoal", "chutes_no_alvo": "shotsOnTarget", "posse_de_bola": "ballPossession",
    "passes": "totalPasses", "precisao_passes": "accuratePassesPercentage", "faltas": "fouls",
    "cartao_amarelo": "yellowCards", "cartao_vermelho": "redCards", "impedimentos": "offsides",
    "escanteios": "cornerKicks",
}
PERCENT_STATS = ("posse_de_bola", "precisao_passes")
# Provider B goal classes -> goal type.
B_GOAL_CLASS = {"regular": "Normal", "penalty": "Pênalti", "ownGoal": "Gol Contra", "fromCorner": "De Escanteio"}
# The providers' words for a finished match, and the source
# labels written to ``fonte``.
FINISHED = ("FT", "finished")
FONTE_A = "api_football"
FONTE_B = "sofascore"


#: Optional context column: what orders the documents (file time, file name).  Rows made from a document carry it
#: with their place in the document, so a merge can keep the last one.
DOC = "_doc"


def _ctx(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != "payload"]


def _rows(df: DataFrame, ctx: list[str], array, name: str, *more) -> DataFrame:
    """One row per element of ``array``, as ``name``; its place goes into ``DOC``.
    The rows that an outer explode makes of empty arrays have no place and are
    dropped: an inner one asks for the array's size before it, and that filter
    would parse the document again."""
    out = df.select(*ctx, *more, F.posexplode_outer(array).alias("_at", name)).filter(F.col("_at").isNotNull())
    if DOC in ctx:
        out = out.withColumn(DOC, F.struct(F.col(DOC).alias("doc"), F.col("_at").alias("at")))
    return out.drop("_at")


def with_place(lines: DataFrame) -> DataFrame:
    """``DOC`` of JSON Lines read in splits: file time, file name, the split's
    start in the file, and the line's place in the split (its number among the
    rows of the task that read it; the split's rows are all there, in order).
    Takes ``_time``, ``_file`` and ``_start`` as they come from the reader."""
    return lines.withColumn("_line", F.monotonically_increasing_id()).select(
        *[c for c in lines.columns if c not in ("_time", "_file", "_start")],
        F.struct(F.col("_time").alias("time"), F.col("_file").alias("file"), F.col("_start").alias("start"),
                 F.col("_line").alias("line")).alias(DOC))


def with_envelope(raw: DataFrame) -> DataFrame:
    """Provider A's envelope: ``endpoint`` (``fixtures`` if it names none) and ``params`` beside the document."""
    top = F.from_json("payload", "get STRING, parameters MAP<STRING, STRING>")
    return raw.withColumn("_top", top).select(
        *raw.columns, F.coalesce(F.col("_top.get"), F.lit("fixtures")).alias("endpoint"),
        F.col("_top.parameters").alias("params"))


def reject_malformed(raw: DataFrame, max_share: float = 0.0) -> int:
    """Fail if more than ``max_share`` of the documents are not JSON (the
    flatteners would return no rows for them); returns how many are not."""
    bad = F.col("payload").isNotNull() & F.try_parse_json("payload").isNull()
    got = raw.agg(F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("bad")).first()
    if got["bad"] > max_share * got["n"]:
        raise ValueError(f"{got['bad']} of {got['n']} documents are not valid JSON")
    return got["bad"]


def _parse(df: DataFrame, schema: str) -> DataFrame:
    return df.select(*_ctx(df), F.from_json("payload", schema).alias("j"))


def _stat_columns(m: Column, names: dict[str, str]) -> list[Column]:
    out = []
    for col, key in names.items():
        v = m[key]
        out.append((safe_float(v) if col in PERCENT_STATS else v.try_cast("bigint")).alias(col))
    return out


def _last_by_key(items: str, key: str, value: str) -> Column:
    """Map of a list of structs with a key and a value; entries without a key are left out."""
    return F.map_from_entries(F.transform(_keyed(items, key), lambda s: F.struct(s[key], s[value])))


def _keyed(items: str, key: str) -> Column:
    return F.filter(items, lambda s: s[key].isNotNull())


# ---- provider A -----------------------------------------------------------------------------

def round_number(round_text: Column) -> Column:
    """``"Regular Season - 3"`` -> 3; no ``" - "`` or not a number -> null."""
    last = F.element_at(F.split(round_text, " - "), -1)
    return F.when(round_text.contains(" - "), last.try_cast("int"))


def flatten_fixtures(raw: DataFrame, with_season: bool = False) -> DataFrame:
    """Fixture documents -> match rows (date/time by substring of the ISO
    text; date cast to DATE).  ``with_season`` adds ``temporada``, the match's
    own season or else that of the request."""
    asked = F.col("j.parameters.season").try_cast("int").alias("asked")
    f = _rows(_parse(raw, A_FIXTURES), _ctx(raw), "j.response", "f", asked)
    d = F.col("f.fixture.date")
    season = [F.coalesce("f.league.season", "asked").alias("temporada")] if with_season else []
    return f.select(
        *_ctx(raw), *season,
        F.col("f.fixture.id").alias("partida_id"),
        round_number(F.col("f.league.round")).alias("rodada"),
        F.to_date(F.substring(d, 1, 10)).alias("data"),
        F.substring(d, 12, 5).alias("hora"),
        F.col("f.fixture.status.short").alias("status"),
        F.col("f.fixture.venue.name").alias("arena"),
        F.col("f.teams.home.name").alias("mandante"), F.col("f.teams.away.name").alias("visitante"),
        F.col("f.teams.home.id").alias("mandante_id"), F.col("f.teams.away.id").alias("visitante_id"),
        F.col("f.goals.home").alias("gols_mandante"), F.col("f.goals.away").alias("gols_visitante"))


def flatten_team_stats(raw: DataFrame) -> DataFrame:
    """Per team, the key/value statistics list becomes one map (a repeated
    key keeps its last value) and then ten typed columns.  The map is a column
    of its own, so it is made once a team and not once a statistic; the list's
    items are its entries as they are."""
    t = _rows(_parse(raw, A_STATISTICS), _ctx(raw), "j.response", "t")
    m = t.select(*_ctx(raw), F.col("t.team.name").alias("clube"), F.map_from_entries(_keyed("t.statistics", "type")).alias("_m"))
    return m.select(*_ctx(raw), "clube", *_stat_columns(F.col("_m"), A_STAT_NAMES))


def flatten_events(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events -> (goals, cards).  Goals: type ``Goal`` except missed
    penalties, ``Normal Goal`` -> ``Normal``.  Cards: ``Yellow`` in the detail
    -> Amarelo else Vermelho; ``num_camisa`` carries the player id (the
    provider has no shirt number here)."""
    e = _rows(_parse(raw, A_EVENTS), _ctx(raw), "j.response", "e")
    typ, det = F.col("e.type"), F.coalesce(F.col("e.detail"), F.lit(""))
    base = [F.col("e.team.name").alias("clube"), F.col("e.player.name").alias("atleta"),
            F.col("e.time.elapsed").alias("minuto")]
    gols = (e.filter((typ == "Goal") & (det != "Missed Penalty"))
            .select(*_ctx(raw), *base,
                    F.when(det == "Normal Goal", F.lit("Normal")).otherwise(det).alias("tipo_de_gol")))
    cartoes = (e.filter(typ == "Card")
               .select(*_ctx(raw), *base,
                       F.when(det.contains("Yellow"), F.lit("Amarelo")).otherwise(F.lit("Vermelho")).alias("cartao"),
                       F.col("e.player.id").cast("string").alias("num_camisa"),
                       F.lit(None).cast("string").alias("posicao")))
    return gols, cartoes


def flatten_lineups(raw: DataFrame) -> DataFrame:
    """Starters and bench of both teams in one explode (the two arrays
    are tagged and concatenated per team)."""
    t = _rows(_parse(raw, A_LINEUPS), _ctx(raw), "j.response", "t")
    both = F.concat(
        F.transform(F.coalesce("t.startXI", F.array()), lambda p: F.struct(p["player"].alias("p"), F.lit(True).alias("titular"))),
        F.transform(F.coalesce("t.substitutes", F.array()), lambda p: F.struct(p["player"].alias("p"), F.lit(False).alias("titular"))))
    return (_rows(t, _ctx(raw), both, "x", F.col("t.team.name").alias("clube"), F.col("t.coach.name").alias("tecnico"),
                  F.col("t.formation").alias("formacao"))
            .select(*_ctx(raw), "clube", "tecnico", "formacao", F.col("x.p.name").alias("atleta"),
                    F.col("x.p.number").alias("num_camisa"), F.col("x.p.pos").alias("posicao"),
                    F.col("x.titular").alias("titular")))


def flatten_standings(raw: DataFrame) -> DataFrame:
    """``response[0].league.standings[0]`` rows; a missing path gives no
    rows (not an error)."""
    j = _parse(raw, A_STANDINGS)
    table = F.get(F.get(F.col("j.response"), 0)["league"]["standings"], 0)
    s = j.select(*_ctx(raw), F.explode_outer(table).alias("s")).filter(F.col("s").isNotNull())
    return s.select(*_ctx(raw), F.col("s.rank").alias("posicao"), F.col("s.team.name").alias("clube"),
                    F.col("s.points").alias("pontos"), F.col("s.all.played").alias("jogos"),
                    F.col("s.all.win").alias("vitorias"), F.col("s.all.draw").alias("empates"),
                    F.col("s.all.lose").alias("derrotas"), F.col("s.all.goals.for").alias("gols_pro"),
                    F.col("s.all.goals.against").alias("gols_contra"), F.col("s.goalsDiff").alias("saldo_gols"),
                    F.col("s.form").alias("forma"))


# ---- provider B -----------------------------------------------------------------------------

def flatten_matches(raw: DataFrame, canonical: dict[str, str] | None = None) -> DataFrame:
    """Round event lists -> match rows.  Epoch seconds read as UTC and
    split in date and ``HH:mm``; winner (name or ``-``) only for finished
    matches with both scores; stadium name falls back to venue name.
    ``canonical`` (alias -> name, ``{}`` = the built-in list) renames clubs."""
    e = _rows(_parse(raw, B_EVENTS), _ctx(raw), "j.events", "e")
    ts = F.timestamp_seconds(F.col("e.startTimestamp"))
    gh, ga = F.col("e.homeScore.current"), F.col("e.awayScore.current")
    st = F.coalesce(F.col("e.status.type"), F.lit(""))
    home, away = F.col("e.homeTeam.name"), F.col("e.awayTeam.name")
    if canonical is not None:
        from varzea.operators.silver import canonical_club
        home, away = canonical_club(home, canonical or None), canonical_club(away, canonical or None)
    out = e.select(
        *_ctx(raw),
        F.col("e.id").alias("partida_id"),
        F.to_date(ts).alias("data"),
        F.date_format(ts, "HH:mm").alias("hora"),
        home.alias("mandante"), away.alias("visitante"),
        F.col("e.homeTeam.id").alias("mandante_id"), F.col("e.awayTeam.id").alias("visitante_id"),
        gh.alias("gols_mandante"), ga.alias("gols_visitante"),
        F.coalesce(F.nullif(F.col("e.venue.stadium.name"), F.lit("")), F.col("e.venue.name")).alias("arena"),
        st.alias("status"))
    gh, ga = F.col("gols_mandante"), F.col("gols_visitante")
    win = (F.when(gh.isNotNull() & ga.isNotNull() & (F.col("status") == "finished"),
                  F.when(gh > ga, F.col("mandante")).when(ga > gh, F.col("visitante")).otherwise(F.lit("-"))))
    return out.withColumn("vencedor", win).withColumn("fonte", F.lit(FONTE_B))


def flatten_stats(raw: DataFrame) -> DataFrame:
    """Period ``ALL`` only; every item of every group; one map per side
    (a repeated key keeps the last value), then two rows labelled
    ``mandante`` / ``visitante`` in ``lado``.  A document without that period
    gives the two rows with null statistics.  No filter stands between the
    parse and the maps, so each document is parsed once."""
    j = _parse(raw, B_STATISTICS)
    items = F.flatten(F.transform(
        F.filter(F.coalesce("j.statistics", F.array()), lambda p: p["period"] == "ALL"),
        lambda p: F.flatten(F.transform(F.coalesce(p["groups"], F.array()),
                                        lambda g: F.coalesce(g["statisticsItems"], F.array())))))
    it = j.select(*_ctx(raw), items.alias("_items"))
    home = _last_by_key("_items", "key", "homeValue")
    away = _last_by_key("_items", "key", "awayValue")
    sides = F.array(F.struct(F.lit("mandante").alias("lado"), home.alias("m")),
                    F.struct(F.lit("visitante").alias("lado"), away.alias("m")))
    s = it.select(*_ctx(raw), F.inline(sides))
    return s.select(*_ctx(raw), "lado", *_stat_columns(F.col("m"), B_STAT_KEYS), F.lit(FONTE_B).alias("fonte"))


def flatten_incidents(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Incidents -> (goals, cards).  ``lado`` is mandante/visitante from
    ``isHome`` (missing -> home); the player name falls back to
    ``playerName`` when the player object is absent or empty; a card class
    containing ``red`` (also yellowRed) is Vermelho."""
    i = _rows(_parse(raw, B_INCIDENTS), _ctx(raw), "j.incidents", "i")
    player = F.col("i.player")
    empty = player.isNull() | F.coalesce(F.to_json(player) == "{}", F.lit(False))
    name = F.when(empty, F.col("i.playerName")).otherwise(player["name"])
    lado = F.when(F.coalesce(F.col("i.isHome"), F.lit(True)), F.lit("mandante")).otherwise(F.lit("visitante"))
    cls = F.col("i.incidentClass")
    goal_cls = F.coalesce(cls, F.lit("regular"))
    mapping = F.create_map(*[F.lit(x) for kv in B_GOAL_CLASS.items() for x in kv])
    base = [lado.alias("lado"), name.alias("atleta"), F.col("i.time").alias("minuto")]
    gols = (i.filter(F.col("i.incidentType") == "goal")
            .select(*_ctx(raw), *base, F.coalesce(mapping[goal_cls], goal_cls).alias("tipo_de_gol"),
                    F.lit(FONTE_B).alias("fonte")))
    cartoes = (i.filter(F.col("i.incidentType") == "card")
               .select(*_ctx(raw), *base,
                       F.when(F.lower(F.coalesce(cls, F.lit(""))).contains("red"), F.lit("Vermelho"))
                        .otherwise(F.lit("Amarelo")).alias("cartao"),
                       player["position"].alias("posicao"), player["jerseyNumber"].alias("num_camisa"),
                       F.lit(FONTE_B).alias("fonte")))
    return gols, cartoes


def flatten_squads(raw: DataFrame) -> DataFrame:
    """Both line-ups; ``titular`` only when ``substitute`` is exactly
    false (missing -> not a starter)."""
    j = _parse(raw, B_LINEUPS)
    sides = F.array(F.struct(F.lit("mandante").alias("lado"), F.col("j.home").alias("s")),
                    F.struct(F.lit("visitante").alias("lado"), F.col("j.away").alias("s")))
    s = j.select(*_ctx(raw), F.inline(sides))
    p = _rows(s, _ctx(raw), F.coalesce(F.col("s.players"), F.array()), "p", "lado",
              F.col("s.formation").alias("formacao"))
    return p.select(*_ctx(raw), "lado", "formacao", F.col("p.player.name").alias("atleta"),
                    F.col("p.player.jerseyNumber").alias("num_camisa"),
                    F.col("p.player.position").alias("posicao"),
                    F.coalesce(F.col("p.substitute") == F.lit(False), F.lit(False)).alias("titular"),
                    F.lit(FONTE_B).alias("fonte"))


# ---- J10 / J11 ----------------------------------------------------------------------------------

def finished(df: DataFrame, col: str = "status") -> DataFrame:
    """Keep finished matches (both providers' words)."""
    return df.filter(F.col(col).isin(*FINISHED))


def tag(detail: DataFrame, parent: DataFrame, fonte: str, key: str = "partida_id",
        sides: bool = False) -> DataFrame:
    """Attach season / round (and, with ``sides``, the club name of the
    ``lado`` label) from the parent match rows, plus the source label.  The
    parent is one row per match, so the join never fans out."""
    cols = [key, "temporada", "rodada"] + (["mandante", "visitante"] if sides else [])
    p = parent.select(*cols)
    out = detail.join(p, key, "left")
    if sides:
        out = (out.withColumn("clube", F.when(F.col("lado") == "mandante", F.col("mandante"))
                              .otherwise(F.col("visitante"))).drop("mandante", "visitante"))
    return out.withColumn("fonte", F.lit(fonte))
