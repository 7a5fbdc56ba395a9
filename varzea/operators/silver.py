"""Raw landing rows (all STRING) -> typed silver tables.

Column names are assigned by position, as the source does: the raw CSV
headers vary between files, the column order does not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varzea.functions.columns import clean_str, minute_of, parse_date, safe_float, safe_int, season_of

# Positional column names of the raw CSV files.
MATCH_COLUMNS = ["partida_id", "rodada", "data", "hora", "mandante", "visitante", "formacao_mandante",
                 "formacao_visitante", "tecnico_mandante", "tecnico_visitante", "vencedor", "arena",
                 "gols_mandante", "gols_visitante", "estado_mandante", "estado_visitante"]
STATS_COLUMNS = ["partida_id", "rodada", "clube", "chutes", "chutes_no_alvo", "posse_de_bola", "passes",
                 "precisao_passes", "faltas", "cartao_amarelo", "cartao_vermelho", "impedimentos", "escanteios"]
GOALS_COLUMNS = ["partida_id", "rodada", "clube", "atleta", "minuto", "tipo_de_gol"]
CARDS_COLUMNS = ["partida_id", "rodada", "clube", "cartao", "atleta", "num_camisa", "posicao", "minuto"]
FONTE_CSV = "historico_csv"

# Provider club names -> the names used by the historical CSV.
CLUB_ALIASES = {
    "Athletico": "Athletico-PR",
    "Atlético Paranaense": "Athletico-PR",
    "Atlético Goianiense": "Atletico-GO",
    "Atlético Mineiro": "Atletico-MG",
    "Botafogo": "Botafogo-RJ",
    "Ceará": "Ceara",
    "Criciúma": "Criciuma",
    "Cuiabá": "Cuiaba",
    "Grêmio": "Gremio",
    "Goiás": "Goias",
    "Red Bull Bragantino": "Bragantino",
    "São Paulo": "Sao Paulo",
    "Sport Recife": "Sport",
    "Vasco da Gama": "Vasco",
    "Vitória": "Vitoria",
    "América Mineiro": "America-MG",
    "América-MG": "America-MG",
    "Avaí": "Avai",
    "Náutico": "Nautico",
    "Paraná": "Parana",
    "Ponte Preta": "Ponte Preta",
}


def by_position(raw: DataFrame, names: list[str], keep: tuple[str, ...] = ("_source_file",),
                optional: int = 0) -> DataFrame:
    """Rename the data columns by position (extra trailing context columns
    such as ``_source_file`` keep their names).  Missing trailing columns
    become null strings (a 5-column goals file gets ``tipo_de_gol`` null) if
    there are at most ``optional`` of them; any other width is an error, as
    names would land on the wrong columns."""
    data = [c for c in raw.columns if c not in keep]
    if not len(names) - optional <= len(data) <= len(names):
        raise ValueError(f"{len(data)} columns, expected {len(names)} ({names[0]} ... {names[-1]})")
    ctx = [c for c in raw.columns if c in keep]
    cols = [F.col(f"`{c}`").alias(n) for c, n in zip(data, names)]
    cols += [F.lit(None).cast("string").alias(n) for n in names[len(data):]]
    return raw.select(*cols, *ctx)


def silver_partidas(raw: DataFrame, season_overrides=None) -> DataFrame:
    """Matches CSV rows -> typed matches."""
    r = by_position(raw, MATCH_COLUMNS)
    data = parse_date(F.col("data"))
    return r.select(
        safe_int("partida_id").alias("partida_id"),
        season_of(data, season_overrides).alias("temporada"),
        safe_int("rodada").cast("int").alias("rodada"),
        data.alias("data"),
        F.col("hora"),
        *[clean_str(c).alias(c) for c in ["mandante", "visitante", "formacao_mandante", "formacao_visitante",
                                          "tecnico_mandante", "tecnico_visitante", "vencedor", "arena"]],
        safe_int("gols_mandante").alias("gols_mandante"),
        safe_int("gols_visitante").alias("gols_visitante"),
        clean_str("estado_mandante").alias("estado_mandante"),
        clean_str("estado_visitante").alias("estado_visitante"),
        F.lit(FONTE_CSV).alias("fonte"))


def with_season(child: DataFrame, partidas: DataFrame) -> DataFrame:
    """Season of each child row by a left join to the matches on id.
    ``partidas`` must be one row per id (see ``assert_unique``), so the join
    cannot fan out.  The physical join is the planner's choice (both sides
    grow with the data).  Id 0 stands for an unreadable one: it names no
    match, and rows that have it keep a null season."""
    known = partidas.filter(F.col("partida_id") != 0).select(F.col("partida_id").alias("_id"), "temporada")
    return child.join(known, F.nullif("partida_id", F.lit(0)) == F.col("_id"), "left").drop("_id")


def assert_unique(df: DataFrame, keys: list[str]) -> None:
    """Fail if ``keys`` repeat (one distributed aggregate; only a boolean
    reaches the driver)."""
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).count()
    if dup:
        raise ValueError(f"keys {keys} are not unique")


def silver_estatisticas(raw: DataFrame, partidas: DataFrame) -> DataFrame:
    """Team statistics CSV rows -> typed rows with the season."""
    r = by_position(raw, STATS_COLUMNS)
    ints = ["partida_id", "rodada", "chutes", "chutes_no_alvo", "passes", "faltas", "cartao_amarelo",
            "cartao_vermelho", "impedimentos", "escanteios"]
    typed = r.select(*[safe_int(c).alias(c) if c in ints else
                       (safe_float(c).alias(c) if c in ("posse_de_bola", "precisao_passes") else clean_str(c).alias(c))
                       for c in STATS_COLUMNS])
    typed = typed.withColumn("rodada", F.col("rodada").cast("int"))
    return with_season(typed, partidas).withColumn("fonte", F.lit(FONTE_CSV))


def silver_gols(raw: DataFrame, partidas: DataFrame) -> DataFrame:
    """Goals CSV with 5 or 6 columns -> typed goals with the season."""
    r = by_position(raw, GOALS_COLUMNS, optional=1)
    typed = r.select(safe_int("partida_id").alias("partida_id"), safe_int("rodada").cast("int").alias("rodada"),
                     clean_str("clube").alias("clube"), clean_str("atleta").alias("atleta"),
                     minute_of("minuto").alias("minuto"), clean_str("tipo_de_gol").alias("tipo_de_gol"))
    return with_season(typed, partidas).withColumn("fonte", F.lit(FONTE_CSV))


def silver_cartoes(raw: DataFrame, partidas: DataFrame) -> DataFrame:
    """Cards CSV -> typed cards with the season."""
    r = by_position(raw, CARDS_COLUMNS)
    typed = r.select(safe_int("partida_id").alias("partida_id"), safe_int("rodada").cast("int").alias("rodada"),
                     *[clean_str(c).alias(c) for c in ["clube", "cartao", "atleta", "num_camisa", "posicao"]],
                     minute_of("minuto").alias("minuto"))
    return with_season(typed, partidas).withColumn("fonte", F.lit(FONTE_CSV))


def canonical_club(name: Column, aliases: dict[str, str] | None = None) -> Column:
    """Canonical club name from the fixed alias dictionary, as an
    in-expression map lookup (no join)."""
    a = CLUB_ALIASES if aliases is None else aliases
    m = F.create_map(*[F.lit(x) for kv in a.items() for x in kv])
    return F.coalesce(m[name], name)


def canonical_clubs(df: DataFrame, cols: list[str], alias_dim: DataFrame) -> DataFrame:
    """T12 with a user alias table ``(alias, canonical)``: left join per
    column + coalesce.  The table's size is the caller's, so the join
    strategy is left to the planner's size check (AQE broadcasts it when its
    measured size is small)."""
    dim = alias_dim.select(F.col("alias").alias("_alias"), F.col("canonical").alias("_canon"))
    for c in cols:
        df = (df.join(dim, F.col(c) == F.col("_alias"), "left")
              .withColumn(c, F.coalesce(F.col("_canon"), F.col(c))).drop("_alias", "_canon"))
    return df


#: Copies of each dictionary entry in ``unify_spelling``: a club's rows are dealt over as many tasks.
SPELLING_SALTS = 32


def unify_spelling(df: DataFrame, cols: list[str], collation: str = "UNICODE_CI_AI") -> DataFrame:
    """One spelling per club name under a collation (the MySQL
    ``*_unicode_ci`` meaning: case and accents ignored).  The spelling kept
    is the smallest one in binary order, so the result repeats.  The name
    dictionary is one aggregate over the distinct names (bounded by the
    clubs); the join back is the planner's choice, with the rows of a club
    salted by the row's hash so that no club is one task's work."""
    names = df.select(F.explode(F.array(*cols)).alias("_name"))
    dim = (names.filter(F.col("_name").isNotNull()).distinct()
           .groupBy(F.collate("_name", collation).alias("_key"))
           .agg(F.min(F.col("_name").cast("string")).alias("_canon"))
           .withColumn("_of", F.explode(F.sequence(F.lit(0), F.lit(SPELLING_SALTS - 1)))))
    hashed = [F.col(f"`{c}`") for c, t in df.dtypes if not t.startswith(("map", "variant"))]
    out = df.withColumn("_salt", F.pmod(F.xxhash64(*hashed), F.lit(SPELLING_SALTS)).cast("int"))
    for c in cols:
        out = (out.join(dim, (F.collate(F.col(c), collation) == F.col("_key")) & (F.col("_salt") == F.col("_of")), "left")
               .withColumn(c, F.coalesce(F.col("_canon"), F.col(c))).drop("_key", "_canon", "_of"))
    return out.drop("_salt")
