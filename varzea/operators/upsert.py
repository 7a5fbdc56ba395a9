"""Key-based merge with last-write-wins, and the incremental helpers.

A DataFrame has no row order, so every row that takes part in a merge
carries an explicit sequence (batch id, then position in the batch).  The
winner per key is chosen with an *aggregate* (``max`` over a struct whose
first fields are the sequence), not with a ``row_number`` window: the
aggregate is combined map-side before the shuffle, so a key holding a third
of all rows still sends one row per map task, never the whole group to one
task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Merge keys per silver table.
TABLE_KEYS = {
    "partidas": ["partida_id"],
    "classificacao": ["temporada", "clube"],
    "estatisticas": ["partida_id", "clube"],
    "gols": ["partida_id", "atleta", "minuto"],
    "cartoes": ["partida_id", "atleta", "minuto"],
    "escalacoes": ["partida_id", "clube", "atleta"],
}

SEQ = "_seq"
DOC = "_doc"


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType):
        return False
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    return True


def last_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep one row per ``keys``: the one with the greatest ``order`` tuple.

    Remaining ties are broken by the row's own values (greatest wins) so the
    result is deterministic.  Null keys are grouped together (pandas
    ``drop_duplicates`` semantics).
    """
    keys = list(keys)
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    others = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(f"`{c}`") for c in others])
    ordering = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order_cols)])
    payload_types = [df.schema[c].dataType for c in others]
    if all(_orderable(t) for t in payload_types):
        # a column that orders the rows is carried once: among rows equal in it, it decides nothing
        if order and _plain(order, others):
            first = list(dict.fromkeys(order))
            ranked = first + [c for c in others if c not in first]
            best = F.max(F.struct(*[F.col(f"`{c}`") for c in ranked]))
        else:
            best = F.max(F.struct(ordering.alias("_o"), row.alias("_r"))).getField("_r")
    else:
        best = F.max_by(row, ordering)
    return df.groupBy(*keys).agg(best.alias("_best")).select(*keys, "_best.*").select(*df.columns)


def _plain(order: Sequence[str | Column], others: Sequence[str]) -> bool:
    """The order is made of columns of the row, by name."""
    return all(isinstance(o, str) and o in others for o in order)


def with_seq(df: DataFrame, batch: int, position: Column | None = None) -> DataFrame:
    """Tag a batch with ``_seq = (batch, position)``; later batches win.
    ``position`` orders rows inside a batch (e.g. the element index from
    ``posexplode`` of a document).  It defaults to 0: duplicates inside one
    batch are then resolved by the rows' own values, which stays the same
    when a lost task is recomputed (a generated row id would not)."""
    pos = position if position is not None else F.lit(0)
    return df.withColumn(SEQ, F.struct(F.lit(batch).cast("long").alias("batch"), pos.cast("long").alias("pos")))


def upsert(existing: DataFrame | None, new: DataFrame, keys: Sequence[str],
           seq: str = SEQ) -> DataFrame:
    """Append ``new`` to ``existing`` and keep the last row per key.

    Both inputs must carry ``seq``; rows of ``new`` must have larger values.
    Duplicates inside either side are resolved the same way.  Columns are
    unioned by name; a column missing on one side is null there.
    """
    both = new if existing is None else existing.unionByName(new, allowMissingColumns=True)
    return last_wins(both, keys, [seq]).drop(seq)


def merge_documents(existing: DataFrame | None, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """U1 for rows that come from documents: ``new`` wins over ``existing``;
    inside ``new`` the last document wins, then the last place in it (the
    ``_doc`` column that the flatteners carry: file time, file name, place).
    The order comes from the files alone, so a retry or another split of the
    files into batches gives the same rows."""
    ordered = DOC in new.columns
    kind = new.schema[DOC].dataType if ordered else T.LongType()

    def seq(batch: int, place: Column) -> Column:
        return F.struct(F.lit(batch).cast("long").alias("batch"), place.cast(kind).alias("place"))

    rows = new.withColumn(SEQ, seq(1, F.col(DOC) if ordered else F.lit(None)))
    stored = None if existing is None else existing.withColumn(SEQ, seq(0, F.lit(None)))
    return upsert(stored, rows.drop(DOC), keys)


def last_synced_round(partidas: DataFrame, season: int,
                      finished=("FT", "finished")) -> DataFrame:
    """Highest round of ``season`` whose matches are finished (0 if none).
    Accepts both providers' words for a finished match; rows without a status
    (historical CSV) never count as synced."""
    if "status" not in partidas.columns:
        partidas = partidas.withColumn("status", F.lit(None).cast("string"))
    return (partidas.filter((F.col("temporada") == season) & F.col("status").isin(*finished))
            .agg(F.coalesce(F.max("rodada"), F.lit(0)).cast("int").alias("ultima_rodada")))


def changed_fixtures(new: DataFrame, last_round: Column | int,
                     finished=("FT", "finished")) -> DataFrame:
    """U4: fixtures worth re-loading — round unknown, after the last synced
    round, or not finished yet."""
    lr = last_round if isinstance(last_round, Column) else F.lit(last_round)
    return new.filter(F.col("rodada").isNull() | (F.col("rodada") > lr)
                      | ~F.coalesce(F.col("status").isin(*finished), F.lit(False)))


def last_synced_rounds(partidas: DataFrame, finished=("FT", "finished")) -> DataFrame:
    """U3 for every season at once: (temporada, ultima_rodada) of the seasons with a finished match."""
    if "status" not in partidas.columns:
        return partidas.limit(0).select("temporada", F.lit(0).alias("ultima_rodada"))
    return (partidas.filter(F.col("status").isin(*finished)).groupBy("temporada")
            .agg(F.max("rodada").cast("int").alias("ultima_rodada")))


def new_or_changed(new: DataFrame, synced: DataFrame, finished=("FT", "finished")) -> DataFrame:
    """U4 against each row's own season (``last_synced_rounds``: one row a season)."""
    rows = new.join(synced, "temporada", "left")
    return changed_fixtures(rows, F.coalesce("ultima_rodada", F.lit(0)), finished).select(*new.columns)


def update_season(existing: DataFrame, fixtures: DataFrame, season: int,
                  fonte: str = "api_football", finished=("FT", "finished"), mode: str = "differs") -> DataFrame:
    """U5 (plan): merge a provider's fixture rows (J1 output) into the stored
    matches of one season.

    ``mode="source"``: last synced round (U3) of the stored rows -> only new
    or changed fixtures (U4) -> tagged -> last-wins merge by match id (U1).
    That rule never stores a result that finishes after another match of its
    round did, so the default ``differs`` merges every fixture (one that
    equals the stored row changes nothing).  Returns the season's new rows;
    the job writes them to the season partition only.
    """
    if mode not in ("differs", "source"):
        raise ValueError(f"unknown mode {mode!r}")
    cur = existing.filter(F.col("temporada") == season)
    fx = fixtures.filter(F.col("temporada") == season) if "temporada" in fixtures.columns else fixtures
    if mode == "source":
        fx = changed_fixtures(fx, last_synced_round(existing, season, finished).scalar(), finished)
    new = fx.withColumn("temporada", F.lit(season).cast("int")).withColumn("fonte", F.lit(fonte))
    return merge_documents(cur, new, TABLE_KEYS["partidas"])


def dedup_matches(partidas: DataFrame, prefer: Sequence[str] = ("sofascore", "api_football", "historico_csv")) -> DataFrame:
    """Optional (off by default in the pipeline): one row per (season, round,
    home, away) when two sources filed the same match under different id
    spaces.  A source earlier in ``prefer`` wins, then the higher match id.
    An aggregate, so a hot key is combined map-side."""
    rank = F.lit(len(prefer))
    for i, src in reversed(list(enumerate(prefer))):
        rank = F.when(F.col("fonte") == src, F.lit(i)).otherwise(rank)
    keyed = partidas.withColumn("_pref", -rank)
    out = last_wins(keyed, ["temporada", "rodada", "mandante", "visitante"], ["_pref", "partida_id"])
    return out.drop("_pref")
