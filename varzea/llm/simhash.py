"""SimHash near-duplicates by meet-in-the-middle ball hashing (operator 3).

Every text gets a 64-bit fingerprint of its 3-word shingles; fingerprints that
differ in at most ``RADIUS`` = 3 bits are linked, and linked documents form
components.

Two fingerprints at distance 3 meet when each emits all variants within half
the distance.  Half of 3 is not whole, so the 64 bits are cut into three
blocks: of 3 differing bits at most 2 fall into some two of the three blocks.
For each pair of blocks (42 or 43 bits) every distinct fingerprint emits its
projection and all variants with one bit flipped, 131 in all; two fingerprints
within 3 bits meet in at least one variant.  A shuffle on the variants brings
them together, and colliding pairs are verified on all 64 bits.

A variant that more than ``BUCKET`` fingerprints share is not compared pair by
pair.  Its fingerprints emit full-width variants instead: those within one bit
and those within two.  Both of a variant's fingerprints, one within one bit and
the other within two, are within three bits of each other, so every such
meeting is a link already and a star per variant replaces its pairs: the work
grows with the number of fingerprints, not with its square.

Exact copies share a fingerprint, so groups of copies are one row from the
first aggregation on.  Components come from ``components``; nothing is
collected.

Defined results: null, empty and blank texts have fingerprint zero and are
linked like any other; one row per row of the input (repeated ids included);
rows without an id get a fingerprint, belong to their fingerprint's component
and never name one unless no member has an id (component null).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from varzea.llm.common import fresh, partitions, staged, text_bytes
from varzea.llm.components import components, spanning

SHINGLE = 3
RADIUS = 3
SEED = 42
BLOCKS = [(0, 21), (21, 42), (42, 64)]
#: Fingerprints of one variant that are compared pair by pair; larger groups meet by full-width variants.
BUCKET = 64


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of the lower-cased (A-Z) text."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest = xxhash.xxh64_intdigest
    shingles = map(b" ".join, zip(*(words[k:] for k in range(width))))
    n = len(words) - width + 1
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.dtype("<u8"), n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):  # bounded memory for very long texts
        part = hashes[at:at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


@F.pandas_udf(T.LongType())
def fingerprint_column(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Pandas UDF: UTF-8 bytes -> fingerprint as a signed 64-bit integer."""
    for texts in batches:
        yield pd.Series(np.fromiter((fingerprint(t) for t in texts), np.uint64, len(texts)).view(np.int64))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def block_variants(fp: F.Column) -> F.Column:
    """Array of the 131 projected variants; the free block's low bits say which pair of blocks it is."""
    parts = []
    for number, (low, high) in enumerate(BLOCKS):
        free = ((1 << high) - 1) ^ ((1 << low) - 1)
        flips = [0] + [1 << b for b in range(64) if not low <= b < high]
        marks = F.array(*[F.lit(_signed(f | (number + 1) << low)) for f in flips])
        kept = fp.bitwiseAND(F.lit(_signed(~free & (1 << 64) - 1)))
        parts.append(F.transform(marks, kept.bitwiseXOR))
    return F.concat(*parts)


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.view(np.uint64))


def _meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Verified pairs of one shuffle partition, thinned to a spanning forest;
    ``b`` is null for a fingerprint of an over-full variant.  Holds the
    partition's (key, fp)."""
    got = [(b["key"].to_numpy(), b["fp"].to_numpy()) for b in batches]
    if not got:
        return
    key, fp = (np.concatenate([g[k] for g in got]) for k in (0, 1))
    order = np.argsort(key, kind="stable")
    key, fp = key[order], fp[order]
    cut = np.flatnonzero(np.diff(key)) + 1
    start = np.concatenate([[0], cut])
    size = np.diff(np.concatenate([start, [len(key)]]))
    run = np.repeat(size, size)
    hot = np.unique(fp[run > BUCKET])
    some = (run > 1) & (run <= BUCKET)
    key, fp = key[some], fp[some]
    a, b = [], []
    for k in range(1, int(size[size <= BUCKET].max(initial=1))):
        same = key[:-k] == key[k:]
        x, y = fp[:-k][same], fp[k:][same]
        near = (_popcount(x ^ y) <= RADIUS) & (x != y)
        a.append(np.minimum(x[near], y[near]))
        b.append(np.maximum(x[near], y[near]))
    if a:
        pairs = pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)}).drop_duplicates()
        tree = spanning(list(zip(pairs["a"].tolist(), pairs["b"].tolist())))
        if tree:
            yield pd.DataFrame(tree, columns=["a", "b"]).astype({"a": "int64", "b": "Int64"})
    if len(hot):
        yield pd.DataFrame({"a": hot, "b": pd.array([None] * len(hot), "Int64")})


def _ball(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    one = np.array([0] + [1 << b for b in range(64)], np.uint64).view(np.int64)
    two = np.array([1 << a | 1 << b for a in range(64) for b in range(a)], np.uint64).view(np.int64)
    flips = np.concatenate([one, two])
    far = np.arange(len(flips)) >= len(one)
    for batch in batches:
        fps = batch["fp"].to_numpy()
        for at in range(0, len(fps), 256):
            part = fps[at:at + 256]
            yield pd.DataFrame({"key": (part[:, None] ^ flips).ravel(), "fp": np.repeat(part, len(flips)),
                                "far": np.tile(far, len(part))})


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """Links (a, b) between the distinct fingerprints of ``fps`` (column fp)
    that join the same fingerprints as all pairs within RADIUS bits do."""
    spark = fps.sparkSession
    spread = fps.select("fp").repartition(4 * partitions(spark), "fp")  # a few small files else make a few large tasks
    variants = spread.select(F.explode(block_variants(F.col("fp"))).alias("key"), "fp")
    met = staged(variants.repartition(4 * partitions(spark), "key").mapInPandas(_meet, "a long, b long"), "simhash-met")
    pairs = met.filter("b IS NOT NULL")
    hot = met.filter("b IS NULL").select(F.col("a").alias("fp")).distinct()
    balls = hot.repartition(4 * partitions(spark), "fp").mapInPandas(_ball, "key long, fp long, far boolean")
    stars = (balls.repartition(4 * partitions(spark), "key").mapInPandas(_stars, "a long, b long"))
    return pairs.unionByName(stars).distinct()


def _stars(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each variant's fingerprints tied to its least fingerprint within one bit, if it has one."""
    got = list(batches)
    if not got:
        return
    rows = pd.concat(got, ignore_index=True).sort_values(["key", "far", "fp"], kind="stable")
    key, fp, far = (rows[c].to_numpy() for c in ("key", "fp", "far"))
    first = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1])
    size = np.diff(np.concatenate([first, [len(key)]]))
    centre, usable = np.repeat(fp[first], size), np.repeat(~far[first], size)
    tie = usable & (centre != fp)
    out = pd.DataFrame({"a": centre[tie], "b": fp[tie]}).drop_duplicates()
    if len(out):
        yield out


def with_fingerprint(docs: DataFrame, name: str) -> DataFrame:
    return docs.withColumn(name, fingerprint_column.asNondeterministic()(text_bytes(docs)))


def groups(fps: DataFrame) -> DataFrame:
    """Each distinct fingerprint of ``fps`` (doc_id, fp): its component's
    ``root`` (a fingerprint) and ``least``, the smallest id that has it."""
    nodes = staged(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    member = components(fingerprint_links(nodes.select("fp")))
    return (nodes.join(member, nodes.fp == member.node, "left")
            .select("fp", F.coalesce("component", "fp").alias("root"), "least"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fp (signed) and component_id of every row of ``docs``."""
    f = fresh(docs, "fp")
    rows = staged(with_fingerprint(docs, f).select("doc_id", F.col(f).alias("fp")), "simhash-fp")
    group = staged(groups(rows), "simhash-groups")
    least = group.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(group.join(least, "root").select("fp", "component_id"), "fp").select(
        "doc_id", "fp", "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per component, columns unchanged: a row of its
    smallest doc_id, or of a null id where it has no other.  Of several rows of
    that id the one with the least fingerprint stays, then that with the least
    hash of its text, then the least text and the least other columns (in their
    order; columns that have no order are not asked)."""
    f, h = fresh(docs, "fp"), fresh(docs, "text_hash")
    marked = staged(with_fingerprint(docs, f).withColumn(h, F.xxhash64("text")), "simhash-rows")
    first = (groups(marked.select("doc_id", F.col(f).alias("fp"))).groupBy("root")
             .agg(F.min(F.struct(F.col("least").isNull().alias("none"), "least", "fp")).alias("first"))
             .select(F.col("first.least").alias("keep_id"), F.col("first.fp").alias("keep_fp")))
    kept = marked.join(first, marked["doc_id"].eqNullSafe(F.col("keep_id")) & (marked[f] == F.col("keep_fp")), "left_semi")
    others = [c for c in docs.columns if c not in ("doc_id", "text") and orderable(docs.schema[c].dataType)]
    n = fresh(docs, "place")
    best = Window.partitionBy("doc_id", f).orderBy(h, "text", *(F.col(f"`{c}`") for c in others))
    return kept.withColumn(n, F.row_number().over(best)).filter(F.col(n) == 1).drop(f, h, n)


def orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(orderable(x.dataType) for x in kind)
    return orderable(kind.elementType) if isinstance(kind, T.ArrayType) else not isinstance(kind, (T.MapType, T.VariantType))
