"""Embedding near-duplicates (operator 6): an exact metric range join.

Vectors are scaled to length one, where cosine >= c is Euclidean distance <= r
= sqrt(2 - 2c).  Pivots (a bounded sample) partition the vectors: each belongs
to the cell of its nearest pivot.  By the triangle inequality a vector can be
within r of a point of another cell only if it lies within r of the plane
between the two pivots, i.e. if (d_other^2 - d_own^2) / (2 d_pivots) <= r; it is
replicated to exactly those cells.  So a cell holds everything that its own
vectors can be linked with, and cells join independently.

Identical vectors are one row with a weight from the first aggregation on.  A
crowded cell is cut into blocks, and each pair of blocks is a group of its own,
so no task holds more than two blocks.  A group returns counts per own vector
and a spanning forest of its links, never its pairs.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing and form components of their own; vectors of
different length never link; repeated ids are rows of their own with the same
component; a null id gets links but names no component unless it is alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varzea.llm.common import staged
from varzea.llm.components import components, spanning

COSINE = 0.95
#: Pivots, at most; about one for CELL distinct vectors.  Where vectors are spread in many dimensions most cells
#: take replicas of most vectors, so cells are as large as a block: fewer replicas for the same comparisons.
MAX_PIVOTS = 512
CELL = 4096
#: Numbers in a block of vectors (32 MB); two blocks are compared at once.
BLOCK_VALUES = 1 << 22
BLOCK = 4096
#: Vectors multiplied with a block at once, and numbers held to decide candidates.
STRIP = 256
VALUES_AT_ONCE = 1 << 21
#: Distances within this of the bound are decided by the cosine itself.
EDGE = 1e-9


@F.pandas_udf(T.BinaryType())
def packed(vectors: pd.Series) -> pd.Series:
    """The components as the bytes of 64-bit floats, which tasks read without
    boxing; scaled by a power of two so that the largest lies between 1/2 and 1
    (exact, and squares neither vanish nor overflow)."""
    return pd.Series([np.ldexp(v, -np.frexp(np.abs(v).max())[1]).tobytes() for v in (np.asarray(x, np.float64) for x in vectors)])


def matrix(vectors: pd.Series, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), np.float64).reshape(-1, dim)


def unit(v: np.ndarray) -> np.ndarray:
    return v / np.sqrt((v * v).sum(1))[:, None]


def _assign(pivots: dict[int, np.ndarray], radius: float):
    """(dim, cell, home) of every vector: its own cell and those that it is replicated to."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gaps = {d: np.sqrt(np.maximum(0, 2 - 2 * p @ p.T)) for d, p in pivots.items()}
        for batch in batches:
            for dim, rows in batch.groupby("dim"):
                p = pivots.get(int(dim))
                if p is None:
                    yield rows.assign(cell=0, home=True)[["node", "dim", "cell", "home"]]
                    continue
                square = 2 - 2 * unit(matrix(rows["vector"], int(dim))) @ p.T
                own = square.argmin(1)
                ahead = square - square[np.arange(len(own)), own][:, None]
                near = ahead <= 2 * radius * gaps[int(dim)][own] + EDGE
                near[np.arange(len(own)), own] = True
                at, cell = np.nonzero(near)
                yield pd.DataFrame({"node": rows["node"].to_numpy()[at], "dim": int(dim), "cell": cell,
                                    "home": cell == own[at]})
    return run


JOINED = "node long, links long, a long, b long"


def linked_pairs(x: np.ndarray, y: np.ndarray, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) with cosine(x[i], y[j]) >= ``cosine``, a bounded number at
    a time.  Single-precision products, less than their rounding bound below
    the threshold, name the candidates; double precision decides each."""
    dim = x.shape[1]
    nx, ny = np.sqrt((x * x).sum(1)), np.sqrt((y * y).sum(1))
    single_x, single_y = (x / nx[:, None]).astype(np.float32), (y / ny[:, None]).astype(np.float32).T
    low = np.float32(cosine - (dim + 8) * 2.0 ** -22)
    piece = max(1, VALUES_AT_ONCE // dim)
    for at in range(0, len(x), STRIP):
        first, second = np.nonzero(single_x[at:at + STRIP] @ single_y >= low)
        first += at
        for k in range(0, len(first), piece):
            i, j = first[k:k + piece], second[k:k + piece]
            similar = np.einsum("ij,ij->i", x[i], y[j]) / (nx[i] * ny[j])
            linked = similar >= cosine
            for n in np.flatnonzero(np.abs(similar - cosine) < EDGE):
                linked[n] = float(np.dot(x[i[n]], y[j[n]])) / (nx[i[n]] * ny[j[n]]) >= cosine
            yield i[linked], j[linked]


def _join_blocks(cosine: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        left, right = rows[rows["side"] == 0], rows[rows["side"] == 1]
        if not len(left) or not len(right):
            return pd.DataFrame(columns=["node", "links", "a", "b"])
        dim = int(rows["dim"].iloc[0])
        a, b = left["node"].to_numpy(), right["node"].to_numpy()
        weight = right["weight"].to_numpy()
        count, ties = np.zeros(len(a), np.int64), []
        for i, j in linked_pairs(matrix(left["vector"], dim), matrix(right["vector"], dim), cosine):
            other = a[i] != b[j]
            i, j = i[other], j[other]
            np.add.at(count, i, weight[j])
            once = a[i] < b[j]  # the other direction is met where b is at home
            ties = spanning(ties + list(zip(a[i[once]].tolist(), b[j[once]].tolist())))
        return pd.concat([
            pd.DataFrame({"node": a, "links": count}),
            pd.DataFrame(ties, columns=["a", "b"]),
        ]).astype({"node": "Int64", "links": "Int64", "a": "Int64", "b": "Int64"})
    return run


def linked_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors``."""
    spark = vectors.sparkSession
    wide = F.transform("embedding", lambda x: x.cast("double"))
    sound = (F.coalesce(F.size("embedding") > 0, F.lit(False))
             & F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
             & F.exists(wide, lambda x: x != 0))
    rows = staged(vectors.select("vec_id", F.when(F.coalesce(sound, F.lit(False)), wide).alias("embedding"))
                  .withColumn("row", F.monotonically_increasing_id()), "vectors")
    distinct = staged(rows.filter("embedding IS NOT NULL").groupBy("embedding")
                      .agg(F.min("row").alias("node"), F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("weight"))
                      .withColumn("dim", F.size("embedding"))
                      .withColumn("vector", packed.asNondeterministic()("embedding")), "distinct-vectors")
    n = distinct.count()
    chosen = (distinct.orderBy(F.xxhash64("embedding"), "node").limit(max(1, min(MAX_PIVOTS, n // CELL)))
              .select("dim", "vector").collect())  # MAX_PIVOTS vectors at most
    pivots = {d: unit(np.array([np.frombuffer(r["vector"]) for r in chosen if r["dim"] == d])) for d in {r["dim"] for r in chosen}}
    radius = float(np.sqrt(2 - 2 * cosine))
    cells = staged(distinct.select("node", "dim", "vector")
                   .mapInPandas(_assign(pivots, radius), "node long, dim int, cell int, home boolean"), "cells")
    block_rows = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(F.lit(BLOCK_VALUES) / F.col("dim"))))
    sizes = cells.groupBy("dim", "cell").agg(
        F.ceil(F.sum(F.col("home").cast("int")) / block_rows).alias("n_left"),
        F.ceil(F.count(F.lit(1)) / block_rows).alias("n_right"))
    block = cells.join(sizes, ["dim", "cell"])
    spread = F.pmod(F.xxhash64("node"), F.lit(1 << 30))
    left = block.filter("home").select(
        "node", "dim", "cell", F.lit(0).alias("side"), (spread % F.col("n_left")).alias("l"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_right") - 1)).alias("r"))
    right = block.filter("n_left > 0").select(
        "node", "dim", "cell", F.lit(1).alias("side"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_left") - 1)).alias("l"),
        (spread % F.col("n_right")).alias("r"))
    joined = staged(left.unionByName(right).join(distinct.select("node", "vector", "weight"), "node")
                    .groupBy("dim", "cell", "l", "r").applyInPandas(_join_blocks(cosine), JOINED), "vector-links")
    counts = joined.filter("node IS NOT NULL").groupBy("node").agg(F.sum("links").alias("links"))
    member = components(joined.filter("a IS NOT NULL").select("a", "b"))
    named = (distinct.select("node", "least", "weight", "embedding").join(counts, "node", "left")
             .join(member.withColumnRenamed("node", "m"), F.col("node") == F.col("m"), "left")
             .select("embedding", "least", F.coalesce("component", "node").alias("root"),
                     (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")))
    named = staged(named, "named-vectors")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    final = named.join(least, "root").select("embedding", "n_links", "component_id")
    out = (rows.filter("embedding IS NOT NULL").join(final, "embedding").select("vec_id", "n_links", "component_id")
           .unionByName(rows.filter("embedding IS NULL").select(
               "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))))
    return out.select("vec_id", "n_links", F.coalesce("component_id", "vec_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
