"""Substring dedup (operator 8): Rabin-Karp hashes of every window of
``WINDOW`` words, counted in Spark; repeated windows become removal intervals.

1. Each task hashes the words of a chunk of documents and rolls two
   independent polynomial hashes over them.  A window that already occurs
   earlier in the chunk is a repeat at once; only the first occurrence goes
   on, so a passage that a third of the corpus shares sends one entry per
   chunk (a map-side combine).
2. The windows are shuffled by the second hash.  A shuffle row holds a chunk's
   windows of one hash range as packed columns (first hash and position of each
   window, id and text hash of each run of windows of one row).
3. In each hash range the occurrences of a hash are counted; all but the
   earliest (by document, then position) are repeats and are shuffled to their
   rows.
4. Each row merges its repeated windows into maximal intervals of words.

A row is known by its id and a 64-bit hash of its text, so rows that share an
id (or have none) lose only what they hold themselves; rows equal in both have
the same repeats.  The id and the position alone decide which window is earlier.

The two polynomials take the two halves of a 128-bit hash of each word, so words
that agree in one half still differ in the other.  Two different windows are
taken for one only if 64 bits of one hash and the hash range of the other agree
by chance: with 2^r ranges 2^-(64+r) per pair; two texts of one id with 2^-64
per pair.

Defined results: a null or empty text has no words; fewer than ``WINDOW``
words are never removed; of windows with the same document id and the same
position (repeated rows) none comes first, so a repeated row loses no more
than its twin; null ids are one id that sorts before all others; texts are read whole, in
chunks, so that a task holds one chunk, one hash range or one range of
rows at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from varzea.llm.common import fresh, partitions, text_bytes

WINDOW = 20
#: Words that a map task hashes at once.
CHUNK_WORDS = 1_000_000
#: Hash ranges and row ranges per shuffle partition.  A hash range sends a row range one packed row at most,
#: and never more rows than it has repeats.
RANGES = 2
NULL_ID = -(1 << 63)

_B1 = np.uint64(0x9E3779B97F4A7C15)
_B2 = np.uint64(0xC2B2AE3D27D4EB4F)
_CODEC = pa.Codec("zstd", compression_level=1)


def pack_ints(a: np.ndarray) -> bytes:
    """Integers as compressed differences."""
    raw = np.diff(a.astype(np.int64), prepend=np.int64(0))
    return len(raw).to_bytes(8, "little") + _CODEC.compress(raw, asbytes=True)


def unpack_ints(b: bytes) -> np.ndarray:
    n = int.from_bytes(b[:8], "little")
    return np.cumsum(np.frombuffer(_CODEC.decompress(b[8:], decompressed_size=8 * n, asbytes=True), np.int64))


def window_hashes(words: np.ndarray, base: np.uint64, width: int) -> np.ndarray:
    """Rabin-Karp hash of every run of ``width`` word hashes, modulo 2^64.
    Runs of doubled width are joined from two halves."""
    out, out_width = None, 0
    run, span = words, 1
    power = base
    with np.errstate(over="ignore"):
        while True:
            if width & span:
                if out is None:
                    out, out_width = run, span
                else:
                    n = len(words) - out_width - span + 1
                    shift = np.uint64(pow(int(base), span, 1 << 64))
                    out = out[:n] * shift + run[out_width:out_width + n]
                    out_width += span
            if 2 * span > width:
                return out
            run = run[:-span] * power + run[span:]
            power = power * power
            span *= 2


def _emit(kind: int, part: np.ndarray, doc: np.ndarray, key: np.ndarray, at: np.ndarray,
          h: np.ndarray | None) -> pd.DataFrame:
    """Packed rows, one per range; windows of one row that follow each other share an entry of doc, key and ends."""
    order = np.argsort(part, kind="stable")
    part, doc, key, at = part[order], doc[order], key[order], at[order]
    h = None if h is None else h[order]
    cut = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]])
    rows = []
    for a, b in zip(cut[:-1], cut[1:]):
        if b > a:
            ends = np.append(np.flatnonzero((np.diff(doc[a:b]) != 0) | (np.diff(key[a:b]) != 0)) + 1, b - a)
            rows.append((kind, int(part[a]), pack_ints(doc[a:b][ends - 1]), key[a:b][ends - 1].tobytes(), pack_ints(ends),
                         pack_ints(at[a:b]), b"" if h is None else h[a:b].tobytes()))
    return pd.DataFrame(rows, columns=["kind", "part", "doc", "key", "ends", "at", "hash"])


def _unpack(rows: Iterable[tuple[bytes, bytes, bytes, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc, key and at of every window of packed (doc, key, ends, at)."""
    docs, keys, ats = [], [], []
    for doc, key, ends, at in rows:
        sizes = np.diff(unpack_ints(ends), prepend=0)
        docs.append(np.repeat(unpack_ints(doc), sizes))
        keys.append(np.repeat(np.frombuffer(key, np.int64), sizes))
        ats.append(unpack_ints(at))
    return np.concatenate(docs), np.concatenate(keys), np.concatenate(ats)


PACKED = "kind int, part int, doc binary, key binary, ends binary, at binary, hash binary"
WINDOWS, REPEATS = 0, 1


def _row_range(doc: np.ndarray, key: np.ndarray, ranges: int) -> np.ndarray:
    """As ``pmod(xxhash64(id ^ key), ranges)`` in Spark."""
    ids, inverse = np.unique(doc ^ key, return_inverse=True)
    packed = ids.astype("<i8").tobytes()
    signed = np.array([xxhash.xxh64_intdigest(packed[k:k + 8], 42) for k in range(0, len(packed), 8)], np.uint64)
    return (signed.view(np.int64) % ranges)[inverse]


def _hash_chunk(rows: dict[tuple[int, int], np.ndarray], width: int, ranges: int) -> Iterator[pd.DataFrame]:
    """``rows``: both hashes of the words of each id and text hash."""
    order = sorted(rows)
    sizes = np.array([len(rows[k]) for k in order])
    total = int(sizes.sum())
    word = np.concatenate([rows[k] for k in order])
    begin = np.cumsum(sizes) - sizes
    ids = np.array([i for i, _ in order], np.int64)
    doc, key = np.repeat(ids, sizes), np.repeat(np.array([k for _, k in order], np.int64), sizes)
    at = np.arange(total) - np.repeat(begin, sizes)
    whole = (at + width <= np.repeat(sizes, sizes))[:total - width + 1]
    h = window_hashes(word[:, 0], _B1, width)[whole]
    part = (window_hashes(word[:, 1], _B2, width)[whole] >> np.uint64(20)) % np.uint64(ranges)
    doc, key, at = (x[:len(whole)][whole] for x in (doc, key, at))
    part = part.astype(np.int64)
    by = np.arange(len(h))
    if (np.diff(ids) == 0).any():  # rows of one id: the earlier place first, whatever the row
        by = np.lexsort((at, doc))
    by = by[np.lexsort((h[by], part[by]))]
    new = np.ones(len(by), bool)
    new[1:] = (h[by][1:] != h[by][:-1]) | (part[by][1:] != part[by][:-1])
    lead = by[np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))]
    later = np.zeros(len(by), bool)
    later[by] = (doc[by] != doc[lead]) | (at[by] != at[lead])  # same id and place as the earliest: not later than it
    if later.any():
        yield _emit(REPEATS, _row_range(doc[later], key[later], ranges), doc[later], key[later], at[later], None)
    yield _emit(WINDOWS, part[~later], doc[~later], key[~later], at[~later], h[~later])


def _hash_windows(width: int, ranges: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashed: dict[tuple[int, int], np.ndarray] = {}
        held = 0
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for i, k, t in zip(batch["id"].tolist(), batch["key"].tolist(), batch["text"]):
                words = t.split()  # on space, tab, \n, \v, \f, \r
                if len(words) < width or (i, k) in hashed:
                    continue
                hashed[i, k] = np.frombuffer(b"".join(map(digest, words)), np.uint64).reshape(-1, 2)
                held += len(words)
                if held >= CHUNK_WORDS:
                    yield from _hash_chunk(hashed, width, ranges)
                    hashed, held = {}, 0
        if hashed:
            yield from _hash_chunk(hashed, width, ranges)
    return run


def _later_ones(ranges: int):
    """The repeats of one hash range: every occurrence of a hash after its
    earliest.  Repeats that the chunks have found already pass through."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        known, rows = rows[rows["kind"] == REPEATS], rows[rows["kind"] == WINDOWS]
        if not len(rows):
            return known
        doc, key, at = _unpack(zip(rows["doc"], rows["key"], rows["ends"], rows["at"]))
        h = np.frombuffer(b"".join(rows["hash"]), np.uint64)
        order = np.argsort(h, kind="stable")
        same = np.zeros(len(h), bool)
        equal = h[order][1:] == h[order][:-1]
        same[1:] |= equal
        same[:-1] |= equal
        some = order[same]  # occurrences of hashes that more than one chunk has
        h, doc, key, at = h[some], doc[some], key[some], at[some]
        order = np.lexsort((at, doc, h))
        h, doc, key, at = h[order], doc[order], key[order], at[order]
        lead = np.arange(len(h))
        lead[1:][h[1:] == h[:-1]] = 0
        lead = np.maximum.accumulate(lead)
        later = (doc != doc[lead]) | (at != at[lead])
        if not later.any():
            return known
        doc, key, at = doc[later], key[later], at[later]
        order = np.lexsort((at, key, doc))
        doc, key, at = doc[order], key[order], at[order]
        return pd.concat([known, _emit(REPEATS, _row_range(doc, key, ranges), doc, key, at, None)])
    return run


def _id(docs: DataFrame) -> Column:
    return F.coalesce(docs["doc_id"].cast("long"), F.lit(NULL_ID))


def repeated_windows(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """Packed repeats by range of rows: part, doc, key, ends, at."""
    spark = docs.sparkSession
    ranges = RANGES * partitions(spark)
    source = docs.select(_id(docs).alias("id"), F.xxhash64(text_bytes(docs)).alias("key"), text_bytes(docs).alias("text"))
    return (source.mapInPandas(_hash_windows(width, ranges), PACKED).groupBy("part")
            .applyInPandas(_later_ones(ranges), PACKED).select("part", "doc", "key", "ends", "at"))


def intervals(starts: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Maximal intervals [first, end) covered by windows at the sorted starts."""
    if not len(starts):
        return []
    gap = np.flatnonzero(np.diff(starts) > width)
    first = starts[np.concatenate([[0], gap + 1])]
    end = starts[np.concatenate([gap, [len(starts) - 1]])] + width
    return list(zip(first.tolist(), end.tolist()))


def cut_words(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``text`` without the word intervals; what is kept stays as it stands, with one blank at each cut."""
    words = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", text)]
    pieces, at = [], 0
    for first, end in spans + [(len(words), len(words))]:
        if first > at:
            pieces.append(text[words[at][0] if at else 0:words[first - 1][1] if first < len(words) else len(text)])
        at = end
    return b" ".join(pieces)


def with_removals(docs: DataFrame, digest: Callable[[bytes, list[tuple[int, int]]], dict], fields: pa.Schema,
                  width: int = WINDOW) -> DataFrame:
    """Rows of ``docs`` and, for each, the ``fields`` that ``digest`` makes of
    its text and its removal intervals (in words).  Texts meet their packed
    repeats by range of rows; texts too short for a window go to any range."""
    ranges = RANGES * partitions(docs.sparkSession)
    part, key = fresh(docs, "part"), fresh(docs, "key")
    columns = docs.columns
    text_key = F.xxhash64(text_bytes(docs))
    dealt = F.when(F.octet_length(text_bytes(docs)) < 2 * width - 1, F.spark_partition_id().cast("long")).otherwise(
        _id(docs).bitwiseXOR(text_key))
    left = docs.select("*", text_key.alias(key), F.pmod(F.xxhash64(dealt), F.lit(ranges)).cast("int").alias(part))
    right = repeated_windows(docs, width)
    names, id_at, text_at = fields.names, columns.index("doc_id"), columns.index("text")

    def run(rows: pa.Table, repeats: pa.Table) -> pa.Table:
        starts: dict[tuple[int, int], np.ndarray] = {}
        if len(repeats):
            doc, key, at = _unpack(zip(*(repeats[c].to_pylist() for c in ("doc", "key", "ends", "at"))))
            order = np.lexsort((at, key, doc))
            doc, key, at = doc[order], key[order], at[order]
            cut = np.concatenate([[0], np.flatnonzero((np.diff(doc) != 0) | (np.diff(key) != 0)) + 1])
            starts = dict(zip(zip(doc[cut].tolist(), key[cut].tolist()), np.split(at, cut[1:])))
        out = []
        for i, t, k in zip(rows.column(id_at), rows.column(text_at), rows.column(len(columns))):
            spans = intervals(starts.get((NULL_ID if i.as_py() is None else int(i.as_py()), k.as_py()), ()), width)
            out.append(digest((t.as_py() or "").encode(), spans))
        made = pa.Table.from_pylist(out, schema=fields)
        kept = rows.select(list(range(len(columns))))
        return pa.Table.from_arrays([*kept.columns, *made.columns], names=[*columns, *names])

    schema = T.StructType([*docs.schema.fields, *from_arrow_schema(fields).fields])
    return left.groupBy(part).cogroup(right.groupBy("part")).applyInArrow(run, schema)


DIGEST = pa.schema([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])


def digest(text: bytes, spans: list[tuple[int, int]]) -> dict:
    words = text.split()
    kept, at = [], 0
    for first, end in spans:
        kept += words[at:first]
        at = end
    kept += words[at:]
    return {"n_words": len(words), "n_removed": len(words) - len(kept),
            "kept_sha256": hashlib.sha256(b" ".join(kept)).hexdigest()}


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the hash of the kept words of every row."""
    return with_removals(docs.select("doc_id", "text"), digest, DIGEST).select("doc_id", *DIGEST.names)


def remove_repeats(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """``docs`` with every repeated passage cut from its text (n_chars, if
    there, follows); all rows stay, texts that lose nothing are untouched."""
    new = fresh(docs, "kept_text")

    def cut(text: bytes, spans: list[tuple[int, int]]) -> dict:
        return {new: cut_words(text, spans).decode() if spans else None}

    out = with_removals(docs, cut, pa.schema([(new, pa.string())]), width)
    changed = F.col(new).isNotNull()
    out = out.withColumn("text", F.coalesce(F.col(new), F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars"))
                             .cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
