"""Phrase collocations (operator 13), mined as relations (SETM).

The occurrence relation R1 holds a row per word, sorted by piece (a stretch
without ``[.,;:!?\\n\\r...]``) and position; Rk holds a row per occurrence of a
frequent phrase of k words.  Each length runs the same steps:

1. join: R(k-1) meets itself at the next position of the same piece; as both
   sides are sorted that is a shift by one.  Two frequent phrases of k-1 words
   that overlap name a phrase of k words (for k = 2, two words).
2. group and count, then keep the groups of ``MIN_COUNT`` and number them.
3. semi-join: occurrences of other groups leave the relation, which is written
   as Rk.  Only what is left is extended.

The relations are persisted a chunk a row: the documents that a task reads one
after the other, one language each, up to ``CHUNK_WORDS`` words; a task holds
``OPEN_WORDS`` words of unfinished chunks at most.  A relation is
a column of numbers, one per place; a gap keeps pieces apart, and occurrences
that left are gaps too.  Numbers are local to the chunk; a second column holds
the global number of each.  A chunk counts its own groups first, so a phrase
that makes up a third of the corpus is one entry a chunk, and sends them packed
by hash range.  A range holds about ``RANGE_WORDS`` words' entries whatever the
size of the corpus, adds them up, and answers each chunk with the numbers of
the groups that are frequent.

Rows are large, so what a task holds at once is bounded by bytes and not by
Spark's counts of rows: batches between Spark and Python end at
``BATCH_BYTES``, and the row groups of the files, which are read whole, after a
few rows.  Joins with the frequent words and phrases are sort-merge joins by
hint: a broadcast would put all of them, which grow with the corpus, into every
executor.

Phrases are known by the numbers of their two overlapping parts and never by a
hash: the counts are exact.  A number is the range's and a counter within it.

Scores, the dropping of phrases inside longer ones and the ranking are joins and
windows over the frequent phrases.  It is enough to compare a phrase with those
one word longer: a longer one that holds it also holds one of these, at least
as often.

Defined results: a null or empty text has no words; a null lang is ``und``;
rows count as often as they occur, whatever their ids; a table without frequent
phrases gives no rows.  Only A-Z is lower-cased.  Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from varzea.llm.common import configured, drop_staged, scratch, staged, text_bytes

MIN_COUNT = 30
MAX_WORDS = 4
#: A candidate goes if a longer one that holds it has this share of its count (in hundredths).
COVERED = 80
TOP = 2000
SCALE = 2_000_000
#: A chunk ends with the text that reaches this many words.
CHUNK_WORDS = 500_000
#: Words of the chunks that a task has open, one a language; beyond that it ends the largest.
OPEN_WORDS = 2_000_000
#: Words of the corpus for each hash range; a range holds no more entries than that, on average.
RANGE_WORDS = 2_000_000
#: A batch of rows between Spark and Python ends with the row that reaches this.
BATCH_BYTES = 8 << 20
#: Rows of a row group of chunks (megabytes each), and of answers (a range's together are as large).
CHUNK_ROWS, ANSWER_ROWS = 4, 64
#: A range numbers its phrases from its own multiple of this.
RANGE_NUMBERS = 1 << 32
GAP = -1

#: Stands between pieces; no byte of UTF-8 text.
_BREAK = b"\xff"
#: Lower-cases A-Z and breaks pieces.
_BYTES = bytes(c + 32 if 65 <= c <= 90 else _BREAK[0] if c in b".,;:!?\n\v\f\r" else c for c in range(256))
RELATION = "chunk long, lang string, words array<string>, counts array<long>, at binary"


class Numbers(dict):
    """Numbers for words as they come; the break between pieces is a gap."""

    def __init__(self):
        super().__init__({_BREAK: GAP})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self) - 1
        return n


def _chunk(chunk: int, lang: str, number: Numbers, at: list[int]) -> pd.DataFrame:
    places = np.array(at, np.int32)
    counts = np.bincount(places[places >= 0], minlength=len(number) - 1)
    words = [w.decode() for w in number if w != _BREAK]
    return pd.DataFrame([(chunk, lang, words, counts.tolist(), places.tobytes())],
                        columns=["chunk", "lang", "words", "counts", "at"])


def _occurrences(chunk_words: int, open_words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        chunk = TaskContext.get().partitionId() << 32
        open_: dict[str, tuple[Numbers, list[int]]] = {}
        held = 0
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                if lang not in open_:
                    open_[lang] = Numbers(), []
                number, at = open_[lang]
                held -= len(at)
                at += map(number.__getitem__, text.translate(_BYTES).replace(_BREAK, b" \xff ").split())
                at.append(GAP)
                held += len(at)
                while len(at) >= chunk_words or held >= open_words:
                    full = lang if len(at) >= chunk_words else max(open_, key=lambda x: len(open_[x][1]))
                    number, done = open_.pop(full)
                    held -= len(done)
                    yield _chunk(chunk, full, number, done)
                    chunk += 1
                    if full == lang:
                        break
        for lang, (number, at) in open_.items():
            yield _chunk(chunk, lang, number, at)
            chunk += 1
    return run


def _ranges_of(first: np.ndarray, second: np.ndarray, ranges: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ second.astype(np.uint64)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return ((h ^ (h >> np.uint64(29))) % np.uint64(ranges)).astype(np.int64)


def joined(at: np.ndarray, numbers: np.ndarray, ranges: int):
    """The chunk's next longer phrases: for every place the local number of the
    phrase that starts there (or ``GAP``), and of each phrase its parts (global
    numbers), count and range.  Phrases are in order of range and parts."""
    out = np.full(len(at), GAP, np.int32)
    here = np.flatnonzero((at[:-1] >= 0) & (at[1:] >= 0))
    pair = at[here].astype(np.int64) << 32 | at[here + 1]
    pair, where, counts = np.unique(pair, return_inverse=True, return_counts=True)
    first, second = numbers[pair >> 32], numbers[pair & 0xFFFFFFFF]
    part = _ranges_of(first, second, ranges)
    order = np.lexsort((second, first, part))
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order))
    out[here] = place[where]
    return out, first[order], second[order], counts[order], part[order]


SENT = "part long, chunk long, first binary, second binary, counts binary"


def _send(ranges: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for chunk, at, numbers in zip(batch["chunk"].tolist(), batch["at"], batch["numbers"]):
                _, first, second, counts, part = joined(np.frombuffer(at, np.int32), np.frombuffer(numbers, np.int64), ranges)
                counts = counts.astype(np.int32)
                cut = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]]).tolist()
                yield pd.DataFrame([(int(part[a]), chunk, first[a:b].tobytes(), second[a:b].tobytes(), counts[a:b].tobytes())
                                    for a, b in zip(cut, cut[1:]) if b > a],
                                   columns=["part", "chunk", "first", "second", "counts"])
    return run


#: A row with a chunk answers it (numbers of its groups, in the order sent); one without holds the range's frequent groups.
ANSWER = "part long, chunk long, numbers binary, first binary, second binary, counts binary"


def _count(least: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, chunks, sizes = 0, [], []
        sent = {"first": [], "second": [], "counts": []}
        for rows in batches:
            part = int(rows["part"].iloc[0])
            chunks += rows["chunk"].tolist()
            sizes += [len(raw) // 8 for raw in rows["first"]]
            for column, arrays in sent.items():
                arrays.append(np.frombuffer(b"".join(rows[column]), np.int32 if column == "counts" else np.int64))
        first, second, counts = (np.concatenate(sent.pop(column)) for column in ["first", "second", "counts"])
        order = np.lexsort((second, first))
        first, second, counts = first[order], second[order], counts[order]
        new = np.ones(len(order), bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        starts = np.flatnonzero(new)
        total = np.add.reduceat(counts, starts, dtype=np.int64)
        often = total >= least
        number = np.where(often, part * RANGE_NUMBERS + np.cumsum(often) - 1, GAP)
        heads = starts[often]
        groups = number[often].tobytes(), first[heads].tobytes(), second[heads].tobytes(), total[often].tobytes()
        del first, second, counts
        reply = np.empty(len(order), np.int64)
        reply[order] = number[np.cumsum(new) - 1]
        out, a, held = [], 0, 0
        for chunk, size in zip(chunks, sizes):
            answer = reply[a:a + size]
            a += size
            if (answer >= 0).any():
                out.append((part, chunk, answer.tobytes(), None, None, None))
                held += answer.nbytes
            if held >= BATCH_BYTES:
                yield _answers(out)
                out, held = [], 0
        if often.any():
            out.append((part, None, *groups))
        yield _answers(out)
    return run


def _answers(rows: list[tuple]) -> pd.DataFrame:
    made = pd.DataFrame(rows, columns=["part", "chunk", "numbers", "first", "second", "counts"])
    made["chunk"] = made["chunk"].astype("Int64")
    return made


R = "chunk long, at binary, numbers binary"


def kept(at: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The semi-join: places of phrases without a global number become gaps, the others are numbered anew."""
    often = number >= 0
    local = np.append(np.where(often, np.cumsum(often) - 1, GAP), GAP).astype(np.int32)  # the last for gaps
    return local[at], number[often]


def _semi_join(ranges: int):
    def run(relation: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(relation) or not len(answers):  # nothing frequent is left in the chunk
            return pd.DataFrame([], columns=["chunk", "at", "numbers"])
        at, _, _, _, part = joined(np.frombuffer(relation["at"].iloc[0], np.int32),
                                   np.frombuffer(relation["numbers"].iloc[0], np.int64), ranges)
        number = np.full(len(part), GAP, np.int64)
        for p, raw in zip(answers["part"].tolist(), answers["numbers"]):
            a = int(np.searchsorted(part, p))
            number[a:a + len(raw) // 8] = np.frombuffer(raw, np.int64)
        at, numbers = kept(at, number)
        return pd.DataFrame([(relation["chunk"].iloc[0], at.tobytes(), numbers.tobytes())], columns=["chunk", "at", "numbers"])
    return run


def _number_words(relation: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
    if not len(relation) or not len(words):
        return pd.DataFrame([], columns=["chunk", "at", "numbers"])
    number = np.full(int(relation["n_words"].iloc[0]), GAP, np.int64)
    number[words["place"].to_numpy()] = words["number"].to_numpy()
    at, numbers = kept(np.frombuffer(relation["at"].iloc[0], np.int32), number)
    return pd.DataFrame([(relation["chunk"].iloc[0], at.tobytes(), numbers.tobytes())], columns=["chunk", "at", "numbers"])


def _groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for columns in zip(batch["numbers"], batch["first"], batch["second"], batch["counts"]):
            yield pd.DataFrame(dict(zip(["number", "first", "second", "a"], (np.frombuffer(c, np.int64) for c in columns))))


def frequent_phrases(docs: DataFrame, max_words: int = MAX_WORDS, least: int = MIN_COUNT) -> tuple[DataFrame, DataFrame]:
    """Every phrase of up to ``max_words`` words that occurs ``least`` times in
    its language (lang, words, phrase, a, and the phrase without its last and
    without its first word), and all words of each language (lang, n)."""
    with scratch() as keep, configured(docs.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES)):
        source = docs.select(F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"),
                             text_bytes(docs).alias("text"))
        relation = staged(source.mapInPandas(_occurrences(CHUNK_WORDS, OPEN_WORDS), RELATION), "occurrences", CHUNK_ROWS)
        listed = relation.select("chunk", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "w"))
        listed = listed.select("chunk", "lang", "place", F.col("w.words").alias("phrase"), F.col("w.counts").alias("c"))
        totals = keep(staged(relation.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x).alias("c"))
                        .groupBy("lang").agg(F.sum("c").alias("n")), "words-in-all"))
        words = keep(staged(listed.groupBy("lang", "phrase").agg(F.sum("c").alias("a")).filter(F.col("a") >= least)
                       .withColumn("number", F.monotonically_increasing_id()), "frequent-words"))
        rows = totals.agg(F.sum("n")).first()[0] or 0
        ranges = int(rows // RANGE_WORDS) + 1
        numbered = listed.join(words.select("lang", "phrase", "number").hint("merge"), ["lang", "phrase"]).select(
            F.col("chunk").alias("of"), "place", "number")
        occurring = staged(relation.select("chunk", F.size("words").alias("n_words"), "at").groupBy("chunk")
                           .cogroup(numbered.groupBy("of")).applyInPandas(_number_words, R), "occurrences", CHUNK_ROWS)
        drop_staged(relation)
        last = F.lit(None).cast("string")
        level = words.select("lang", F.lit(1).alias("words"), "phrase", "a", last.alias("head"), last.alias("rest"), "number",
                             F.col("phrase").alias("last"))
        levels = [level]
        for k in range(2, max_words + 1):
            counted = staged(occurring.mapInPandas(_send(ranges), SENT).groupBy("part").applyInPandas(_count(least), ANSWER),
                             "phrases", ANSWER_ROWS)
            groups = counted.filter("chunk IS NULL").select("numbers", "first", "second", "counts").mapInPandas(
                _groups, "number long, first long, second long, a long")
            head = level.select("lang", F.col("number").alias("first"), F.col("phrase").alias("head"))
            rest = level.select(F.col("number").alias("second"), F.col("phrase").alias("rest"), "last")
            level = keep(staged(groups.join(head.hint("merge"), "first").join(rest.hint("merge"), "second").select(
                "lang", F.lit(k).alias("words"), F.concat_ws(" ", "head", "last").alias("phrase"), "a", "head", "rest", "number",
                "last"), "frequent-phrases"))
            levels.append(level)
            if k < max_words:
                answers = counted.filter("chunk IS NOT NULL").select("chunk", "part", "numbers")
                before, occurring = occurring, staged(
                    occurring.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(_semi_join(ranges), R), "occurrences",
                    CHUNK_ROWS)
                drop_staged(before)
            drop_staged(counted)
        drop_staged(occurring)
    every = levels[0]
    for level in levels[1:]:
        every = every.unionByName(level)
    return every.select("lang", "words", "phrase", "a", "head", "rest"), totals


def candidates(phrases: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score and covered (lies in a longer phrase that is nearly as frequent) of every phrase
    of two words or more.  Counts are decimals where they are multiplied."""
    long_ones = phrases.filter("words > 1").select("lang", "words", "phrase", "a", "head", "rest")
    parts = F.split("phrase", " ")
    cuts = long_ones.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.concat_ws(" ", F.slice(parts, 1, F.col("k"))).alias("left_part"),
        F.concat_ws(" ", F.slice(parts, F.col("k") + 1, F.col("words"))).alias("right_part"))
    count = phrases.select("lang", "phrase", "a").hint("merge")
    cuts = (cuts.join(count.select("lang", F.col("phrase").alias("left_part"), F.col("a").alias("l")), ["lang", "left_part"])
            .join(count.select("lang", F.col("phrase").alias("right_part"), F.col("a").alias("r")), ["lang", "right_part"])
            .withColumn("score", F.expr(f"cast({SCALE} AS decimal(18,0)) * cast(a AS decimal(19,0)) "
                                        "div (cast(l AS decimal(19,0)) + cast(r AS decimal(19,0)))")))
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("b")).select(
        "lang", "phrase", "b.a", "b.l", "b.r", "b.score")
    around = long_ones.filter("words > 2").select("lang", F.explode(F.array("head", "rest")).alias("phrase"),
                                                  F.col("a").alias("longer")).groupBy("lang", "phrase").agg(
        F.max("longer").alias("longer"))
    covers = F.expr(f"100 * cast(longer AS decimal(19,0)) >= {COVERED} * cast(a AS decimal(19,0))")
    return best.join(around.hint("merge"), ["lang", "phrase"], "left").withColumn("covered", F.coalesce(covers, F.lit(False))).drop("longer")


def collocations(docs: DataFrame, top: int = TOP) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    phrases, totals = frequent_phrases(docs)
    by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = (candidates(phrases).filter("NOT covered").withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                                              F.col("score").cast("long").alias("score"))
