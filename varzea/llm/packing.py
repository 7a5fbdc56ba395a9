"""Best-fit packing (operator 4): a grouping genetic algorithm on islands.

Documents become token ids and an end token; longer ones are cut so that only
the first piece is shorter than a sequence.  Full pieces fill a sequence each.
The others are dealt at random (by a hash of a row number) over shards of
about ``SHARD`` pieces, and several islands work on each shard:

* an individual is an assignment of the shard's pieces to bins;
* crossover injects whole well-filled bins of one parent into the other, the
  bins that would then hold a piece twice are removed, and the pieces that
  lose their bin are put back by best fit, longest first;
* an island keeps its population from epoch to epoch; after each the best
  individual of every island (the elite) also moves to the next island of its
  shard, as a guest of the population there;
* at the end a shard keeps the bins of its best individual, but for its
  ``OPEN_BINS`` worst, or as many of these as hold half of its pieces at most:
  their pieces migrate to the next level, where fewer shards pack what all
  shards left over, until one shard is left.  Each level has at most half of
  the pieces of the one before.

A task holds one shard (lengths for evolution, rows for the final placing).

Defined results: a null or empty text is one piece, the end token alone; rows
are packed one by one, so repeated rows and null ids stay; an empty table
gives an empty result; texts are encoded whole.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varzea.llm.common import partitions, staged

CAPACITY = 1024
END_ID = 2
SHARD = 8192
ISLANDS = 2
EPOCHS = 2
POPULATION = 6
GENERATIONS = 10
OPEN_BINS = 6
#: How far a first individual's order strays from longest first, from the first to the last of a population.
NOISE = 0.3
#: Share of a parent's bins, the fullest, that crossover injects.
INJECT = 0.5
#: Characters of whole texts that are encoded together (a longer text alone); no result depends on it.
BATCH_CHARS = 1 << 24
#: Distinct words that one call of the tokenizer takes, and words whose ids are put together at a time.
CALL_WORDS = 1 << 16
JOIN_WORDS = 1 << 18


#: White space before a blank, and a blank without it (white space as ``str.isspace`` has it, which holds the pattern's).
_SPACED = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] "
_BLANK = re.compile(r"(?<=\S) ")


class Encoder:
    """Packed token ids of whole texts, as the vocabulary's own tokenizer gives them.

    A blank begins a new token unless white space stands before it, so texts are
    cut at all other blanks.  The distinct words of a batch are encoded once,
    many in one call with a blank before each, and the tokens' bytes tell where
    a word's ids end.  Texts with a special string are encoded alone."""

    def __init__(self, rank_path: str, special: dict[str, int]):
        import public_tokenizers
        import tiktoken
        with open(rank_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._ids = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                      special_tokens={}).encode_ordinary
        self._bytes = np.zeros(max(ranks.values()) + 1, np.int64)
        self._bytes[list(ranks.values())] = list(map(len, ranks))
        self._special = special
        self._cut = re.compile("(" + "|".join(map(re.escape, special)) + ")")

    def _whole(self, text: str) -> bytes:
        return array("I", self._ids(text)).tobytes()

    def encode(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        text = text or ""
        if "<|" not in text:
            return self._whole(text)
        return b"".join(array("I", [self._special[p]]).tobytes() if p in self._special else self._whole(p)
                        for p in self._cut.split(text) if p)

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """``encode`` of each text."""
        batch, chars = [], 0
        for text in texts:
            text = text or ""
            if batch and chars + len(text) > BATCH_CHARS:
                yield from self._batch(batch)
                batch, chars = [], 0
            batch.append(text)
            chars += len(text)
        if batch:
            yield from self._batch(batch)

    def _batch(self, texts: list[str]) -> Iterator[bytes]:
        column = pa.array(texts, pa.string())
        special = pc.match_substring(column, "<|")
        spaced = pc.match_substring_regex(column, _SPACED)
        others = column.filter(pc.and_not(spaced, special)).to_pylist()
        at_some = self._words(pa.array([_BLANK.split(t) for t in others], pa.list_(pa.string())))
        at_blanks = self._words(pc.split_pattern(column.filter(pc.invert(pc.or_(special, spaced))), " "))
        del column, others
        for text, whole, some in zip(texts, special.to_pylist(), spaced.to_pylist()):
            yield self.encode(text) if whole else next(at_some if some else at_blanks)

    def _words(self, cut: pa.ListArray) -> Iterator[bytes]:
        """Ids of texts that are cut at blanks without white space before them."""
        at = cut.offsets.to_numpy().astype(np.int64)
        coded = cut.values.dictionary_encode()
        codes, words = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False)
        ids, begin, n = self._table(words, pc.binary_length(coded.dictionary).to_numpy().astype(np.int64))
        firsts, a = words[codes[at[:-1]]].tolist(), 0
        del cut, coded, words
        while a < len(firsts):
            b = max(a + 1, int(np.searchsorted(at, at[a] + JOIN_WORDS, "right")) - 1)
            here = codes[at[a]:at[b]]
            of_word = n[here]
            of_word[at[a:b] - at[a]] = 0  # a text's first word has no blank before it
            ends = np.cumsum(of_word)
            joined = ids[np.repeat(begin[here] - ends + of_word, of_word) + np.arange(ends[-1])]
            stops = ends[at[a + 1:b + 1] - at[a] - 1].tolist()
            for first, start, stop in zip(firsts[a:b], [0, *stops], stops):
                yield self._whole(first) + joined[start:stop].tobytes()
            a = b

    def _table(self, words: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of words after a blank, where each word's begin and how many they are."""
        last = np.array([not w or w[-1].isspace() for w in words], bool)  # no other word may follow these
        many, single = np.flatnonzero(~last), np.flatnonzero(last)
        parts, n = [np.zeros(0, "<u4")], np.zeros(len(words), np.int64)
        for k in range(0, len(many), CALL_WORDS):
            some = many[k:k + CALL_WORDS]
            parts.append(np.array(self._ids(" " + " ".join(words[some].tolist())), "<u4"))
            stops = np.searchsorted(np.cumsum(self._bytes[parts[-1]]), np.cumsum(size[some] + 1)) + 1
            n[some] = np.diff(stops, prepend=0)
        for k in single.tolist():
            parts.append(np.array(self._ids(" " + words[k]), "<u4"))
            n[k] = len(parts[-1])
        begin, order = np.zeros(len(words), np.int64), np.concatenate([many, single])
        begin[order] = np.cumsum(n[order]) - n[order]
        return np.concatenate(parts), begin, n


@lru_cache(maxsize=1)
def encoder(rank_path: str, special: tuple[tuple[str, int], ...]) -> Encoder:
    return Encoder(rank_path, dict(special))


def _pieces(rank_path: str, special: tuple[tuple[str, int], ...], capacity: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(rank_path, special)
        end = array("I", [END_ID]).tobytes()
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch["doc_id"], enc.encode_all(batch["text"])):
                ids += end
                n = len(ids) // 4
                start, stop, piece = 0, (n - 1) % capacity + 1, 0
                while start < n:
                    rows.append((doc_id, piece, start, stop - start, zlib.crc32(ids[4 * start:4 * stop])))
                    start, stop, piece = stop, stop + capacity, piece + 1
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out
    return run


def pieces(docs: DataFrame, rank_path: str, special: dict[str, int], capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).mapInPandas(
        _pieces(rank_path, tuple(sorted(special.items())), capacity),
        "doc_id long, piece int, start long, length long, ids_crc32 long")


class Bins:
    """An individual: pieces' bins, with the free space of each bin."""

    def __init__(self, lengths: list[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.bin_of = [-1] * len(lengths)
        self.free: list[int] = []

    def best_fit(self, pieces_left: list[int]) -> None:
        """Put each piece where the least space stays free, else into a new bin."""
        lengths, bin_of, free, capacity = self.lengths, self.bin_of, self.free, self.capacity
        by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
        mask = 0
        for b, space in enumerate(free):
            if space:
                by_space[space].append(b)
                mask |= 1 << space
        for i in pieces_left:
            need = lengths[i]
            fits = mask >> need
            if fits:
                space = need + (fits & -fits).bit_length() - 1
                b = by_space[space].pop()
                if not by_space[space]:
                    mask &= ~(1 << space)
            else:
                b, space = len(free), capacity
                free.append(capacity)
            bin_of[i] = b
            space -= need
            free[b] = space
            if space:
                by_space[space].append(b)
                mask |= 1 << space

    def fitness(self) -> tuple[int, int]:
        """Fewer bins first, then fuller ones."""
        return -len(self.free), sum((self.capacity - f) ** 2 for f in self.free)


def first_individual(lengths: list[int], capacity: int, rng: np.random.Generator, noise: float) -> Bins:
    order = np.argsort(-(np.array(lengths) * (1 + noise * rng.random(len(lengths)))), kind="stable")
    out = Bins(lengths, capacity)
    out.best_fit(order.tolist())
    return out


def crossover(a: Bins, b: Bins, rng: np.random.Generator) -> Bins:
    """Whole well-filled bins of ``a`` into ``b``."""
    bin_a, bin_b = np.array(a.bin_of), np.array(b.bin_of)
    free_a, free_b = np.array(a.free), np.array(b.free)
    good = np.argsort(free_a, kind="stable")[:max(1, int(INJECT * len(free_a)))]
    good = good[rng.random(len(good)) < 0.5]
    take = np.zeros(len(free_a), bool)
    take[good] = True
    injected = take[bin_a]
    doubled = np.zeros(len(free_b), bool)
    doubled[bin_b[injected]] = True
    stays = ~doubled[bin_b]
    new_b = np.cumsum(~doubled) - 1
    new_a = np.cumsum(take) - 1 + int((~doubled).sum())
    child = Bins(a.lengths, a.capacity)
    child.bin_of = np.where(injected, new_a[bin_a], np.where(stays, new_b[bin_b], -1)).tolist()
    child.free = np.concatenate([free_b[~doubled], free_a[take]]).tolist()
    displaced = np.flatnonzero(~injected & ~stays)
    lengths = np.array(a.lengths)[displaced]
    child.best_fit(displaced[np.argsort(-lengths, kind="stable")].tolist())
    return child


def _individual(lengths: list[int], capacity: int, bin_of: list[int]) -> Bins:
    out = Bins(lengths, capacity)
    out.bin_of = bin_of
    filled = np.bincount(bin_of, weights=lengths, minlength=max(bin_of) + 1)
    out.free = (capacity - filled.astype(int)).tolist()
    return out


def _fittest(population: list[Bins]) -> list[Bins]:
    """The best ``POPULATION``, best first; of equally fit ones the first, so that copies do not take the others' places."""
    distinct: dict[tuple[int, int], Bins] = {}
    for one in population:
        distinct.setdefault(one.fitness(), one)
    return [distinct[f] for f in sorted(distinct, reverse=True)[:POPULATION]]


def evolve(lengths: list[int], capacity: int, seed: int, kept: list[list[int]],
           elite: list[int] | None) -> list[Bins]:
    """One island's epoch, best first.  ``kept`` are the assignments that the
    epoch before left here (none: a first population), ``elite`` is the one that
    migrated here."""
    rng = np.random.default_rng(seed)
    if kept:
        population = [_individual(lengths, capacity, k) for k in kept]
    else:
        population = [first_individual(lengths, capacity, rng, NOISE * k / max(1, POPULATION - 1))
                      for k in range(POPULATION)]
    if elite is not None:
        population.append(_individual(lengths, capacity, elite))
    least = -(-sum(lengths) // capacity)
    for _ in range(GENERATIONS):
        population = _fittest(population)
        if len(population[0].free) == least:
            break  # no packing has fewer bins
        order = rng.permutation(len(population)).tolist()  # each is a parent, beside the next one
        population += [crossover(population[i], population[j], rng)
                       for i, j in zip(order, order[1:] + order[:1]) if i != j]
    return _fittest(population)


STATE = "shard long, island int, best binary, kept array<binary>, bins long, fill double"


def _island(capacity: int, epoch: int):
    def run(key, items: pd.DataFrame, states: pd.DataFrame) -> pd.DataFrame:
        columns = ["shard", "island", "best", "kept", "bins", "fill"]
        if not len(items):
            return pd.DataFrame(columns=columns)
        shard, island = int(key[0]), int(key[1])
        lengths = items.sort_values("row")["length"].astype(int).tolist()
        own, guests = states[~states["guest"].astype(bool)], states[states["guest"].astype(bool)]
        kept = [np.frombuffer(k, np.int32).tolist() for k in own["kept"].iloc[0]] if len(own) else []
        elite = np.frombuffer(guests["best"].iloc[0], np.int32).tolist() if len(guests) else None
        population = evolve(lengths, capacity, shard * 1000 + island * 10 + epoch, kept, elite)
        bins, fill = population[0].fitness()
        packed = [np.array(p.bin_of, np.int32).tobytes() for p in population]
        return pd.DataFrame([(shard, island, packed[0], packed, -bins, float(fill))], columns=columns)
    return run


PLACED = ("row long, doc_id long, piece int, start long, length long, ids_crc32 long, "
          "sequence_id long, offset long, settled boolean")


def _place(level: int, last: bool):
    def run(key, items: pd.DataFrame, states: pd.DataFrame) -> pd.DataFrame:
        columns = [c.split()[0] for c in PLACED.split(", ")]
        if not len(items):
            return pd.DataFrame(columns=columns)
        items = items.sort_values("row").reset_index(drop=True)
        best = states.sort_values(["bins", "fill", "island"], ascending=[True, False, True])["best"].iloc[0]
        items["bin"] = np.frombuffer(best, np.int32)
        bins = items.groupby("bin")["length"].agg(["sum", "size"]).sort_values("sum", kind="stable")[:OPEN_BINS]
        opened = set() if last else set(bins.index[2 * bins["size"].cumsum() <= len(items)])
        items["settled"] = ~items["bin"].isin(opened)
        items["sequence_id"] = (level << 58) + (int(key[0]) << 24) + items["bin"].astype("int64")
        items["offset"] = items.groupby("bin")["length"].cumsum() - items["length"]
        return items[columns]
    return run


def pack(pieces_: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces_`` with sequence_id and offset: no sequence over ``capacity``."""
    spark = pieces_.sparkSession
    rows = staged(pieces_.withColumn("row", F.monotonically_increasing_id()), "pieces")
    payload = ["doc_id", "piece", "start", "length", "ids_crc32"]
    full = rows.filter(F.col("length") >= capacity).select(
        *payload, (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    done = [full]
    rest, level = rows.filter(F.col("length") < capacity), 1
    while True:
        n = rest.count()
        shards = max(1, -(-n // SHARD))
        items = rest.withColumn("shard", F.pmod(F.xxhash64("row", F.lit(level)), F.lit(shards)))
        lengths = items.select("shard", "row", "length", F.explode(F.array(*map(F.lit, range(ISLANDS)))).alias("island"))
        state = spark.createDataFrame([], STATE)
        for epoch in range(EPOCHS):
            # the elite goes to the next island, the population stays
            moved = (state.select("shard", ((F.col("island") + 1) % ISLANDS).cast("int").alias("island"), "best",
                                  F.lit(None).cast("array<binary>").alias("kept"), F.lit(True).alias("guest"))
                     .unionByName(state.select("shard", "island", F.lit(None).cast("binary").alias("best"), "kept",
                                               F.lit(False).alias("guest"))))
            state = staged(lengths.groupBy("shard", "island").cogroup(moved.groupBy("shard", "island"))
                           .applyInPandas(_island(capacity, epoch), STATE), "islands")
        last = shards == 1
        placed = staged(items.groupBy("shard").cogroup(state.drop("kept").groupBy("shard"))
                        .applyInPandas(_place(level, last), PLACED), "packed")
        done.append(placed.filter("settled").select(*payload, "sequence_id", "offset"))
        if last:
            break
        rest, level = placed.filter("NOT settled").select("row", *payload), level + 1
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def pack_documents(docs: DataFrame, rank_path: str, special: dict[str, int], capacity: int = CAPACITY) -> DataFrame:
    return pack(pieces(docs, rank_path, special, capacity), capacity)
