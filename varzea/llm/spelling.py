"""Spelling variants (operator 11): a dictionary of pairs of trie nodes.

1. The runs of letters of all texts are counted (combined map-side) and words
   of ``MIN_LENGTH`` code points with ``MIN_COUNT`` occurrences stay.  A run is
   damaged first as the contract says, by a checksum of its document and itself.
2. The nodes of the trie of all words, and of the trie of all reversed words,
   are numbered: a node is a prefix (a suffix) that some word has.
3. A word that is cut before position i is the pair (prefix node, suffix node)
   there; a word whose letter i is skipped is the pair of the nodes on both
   sides of the letter.  The dictionary holds both kinds of pairs, as integers.
   Two words differ by one replaced letter exactly if they share a skipping
   pair, and by one inserted letter exactly if a cutting pair of the shorter is
   a skipping pair of the longer.  No string is compared.
4. A pair stands for one string with at most one open letter, so it is held by
   one cut word and ``LETTERS`` skipped ones at most: a bounded list.  All who
   share a pair are near each other, so each takes the list's most frequent
   other word, and the number of others, without a row per two words.  A letter
   that repeats can be skipped in several places with the same result; only the
   first place of a run of equal letters counts for insertions.
5. The most frequent near word becomes the form if it is ``RATIO`` times as
   frequent.  Roots are found by doubling: every round follows all forms found
   so far.  Frequencies grow fivefold with each form, so a 64-bit count needs
   five rounds at most.

Defined results: a null or empty text has no words; a null id counts as an
empty string in the checksum; repeated rows count as often as they occur; words
without a near word have no form and are their own root.  Only A-Z is lower-cased.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varzea.llm.common import scratch, staged

RUN = "[A-Za-zÀ-ÿ]"
#: Letters that a word can hold: a-z and U+00C0 to U+00FF.
LETTERS = 26 + 64
MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
#: A run is damaged if this divides its checksum.
DAMAGE = 199
ROOT = 0

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n of the words of all texts; runs too short for a word are not even taken out."""
    runs = docs.select(F.coalesce(docs["doc_id"].cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(
        F.coalesce(docs["text"].cast("string"), F.lit("")), F.lit(f"{RUN}{{{min_length},}}"), F.lit(0))).alias("run"))
    run = runs.select("id", F.translate("run", _UPPER, _LOWER).alias("run"))
    run = run.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    gap = F.pmod("h", F.length("run")).cast("int")  # from 0
    word = F.when(F.col("h") % DAMAGE == 0, F.concat(F.substring("run", F.lit(1), gap), F.substring("run", gap + 2, F.length("run"))))
    return (run.select(F.coalesce(word, "run").alias("word")).filter(F.length("word") >= min_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count))


def _joined(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """A sort-merge join.  Both sides grow with the vocabulary, and Spark sizes an exploded one
    like the table that it comes from: left to choose, it would broadcast millions of rows."""
    return left.join(right.hint("merge"), on, how)


def _nodes(words: DataFrame, part, side: str) -> DataFrame:
    """(part, node) for every prefix or suffix; the empty one is ``ROOT`` without being listed."""
    return staged(words.select(F.explode(part).alias("part")).distinct().select(
        "part", (F.monotonically_increasing_id() + 1).alias("node")), f"{side}-nodes")


def _numbered(words: DataFrame, part, side: str) -> DataFrame:
    """(w, nodes) with the node of each part of a word, in the order of the parts."""
    nodes = _nodes(words, part, side)
    found = _joined(words.select("w", F.posexplode(part).alias("i", "part")), nodes, "part")
    return found.groupBy("w").agg(F.array_sort(F.collect_list(F.struct("i", "node")))["node"].alias(side))  # a list per letter of a word


def node_pairs(words: DataFrame) -> DataFrame:
    """The dictionary: p, s (nodes), w, word, n, skips (a letter stands between them), first (of equal letters)."""
    size = F.length("word")
    prefixes = F.transform(F.sequence(F.lit(1), size), lambda i: F.substring("word", F.lit(1), i))
    suffixes = F.transform(F.sequence(F.lit(1), size), lambda i: F.substring("word", i, size))
    root = F.array(F.lit(ROOT).cast("long"))
    both = _joined(_joined(words, _numbered(words, prefixes, "front"), "w"), _numbered(words, suffixes, "back"), "w")
    both = both.withColumn("front", F.concat(root, "front")).withColumn("back", F.concat("back", root))
    letter = lambda i: F.substring("word", i + 1, F.lit(1))
    cut = F.transform(F.sequence(F.lit(0), size), lambda i: F.struct(
        F.get("front", i).alias("p"), F.get("back", i).alias("s"), F.lit(False).alias("skips"), F.lit(False).alias("first")))
    skip = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.struct(
        F.get("front", i).alias("p"), F.get("back", i + 1).alias("s"), F.lit(True).alias("skips"),
        ((i == 0) | (letter(i) != letter(i - 1))).alias("first")))
    return both.select("w", "word", "n", F.inline(F.concat(cut, skip)))


def near_words(words: DataFrame) -> DataFrame:
    """w, n_near, best (its most frequent near word: n, word) of every word that has one.

    ``words``: w (a number), word, n."""
    member = F.struct((-F.col("n")).alias("less"), "word", "w", "skips", "first")
    shared = (node_pairs(words).groupBy("p", "s").agg(F.array_sort(F.collect_list(member)).alias("m"))
              .filter(F.size("m") > 1))
    skips = F.size(F.filter("m", lambda x: x["skips"]))
    firsts = F.size(F.filter("m", lambda x: x["first"]))
    counted = shared.select("m", skips.alias("skips_here"), firsts.alias("firsts_here"))
    each = counted.select("m", "skips_here", "firsts_here", F.explode("m").alias("x"))
    other = F.when(F.col("m")[0]["w"] == F.col("x.w"), F.col("m")[1]).otherwise(F.col("m")[0])
    cut_here = (F.size("m") - F.col("skips_here"))
    near = F.when(F.col("x.skips"), F.col("skips_here") - 1 + F.when(F.col("x.first"), cut_here).otherwise(0)).otherwise(
        F.col("firsts_here"))
    return (each.select(F.col("x.w").alias("w"), near.cast("long").alias("near"),
                        F.struct(other["less"].alias("less"), other["word"].alias("word")).alias("other"))
            .groupBy("w").agg(F.sum("near").alias("n_near"), F.min("other").alias("best"))
            .select("w", "n_near", F.struct((-F.col("best.less")).alias("n"), F.col("best.word").alias("word")).alias("best")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every row of (word, form); no form may lead back to its word."""
    now = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("end"))
        before, now = now, staged(_joined(now, further, "root", "left").select(
            "word", F.coalesce("end", "root").alias("root"), F.col("end").isNotNull().alias("moved")), "roots")
        if now.filter("moved").isEmpty():
            return before


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``docs``."""
    with scratch() as keep:
        words = staged(vocabulary(docs).withColumn("w", F.monotonically_increasing_id()), "words")
        near = _joined(words, near_words(words), "w", "left")
        is_form = F.col("best.n") >= RATIO * F.col("n")
        formed = keep(staged(near.select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, F.col("best.n")).alias("form_n")), "forms"))
        root = keep(roots(formed.filter("form IS NOT NULL")))
    return _joined(formed, root, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
