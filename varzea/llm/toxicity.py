"""Toxicity (operator 2): a weighted lexicon matched by Aho-Corasick.

Texts are folded first: compatibility forms and homoglyphs become plain
letters, digits and signs that stand for letters inside a word are replaced,
case is dropped.  The folded words, set between blanks, are run once through
an Aho-Corasick automaton of lexicon terms (whole words and word beginnings)
and exception phrases.  At each word the heaviest term counts, unless an
exception phrase covers it.  The sum of weights, also per hundred words, goes
through a logistic curve to a score from 0 to 1.

The lexicon and the curve are learned from labelled documents only, from at
most ``SAMPLE`` of them (chosen by a hash of the id):

1. documents per term among the toxic ones (terms in fewer than ``MIN_DOCS``
   are left out; at most ``MAX_CANDIDATES``, the most frequent, go on);
2. documents per such term among the others;
3. a term's weight is the log odds of its two shares; terms whose log
   likelihood ratio is under ``MIN_RATIO`` are left out;
4. the curve is fitted to the sample's sums, each computed without the
   document's own part in the term counts.

Labels, language, source and id are never inputs of a score.

Defined results: a null or empty text has no words and gets the curve's value
at zero; without toxic training rows the lexicon is empty and every score is
0; documents and labels may repeat (a label counts once per id, the largest);
null ids and null labels are never trained on; extra columns are not read.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varzea.llm.common import fresh, staged

#: Labelled documents that the classifier is fitted on, at most.
SAMPLE = 12_000
MIN_DOCS = 6
MIN_RATIO = 24.0
PREFIXES = (3, 4, 5, 6)

# Letters of other scripts that look like Latin ones.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j",
    "к": "k", "м": "m", "т": "t", "н": "h", "в": "b", "г": "r", "ԁ": "d", "ӏ": "l", "ո": "n", "ս": "u",
    "А": "a", "Е": "e", "О": "o", "Р": "p", "С": "c", "У": "y", "Х": "x", "І": "i", "Ѕ": "s", "Ј": "j",
    "К": "k", "М": "m", "Т": "t", "Н": "h", "В": "b",
    "α": "a", "ε": "e", "ο": "o", "ρ": "p", "ι": "i", "κ": "k", "ν": "v", "τ": "t", "υ": "u", "χ": "x",
    "Α": "a", "Β": "b", "Ε": "e", "Η": "h", "Ι": "i", "Κ": "k", "Μ": "m", "Ν": "n", "Ο": "o", "Ρ": "p",
    "Τ": "t", "Υ": "y", "Χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l",
    "​": "", "‌": "", "‍": "", "⁠": "", "﻿": "", "­": "",
}
# Digits and signs that stand for letters inside a word.
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
# Phrases in which an insulting word is harmless.
EXCEPTIONS = ["trash can", "trash bin", "trash bag", "clown fish", "sore loser", "pond scum", "scum line",
              "disgusting smell", "circus clown", "rodeo clown", "worthless stock", "worthless check"]

_LOOKALIKE = re.compile("[" + "".join(LOOKALIKES) + "]")
_LOOK_TABLE = {ord(k): v for k, v in LOOKALIKES.items()}
_DIGIT_TABLE = {ord(k): v for k, v in DIGITS.items()}
_WORD = re.compile(r"[^\W_]+(?:[@$!]+[^\W_]+)*")
_SIGN = re.compile(r"[0-9@$!]")
_LETTER = re.compile(r"[^\W\d_]")


def fold(text: str) -> list[str]:
    """Folded words of a text."""
    if not text.isascii():
        if not unicodedata.is_normalized("NFKC", text):
            text = unicodedata.normalize("NFKC", text)
        if _LOOKALIKE.search(text):
            text = text.translate(_LOOK_TABLE)
    text = text.lower()
    words = _WORD.findall(text)
    if _SIGN.search(text):
        words = [w.translate(_DIGIT_TABLE) if _SIGN.search(w) and _LETTER.search(w) else w for w in words]
    return words


def terms(words: set[str]) -> set[str]:
    """Whole words " word " and word beginnings " wor"."""
    out = {f" {w} " for w in words}
    for n in PREFIXES:
        out.update(" " + w[:n] for w in words if len(w) >= n)
    return out


@dataclass(frozen=True)
class Model:
    toxic: int = 0
    clean: int = 0
    counts: dict[str, tuple[int, int]] = field(default_factory=dict)  # toxic, clean documents per term
    curve: tuple[float, ...] = ()

    def weight(self, a: float, b: float, toxic: float, clean: float) -> float:
        return math.log((a + 0.5) / (toxic + 1.0)) - math.log((b + 0.5) / (clean + 1.0))


class Matcher:
    def __init__(self, model: Model, exceptions: list[str] | None = None):
        self.model = model
        self.automaton = ahocorasick.Automaton()
        self.weights = {t: model.weight(a, b, model.toxic, model.clean) for t, (a, b) in model.counts.items()}
        for t in model.counts:
            self.automaton.add_word(t, (len(t), t))
        for e in EXCEPTIONS if exceptions is None else exceptions:
            phrase = " " + " ".join(fold(e)) + " "
            self.automaton.add_word(phrase, (len(phrase), None))
        self.automaton.make_automaton()

    def hits(self, words: list[str]) -> dict[int, str]:
        """The heaviest term that begins at each word, outside exception phrases."""
        best: dict[int, str] = {}
        spared: list[tuple[int, int]] = []
        weights = self.weights
        for end, (length, term) in self.automaton.iter(" " + " ".join(words) + " "):
            start = end - length + 1
            if term is None:
                spared.append((start, end))
            elif start not in best or weights[term] > weights[best[start]]:
                best[start] = term
        out, k, until = {}, 0, 0
        spared.sort()
        for s in sorted(best):  # both in order: each span is met once
            while k < len(spared) and spared[k][0] <= s:
                until = max(until, spared[k][1])
                k += 1
            if s >= until:
                out[s] = best[s]
        return out

    def features(self, text: str | None, label: int | None = None) -> tuple[float, float, float]:
        """Sum of weights, sum per hundred words, and number of hits, as
        logarithms; with ``label`` the document's own counts are taken out."""
        words = fold(text or "")
        total, n = 0.0, 0
        m = self.model
        for t in self.hits(words).values():
            if label is None:
                w = self.weights[t]
            else:
                a, b = m.counts[t]
                w = m.weight(max(0, a - label), max(0, b - (1 - label)), m.toxic - label, m.clean - (1 - label))
            if w > 0:
                total += w
                n += 1
        return math.log1p(total), math.log1p(100.0 * total / max(1, len(words))), math.log1p(n)

    def score(self, text: str | None) -> float:
        if not self.model.counts or not self.model.curve:
            return 0.0
        z = self.model.curve[0] + sum(c * x for c, x in zip(self.model.curve[1:], self.features(text)))
        return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, z))))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of at most SAMPLE labelled documents that are not held out."""
    sample = (labels.filter(labels["doc_id"].isNotNull() & labels["toxic"].isin(0, 1) & ~held_out(labels["doc_id"]))
              .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE))
    texts = docs.select("doc_id", "text").filter("doc_id IS NOT NULL")
    # SAMPLE rows of two numbers at most
    return staged(texts.join(F.broadcast(sample), "doc_id").select("text", "toxic"), "toxicity-sample")


TERM_COUNT = "term string, toxic long, clean long"


def _count_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: tuple[Counter[str], Counter[str]] = Counter(), Counter()  # clean, toxic
    for batch in batches:
        for t, toxic in zip(batch["text"], batch["toxic"]):
            held[toxic].update(terms(set(fold(t or ""))))
        if sum(map(len, held)) > 200_000:
            yield _counted(held)
            held = Counter(), Counter()
    yield _counted(held)


def _counted(held: tuple[Counter[str], Counter[str]]) -> pd.DataFrame:
    clean, toxic = held
    return pd.DataFrame([(t, toxic[t], clean[t]) for t in {**clean, **toxic}], columns=["term", "toxic", "clean"])


def lexicon_terms(rows: DataFrame, toxic: int, clean: int) -> DataFrame:
    """term, toxic and clean documents that have it, of the terms over-represented in toxic ones.  All terms of
    the sample are counted and judged in Spark."""
    counts = rows.mapInPandas(_count_terms, TERM_COUNT).groupBy("term").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    p = (a + b) / (toxic + clean)

    def part(k: Column, n: int) -> Column:
        q = k / n
        return (F.when(k > 0, k * F.ln(q / p)).otherwise(0.0)
                + F.when(k < n, (n - k) * F.ln((1 - q) / (1 - p))).otherwise(0.0))

    likelihood = F.when(p < 1, 2 * (part(a, toxic) + part(b, clean))).otherwise(0.0)
    return counts.filter((F.col("a") >= min(MIN_DOCS, max(1, toxic // 4))) & (a / toxic > b / clean)
                         & (likelihood >= min(MIN_RATIO, 2.0 * toxic)))


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> tuple[float, ...]:
    """Logistic regression by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(w.tolist())


def train(docs: DataFrame, labels: DataFrame) -> Model:
    rows = training_rows(docs, labels)
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return Model()
    # terms of SAMPLE documents at most, and of those the few that tell
    counts = {r["term"]: (r["a"], r["b"]) for r in sorted(lexicon_terms(rows, toxic, clean).collect())}
    model = Model(toxic, clean, counts)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = Matcher(model)
        for b in batches:
            got = [(*m.features(t, y), y) for t, y in zip(b["text"], b["toxic"])]
            yield pd.DataFrame(got, columns=["a", "b", "c", "y"])

    # SAMPLE rows of four numbers at most
    points = rows.mapInPandas(features, "a double, b double, c double, y int").toPandas()
    points = points.sort_values(["a", "b", "c", "y"]).to_numpy(float)  # sums do not depend on the order of tasks
    return Model(toxic, clean, counts, fit_curve(points[:, :3], points[:, 3]))


def score_column(model: Model):
    """Pandas UDF text -> score."""
    @F.pandas_udf(T.DoubleType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = Matcher(model)
        for texts in batches:
            yield pd.Series([m.score(t) for t in texts], dtype=float)
    return run


def scored(docs: DataFrame, labels: DataFrame, name: str) -> DataFrame:
    """``docs`` with its score in column ``name``."""
    return docs.withColumn(name, score_column(train(docs, labels)).asNondeterministic()(docs["text"]))


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    s = fresh(docs, "score")
    return scored(docs, labels, s).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col(s).alias("score"),
        F.when(F.col(s) >= 0.5, 1).otherwise(0).alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` that score under 0.5, columns unchanged."""
    s = fresh(docs, "score")
    return scored(docs, labels, s).filter(F.col(s) < 0.5).drop(s)
