"""Quality rules as a bitmask ledger (operator 10).

Every rule is evaluated once per document.  The ledger keeps the measurements
and one integer whose bit *k* says that rule *k* failed, so policies (a mask
of rules that reject) can be changed, versioned and compared later without
reading a text again.  Policies and ablations are bitwise SQL over the ledger.

Defined results: a null or empty text has no words and fails ``few_words``;
rows are judged one by one, so repeated rows and null ids each keep their own
verdict; an empty table gives an empty ledger; extra columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varzea.llm.common import fresh, text_bytes

WINDOW = 8
SYMBOLS = b"#*$%&|<>"

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    name: str
    fails: str  # SQL over the measures


#: The position in this list is the rule's bit; append only.
RULES = [
    Rule("few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbol_heavy", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "n_lines >= 4 AND 2 * n_dup_lines > n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 30 * n_words"),
]
BIT = {r.name: 1 << i for i, r in enumerate(RULES)}

#: Versioned policies: the rules whose failure rejects a document.
POLICIES = {
    "base": BIT["few_words"] | BIT["repeated_windows"],
    "v1": sum(BIT.values()),
}
CURRENT_POLICY = "v1"


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words inside windows of ``width`` words that occur at least twice.

    Windows are named exactly by doubling: pairs of words, pairs of pairs and
    so on, each named by its rank, so no hash can collide (``width`` is a
    power of two)."""
    n = len(words)
    if n <= width:
        return 0
    seen: dict[bytes, int] = {}
    name = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    span = 1
    while span < width:
        key = name[:-span] * (int(name.max()) + 1) + name[span:]
        name, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        if len(name) == len(key):  # no repeat at this width, so none at a larger one
            return 0
        name, span = inverse, 2 * span
    starts = np.flatnonzero(count[name] > 1)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    return int((np.cumsum(edge) > 0).sum())


def measure(text: bytes) -> tuple[int, ...]:
    words = text.split()  # on space, tab, \n, \v, \f, \r
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (len(words), len(b"".join(words).decode("utf-8", "replace")),
            len(text) - len(text.translate(None, SYMBOLS)), len(lines),
            len(lines) - len(set(lines)), repeated_words(words))


@F.pandas_udf(T.StructType([T.StructField(m, T.LongType()) for m in MEASURES]))
def _measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        yield pd.DataFrame([measure(t) for t in texts], columns=MEASURES, dtype="int64")


def failure_bits(prefix: str = "") -> Column:
    """One integer of failure bits from the measures below ``prefix``."""
    bits = F.lit(0).cast("long")
    for rule in RULES:
        cond = rule.fails
        for m in MEASURES:
            cond = cond.replace(m, f"{prefix}{m}")
        bits = bits.bitwiseOR(F.when(F.expr(cond), F.lit(BIT[rule.name])).otherwise(F.lit(0)))
    return bits


def with_measures(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a struct column ``name`` of the measures; one pass, no shuffle."""
    return docs.withColumn(name, _measure.asNondeterministic()(text_bytes(docs)))


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measures and ``fail_bits`` of every row of ``docs``."""
    m = fresh(docs, "measures")
    out = with_measures(docs, m).select("doc_id", f"{m}.*")
    return out.withColumn("fail_bits", failure_bits())


def apply_policy(led: DataFrame, policy: str = CURRENT_POLICY) -> DataFrame:
    """``kept``: no rule of the policy failed.  Reads bits only."""
    return led.withColumn("kept", F.col("fail_bits").bitwiseAND(F.lit(POLICIES[policy])) == 0)


def ablations(led: DataFrame, policy: str = CURRENT_POLICY) -> DataFrame:
    """For each rule of the policy: documents it fails, and documents kept
    only if it were left out (``sole``).  The ledger is first aggregated to
    its distinct bit patterns (at most 2^rules rows), the rest is bitwise."""
    mask = POLICIES[policy]
    patterns = (led.select(F.col("fail_bits").bitwiseAND(F.lit(mask)).alias("bits"))
                .groupBy("bits").agg(F.count(F.lit(1)).alias("n")))
    rules = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(BIT[r.name]).cast("long").alias("bit"))
                      for r in RULES if BIT[r.name] & mask])
    return (patterns.select("bits", "n", F.inline(rules))
            .groupBy("rule")
            .agg(F.sum(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("failed"),
                 F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("sole")))


def keep_good(docs: DataFrame, policy: str = CURRENT_POLICY) -> DataFrame:
    """Rows of ``docs`` that the policy keeps, with their columns unchanged."""
    m = fresh(docs, "measures")
    bits = failure_bits(f"{m}.").bitwiseAND(F.lit(POLICIES[policy]))
    return with_measures(docs, m).filter(bits == 0).drop(m)
