"""URL filters (operator 9): rules first, then gradient-boosted trees on
lexical features.  DataFrame and SQL functions only.

Rules name a host and a path; a rule fits its host and all subdomains when the
path begins with the rule's path, and the longest rule wins.  URLs that a rule
settles are the labelled ones: at most ``TRAIN_ROWS`` distinct ones (chosen by
a hash) train the trees, which judge all the others.

Features of a URL: length, path depth, digit ratio, character entropy, number
of parameters, hyphens and labels of the host, and suffix statistics: the
smoothed share of blocked training URLs with the same last host label, the
same last two labels and the same first path segment.  Each statistic is a
table with at most TRAIN_ROWS rows, joined by equality.

Defined results: a null URL or one without ``://`` has an empty host and path,
fits no rule and is judged by the trees; if the labelled URLs hold one verdict
only (or there are none) the rest is judged that verdict (or allow) with score
1 or 0; rows are judged one by one, so repeated rows and null ids stay.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varzea.llm.common import fresh, staged

#: Distinct labelled URLs that the trees are trained on, at most.
TRAIN_ROWS = 10_000
TREES = 8
DEPTH = 3
#: Weight of the overall share in a suffix statistic.
SMOOTHING = 5.0


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules.
RULES = [Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
         Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/")]

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(url, _URL, 1), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, _URL, 2)


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Name of the longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.name)):  # the longest ends up outermost
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.lit(r.name)).otherwise(out)
    return out


def _occurrences(text: Column, what: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))) / F.lit(len(what))


def _entropy(text: Column) -> Column:
    n = F.length(text)
    share = F.transform(F.array_distinct(F.split(text, "")),
                        lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n)
    bits = F.aggregate(share, F.lit(0.0), lambda acc, p: acc - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    return F.when(n > 0, bits).otherwise(0.0)


STATISTICS = ["last_label", "last_two", "first_segment"]
FEATURES = ["url_length", "depth", "digit_ratio", "entropy", "n_params", "n_hyphens", "n_labels",
            *[f"{s}_share" for s in STATISTICS]]


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    n = F.length(url)
    labels = F.split(host, r"\.")
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    return {
        "url_length": n.cast("double"),
        "depth": F.size(F.filter(F.split(path, "/"), lambda x: x != "")).cast("double"),
        "digit_ratio": F.when(n > 0, (n - F.length(F.translate(url, string.digits, ""))) / n).otherwise(0.0),
        "entropy": _entropy(url),
        "n_params": F.when(query != "", _occurrences(query, "&") + 1).otherwise(0.0),
        "n_hyphens": _occurrences(host, "-").cast("double"),
        "n_labels": F.size(labels).cast("double"),
        "last_label": F.element_at(labels, -1),
        "last_two": F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2)),
        "first_segment": F.coalesce(F.get(F.filter(F.split(path, "/"), lambda x: x != ""), F.lit(0)), F.lit("")),
    }


def _share(prior: float) -> Column:
    return (F.coalesce("blocked", F.lit(0)) + SMOOTHING * prior) / (F.coalesce("n", F.lit(0)) + SMOOTHING)


def _with_shares(rows: DataFrame, tables: dict[str, DataFrame], prior: float) -> DataFrame:
    for s, table in tables.items():
        # at most TRAIN_ROWS rows of a short text and two numbers
        rows = rows.join(F.broadcast(table), s, "left").withColumn(f"{s}_share", _share(prior)).drop("blocked", "n")
    return rows


def judge(pages: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict and score (likelihood of block; of a
    rule's verdict 0 or 1) of every row of ``pages``."""
    rules = RULES if rules is None else rules
    u, h, p, r = (fresh(pages, x) for x in ("url", "host", "path", "rule"))
    base = (pages.withColumn(u, F.coalesce("url", F.lit(""))).withColumn(h, host_of(F.col(u)))
            .withColumn(p, path_of(F.col(u))))
    base = base.select("page_id", F.col(u).alias("url"), F.col(h).alias("host"), F.col(p).alias("path"),
                       rule_of(F.col(h), F.col(p), rules).alias("rule"))
    blocked = [x.name for x in rules if x.verdict == "block"]
    label = F.col("rule").isin(blocked).cast("double") if blocked else F.lit(0.0)
    rows = base.select("*", *[c.alias(k) for k, c in lexical(F.col("url"), F.col("host"), F.col("path")).items()])

    chosen = (base.filter(F.col("rule").isNotNull()).select("url", "host", "path", label.alias("label")).distinct()
              .orderBy(F.xxhash64("url"), "url").limit(TRAIN_ROWS))
    train = staged(chosen.select("label", F.pmod(F.xxhash64(F.lit("half"), "url"), F.lit(2)).cast("int").alias("half"), *[c.alias(k) for k, c in
                                            lexical(F.col("url"), F.col("host"), F.col("path")).items()]), "url-train")
    seen = train.agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("share")).first()
    settled = F.col("rule").isNotNull()
    if not seen["n"] or seen["share"] in (0.0, 1.0):
        score = F.when(settled, label).otherwise(F.lit(seen["share"] or 0.0))
        return _answer(base.withColumn("score", score))
    tables = {s: staged(train.groupBy(s).agg(F.sum("label").alias("blocked"), F.count(F.lit(1)).alias("n")), "url-suffix")
              for s in STATISTICS}
    vector = VectorAssembler(inputCols=FEATURES, outputCol="features")
    # a training URL takes its statistics from the other half, so no label is in its own features
    fit_rows = train
    for s in STATISTICS:
        halves = train.groupBy(s, (1 - F.col("half")).alias("half")).agg(
            F.sum("label").alias("blocked"), F.count(F.lit(1)).alias("n"))
        fit_rows = fit_rows.join(F.broadcast(halves), [s, "half"], "left").withColumn(
            f"{s}_share", _share(seen["share"])).drop("blocked", "n")
    model = GBTClassifier(featuresCol="features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, seed=7).fit(
        vector.transform(fit_rows).select("features", "label"))
    judged = model.transform(vector.transform(_with_shares(rows, tables, seen["share"])))
    score = F.when(settled, label).otherwise(F.get(vector_to_array("probability"), F.lit(1)))
    return _answer(judged.withColumn("score", score))


def _answer(rows: DataFrame) -> DataFrame:
    return rows.select("page_id", "host", "path", "rule",
                       F.when(F.col("score") >= 0.5, "block").otherwise("allow").alias("verdict"), "score")
