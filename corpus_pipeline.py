"""Corpus pipeline: documents through five operators, each stage's rows written
and read again as the next one's documents.

``run(spark, sf_dir)`` returns the packed sequences of the documents that the
rules, the toxicity model and the near-duplicate stage keep.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from varzea.llm import quality_rules, simhash, substring_dedup, toxicity
from varzea.llm.common import read_table, ship, staged
from varzea.llm.queries import pack_all


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current rule policy keeps."""
    ship(spark)
    return quality_rules.keep_good(docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.5."""
    return toxicity.keep_clean(docs, read_table(spark, sf_dir, "labels"))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each near-duplicate component."""
    ship(spark)
    return simhash.keep_first(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that an earlier document or place has."""
    ship(spark)
    return substring_dedup.remove_repeats(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences."""
    ship(spark)
    return pack_all(docs)


STAGES = [("quality_rules", quality_stage), ("toxicity", toxicity_stage), ("simhash_dedup", simhash_stage),
          ("substring_dedup", substring_stage), ("best_fit_packing", packing_stage)]

#: The learned, hashed and packed stages are beyond SQL; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
