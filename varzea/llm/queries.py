"""Registered queries of the operators, opN_<name>, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varzea.llm import (bpe, collocations, embedding_join, licenses, packing, quality_rules, simhash, spelling,
                        substring_dedup, suffix_dedup, token_files, toxicity, url_filter)
from varzea.llm.common import read_table, shared_folder
from varzea.llm.oracles import ORACLES  # noqa: F401


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents")).drop("spans")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predictions(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_all(read_table(spark, sf_dir, "documents"))


def pack_all(docs: DataFrame) -> DataFrame:
    """Packing with the byte-level vocabulary (its rank file holds the same ids)."""
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.tiktoken"), {"<|endoftext|>": 50256})


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(read_table(spark, sf_dir, "documents"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.linked_vectors(read_table(spark, sf_dir, "embeddings"))


def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(read_table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read_table(spark, sf_dir, "pages"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = quality_rules.apply_policy(quality_rules.ledger(read_table(spark, sf_dir, "documents")))
    base = quality_rules.POLICIES["base"]
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      (F.col("fail_bits").bitwiseAND(F.lit(base)) != 0).alias("base_failed"), "kept", "fail_bits")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read_table(spark, sf_dir, "documents"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    manifest = token_files.write(docs, shared_folder(spark, "ids"), vocabulary("word_bpe_49k.json"))
    return token_files.read(manifest)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


def vocabulary(name: str) -> str:
    """Place of a published vocabulary file."""
    import public_tokenizers
    return public_tokenizers.path(name)


QUERIES = {f.__name__: f for f in [op1_license_scan, op2_toxicity, op3_simhash_dedup, op4_best_fit_packing,
                                   op5_suffix_array_dedup, op6_embedding_dedup, op7_bpe_round_trip, op8_substring_dedup, op9_url_filter,
                                   op10_quality_rules, op11_spelling_variants, op12_token_files, op13_collocations]}
