"""The operators with production parameters over the whole sample tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    decontam,
    extraction,
    licenses,
    neardup,
    packing,
    periodic,
    prefix_trie,
    quality,
    repeats,
    secrets,
    simhash,
    templates,
    toxicity,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> packing.Vocabulary:
    """The byte-pair vocabulary of 50,257 ids; each text is closed by id 1."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return packing.Vocabulary.read(path, public_tokenizers.PATTERN, {"<|endoftext|>": 50256}, end=1)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), vocabulary())
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan(table(spark, sf_dir, "documents")))


def op3_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontam.digest(found)


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        F.col("n_hits").cast("long").alias("n_hits"),
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = quality.ledger(table(spark, sf_dir, "documents"))
    judged = quality.apply_policy(entries, "web-1")
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality.passes("base-1")).alias("base_failed"), "kept", "failed",
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.drop_recurring(table(spark, sf_dir, "documents"))


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(repeats.remove_repeats(table(spark, sf_dir, "documents")))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations of each hundred ids share the first turns of that hundred's first, none to five of them."""
    conv = F.col("conv")
    return prefix_trie.prefix_trie(
        table(spark, sf_dir, "conversations"), head=F.crc32(conv.cast("string")) % 6, origin=conv - conv % 100
    )


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return periodic.digest(periodic.periodic_runs(docs, rewrite=periodic.planted))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(simhash.near_duplicates(table(spark, sf_dir, "documents")))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_licenses": op2_licenses,
    "op3_extraction": op3_extraction,
    "op4_decontamination": op4_decontamination,
    "op5_secrets": op5_secrets,
    "op6_toxicity": op6_toxicity,
    "op7_quality": op7_quality,
    "op8_line_dedup": op8_line_dedup,
    "op9_repeats": op9_repeats,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_simhash": op13_simhash,
}

ORACLE: dict[str, str] = {}
