"""From raw documents to packed training sequences, in five stages.

Each stage is a function of (spark, docs, sf_dir), of the whole table that the one before it kept,
and but for the last returns the columns of documents. `run` writes each stage's result as Parquet
below the shared checkpoint folder and reads it again for the next, so a lost executor costs at
most a stage's tasks, never the stages before.

Null texts pass the first stages as empty texts would; rows with null in other columns are kept;
an empty table gives an empty result. A stage bounds the bytes of a batch for Python workers, so texts of any
usual length pass in an executor's memory.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, neardup, packing, templates, toxicity
from tidemark.llm.queries import table, vocabulary
from tidemark.session import bound_batches, scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
OTHERS = ("lang", "source", "n_chars")
#: Score from which a document is rejected as toxic.
REJECT = 0.3

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def bounded(stage: Stage) -> Stage:
    """The stage, with batches of bounded bytes."""

    @wraps(stage)
    def begun(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        return stage(spark, docs, sf_dir)

    return begun


@bounded
def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below REJECT; the model learns from the labelled rows of this table."""
    model = toxicity.learn(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select(*COLUMNS, F.col("text").alias("original")).select(
        *(F.col(c) for c in COLUMNS), "original"
    ), model)
    kept = scored.where(F.col("score") < REJECT)
    return kept.select("doc_id", F.col("original").alias("text"), *OTHERS)


@bounded
def boilerplate_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines whose template recurs; n_chars follows the text."""
    cleaned = templates.drop_recurring(docs, keep=OTHERS)
    n_chars = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.select("doc_id", "text", "lang", "source", n_chars.alias("n_chars"))


@bounded
def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one of the smallest id."""
    return neardup.near_duplicates(docs, keep=("text", *OTHERS)).where("chosen").select(*COLUMNS)


@bounded
def contaminated_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark passages."""
    found = decontam.digest(
        decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"), keep=("text", *OTHERS))
    )
    return found.where(~F.col("contaminated")).select(*COLUMNS)


@bounded
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in training sequences."""
    pieces = packing.pack(docs, vocabulary())
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("toxicity", toxic_out),
    ("line_dedup", boilerplate_out),
    ("near_dedup", near_duplicates_out),
    ("decontamination", contaminated_out),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


#: Learning, sketching and tokenising have no SQL.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
