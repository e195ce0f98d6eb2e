"""Stored high-water marks: what has been loaded up to when."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import Moment, as_datetime, ntz
from tidemark.schemas import DBNAME, SEED, WATERMARK, WATERMARKED


def seed_watermarks(spark: SparkSession) -> DataFrame:
    """One row per watermarked table, below the earliest date of any source."""
    return spark.createDataFrame([(DBNAME, t, SEED) for t in WATERMARKED], WATERMARK)


def read_watermark(watermarks: DataFrame, table: str) -> datetime:
    """The mark of one table as a driver value, so that it can reach a source's filter.

    A table without a row has not been loaded yet. Two rows are an error.
    """
    rows = watermarks.where(F.col("tablename") == table).select("last_update").take(2)
    if len(rows) > 1:
        raise ValueError(f"several watermarks for {table}")
    return as_datetime(rows[0][0]) if rows else SEED


def changed_since(update_col: str, create_col: str, mark: Moment) -> Column:
    """``coalesce(update, create) > mark``, spelled so that sources can evaluate it.

    A ``coalesce`` is not pushed to JDBC or Parquet; these plain comparisons are.
    """
    u, c, at = F.col(update_col), F.col(create_col), ntz(mark)
    return (u > at) | (u.isNull() & (c > at))


def incremental(
    source: DataFrame,
    mark: Moment,
    update_col: str = "update_dt",
    create_col: str = "create_dt",
) -> DataFrame:
    """Rows that changed strictly after the mark."""
    return source.where(changed_since(update_col, create_col, mark))


def advance_watermark(
    watermarks: DataFrame, newest: dict[str, tuple[DataFrame, Column]]
) -> DataFrame:
    """Raise the mark of each named table to the largest time among its loaded rows.

    ``newest`` gives, per table, the loaded rows and the time expression. A table that
    loaded nothing keeps its mark, and a mark never moves back. Each maximum is a
    partial and a final aggregate; only one row per table is joined.
    """
    found: DataFrame | None = None
    for table, (rows, time) in newest.items():
        one = rows.agg(F.max(time).alias("_newest")).select(
            F.lit(table).alias("tablename"), "_newest"
        )
        found = one if found is None else found.unionByName(one)
    if found is None:
        return watermarks
    return watermarks.join(found, "tablename", "left").select(
        *[c for c in watermarks.columns if c != "last_update"],
        F.greatest("last_update", "_newest").alias("last_update"),
    )
