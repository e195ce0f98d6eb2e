"""Reading history tables, and checking them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import Moment, before, high, ntz
from tidemark.operators.chain import with_first, with_successor
from tidemark.schemas import LIVE


def is_open() -> Column:
    return F.col("effective_to") == high()


def dim_current(history: DataFrame) -> DataFrame:
    """Open versions, tombstones included."""
    return history.where(is_open())


def dim_as_of(history: DataFrame, moment: Moment) -> DataFrame:
    """Versions valid at ``moment``, both ends included, and not deleted.

    The three predicates are plain comparisons and reach the Parquet scan; closed
    versions are stored per run, so their row groups are skipped by ``effective_to``.
    """
    at = ntz(moment)
    return history.where(
        (F.col("effective_from") <= at)
        & (F.col("effective_to") >= at)
        & (F.col("deleted_flg") == LIVE)
    )


def dim_first_seen(
    history: DataFrame,
    key: str,
    start: str = "effective_from",
    out: str = "first_seen",
    hot_rows: int | None = None,
) -> DataFrame:
    """Add when each key was first seen: the running minimum of ``start``.

    Taken over all versions of the key. In start order the running minimum is the
    minimum itself. ``hot_rows``: how many rows make a key hot, see ``chain``.
    """
    return with_first(history, key, start, out, hot_rows)


def validate_history(history: DataFrame, key: str) -> DataFrame:
    """Number of violations per rule, as ``(check_name, violations)``; all zero if sound.

    ``open_rows``        keys that do not have exactly one open version
    ``reversed``         versions that end before they start
    ``duplicate_start``  (key, start) pairs held by several versions
    ``broken_chain``     versions not ending one second before their successor starts,
                         whether they overlap it or leave a gap
    """
    keys = history.groupBy(key).agg(F.count_if(is_open()).alias("n"))
    starts = history.groupBy(key, "effective_from").agg(
        F.count("*").alias("n"), F.max("effective_to").alias("effective_to")
    )
    chain = with_successor(starts, key, "effective_from", counted=history)

    def tally(df: DataFrame, name: str, broken: Column) -> DataFrame:
        return df.agg(F.count_if(broken).alias("violations")).select(
            F.lit(name).alias("check_name"), "violations"
        )

    return (
        tally(keys, "open_rows", F.col("n") != 1)
        .unionByName(tally(history, "reversed", F.col("effective_from") > F.col("effective_to")))
        .unionByName(tally(starts, "duplicate_start", F.col("n") > 1))
        .unionByName(
            tally(chain, "broken_chain", F.col("effective_to") != before(F.col("next_from")))
        )
    )
