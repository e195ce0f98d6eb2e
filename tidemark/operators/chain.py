"""Per-key time chains that stay splittable when one key owns much of the data.

A plain ``lead(start) OVER (PARTITION BY key ORDER BY start)`` sends every row of a key
to one task. That is fine, and cheapest, for all but a few keys. So the rows are counted
first, and only those of *hot* keys are divided further, by calendar month. Times are
whole seconds, so a month of one key holds at most 31 * 86,400 distinct starts, however
large the key is. One narrow row per (hot key, month) then links the months.

The count runs when the operator is called. For stored rows it reads file footers only,
and up to ``HOT_ROWS`` rows, as on most nights, it is all there is: no key can be hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "_bucket"

# A key is hot when it has more rows than this, and than this share of all rows. So
# there are fewer than MAX_HOT_KEYS hot keys, whatever the data.
HOT_ROWS = 1_000_000
MAX_HOT_KEYS = 10_000


def hot_keys(
    rows: DataFrame, key: str, hot_rows: int | None = None, nulls: bool = False
) -> DataFrame | None:
    """The hot keys of ``rows``, small enough to broadcast, or None if no key is hot.

    ``hot_rows`` takes the place of ``HOT_ROWS``. ``nulls``: NULL can be a hot key too.
    """
    at_least = HOT_ROWS if hot_rows is None else hot_rows
    total = rows.count()
    if total <= at_least:
        return None
    limit = max(at_least, total / MAX_HOT_KEYS)
    found = rows.groupBy(key).count().where(F.col("count") > limit)
    if not nulls:
        found = found.where(F.col(key).isNotNull())
    hot = found.select(key).collect()
    return F.broadcast(rows.sparkSession.createDataFrame(hot, found.schema[:1])) if hot else None


def bucketed(rows: DataFrame, hot: DataFrame, key: str, start: str) -> DataFrame:
    """Add ``_bucket``: months since year 0 for hot keys, -1 without a time; 0 for others."""
    month = F.coalesce(F.year(start) * 12 + F.month(start), F.lit(-1))
    marked = rows.join(hot.withColumn("_hot", F.lit(True)), key, "left")
    return marked.withColumn(BUCKET, F.when(F.col("_hot"), month).otherwise(0)).drop("_hot")


def month_links(divided: DataFrame, key: str, start: str, **extra: Column) -> DataFrame:
    """One row per (hot key, month): ``_next_head``, the first start in the key's next
    month that has one, and the ``extra`` aggregates. Pre-aggregated before its shuffle."""
    by_month = Window.partitionBy(key).orderBy(BUCKET)
    return (
        divided.where(F.col(BUCKET) != 0)
        .groupBy(key, BUCKET)
        .agg(F.min(start).alias("_head"), *[agg.alias(name) for name, agg in extra.items()])
        .withColumn("_next_head", F.lead("_head").over(by_month))
        .drop("_head")
    )


def with_successor(
    rows: DataFrame,
    key: str,
    start: str,
    out: str = "next_from",
    counted: DataFrame | None = None,
) -> DataFrame:
    """Add the start of the key's next row, NULL on its last one.

    ``(key, start)`` must be unique; ``one_row_per`` makes it so. ``counted`` are the
    rows to look for hot keys in: cheaper ones to count, with no fewer rows for a key
    that has several.
    """
    hot = hot_keys(rows if counted is None else counted, key)
    if hot is None:
        return rows.withColumn(out, F.lead(start).over(Window.partitionBy(key).orderBy(start)))
    divided = bucketed(rows, hot, key, start)
    inside = Window.partitionBy(key, BUCKET).orderBy(start)
    return (
        divided.withColumn(out, F.lead(start).over(inside))
        .join(month_links(divided, key, start), [key, BUCKET], "left")
        .withColumn(out, F.coalesce(out, "_next_head"))
        .select(*rows.columns, out)
    )


def with_first(
    rows: DataFrame, key: str, start: str, out: str, hot_rows: int | None = None
) -> DataFrame:
    """Add the smallest ``start`` of the key. Rows of hot keys, and of a missing key if
    they are as many, are not grouped at all: the minima of these few keys are broadcast
    to them."""
    hot, first = hot_keys(rows, key, hot_rows, nulls=True), F.min(start)
    of_key = first.over(Window.partitionBy(key))
    if hot is None:
        return rows.withColumn(out, of_key)
    hot = F.broadcast(hot.withColumnRenamed(key, "_hot_key"))
    same = F.col(key).eqNullSafe(F.col("_hot_key"))
    minima = F.broadcast(rows.join(hot, same).groupBy("_hot_key").agg(first.alias(out)))
    others = rows.join(hot, same, "left_anti").withColumn(out, of_key)
    return rows.join(minima, same).select(*rows.columns, out).unionByName(others)


def one_row_per(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """One row per key, repeatably: of conflicting copies the largest ``values`` wins.

    Written as an aggregate so that copies collapse before the shuffle; a key with any
    number of copies costs each reading task one row.
    """
    if not values:
        return df.select(*keys).distinct()
    return (
        df.groupBy(*keys)
        .agg(F.max(F.struct(*values)).alias("_best"))
        .select(*keys, *[F.col(f"_best.{v}").alias(v) for v in values])
    )
