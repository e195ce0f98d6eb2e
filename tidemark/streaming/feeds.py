"""Feeds as streams: whatever waits in the folder is loaded once, then the query ends.

The stream's checkpoint remembers which files were read, and the warehouse remembers the
last batch it took over, so a batch repeated after a failure is not applied twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark import schemas
from tidemark.plans.load import (
    Newest,
    load_blacklist,
    load_terminals,
    load_transactions,
    read_terminals,
)
from tidemark.plans.store import Commit, Warehouse
from tidemark.sources.delimited import FEED_OPTIONS, KEEP_BAD, with_bad_line
from tidemark.sources.discovery import file_date
from tidemark.sources.workbook import workbook_rows

# The feed names as globs.
_DIGITS = "[0-9]" * 8
GLOBS = {
    "blacklist": f"passport_blacklist_{_DIGITS}.xlsx",
    "transactions": f"transactions_{_DIGITS}.txt",
    "terminals": f"terminals_{_DIGITS}.xlsx",
}

BINARY_FILE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def feed_source(
    spark: SparkSession, folder: str, feed: str, archive: str | None = None
) -> DataFrame:
    """The feed as a streaming DataFrame; read files may be moved to ``archive``.

    A drop may be a file or a folder of part files under the drop's name. Spark moves a
    file only after a later batch has committed.
    """
    drops = f"{folder.rstrip('/')}/{GLOBS[feed]}"
    reader = spark.readStream
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if feed == "transactions":
        lines = with_bad_line(schemas.STG_TRANSACTIONS)
        return reader.options(**{**FEED_OPTIONS, **KEEP_BAD}).schema(lines).csv(drops)
    return reader.format("binaryFile").schema(BINARY_FILE).load(drops)


def _publish(commit: Commit, newest: Newest, feed: str | None, batch_id: int) -> None:
    commit.advance_watermarks(newest)
    if feed:
        commit.put_stream_batch(feed, batch_id)
    commit.publish()


def _take_transactions(warehouse: Warehouse, batch: DataFrame, batch_id: int) -> None:
    commit = warehouse.begin()
    newest = load_transactions(commit, batch, strict=False)
    _publish(commit, newest, "transactions", batch_id)


def _take_blacklist(warehouse: Warehouse, batch: DataFrame, batch_id: int) -> None:
    rows = workbook_rows(batch, "blacklist", schemas.STG_BLACKLIST, dates=("entry_dt",))
    commit = warehouse.begin()
    newest = load_blacklist(commit, rows)
    _publish(commit, newest, "blacklist", batch_id)


def _take_terminals(warehouse: Warehouse, batch: DataFrame, batch_id: int) -> None:
    # Each day is a full snapshot, so the days are applied one after the other. A batch
    # repeated after a failure skips the days already applied.
    # The names alone are looked at for the days, and each workbook is read once, for its own.
    named = batch.select("path", file_date(F.col("path")).alias("day")).distinct().collect()
    days = sorted({r.day for r in named})
    for day in days:
        rows = read_terminals(warehouse.spark, [r.path for r in named if r.day == day])
        commit = warehouse.begin()
        newest = load_terminals(commit, rows, day)
        _publish(commit, newest, "terminals" if day == days[-1] else None, batch_id)


_TAKERS = {
    "transactions": _take_transactions,
    "blacklist": _take_blacklist,
    "terminals": _take_terminals,
}


def feed_stream(
    warehouse: Warehouse,
    folder: str,
    feed: str,
    archive: str | None = None,
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Load everything that waits of one feed. Start it again when new files arrive.

    All feeds publish to the same manifest, so run one load at a time: of two at once
    the second fails and takes its batch again when restarted.
    """
    take = _TAKERS[feed]

    def apply(batch: DataFrame, batch_id: int) -> None:
        done = warehouse.manifest()["streams"].get(feed, -1)
        if batch_id > done:
            take(warehouse, batch, batch_id)

    return (
        feed_source(warehouse.spark, folder, feed, archive)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint or f"{warehouse.root}/checkpoints/{feed}")
        .trigger(availableNow=True)
        .start()
    )
