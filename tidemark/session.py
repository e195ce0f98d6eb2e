"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# AQE merges small shuffle partitions and splits skewed ones of joins and rebalances. It
# never adds partitions to an aggregate or a window, so the number to start from has to
# follow the data: see ``shuffle_partitions``.
PARTITION_BYTES = 128 << 20
# Spark sends 10,000 rows at once to a Python worker, whatever their length: long texts are held by
# the megabyte on both sides.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    BATCH_BYTES: "1m",
    "spark.ui.showConsoleProgress": "false",
}


def shuffle_partitions(input_bytes: int) -> int:
    """Partitions to start a shuffle of the whole input with: about 128 MB each, 200 at least."""
    return max(200, -(-input_bytes // PARTITION_BYTES))


def build_session(
    app: str = "tidemark",
    master: str | None = None,
    input_bytes: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the library's defaults; ``conf`` wins over them.

    ``input_bytes``, the size of the largest input, sets the number of shuffle partitions.
    On a cluster either it or ``spark.sql.shuffle.partitions`` must be given.
    """
    partitions = "spark.sql.shuffle.partitions"
    if input_bytes is not None:
        conf = {partitions: str(shuffle_partitions(input_bytes)), **conf}
    elif master and not master.startswith("local") and partitions not in conf:
        raise ValueError(f"give input_bytes or {partitions}")
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def bound_batches(spark: SparkSession) -> None:
    """Bound the bytes of the rows that go to a Python worker at once, unless the session has a bound.

    It holds for what the session runs from then on, as results are computed after a stage is described.
    """
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, DEFAULTS[BATCH_BYTES])


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Run one job under other settings and put the old ones back."""
    before = {name: spark.conf.get(name, None) for name in conf}
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; on a cluster a folder of the
    driver's machine would be invisible to the executors, so that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    own = tempfile.mkdtemp(prefix="tidemark-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
