"""Setting processed drops aside."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemark.sources import files
from tidemark.sources.discovery import Drop

SUFFIX = ".backup"


def archive_drops(spark: SparkSession, drops: list[Drop], archive: str) -> list[str]:
    """Move drops to ``<archive>/<name>.backup``. Call it only after the load committed:
    a failed load then finds its files where they were."""
    if drops:
        files.make_folder(spark, archive)
    moved = []
    for drop in drops:
        base = f"{archive.rstrip('/')}/{drop.name}{SUFFIX}"
        target, copies = base, 0
        while files.exists(spark, target):
            copies += 1
            target = f"{base}.{copies}"
        if not files.rename(spark, drop.path, target):
            raise OSError(f"cannot move {drop.path} to {target}")
        moved.append(target)
    return moved
