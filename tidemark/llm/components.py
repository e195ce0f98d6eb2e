"""Connected components of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import scratch_path, shared_dir


def checkpointed(df: DataFrame) -> DataFrame:
    """Written to the shared checkpoint folder, without lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Written as a table to the shared checkpoint folder and read again; smaller than a checkpoint."""
    path = scratch_path(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of a link (a, b); root is the same for nodes that links connect.

    Every round, each node moves to the smallest of itself and its neighbours, and the links move
    along; links within one node vanish. Rounds end when no link is left; only their number is
    seen by the driver. A node with very many links is a partial aggregate, not a group.
    """
    links = checkpointed(links.select("a", "b").where("a <> b").distinct())
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    roots = nodes.select("node", F.col("node").alias("root"))
    while not links.isEmpty():
        both = links.select("a", "b").union(links.select("b", "a"))
        moved = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("to"))
        moved = checkpointed(moved)
        at_a = moved.select(F.col("a"), F.col("to").alias("ta"))
        at_b = moved.select(F.col("a").alias("b"), F.col("to").alias("tb"))
        links = links.join(at_a, "a").join(at_b, "b").select(
            F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")
        )
        links = checkpointed(links.where("a <> b").distinct())
        on = moved.select(F.col("a").alias("root"), "to")
        roots = roots.join(on, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
        roots = checkpointed(roots)
    return roots
