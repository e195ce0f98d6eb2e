"""Extraction from database tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import Moment, as_datetime


#: In place of ranges: the table is small, one task reads it.
SINGLE_TASK = "single task"

Ranges = tuple[str, str, str, int]


@dataclass(frozen=True)
class JdbcSource:
    """Where to read from. ``partitions`` says for each table how its read is split, into
    ranges of one column ``(column, lower, upper, number)``; choose an indexed, evenly
    spread one that every extract of the table carries, such as its key. A table is read
    by one task only if ``SINGLE_TASK`` says so."""

    url: str
    properties: dict[str, str] = field(default_factory=dict)
    partitions: dict[str, Ranges | str] = field(default_factory=dict)
    fetchsize: int = 10_000

    def options(self, table: str, query: str | None = None) -> dict[str, str]:
        """Options to read a table, or a query on it in brackets."""
        split = self.partitions.get(table)
        if split is None:
            raise ValueError(f"say how to split {table}, or SINGLE_TASK")
        options = {
            **self.properties,
            "url": self.url,
            "dbtable": query or table,
            "fetchsize": str(self.fetchsize),
            # Database dates carry a time to the second and no zone.
            "preferTimestampNTZ": "true",
        }
        if split != SINGLE_TASK:
            column, lower, upper, number = split
            options |= {
                "partitionColumn": column,
                "lowerBound": lower,
                "upperBound": upper,
                "numPartitions": str(number),
            }
        return options


def jdbc_table(
    spark: SparkSession,
    source: JdbcSource,
    table: str,
    columns: list[str],
    query: str | None = None,
) -> DataFrame:
    """Chosen columns of a source table, or of a query on it in brackets, under the given
    names whatever case the database reports them in; only they are fetched."""
    loaded = spark.read.format("jdbc").options(**source.options(table, query)).load()
    return loaded.select(*[F.col(c).alias(c) for c in columns])


def changed_rows_query(
    table: str, columns: list[str], mark: Moment, update_col: str, create_col: str
) -> str:
    """The extract as the database is to run it.

    Written out rather than left to filter pushdown: not every dialect of Spark renders
    a zone-free time as a literal the database accepts. The escape is JDBC's own, which
    drivers translate.
    """
    at = f"{{ts '{as_datetime(mark).isoformat(sep=' ')}'}}"
    return (
        f"SELECT {', '.join(columns)} FROM {table} "
        f"WHERE {update_col} > {at} OR ({update_col} IS NULL AND {create_col} > {at})"
    )


def jdbc_incremental(
    spark: SparkSession,
    source: JdbcSource,
    table: str,
    columns: list[str],
    mark: Moment,
    update_col: str = "update_dt",
    create_col: str = "create_dt",
) -> DataFrame:
    """Rows changed since the mark; the database evaluates the comparison."""
    query = changed_rows_query(table, columns, mark, update_col, create_col)
    return jdbc_table(spark, source, table, columns, f"({query}) changed")
