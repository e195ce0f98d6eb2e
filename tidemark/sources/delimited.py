"""Delimited text feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Options of the text feed: header row, semicolon, columns bound by position. Rows of
# another width fail the read rather than shift values. One row per line, so that
# large files are split.
FEED_OPTIONS = {
    "sep": ";",
    "header": "true",
    # a quote inside quoted text is doubled; a backslash is an ordinary character
    "escape": '"',
    "enforceSchema": "true",
    "mode": "FAILFAST",
    "columnPruning": "false",
    "multiLine": "false",
}


#: Column with the whole line where its width is wrong, else NULL.
BAD_LINE = "_bad_line"
KEEP_BAD = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE}


def read_delimited(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType,
    keep_bad: bool = False,
    **options: str,
) -> DataFrame:
    """Feed files as text columns named by ``schema``; nothing is inferred, so ids keep
    their leading zeros. ``keep_bad``: lines of another width are kept in ``BAD_LINE``
    rather than failing the read."""
    bad = KEEP_BAD if keep_bad else {}
    if keep_bad:
        schema = with_bad_line(schema)
    return spark.read.options(**{**FEED_OPTIONS, **bad, **options}).schema(schema).csv(paths)


def with_bad_line(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())])


def write_delimited(df: DataFrame, path: str) -> None:
    """Write a drop of the text feed."""
    df.write.options(sep=";", header="true", escape='"').mode("error").csv(path)
