"""Cleaning of text that comes from feeds and source tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import to_second

# The three date patterns the feeds use.
SECOND_PATTERN = "yyyy-MM-dd HH:mm:ss"
DAY_PATTERN = "yyyy-MM-dd"
DOTTED_DAY_PATTERN = "dd.MM.yyyy"


def normalize_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Trim blanks from text keys; an empty key becomes NULL.

    Every key is trimmed once, at ingest. A padded copy of a key would otherwise never
    match its trimmed twin and the record would look deleted.
    """
    text = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.withColumns(
        {k: F.nullif(F.trim(F.col(k)), F.lit("")) for k in keys if k in text}
    )


def parse_dates(col: Column, pattern: str, strict: bool = True) -> Column:
    """Text to zone-free timestamp. Bad text raises, or gives NULL when not ``strict``."""
    if strict:
        return F.to_timestamp_ntz(col, F.lit(pattern))
    return F.try_to_timestamp(col, F.lit(pattern)).cast("timestamp_ntz")


def to_iso_text(col: Column) -> Column:
    """Date to ``yyyy-MM-dd`` text."""
    return F.date_format(col, DAY_PATTERN)


def parse_amount(col: Column, precision: int = 18, scale: int = 2, strict: bool = True) -> Column:
    """Text with a decimal comma (or point) to a decimal. Cents are kept. Bad text raises, or
    gives NULL when not ``strict``."""
    text, kind = F.replace(F.trim(col), F.lit(","), F.lit(".")), T.DecimalType(precision, scale)
    return text.cast(kind) if strict else text.try_cast(kind)


def change_time(update_col: str = "update_dt", create_col: str = "create_dt") -> Column:
    """When a source row last changed: its update time, else its create time."""
    return F.coalesce(F.col(update_col), F.col(create_col))


def full_name(*parts: str) -> Column:
    """Parts joined by one blank; a missing part counts as empty text but keeps its blank."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit(" "))
        pieces.append(F.coalesce(F.col(part), F.lit("")))
    return F.concat(*pieces)


def seconds_only(df: DataFrame, *cols: str) -> DataFrame:
    """Cut the given time columns to the second."""
    return df.withColumns({c: to_second(F.col(c)) for c in cols})
