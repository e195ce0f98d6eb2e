"""Zone-free timestamps to the second.

``to_timestamp``, ``lit(datetime)`` and ``date_trunc`` return zoned timestamps and
``coalesce`` widens to them, so every time expression goes through these helpers.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schemas import HIGH

Moment = datetime | date | str | Column


def as_datetime(value: datetime | date | str) -> datetime:
    """A driver-side moment, cut to the second."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    elif not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)
    return value.replace(microsecond=0, tzinfo=None)


def ntz(value: Moment) -> Column:
    """Zone-free timestamp of a column, a datetime or an ISO text."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    return F.expr(f"TIMESTAMP_NTZ '{as_datetime(value).isoformat(sep=' ')}'")


def to_second(col: Column) -> Column:
    """Cut to the second: validity intervals leave a one-second gap between versions,
    so a fraction of a second would fall between two of them. Only the fraction passes
    through the session's zone, which cannot change it."""
    fraction = F.date_part(F.lit("SECONDS"), col) % 1
    return ntz(col) - F.make_dt_interval(secs=fraction)


def before(col: Column) -> Column:
    """Last second before ``col``: where a version ends when the next one starts."""
    return col - F.expr("INTERVAL 1 SECOND")


def high() -> Column:
    return ntz(HIGH)
