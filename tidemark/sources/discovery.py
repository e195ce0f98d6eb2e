"""Finding the daily drops of each feed."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.clean import parse_dates
from tidemark.sources import files

# The feeds and how their daily drops are named; the eight digits are
# the business date, day first.
FEED_NAMES = {
    "blacklist": r"passport_blacklist_\d{8}\.xlsx",
    "transactions": r"transactions_\d{8}\.txt",
    "terminals": r"terminals_\d{8}\.xlsx",
}
FILE_DATE_PATTERN = "ddMMyyyy"
_STAMP = r"(?:passport_blacklist|transactions|terminals)_(\d{8})\."


class MissingFeedError(Exception):
    """A feed has no drop waiting."""


@dataclass(frozen=True)
class Drop:
    """One daily drop: a file, or a folder of part files under the same name."""

    feed: str
    path: str
    date: datetime

    @property
    def name(self) -> str:
        return self.path.rsplit("/", 1)[-1]


def discover_feed(spark: SparkSession, folder: str, feed: str) -> list[Drop]:
    """The waiting drops of a feed, oldest business date first."""
    pattern = re.compile(FEED_NAMES[feed])
    found = [
        Drop(
            feed,
            f"{folder.rstrip('/')}/{name}",
            datetime.strptime(re.search(r"\d{8}", name).group(), "%d%m%Y"),
        )
        for name in files.list_names(spark, folder)
        if pattern.fullmatch(name)
    ]
    return sorted(found, key=lambda drop: drop.date)


def next_drop(spark: SparkSession, folder: str, feed: str) -> Drop:
    """The oldest waiting drop; it is an error if there is none."""
    waiting = discover_feed(spark, folder, feed)
    if not waiting:
        raise MissingFeedError(f"no drop of feed {feed!r} in {folder}")
    return waiting[0]


def waiting_days(spark: SparkSession, folder: str) -> dict[datetime, dict[str, Drop]]:
    """The waiting drops of all feeds by business date, oldest first. A day on which a feed has no drop
    lacks it in its entry."""
    days: dict[datetime, dict[str, Drop]] = {}
    for feed in FEED_NAMES:
        for drop in discover_feed(spark, folder, feed):
            days.setdefault(drop.date, {})[feed] = drop
    return dict(sorted(days.items()))


def next_day(spark: SparkSession, folder: str) -> dict[str, Drop]:
    """The drops of the oldest waiting day. It is an error if any feed has none for that day: days are
    never mixed, and none is passed over."""
    days = waiting_days(spark, folder)
    if not days:
        raise MissingFeedError(f"no drop of any feed in {folder}")
    day, drops = next(iter(days.items()))
    gaps = {d.date().isoformat(): sorted(set(FEED_NAMES) - set(found)) for d, found in days.items()}
    if missing := gaps[day.date().isoformat()]:
        others = {d: m for d, m in gaps.items() if m}
        raise MissingFeedError(f"{day.date()} has no drop of {', '.join(missing)}; gaps: {others}")
    return drops


def file_date(path: Column) -> Column:
    """Business date from the drop's name anywhere in a file path."""
    return parse_dates(F.regexp_extract(path, _STAMP, 1), FILE_DATE_PATTERN)


def stamp_file_date(df: DataFrame, out: str = "file_date") -> DataFrame:
    """Add the business date to rows read straight from feed files."""
    return df.withColumn(out, file_date(F.col("_metadata.file_path")))
