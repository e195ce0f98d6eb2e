"""Feeds and source tables."""

from tidemark.sources.archive import archive_drops
from tidemark.sources.delimited import read_delimited, write_delimited
from tidemark.sources.discovery import (
    Drop,
    MissingFeedError,
    discover_feed,
    file_date,
    next_day,
    next_drop,
    stamp_file_date,
    waiting_days,
)
from tidemark.sources.jdbc import SINGLE_TASK, JdbcSource, jdbc_incremental, jdbc_table
from tidemark.sources.workbook import WorkbookError, read_workbook, workbook_rows

__all__ = [
    "SINGLE_TASK",
    "Drop",
    "JdbcSource",
    "MissingFeedError",
    "WorkbookError",
    "archive_drops",
    "discover_feed",
    "file_date",
    "jdbc_incremental",
    "jdbc_table",
    "next_day",
    "next_drop",
    "read_delimited",
    "read_workbook",
    "stamp_file_date",
    "workbook_rows",
    "write_delimited",
    "waiting_days",
]
