"""The nightly load: feeds and source tables into facts and histories."""

from __future__ import annotations

import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime
from functools import partial
from typing import Protocol

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions.clean import change_time, normalize_keys, seconds_only
from tidemark.functions.times import Moment, as_datetime, high, ntz
from tidemark.operators.facts import (
    bad_text,
    fact_blacklist,
    fact_transactions,
    rejected_lines,
)
from tidemark.operators.scd2 import scd2_apply_incremental, scd2_apply_snapshot
from tidemark.operators.watermark import incremental
from tidemark.plans.store import Commit, Warehouse
from tidemark.sources.archive import archive_drops
from tidemark.sources.delimited import read_delimited
from tidemark.sources.discovery import Drop, file_date, next_day, waiting_days
from tidemark.sources.jdbc import JdbcSource, jdbc_incremental, jdbc_table
from tidemark.sources.workbook import read_workbook

log = logging.getLogger(__name__)

#: The largest time loaded of each table; None if it loaded nothing.
Newest = dict[str, datetime | None]

STG_BANK = {
    "accounts": schemas.STG_ACCOUNTS,
    "cards": schemas.STG_CARDS,
    "clients": schemas.STG_CLIENTS,
}


class Bank(Protocol):
    """The source database: rows of a table changed since a mark, and all its keys."""

    def changes(self, table: str, mark: Moment) -> DataFrame: ...

    def keys(self, table: str) -> DataFrame: ...


def _key_column(table: str) -> str:
    spec = schemas.DIMS[table]
    return next((s for s, t in spec.source_columns.items() if t == spec.key), spec.key)


@dataclass(frozen=True)
class FrameBank:
    """Source tables given as DataFrames."""

    tables: dict[str, DataFrame]

    def changes(self, table: str, mark: Moment) -> DataFrame:
        return incremental(self.tables[table].select(*STG_BANK[table].fieldNames()), mark)

    def keys(self, table: str) -> DataFrame:
        return self.tables[table].select(_key_column(table))


@dataclass(frozen=True)
class JdbcBank:
    """Source tables read over JDBC; ``names`` maps a table to its name in the database."""

    spark: SparkSession
    source: JdbcSource
    names: dict[str, str]

    def changes(self, table: str, mark: Moment) -> DataFrame:
        columns = STG_BANK[table].fieldNames()
        return jdbc_incremental(self.spark, self.source, self.names[table], columns, mark)

    def keys(self, table: str) -> DataFrame:
        return jdbc_table(self.spark, self.source, self.names[table], [_key_column(table)])


def clean_bank_rows(table: str, rows: DataFrame) -> DataFrame:
    """Source rows with the history's names, trimmed text keys and times to the second."""
    spec = schemas.DIMS[table]
    times = [
        f.name for f in rows.schema if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
    ]
    renamed = seconds_only(rows, *times).withColumnsRenamed(spec.source_columns)
    references = {"account_num", "client", "passport_num"} & set(renamed.columns)
    return normalize_keys(renamed, spec.key, *references)


def load_transactions(
    commit: Commit, staged: DataFrame, skip_stored: bool = True, strict: bool = True
) -> Newest:
    """Append a drop of transactions. It is parsed once, by the write of its rows, which also
    yields the times it spans. Rows stored before are left out; a row whose id and time are
    stored with other values is set aside, not lost.

    When not ``strict``, lines that cannot be read are set aside instead of failing the
    run. They are read again for that, only if there are any.
    """
    unread = Observation()
    read = staged
    if not strict:
        read = staged.observe(unread, F.count_if(bad_text(staged).isNotNull()).alias("n"))
    seen = commit.add_transactions(fact_transactions(read, strict), skip_stored)
    if not strict and unread.get["n"]:
        commit.add_unread_lines(rejected_lines(staged))
    return {"transactions": seen["last"]}


def load_blacklist(commit: Commit, staged: DataFrame) -> Newest:
    """Append the passports listed since the mark. Every file repeats the list, and several may
    come together, so equal rows are one."""
    listed = fact_blacklist(staged.select(*schemas.STG_BLACKLIST.fieldNames()), schemas.SEED)
    rows = commit.stage("blacklist", listed, F.col("entry_dt"))
    mark = commit.warehouse.watermark("blacklist")
    commit.add_blacklist(rows.where(F.col("entry_dt") > ntz(mark)).distinct())
    return {"blacklist": commit.newest["blacklist"]}


def _fingerprints(rows: DataFrame, key: str, attrs: list[str], bucket: Column) -> dict[int, tuple]:
    """Of each bucket the number of rows and two hashes of all of them, whatever their order."""
    told = [c for a in attrs for c in (F.col(a), F.col(a).isNull())]
    hashes = (F.xxhash64(key, *told), F.xxhash64(*told, key, F.lit(1)))
    marked = rows.where(F.col(key).isNotNull()).select(
        bucket.alias("b"), *[h.alias(f"h{i}") for i, h in enumerate(hashes)]
    )
    found = marked.groupBy("b").agg(F.count("*"), F.bit_xor("h0"), F.bit_xor("h1"))
    return {r[0]: tuple(r[1:]) for r in found.collect()}


def differing_buckets(
    warehouse: Warehouse, table: str, given: DataFrame, attrs: list[str]
) -> set[int]:
    """Buckets in which the live open rows and the given rows are not the same, by key and attributes.

    Nothing is joined or shuffled but one row per bucket and task. Equal rows given twice make a
    bucket differ, which costs a look at it and changes nothing.
    """
    key = schemas.DIMS[table].key
    live = warehouse.open_rows(table).where(F.col("deleted_flg") == schemas.LIVE)
    bucket = warehouse.bucket(key)
    here, there = (_fingerprints(rows, key, attrs, bucket) for rows in (live, given))
    return {b for b in here.keys() | there.keys() if here.get(b) != there.get(b)}


def load_terminals(commit: Commit, staged: DataFrame, eff_ts: Moment) -> Newest:
    """Apply a full terminal snapshot holding from ``eff_ts``.

    A snapshot older than one already applied is not applied: its gaps would delete
    terminals that came later. Its rows are set aside among the rejected ones.
    """
    spec = schemas.TERMINALS
    loaded = commit.warehouse.watermark("terminals")
    if eff_ts < loaded:
        log.warning("terminals of %s not applied: those of %s are loaded", eff_ts, loaded)
        late = normalize_keys(staged.select(spec.key, *spec.attrs), spec.key).withColumns(
            {
                "effective_from": ntz(eff_ts),
                "effective_to": high(),
                "deleted_flg": F.lit(schemas.LIVE),
            }
        )
        commit.add_rejected("terminals", late)
        return {}
    cleaned = normalize_keys(staged.select(spec.key, *spec.attrs), spec.key)
    snap = commit.stage("terminals", cleaned)
    hit = differing_buckets(commit.warehouse, "terminals", snap, spec.attrs)
    opened = commit.warehouse.open_rows("terminals", hit)
    touched = snap.where(_in_buckets(commit.warehouse, spec.key, hit) | F.col(spec.key).isNull())
    applied = scd2_apply_snapshot(opened, touched, spec.key, spec.attrs, eff_ts)
    commit.put_history("terminals", applied, hit)
    return {"terminals": as_datetime(eff_ts)}


def _in_buckets(warehouse: Warehouse, key: str, buckets: set[int]) -> Column:
    return warehouse.bucket(key).isin(sorted(buckets))


def load_bank_table(commit: Commit, bank: Bank, table: str, run_ts: Moment) -> Newest:
    """Apply the changes of a source table, and its deletions by comparing all keys.

    Only the folders of changed, new, deleted and returned keys are read whole and rewritten.
    """
    spec, warehouse = schemas.DIMS[table], commit.warehouse
    changed = clean_bank_rows(table, bank.changes(table, warehouse.watermark(table)))
    changes = commit.stage(table, changed, change_time())
    keys = commit.stage(f"{table}_keys", clean_bank_rows(table, bank.keys(table)))
    bucket = warehouse.bucket(spec.key)
    hit = {r[0] for r in changes.select(bucket).distinct().collect()}
    hit |= differing_buckets(warehouse, table, keys, [])
    applied = scd2_apply_incremental(
        warehouse.open_rows(table, hit),
        changes.withColumn("change_ts", change_time()),
        spec.key,
        spec.attrs,
        "change_ts",
        run_ts,
        keys.where(_in_buckets(warehouse, spec.key, hit)),
    )
    commit.put_history(table, applied, hit)
    return {table: commit.newest[table]}


def read_blacklist(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return read_workbook(spark, paths, "blacklist", schemas.STG_BLACKLIST, dates=("entry_dt",))


def read_terminals(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Terminals with the business date of their file."""
    rows = read_workbook(spark, paths, "terminals", schemas.STG_TERMINALS_DRAFT)
    return rows.withColumn("file_date", file_date(F.col("path"))).drop("path")


def load_together(steps: list[Callable[[], Newest]]) -> Newest:
    """Load tables side by side. They do not depend on each other, so the jobs of small
    ones fill what those of large ones leave idle. Any failure fails the run."""
    newest: Newest = {}
    with ThreadPoolExecutor(len(steps)) as pool:
        for done in [pool.submit(step) for step in steps]:
            newest |= done.result()
    return newest


def run_load(
    warehouse: Warehouse,
    feeds: str,
    bank: Bank,
    run_ts: Moment,
    archive: str | None = None,
    skip_stored: bool = True,
    strict: bool = False,
) -> list[Drop]:
    """Load the drops of the oldest waiting day and the changes of the source tables.

    All or nothing: tables and marks change together at the end, any failure leaves the
    warehouse as it was, and the drops are set aside only after that. A second run over
    the same input changes nothing. Lines of transactions that cannot be read are kept aside, or
    fail the run when ``strict``. ``run_ts`` stamps deletions in the source tables.
    """
    spark = warehouse.spark
    drops = next_day(spark, feeds)
    commit = warehouse.begin()

    path = drops["transactions"].path
    lines = read_delimited(spark, path, schemas.STG_TRANSACTIONS, keep_bad=not strict)
    listed = read_blacklist(spark, drops["blacklist"].path)
    terminals = read_terminals(spark, drops["terminals"].path)
    steps: list[Callable[[], Newest]] = [
        lambda: load_transactions(commit, lines, skip_stored, strict),
        lambda: load_blacklist(commit, listed),
        lambda: load_terminals(commit, terminals, drops["terminals"].date),
        *[partial(load_bank_table, commit, bank, table, run_ts) for table in STG_BANK],
    ]
    commit.advance_watermarks(load_together(steps))
    commit.publish()

    if archive:
        archive_drops(spark, list(drops.values()), archive)
    return list(drops.values())


def run_backlog(
    warehouse: Warehouse, feeds: str, bank: Bank, run_ts: Moment, archive: str
) -> int:
    """Load waiting drops day by day, oldest first, until none is left. A day that lacks the drop of
    a feed is an error, raised once the days before it are loaded."""
    loads = 0
    while waiting_days(warehouse.spark, feeds):
        run_load(warehouse, feeds, bank, run_ts, archive)
        loads += 1
    return loads
