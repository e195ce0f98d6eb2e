"""The warehouse on shared storage: Parquet folders and one manifest naming the live ones.

A run writes new folders, which nobody reads yet, and then publishes one manifest. So a
run shows whole or not at all, whatever fails on the way, and several tables change
together. Nothing is updated in place: the open part of a history is replaced, its
closed part and the facts only grow.

    <root>/manifests/00000007.json      the latest number is current
    <root>/data/<table>/v=7-<id>/...    what version 7 added
    <root>/staging/7-<id>/<table>       input of the run that makes version 7, until then

The open part of a history lies in folders by hash of the key, and a load rewrites those in which
something changes. Beside each folder of transactions the manifest keeps the times it spans, so
a read for some days opens, and lists, only the folders that have some of them.
"""

from __future__ import annotations

import copy
import json
import re
import uuid
from datetime import datetime, timedelta
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions.times import Moment, as_datetime, ntz
from tidemark.operators.facts import append_fact, differing_copies
from tidemark.operators.scd2 import CLOSED, OPEN, REJECTED, STATE
from tidemark.operators.watermark import seed_watermarks
from tidemark.sources import files

FACTS = {
    "transactions": schemas.FACT_TRANSACTIONS,
    "transactions_rejected": schemas.FACT_TRANSACTIONS,
    "blacklist": schemas.FACT_BLACKLIST,
}
MONTH = "trans_month"
BUCKET = "key_bucket"
#: Folders of an open set. A new warehouse may choose: about 256 MB each in its largest dimension.
BUCKETS = 16
LINES = T.StructType([T.StructField("line", T.StringType()), T.StructField("reason", T.StringType())])
UNDATED = "__HIVE_DEFAULT_PARTITION__"


class ConcurrentLoadError(Exception):
    """Another run published first; this one must start again from its result."""


class Warehouse:
    """Reads what the latest manifest names."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    @classmethod
    def bootstrap(cls, spark: SparkSession, root: str, buckets: int = BUCKETS) -> Warehouse:
        """Create the empty tables and seed the high-water marks; an existing warehouse
        is opened as it is."""
        warehouse = cls(spark, root)
        if warehouse._versions():
            return warehouse
        return warehouse.reset(buckets)

    def reset(self, buckets: int | None = None) -> Warehouse:
        """Publish empty tables and seeded marks. Earlier versions stay until expired."""
        versions = self._versions()
        empty = {
            "version": versions[-1] + 1 if versions else 0,
            "buckets": buckets or (self.manifest()["buckets"] if versions else BUCKETS),
            "watermarks": {
                row["tablename"]: row["last_update"].isoformat()
                for row in seed_watermarks(self.spark).collect()
            },
            "tables": {
                **{name: {OPEN: [], CLOSED: [], REJECTED: []} for name in schemas.DIMS},
                **{name: {"parts": []} for name in FACTS},
            },
            "reports": {},
            "streams": {},
        }
        self._publish(empty)
        return self

    # Manifests.

    def _versions(self) -> list[int]:
        names = files.list_names(self.spark, f"{self.root}/manifests")
        return sorted(int(n[:8]) for n in names if re.fullmatch(r"\d{8}\.json", n))

    def _manifest_path(self, version: int) -> str:
        return f"{self.root}/manifests/{version:08d}.json"

    def manifest(self, version: int | None = None) -> dict:
        if version is None:
            version = self._versions()[-1]
        return json.loads(files.read_text(self.spark, self._manifest_path(version)))

    def _publish(self, manifest: dict) -> None:
        target = self._manifest_path(manifest["version"])
        draft = f"{self.root}/manifests/_draft-{uuid.uuid4().hex}"
        files.write_text(self.spark, draft, json.dumps(manifest, indent=1, sort_keys=True))
        if not files.rename(self.spark, draft, target):
            raise ConcurrentLoadError(target)

    def begin(self) -> Commit:
        return Commit(self)

    # Reading.

    def _read(
        self, table: str, folders: list[str], schema: T.StructType, partitions: T.StructType
    ) -> DataFrame:
        full = T.StructType([*schema.fields, *partitions.fields])
        if not folders:
            return self.spark.createDataFrame([], full)
        discovered = T.StructType([*full.fields, T.StructField("v", T.StringType())])
        return (
            self.spark.read.schema(discovered)
            .option("basePath", f"{self.root}/data/{table}")
            .parquet(*[f"{self.root}/{f}" for f in folders])
            .select(*full.fieldNames())
        )

    def _flat(self, folders: list[str], schema: T.StructType) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f}" for f in folders])

    def history(self, name: str, *states: str, buckets: set[int] | None = None) -> DataFrame:
        """Versions of a dimension; by default the open and the closed ones. The part is
        a folder level, so reading only the open set opens no closed file. ``buckets``: of
        the open set only these."""
        parts = self.manifest()["tables"][name]
        folders = [
            f
            for state in states or (OPEN, CLOSED)
            for f in parts[state]
            if state != OPEN or buckets is None or bucket_of(f) in buckets
        ]
        levels = T.StructType(
            [T.StructField(STATE, T.StringType()), T.StructField(BUCKET, T.IntegerType())]
        )
        return self._read(name, folders, schemas.DIMS[name].schema, levels).drop(STATE, BUCKET)

    def open_rows(self, name: str, buckets: set[int] | None = None) -> DataFrame:
        return self.history(name, OPEN, buckets=buckets)

    def bucket(self, key: str) -> Column:
        """Number of the open folder of a key."""
        return F.pmod(F.xxhash64(key), F.lit(self.manifest()["buckets"])).cast("int")

    def rejected_rows(self, name: str) -> DataFrame:
        """Input set aside because it has no key or time, or is older than what is stored."""
        return self.history(name, REJECTED)

    def transactions(self, first: Moment | None = None, last: Moment | None = None) -> DataFrame:
        """Transactions; with ``first`` and ``last`` those in between and the undated ones.

        Folders that span other times are left out before Spark lists any. Inside those of one
        load's days most files are skipped by the range of their ``trans_date``.
        """
        rows = self._flat(self.transaction_folders(first, last), FACTS["transactions"])
        at = F.col("trans_date")
        if first is not None:
            rows = rows.where(at.isNull() | (at >= ntz(first)))
        if last is not None:
            rows = rows.where(at.isNull() | (at <= ntz(last)))
        return rows

    def transaction_folders(
        self, first: Moment | None = None, last: Moment | None = None, undated: bool = True
    ) -> list[str]:
        """Folders with times from ``first`` to ``last``, or with undated rows."""
        low = None if first is None else as_datetime(first).isoformat()
        high = None if last is None else as_datetime(last).isoformat()
        return [
            part["path"]
            for part in self.manifest()["tables"]["transactions"]["parts"]
            if (undated and part["undated"])
            or (
                part["first"] is not None
                and (low is None or part["last"] >= low)
                and (high is None or part["first"] <= high)
            )
        ]

    def unread_lines(self) -> DataFrame:
        """(line, reason) of feed lines that could not be read."""
        parts = self.manifest()["tables"].get("transactions_unread", {"parts": []})["parts"]
        return self._flat(parts, LINES)

    def rejected_transactions(self) -> DataFrame:
        """Transactions set aside because their id and time are stored with other values."""
        parts = self.manifest()["tables"].get("transactions_rejected", {"parts": []})["parts"]
        return self._read(
            "transactions_rejected", parts, FACTS["transactions_rejected"], T.StructType([])
        )

    def blacklist(self) -> DataFrame:
        parts = self.manifest()["tables"]["blacklist"]["parts"]
        return self._read("blacklist", parts, FACTS["blacklist"], T.StructType([]))

    def report(self, report_ts: Moment | None = None) -> DataFrame:
        """Report rows of one report time, or of all."""
        stored = self.manifest()["reports"]
        if report_ts is not None:
            wanted = as_datetime(report_ts).isoformat()
            stored = {k: v for k, v in stored.items() if k == wanted}
        return self._read("report", list(stored.values()), schemas.REPORT, T.StructType([]))

    def watermarks(self) -> DataFrame:
        marks = self.manifest()["watermarks"]
        rows = [(schemas.DBNAME, t, datetime.fromisoformat(at)) for t, at in marks.items()]
        return self.spark.createDataFrame(rows, schemas.WATERMARK)

    def watermark(self, table: str) -> datetime:
        mark = self.manifest()["watermarks"].get(table)
        return datetime.fromisoformat(mark) if mark else schemas.SEED

    # Housekeeping.

    def expire(self, keep: int) -> list[str]:
        """Delete data folders that none of the last ``keep`` versions names, the
        manifests before those, and the input of failed runs. Returns the data folders
        deleted. What a run still under way has written is left alone."""
        if keep < 1:
            raise ValueError("at least the current version must be kept")
        versions = self._versions()
        kept = [self.manifest(v) for v in versions[-keep:]]
        live = {"/".join(f.split("/")[:3]) for m in kept for f in _folders(m)}
        deleted = []
        for table in files.list_names(self.spark, f"{self.root}/data"):
            for name in files.list_names(self.spark, f"{self.root}/data/{table}"):
                folder = f"data/{table}/{name}"
                old = int(name.removeprefix("v=").split("-")[0]) <= versions[-1]
                if folder not in live and old:
                    files.delete_folder(self.spark, f"{self.root}/{folder}")
                    deleted.append(folder)
        for name in files.list_names(self.spark, f"{self.root}/staging"):
            if int(name.split("-")[0]) <= versions[-1]:
                files.delete_folder(self.spark, f"{self.root}/staging/{name}")
        for version in versions[:-keep]:
            files.delete_folder(self.spark, self._manifest_path(version))
        return deleted


def _folders(manifest: dict) -> list[str]:
    tables = [f for parts in manifest["tables"].values() for group in parts.values() for f in group]
    tables = [f["path"] if isinstance(f, dict) else f for f in tables]
    return tables + list(manifest["reports"].values())


def bucket_of(folder: str) -> int | None:
    found = re.search(rf"/{BUCKET}=(\d+)$", folder)
    return int(found.group(1)) if found else None


def _part(path: str, first: datetime | None, last: datetime | None, undated: bool) -> dict:
    span = {"first": first and first.isoformat(), "last": last and last.isoformat()}
    return {"path": path, **span, "undated": undated}


def observed_write(
    rows: DataFrame, path: str, columns: list[str] | None = None, **metrics: Column
) -> dict[str, Any]:
    """Write ``columns`` of the rows, and return the metrics that this very write saw.

    A task that is repeated counts once, as the write is the last stage of its job.
    """
    seen = Observation()
    observed = rows.observe(seen, *[m.alias(name) for name, m in metrics.items()])
    observed.select(*(columns or rows.columns)).write.mode("overwrite").parquet(path)
    return seen.get


class Commit:
    """One run's changes. Nothing is visible before ``publish``."""

    def __init__(self, warehouse: Warehouse):
        self.warehouse = warehouse
        self.base = warehouse.manifest()
        self.next = copy.deepcopy(self.base)
        self.next["version"] += 1
        # Of two runs at once each writes folders of its own; only one can publish.
        self.run = f"{self.next['version']}-{uuid.uuid4().hex[:12]}"
        self.staging = f"{warehouse.root}/staging/{self.run}"
        #: Of each staged input the largest time, where one was named.
        self.newest: dict[str, datetime | None] = {}

    def stage(self, table: str, rows: DataFrame, time: Column | None = None) -> DataFrame:
        """Write the input of this run and read it back. The write itself yields the largest
        ``time`` of the rows, for the table's mark.

        Everything the run derives comes from this one copy. A source table read again
        after an executor was lost could have moved on in between, and the loaded rows
        and the mark would then disagree.
        """
        path = f"{self.staging}/{table}"
        if time is None:
            rows.write.mode("overwrite").parquet(path)
        else:
            self.newest[table] = observed_write(rows, path, newest=F.max(time))["newest"]
        return self.warehouse.spark.read.schema(rows.schema).parquet(path)

    def _write(self, table: str, rows: DataFrame, *partitions: str) -> str:
        folder = f"data/{table}/v={self.run}"
        rows.write.mode("overwrite").partitionBy(*partitions).parquet(
            f"{self.warehouse.root}/{folder}"
        )
        return folder

    def put_history(self, name: str, applied: DataFrame, buckets: set[int] | None = None) -> None:
        """Store the result of an apply: its open rows replace those of ``buckets``, or the whole
        open set, its closed and rejected rows are added. One write; rebalanced by part and
        folder, so that the few closed rows of a day do not become a file per task while
        the open set stays spread."""
        columns = [*schemas.DIMS[name].schema.fieldNames(), STATE]
        number = self.warehouse.bucket(schemas.DIMS[name].key)
        rows = applied.select(*columns, F.when(F.col(STATE) == OPEN, number).alias(BUCKET))
        folder = self._write(name, rows.hint("rebalance", STATE, BUCKET), STATE, BUCKET)
        spark, parts = self.warehouse.spark, self.next["tables"][name]
        for state in (CLOSED, REJECTED):
            path = f"{folder}/{STATE}={state}"
            if files.exists(spark, f"{self.warehouse.root}/{path}"):
                parts[state] = [*parts[state], path]
        path = f"{folder}/{STATE}={OPEN}"
        names = files.list_names(spark, f"{self.warehouse.root}/{path}")
        kept = [f for f in parts[OPEN] if buckets is not None and bucket_of(f) not in buckets]
        parts[OPEN] = kept + [f"{path}/{n}" for n in names if n.startswith(f"{BUCKET}=")]

    def add_rejected(self, name: str, rows: DataFrame) -> None:
        """Set input of a dimension aside; its open and closed rows stay as they are."""
        columns = [*schemas.DIMS[name].schema.fieldNames(), STATE]
        folder = self._write(name, rows.withColumn(STATE, F.lit(REJECTED)).select(*columns), STATE)
        path = f"{folder}/{STATE}={REJECTED}"
        if files.exists(self.warehouse.spark, f"{self.warehouse.root}/{path}"):
            self.next["tables"][name][REJECTED].append(path)

    def add_rejected_transactions(self, rows: DataFrame) -> None:
        table = "transactions_rejected"
        folder = self._write(table, rows.select(*FACTS[table].fieldNames()))
        self.next["tables"].setdefault(table, {"parts": []})["parts"].append(folder)

    def add_transactions(self, rows: DataFrame, skip_stored: bool = False) -> dict[str, Any]:
        """Append transactions, and say what the write saw: ``n`` rows, ``first``, ``last`` and the
        number ``undated``.

        Rows are computed and written once. Only if stored folders span the same times, and
        ``skip_stored``, or if the rows span several months, are they read back: rows loaded before
        are left out, those stored with other values are set aside, and each month gets a folder.
        """
        fields, at, table = FACTS["transactions"].fieldNames(), F.col("trans_date"), "transactions"
        root, spark = self.warehouse.root, self.warehouse.spark
        folder = f"data/{table}/v={self.run}"
        seen = observed_write(
            rows, f"{root}/{folder}", fields, n=F.count("*"), first=F.min(at), last=F.max(at),
            undated=F.count_if(at.isNull()),
        )
        first, last, undated = seen["first"], seen["last"], seen["undated"] > 0
        if not seen["n"]:
            files.delete_folder(spark, f"{root}/{folder}")
            return seen
        known = []
        if skip_stored and first is not None:
            known = self.warehouse.transaction_folders(first, last, undated)
        elif skip_stored:
            known = [p["path"] for p in self.base["tables"][table]["parts"] if p["undated"]]
        several = first is not None and (first.year, first.month) != (last.year, last.month)
        parts = self.next["tables"][table]["parts"]
        if not known and not several:
            parts.append(_part(folder, first, last, undated))
            return seen
        given = self.warehouse._flat([folder], FACTS[table])
        fresh = given
        if known:
            stored = self.warehouse._flat(known, FACTS[table])
            if first is not None:
                stored = stored.where(at.isNull() | ((at >= ntz(first)) & (at <= ntz(last))))
            fresh = append_fact(given, stored)
            self.add_rejected_transactions(differing_copies(given, stored))
        final = f"{folder}-final"
        if several:
            dated = fresh.withColumn(MONTH, F.trunc("trans_date", "month")).hint("rebalance", MONTH)
            dated.sortWithinPartitions(MONTH, "trans_date").write.partitionBy(MONTH).parquet(f"{root}/{final}")
            for name in files.list_names(spark, f"{root}/{final}"):
                if not name.startswith(f"{MONTH}="):
                    continue
                value = name.removeprefix(f"{MONTH}=")
                if value == UNDATED:
                    parts.append(_part(f"{final}/{name}", None, None, True))
                    continue
                start = datetime.fromisoformat(value)
                end = (start + timedelta(days=32)).replace(day=1) - timedelta(seconds=1)
                parts.append(_part(f"{final}/{name}", max(first, start), min(last, end), False))
        else:
            fresh.write.parquet(f"{root}/{final}")
            parts.append(_part(final, first, last, undated))
        files.delete_folder(spark, f"{root}/{folder}")
        return seen

    def add_unread_lines(self, rows: DataFrame) -> None:
        table = "transactions_unread"
        folder = self._write(table, rows.select(*LINES.fieldNames()))
        self.next["tables"].setdefault(table, {"parts": []})["parts"].append(folder)

    def add_blacklist(self, rows: DataFrame) -> None:
        self._add_part(
            "blacklist", self._write("blacklist", rows.select(*FACTS["blacklist"].fieldNames()))
        )

    def _add_part(self, table: str, folder: str) -> None:
        self.next["tables"][table]["parts"].append(folder)

    def put_report(self, report_ts: Moment, rows: DataFrame) -> None:
        """Store a report; an earlier one of the same time is replaced."""
        folder = self._write("report", rows.select(*schemas.REPORT.fieldNames()))
        self.next["reports"][as_datetime(report_ts).isoformat()] = folder

    def advance_watermarks(self, newest: dict[str, datetime | None]) -> None:
        """Raise the marks of watermarked tables to the largest times loaded; none moves back, and a
        table that loaded nothing keeps its mark."""
        marks = self.next["watermarks"]
        for table, at in newest.items():
            if at is not None and table in marks:
                marks[table] = max(marks[table], as_datetime(at).isoformat())

    def put_stream_batch(self, feed: str, batch_id: int) -> None:
        self.next["streams"][feed] = batch_id

    def publish(self) -> None:
        """Make the changes visible; the input is no longer needed then."""
        self.warehouse._publish(self.next)
        files.delete_folder(self.warehouse.spark, self.staging)
