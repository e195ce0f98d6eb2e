"""Comparing a full snapshot with the history."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.chain import one_row_per
from tidemark.schemas import DELETED, LIVE


def differs(left: str, right: str, attrs: list[str], null_safe: bool = True) -> Column:
    """True where any attribute of alias ``left`` differs from that of ``right``.

    By default NULL against a value is a difference. ``null_safe=False`` compares with
    plain ``!=``, which never sees an attribute become NULL or stop being NULL.
    """
    pairs = [(F.col(f"{left}.{a}"), F.col(f"{right}.{a}")) for a in attrs]
    if null_safe:
        tests = [~a.eqNullSafe(b) for a, b in pairs]
    else:
        tests = [a != b for a, b in pairs]
    return reduce(or_, tests, F.lit(False))


def snapshot_new(snap: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """Snapshot rows whose key has no version of any age."""
    snap = one_row_per(snap, [key], [c for c in snap.columns if c != key])
    return snap.join(history.select(key).distinct(), key, "left_anti")


def snapshot_changed(
    snap: DataFrame,
    open_rows: DataFrame,
    key: str,
    attrs: list[str],
    null_safe: bool = True,
    reopen: bool = True,
) -> DataFrame:
    """Snapshot rows that differ from the key's open version.

    With ``reopen``, a key whose open version is a tombstone counts as changed even if
    its attributes are the same; otherwise a record that was deleted and came back
    unchanged would stay deleted for ever.
    """
    changed = differs("s", "o", attrs, null_safe)
    if reopen and "deleted_flg" in open_rows.columns:
        changed = changed | (F.col("o.deleted_flg") == DELETED)
    snap = one_row_per(snap, [key], [c for c in snap.columns if c != key])
    return (
        snap.alias("s")
        .join(open_rows.alias("o"), F.col(f"s.{key}") == F.col(f"o.{key}"), "inner")
        .where(changed)
        .select("s.*")
    )


def snapshot_deleted(open_rows: DataFrame, live_keys: DataFrame, key: str) -> DataFrame:
    """Open, not yet deleted rows whose key is gone from the source.

    Tombstones are left out *before* the anti-join: a tombstone is never among the live
    keys, so it would be reported, and copied, again on every run.
    """
    if "deleted_flg" in open_rows.columns:
        open_rows = open_rows.where(F.col("deleted_flg") == LIVE)
    return open_rows.join(live_keys.select(key).distinct(), key, "left_anti")
