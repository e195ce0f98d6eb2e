"""Type-2 history: every version of a record with the closed interval it was valid in.

A version ends one second before its successor starts; the open one ends at the high
date. Deletion closes the open version and opens a tombstone, a copy flagged ``Y``.

The one-pass applies return the rows to store next to a ``state`` column:

``open``      the new open set, replacing the old one
``closed``    versions closed by this run, to be appended to the closed ones
``rejected``  input that cannot be applied: it has no key or time, or is older than what is stored
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.times import Moment, before, high, ntz
from tidemark.operators.chain import (
    BUCKET,
    bucketed,
    hot_keys,
    month_links,
    one_row_per,
    with_successor,
)
from tidemark.operators.diff import differs, snapshot_deleted
from tidemark.schemas import DELETED, LIVE

STATE = "state"
OPEN, CLOSED, REJECTED = "open", "closed", "rejected"


def scd2_insert_versions(rows: DataFrame, key: str, attrs: list[str], start: Moment) -> DataFrame:
    """Open versions from ``start`` (a column of ``rows`` or one moment for all)."""
    return rows.select(
        key,
        *attrs,
        ntz(start).alias("effective_from"),
        high().alias("effective_to"),
        F.lit(LIVE).alias("deleted_flg"),
    )


def scd2_close_versions(
    open_rows: DataFrame, updates: DataFrame, key: str, attrs: list[str], start: Moment
) -> DataFrame:
    """The open versions that ``updates`` supersede, closed one second before the new start.

    Only a strictly later start closes a version. Of several updates of a key the
    earliest one closes it; the others follow each other. Rows without a key close nothing
    and are left out first, so that they do not meet in one window.
    """
    open_rows, updates = (df.where(F.col(key).isNotNull()) for df in (open_rows, updates))
    marks = (
        updates.select(key, ntz(start).alias("effective_from"))
        .distinct()
        .join(open_rows, [key, "effective_from"], "left_anti")
        .withColumn("_existing", F.lit(False))
    )
    chain = with_successor(
        open_rows.withColumn("_existing", F.lit(True)).unionByName(marks, allowMissingColumns=True),
        key,
        "effective_from",
        counted=updates,
    )
    return chain.where(F.col("_existing") & F.col("next_from").isNotNull()).select(
        key,
        *attrs,
        "effective_from",
        before(F.col("next_from")).alias("effective_to"),
        "deleted_flg",
    )


def scd2_tombstones(
    open_rows: DataFrame, live_keys: DataFrame, key: str, attrs: list[str], run_ts: Moment
) -> DataFrame:
    """Copies, flagged deleted and open from ``run_ts``, of open rows gone from the source."""
    return snapshot_deleted(open_rows, live_keys, key).select(
        key,
        *attrs,
        ntz(run_ts).alias("effective_from"),
        high().alias("effective_to"),
        F.lit(DELETED).alias("deleted_flg"),
    )


def _version(
    prefix: str, attrs: list[str], start: Column, end: Column, flag: Column, state: str
) -> Column:
    """One output row of an apply, as a struct; ``prefix`` names the side it is taken from."""
    return F.struct(
        *[F.col(f"{prefix}{a}").alias(a) for a in attrs],
        start.alias("effective_from"),
        end.alias("effective_to"),
        flag.alias("deleted_flg"),
        F.lit(state).alias(STATE),
    )


def _unusable(
    rows: DataFrame, test: Column, key: str, attrs: list[str], start: Column
) -> DataFrame:
    """Input rows that can be no version, for want of a key or a time, as rejected rows."""
    rejected = _version("", attrs, start, high(), F.lit(LIVE), REJECTED).alias("_row")
    return rows.where(test).select(key, rejected).select(key, "_row.*")


def scd2_apply_snapshot(
    open_rows: DataFrame,
    snap: DataFrame,
    key: str,
    attrs: list[str],
    eff_ts: Moment,
    run_ts: Moment | None = None,
    null_safe: bool = True,
) -> DataFrame:
    """Apply a full snapshot to the open set, in one join.

    ``open_rows`` are the versions whose end is the high date; every known key has
    exactly one, live or tombstone, so closed history is not read. ``eff_ts`` is when
    the snapshot's content holds from. ``run_ts`` stamps deletions; it defaults to
    ``eff_ts`` so that a key returning in the next snapshot closes its tombstone, and
    one moment serves both the closed version and the tombstone so that they touch.

    Both sides are unique per key, so no key can be hot, and the aggregate that makes
    the snapshot unique already places it for the join: one shuffle per side.
    """
    eff, run = ntz(eff_ts), ntz(eff_ts if run_ts is None else run_ts)
    given = one_row_per(snap.where(F.col(key).isNotNull()), [key], attrs)
    joined = open_rows.alias("o").join(
        given.alias("s"), F.col(f"o.{key}") == F.col(f"s.{key}"), "full_outer"
    )

    known, present = F.col(f"o.{key}").isNotNull(), F.col(f"s.{key}").isNotNull()
    start, flag = F.col("o.effective_from"), F.col("o.deleted_flg")
    deleted = flag == DELETED
    superseded = present & (deleted | differs("o", "s", attrs, null_safe))
    gone = ~present & ~deleted & (start < run)

    kept = _version("o.", attrs, start, high(), flag, OPEN)
    fresh = _version("s.", attrs, eff, high(), F.lit(LIVE), OPEN)
    replaced = _version("o.", attrs, start, before(eff), flag, CLOSED)
    ended = _version("o.", attrs, start, before(run), flag, CLOSED)
    tombstone = _version("o.", attrs, run, high(), F.lit(DELETED), OPEN)
    late = _version("s.", attrs, eff, high(), F.lit(LIVE), REJECTED)

    rows = (
        F.when(~known, F.array(fresh))
        .when(superseded & (start < eff), F.array(replaced, fresh))
        .when(superseded, F.array(kept, late))
        .when(gone, F.array(ended, tombstone))
        .otherwise(F.array(kept))
    )
    applied = joined.select(
        F.coalesce(F.col(f"o.{key}"), F.col(f"s.{key}")).alias(key), F.explode(rows).alias("_row")
    ).select(key, "_row.*")
    return applied.unionByName(_unusable(snap, F.col(key).isNull(), key, attrs, eff))


def scd2_apply_incremental(
    open_rows: DataFrame,
    changes: DataFrame,
    key: str,
    attrs: list[str],
    change_ts: str,
    run_ts: Moment,
    live_keys: DataFrame | None = None,
) -> DataFrame:
    """Apply extracted changes, several per key allowed, to the open set.

    Changes of a key are chained by time after its open version. Copies with an equal
    key and time collapse to one. A change at or before the open version's start is
    late, except an exact copy of that version, which a rerun delivers again. With
    ``live_keys``, the full key list of the source, keys no longer in it are closed at
    ``run_ts`` and get a tombstone. A deleted key that is in it again, without a newer
    change, gets a live version from ``run_ts`` with the attributes of its tombstone.

    Open versions, changes and live keys meet in one shuffle by key, in which the rows
    of hot keys are divided by month; see ``chain``.
    """
    run = ntz(run_ts)
    unusable = F.col(key).isNull() | F.col(change_ts).isNull()
    arriving = one_row_per(
        changes.where(~unusable).select(key, *attrs, F.col(change_ts).alias("effective_from")),
        [key, "effective_from"],
        attrs,
    ).withColumns({"deleted_flg": F.lit(LIVE), "_existing": F.lit(False)})
    stored = open_rows.select(key, *attrs, "effective_from", "deleted_flg")
    rows = stored.withColumn("_existing", F.lit(True)).unionByName(arriving)
    rows = rows.withColumn("_live", F.lit(live_keys is None))
    if live_keys is not None:
        # The live keys travel in the same shuffle, as rows without a time.
        present = live_keys.select(key).where(F.col(key).isNotNull()).distinct()
        rows = rows.unionByName(
            present.withColumn("_live", F.lit(True)), allowMissingColumns=True
        )

    existing_from = F.when(F.col("_existing"), F.col("effective_from"))
    group, links = [key], None
    hot = hot_keys(changes, key)  # only changes can repeat a key
    if hot is not None:
        rows = bucketed(rows, hot, key, "effective_from")
        group, of_key = [key, BUCKET], Window.partitionBy(key)
        links = month_links(
            rows, key, "effective_from", _from=F.max(existing_from), _present=F.max("_live")
        ).select(
            *group,
            "_next_head",
            F.max("_from").over(of_key).alias("_hot_open_from"),
            F.max("_present").over(of_key).alias("_hot_live"),
        )

    # An open version and a change may share a start; the version sorts first.
    inside = Window.partitionBy(*group).orderBy("effective_from", F.desc("_existing"))
    whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    body = F.struct(*attrs)
    ahead = F.lead("effective_from", 1).over(inside)
    chained = rows.withColumns(
        {
            "_next": F.when(
                ahead == F.col("effective_from"), F.lead("effective_from", 2).over(inside)
            ).otherwise(ahead),
            "_copy": (F.lag("effective_from").over(inside) == F.col("effective_from"))
            & F.lag(body).over(inside).eqNullSafe(body)
            & F.lag("deleted_flg").over(inside).eqNullSafe(F.lit(LIVE)),
            "_open_from": F.max(existing_from).over(whole),
            "_any_live": F.max("_live").over(whole),
        }
    ).where(F.col("_existing").isNotNull())
    successor, open_from, live = F.col("_next"), F.col("_open_from"), F.col("_any_live")
    if links is not None:
        chained = chained.join(links, group, "left")
        successor = F.coalesce(successor, F.col("_next_head"))
        open_from = F.coalesce(F.col("_hot_open_from"), open_from)
        live = F.coalesce(F.col("_hot_live"), live)

    start, flag = F.col("effective_from"), F.col("deleted_flg")
    late = ~F.col("_existing") & F.coalesce(start <= open_from, F.lit(False))
    copy = late & F.coalesce(F.col("_copy"), F.lit(False))
    gone = (flag == LIVE) & ~live & (start < run)
    returned = (
        F.lit(live_keys is not None) & F.col("_existing") & (flag == DELETED) & live & (start < run)
    )

    result = (
        F.when(late, F.array(_version("", attrs, start, high(), flag, REJECTED)))
        .when(
            successor.isNotNull(),
            F.array(_version("", attrs, start, before(successor), flag, CLOSED)),
        )
        .when(
            gone,
            F.array(
                _version("", attrs, start, before(run), flag, CLOSED),
                _version("", attrs, run, high(), F.lit(DELETED), OPEN),
            ),
        )
        .when(
            returned,
            F.array(
                _version("", attrs, start, before(run), flag, CLOSED),
                _version("", attrs, run, high(), F.lit(LIVE), OPEN),
            ),
        )
        .otherwise(F.array(_version("", attrs, start, high(), flag, OPEN)))
    )
    applied = (
        chained.where(~copy).select(key, F.explode(result).alias("_row")).select(key, "_row.*")
    )
    return applied.unionByName(_unusable(changes, unusable, key, attrs, F.col(change_ts)))


def history_of(applied: DataFrame, closed: DataFrame | None = None) -> DataFrame:
    """The whole history after an apply: its open and closed rows, plus earlier closed ones."""
    rows = applied.where(F.col(STATE) != REJECTED).drop(STATE)
    return rows if closed is None else rows.unionByName(closed.select(*rows.columns))

