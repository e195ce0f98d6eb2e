"""History operators: one test per deliberate deviation, and brute force over random input."""

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark import operators as op
from tidemark.operators import chain
from tidemark.operators.scd2 import STATE
from tidemark.schemas import HIGH

T0 = datetime(2021, 3, 1)
OPEN = "k string, a string, b string, effective_from timestamp_ntz, effective_to timestamp_ntz, deleted_flg string"
SNAP = "k string, a string, b string"
CHANGES = "k string, a string, b string, at timestamp_ntz"
SECOND = timedelta(seconds=1)


@pytest.fixture(params=["few rows per key", "every repeated key hot"])
def hotness(request, monkeypatch):
    """Run a test as it is, and once more with repeated keys divided by month."""
    if request.param == "every repeated key hot":
        monkeypatch.setattr(chain, "HOT_ROWS", 1)
        monkeypatch.setattr(chain, "MAX_HOT_KEYS", 1_000_000)


def day(n, **extra):
    return T0 + timedelta(days=n, **extra)


def opened(spark, *rows):
    return spark.createDataFrame([(k, a, b, f, HIGH, flag) for k, a, b, f, flag in rows], OPEN)


def collected(df):
    columns = ["k", "a", "b", "effective_from", "effective_to", "deleted_flg"]
    columns += [STATE] if STATE in df.columns else []
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def snapshot(spark, open_rows, snap, eff, run=None, **options):
    given = spark.createDataFrame(snap, SNAP)
    return collected(
        op.scd2_apply_snapshot(opened(spark, *open_rows), given, "k", ["a", "b"], eff, run, **options)
    )


def incremental(spark, open_rows, changes, run, live=None):
    keys = None if live is None else spark.createDataFrame([(k,) for k in live], "k string")
    given = spark.createDataFrame(changes, CHANGES)
    return collected(
        op.scd2_apply_incremental(
            opened(spark, *open_rows), given, "k", ["a", "b"], "at", run, keys
        )
    )


def test_snapshot_cases(spark):
    got = snapshot(
        spark,
        [("same", "1", "1", day(0), "N"), ("chg", "1", "1", day(0), "N"), ("del", "1", "1", day(0), "N")],
        [("same", "1", "1"), ("chg", "2", "1"), ("new", "9", "9")],
        day(1),
    )
    assert got == [
        ("chg", "1", "1", day(0), day(1) - SECOND, "N", "closed"),
        ("chg", "2", "1", day(1), HIGH, "N", "open"),
        ("del", "1", "1", day(0), day(1) - SECOND, "N", "closed"),
        ("del", "1", "1", day(1), HIGH, "Y", "open"),
        ("new", "9", "9", day(1), HIGH, "N", "open"),
        ("same", "1", "1", day(0), HIGH, "N", "open"),
    ]


def test_tombstone_stays_single(spark):
    assert snapshot(spark, [("x", "1", "1", day(0), "Y")], [], day(1)) == [
        ("x", "1", "1", day(0), HIGH, "Y", "open")
    ]
    tombstones = op.scd2_tombstones(
        opened(spark, ("x", "1", "1", day(0), "Y")),
        spark.createDataFrame([], "k string"),
        "k",
        ["a", "b"],
        day(1),
    )
    assert tombstones.count() == 0


def test_incremental_leaves_tombstone_open(spark):
    """Closing deleted versions never touches a tombstone, in any table."""
    assert incremental(spark, [("x", "1", "1", day(0), "Y")], [], day(2), live=[]) == [
        ("x", "1", "1", day(0), HIGH, "Y", "open")
    ]


def test_closed_version_and_tombstone_touch(spark):
    got = incremental(spark, [("x", "1", "1", day(0), "N")], [], day(2), live=[])
    assert got == [
        ("x", "1", "1", day(0), day(2) - SECOND, "N", "closed"),
        ("x", "1", "1", day(2), HIGH, "Y", "open"),
    ]


@pytest.mark.parametrize("null_safe", [True, False])
def test_null_becoming_a_value(spark, null_safe):
    got = snapshot(
        spark, [("x", None, "1", day(0), "N")], [("x", "1", "1")], day(1), null_safe=null_safe
    )
    assert len(got) == (2 if null_safe else 1)


def test_returned_unchanged_reopens(spark):
    got = snapshot(spark, [("x", "1", "1", day(0), "Y")], [("x", "1", "1")], day(1))
    assert got == [
        ("x", "1", "1", day(0), day(1) - SECOND, "Y", "closed"),
        ("x", "1", "1", day(1), HIGH, "N", "open"),
    ]
    changed = op.snapshot_changed(
        spark.createDataFrame([("x", "1", "1")], SNAP),
        opened(spark, ("x", "1", "1", day(0), "Y")),
        "k",
        ["a", "b"],
    )
    assert changed.count() == 1


def test_deletion_defaults_to_snapshot_time_so_next_day_closes_it(spark):
    deleted = snapshot(spark, [("x", "1", "1", day(0), "N")], [], day(1))
    tombstone = next(r for r in deleted if r[5] == "Y")
    back = snapshot(spark, [(*tombstone[:4], "Y")], [("x", "1", "1")], day(2))
    assert [r[3:6] for r in back] == [(day(1), day(2) - SECOND, "Y"), (day(2), HIGH, "N")]


def test_older_snapshot_is_rejected_not_lost(spark):
    got = snapshot(spark, [("x", "1", "1", day(5), "N")], [("x", "2", "1"), (None, "3", "3")], day(1))
    assert got == sorted(
        [
            ("x", "1", "1", day(5), HIGH, "N", "open"),
            ("x", "2", "1", day(1), HIGH, "N", "rejected"),
            (None, "3", "3", day(1), HIGH, "N", "rejected"),
        ],
        key=str,
    )


def test_several_changes_of_a_key_follow_each_other(spark, hotness):
    changes = [
        ("x", "3", "1", day(40)),
        ("x", "2", "1", day(1)),
        ("x", "2", "0", day(1)),  # same moment: the largest wins
        ("x", "4", "1", day(41)),
        (None, "0", "0", day(1)),
    ]
    got = incremental(spark, [("x", "1", "1", day(0), "N"), ("y", "1", "1", day(0), "N")], changes, day(90))
    assert got == sorted(
        [
            ("x", "1", "1", day(0), day(1) - SECOND, "N", "closed"),
            ("x", "2", "1", day(1), day(40) - SECOND, "N", "closed"),
            ("x", "3", "1", day(40), day(41) - SECOND, "N", "closed"),
            ("x", "4", "1", day(41), HIGH, "N", "open"),
            ("y", "1", "1", day(0), HIGH, "N", "open"),
            (None, "0", "0", day(1), HIGH, "N", "rejected"),
        ],
        key=str,
    )


def test_redelivered_change_is_ignored_and_conflicting_one_rejected(spark, hotness):
    got = incremental(
        spark,
        [("x", "1", "1", day(3), "N"), ("y", "1", "1", day(3), "N")],
        [("x", "1", "1", day(3)), ("x", "9", "9", day(4)), ("y", "2", "2", day(3)), ("y", "0", "0", day(2))],
        day(9),
    )
    assert got == [
        ("x", "1", "1", day(3), day(4) - SECOND, "N", "closed"),
        ("x", "9", "9", day(4), HIGH, "N", "open"),
        ("y", "0", "0", day(2), HIGH, "N", "rejected"),
        ("y", "1", "1", day(3), HIGH, "N", "open"),
        ("y", "2", "2", day(3), HIGH, "N", "rejected"),
    ]


def test_close_versions_takes_the_earliest_later_start(spark, hotness):
    closed = op.scd2_close_versions(
        opened(spark, ("x", "1", "1", day(3), "N"), ("y", "1", "1", day(3), "N")),
        spark.createDataFrame(
            [("x", d) for d in (day(1), day(3), day(70), day(71))] + [("y", day(3))],
            "k string, at timestamp_ntz",
        ),
        "k",
        ["a", "b"],
        op_column("at"),
    )
    assert collected(closed) == [("x", "1", "1", day(3), day(70) - SECOND, "N")]


def test_rows_without_a_key_close_nothing(spark, hotness):
    """They never match each other, and do not reach the window by key."""
    updates = spark.createDataFrame([(None, "x", "y", day(2)), ("k", "x", "y", day(2))], CHANGES)
    stored = opened(spark, (None, "a", "b", T0, "N"), ("k", "a", "b", T0, "N"))
    closed = op.scd2_close_versions(stored, updates, "k", ["a", "b"], op_column("at"))
    assert [(r.k, r.effective_to) for r in closed.collect()] == [("k", day(2) - SECOND)]


def op_column(name):
    from pyspark.sql import functions as F

    return F.col(name)


def test_new_means_no_version_of_any_age(spark):
    history = spark.createDataFrame([("x", day(0)), ("x", day(1))], "k string, effective_from timestamp_ntz")
    snap = spark.createDataFrame([("x", "1", "1"), ("z", "1", "1")], SNAP)
    assert [r.k for r in op.snapshot_new(snap, history, "k").collect()] == ["z"]


def test_first_seen_spans_closed_versions(spark, hotness):
    history = spark.createDataFrame(
        [("x", day(n)) for n in (0, 1, 45, 400)] + [("y", day(7))],
        "k string, effective_from timestamp_ntz",
    )
    got = {(r.k, r.effective_from): r.first_seen for r in op.dim_first_seen(history, "k").collect()}
    assert got == {**{("x", day(n)): day(0) for n in (0, 1, 45, 400)}, ("y", day(7)): day(7)}


def test_validate_history_counts_each_rule(spark, hotness):
    rows = [
        ("twice", day(0), HIGH), ("twice", day(1), HIGH),  # two open, and the first overlaps
        ("none", day(0), day(1)),  # none open
        ("gap", day(0), day(1)), ("gap", day(9), HIGH),
        ("back", day(5), day(4)), ("back", day(4, seconds=1), HIGH),  # the open one overlaps it
        ("dup", day(0), day(1)), ("dup", day(0), HIGH),
    ]
    history = spark.createDataFrame(rows, "k string, effective_from timestamp_ntz, effective_to timestamp_ntz")
    got = {r.check_name: r.violations for r in op.validate_history(history, "k").collect()}
    assert got == {"open_rows": 2, "reversed": 1, "duplicate_start": 1, "broken_chain": 3}


# Brute force over random change logs.


def replay(changes, runs):
    """The history a row-by-row bookkeeper would keep: {key: [[from, to, value, flag]]}."""
    history = {}
    for changed, live, run in runs(changes):
        for key, value, at in sorted(changed, key=lambda c: (c[2], c[1])):
            versions = history.setdefault(key, [])
            if versions and versions[-1][0] > at:
                continue
            if versions and versions[-1][0] == at:
                continue
            if versions:
                versions[-1][1] = at - SECOND
            versions.append([at, HIGH, value, "N"])
        for key, versions in history.items():
            last = versions[-1]
            if key not in live and last[3] == "N" and last[0] < run:
                last[1] = run - SECOND
                versions.append([run, HIGH, last[2], "Y"])
            elif key in live and last[3] == "Y" and last[0] < run:
                last[1] = run - SECOND
                versions.append([run, HIGH, last[2], "N"])
    return history


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.lists(st.tuples(st.sampled_from("pqr"), st.integers(0, 70)), max_size=8),
            st.sets(st.sampled_from("pqr")),
        ),
        min_size=1,
        max_size=3,
    )
)
def test_incremental_matches_bookkeeping(spark, hotness, loads):
    """Several nightly applies over changing keys; a third of the changes hit one key."""
    runs = []
    for n, (changed, live) in enumerate(loads):
        start = day(100 * n)
        # One value per (key, moment), so that the outcome does not depend on ties.
        rows = sorted({(k, f"{n}{offset}", start + timedelta(days=offset)) for k, offset in changed})
        runs.append((rows, live, start + timedelta(days=90)))
    expected = replay(None, lambda _: runs)

    schema = "k string, a string, effective_from timestamp_ntz, effective_to timestamp_ntz, deleted_flg string"
    open_rows, closed = [], []
    for rows, live, run in runs:
        applied = op.scd2_apply_incremental(
            spark.createDataFrame(open_rows, schema),
            spark.createDataFrame(rows, "k string, a string, at timestamp_ntz"),
            "k",
            ["a"],
            "at",
            run,
            spark.createDataFrame([(k,) for k in live], "k string"),
        ).collect()
        assert not [r for r in applied if r[STATE] == "rejected"]
        open_rows = [tuple(r)[:5] for r in applied if r[STATE] == "open"]
        closed += [tuple(r)[:5] for r in applied if r[STATE] == "closed"]

    got = sorted((k, f, t, a, flag) for k, a, f, t, flag in open_rows + closed)
    assert got == sorted((k, *v[:2], v[2], v[3]) for k, vs in expected.items() for v in vs)
    if got:
        history = spark.createDataFrame(
            [(k, f, t) for k, f, t, _, _ in got],
            "k string, effective_from timestamp_ntz, effective_to timestamp_ntz",
        )
        assert all(r.violations == 0 for r in op.validate_history(history, "k").collect())


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.dictionaries(st.sampled_from("pqrs"), st.sampled_from(["1", "2", None])),
        min_size=1,
        max_size=4,
    )
)
def test_snapshots_match_bookkeeping(spark, days):
    expected = {}
    schema = "k string, a string, effective_from timestamp_ntz, effective_to timestamp_ntz, deleted_flg string"
    open_rows, closed = [], []
    for n, snap in enumerate(days):
        at = day(n)
        for key in set(expected) | set(snap):
            versions = expected.setdefault(key, [])
            last = versions[-1] if versions else None
            live = last is not None and last[3] == "N"
            if key in snap and not (live and last[2] == snap[key]):
                if last:
                    last[1] = at - SECOND
                versions.append([at, HIGH, snap[key], "N"])
            elif key not in snap and live:
                last[1] = at - SECOND
                versions.append([at, HIGH, last[2], "Y"])
        applied = op.scd2_apply_snapshot(
            spark.createDataFrame(open_rows, schema),
            spark.createDataFrame(list(snap.items()), "k string, a string"),
            "k",
            ["a"],
            at,
        ).collect()
        open_rows = [tuple(r)[:5] for r in applied if r[STATE] == "open"]
        closed += [tuple(r)[:5] for r in applied if r[STATE] == "closed"]
    got = sorted(((k, f, t, a, flag) for k, a, f, t, flag in open_rows + closed), key=str)
    assert got == sorted(
        ((k, *v[:2], v[2], v[3]) for k, vs in expected.items() for v in vs), key=str
    )


def test_returned_key_is_reopened(spark, hotness):
    """Deleted, then among the live keys again with its old change time: live from the run on."""
    tombstone = opened(spark, ("p", "1", "2", day(5), "Y"), ("q", "1", "2", day(5), "Y"))
    changes = spark.createDataFrame([("z", "0", "0", day(n)) for n in (1, 2)], CHANGES)
    live = spark.createDataFrame([("p",), ("z",)], "k string")
    applied = op.scd2_apply_incremental(tombstone, changes, "k", ["a", "b"], "at", day(9), live)
    rows = [r for r in collected(applied) if r[0] != "z"]
    assert rows == sorted(
        [
            ("p", "1", "2", day(5), day(9) - SECOND, "Y", "closed"),
            ("p", "1", "2", day(9), HIGH, "N", "open"),
            ("q", "1", "2", day(5), HIGH, "Y", "open"),
        ],
        key=str,
    )
    unknown = op.scd2_apply_incremental(tombstone, changes, "k", ["a", "b"], "at", day(9))
    assert [r for r in collected(unknown) if r[0] == "p"] == [("p", "1", "2", day(5), HIGH, "Y", "open")]
