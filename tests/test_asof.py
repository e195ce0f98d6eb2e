"""Joins to the version valid at each event's own time."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tidemark import operators as op
from tidemark.schemas import HIGH

T0 = datetime(2021, 1, 1)
FOLDER = "/root/testdata/sf0.001"


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def random_versions(rng, keys):
    """(key, start, end, value): versions in order, some with a gap behind; starts over several days."""
    rows = []
    for key in range(keys):
        starts = sorted(rng.sample(range(0, 10 * 86400, 7200), rng.randint(0, 8)))
        ends = [s - 1 for s in starts[1:]] + [None]
        for i, (s, e) in enumerate(zip(starts, ends)):
            if e and rng.random() < 0.3:
                e -= 3600
            rows.append((key, at(s), HIGH if e is None else at(e), f"{key}-{i}"))
    return rows


VERSIONS = "k int, effective_from timestamp_ntz, effective_to timestamp_ntz, told string"


@pytest.mark.parametrize("hot_rows", [None, 30])
def test_as_of_join_matches_brute_force(spark, hot_rows):
    rng = random.Random(11)
    versions = random_versions(rng, 6)
    events = [(rng.choice([0, 0, 0, 1, 2, 5, 7]), at(rng.randrange(0, 10 * 86400, 3600)), i) for i in range(400)]
    events += [(None, T0, 1000), (0, None, 1001)] + [(k, s, 2000) for k, s, _, _ in versions]
    events += events[:5]
    df = spark.createDataFrame(events, "k int, t timestamp_ntz, n int")
    got = op.as_of_join(df, spark.createDataFrame(versions, VERSIONS), "k", "t", hot_rows)
    assert got.columns == ["k", "t", "n", "told"]
    want = [
        (*e, told)
        for e in events
        for k, s, end, told in versions
        if e[1] is not None and k == e[0] and s <= e[1] <= end
    ]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_as_of_join_of_nothing(spark):
    versions = spark.createDataFrame([], VERSIONS)
    events = spark.createDataFrame([(1, T0)], "k int, t timestamp_ntz")
    assert op.as_of_join(events, versions, "k", "t").collect() == []
    some = spark.createDataFrame([(1, T0, HIGH, "x")], VERSIONS)
    assert op.as_of_join(events.where("false"), some, "k", "t").collect() == []


def test_hot_card_is_divided_by_day(spark):
    """A third of the transactions are of one card; no window group is larger than one day of it."""
    third = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500)
    when = F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id"))
    facts = spark.range(0, 60_000, 1, 8).select(third.alias("card_num"), when.alias("trans_date"))
    versions = spark.range(500).select(
        F.col("id").alias("card_num"),
        F.lit(T0).cast("timestamp_ntz").alias("effective_from"),
        F.lit(HIGH).cast("timestamp_ntz").alias("effective_to"),
        F.col("id").alias("owner"),
    )
    rows = op.as_of_join(facts, versions, "card_num", "trans_date", hot_rows=5_000)
    assert rows.where("owner = card_num").count() == 60_000
    plan = rows._jdf.queryExecution().executedPlan().toString()
    windows = re.findall(r"Window \[last\(_version.*", plan)
    assert windows and all("_bucket" in w for w in windows)
    plain = op.as_of_join(facts, versions, "card_num", "trans_date")
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, rows.collect()))


def test_valid_together_keeps_the_common_span(spark):
    left = spark.createDataFrame(
        [(1, "a", at(0), at(99)), (1, "b", at(100), HIGH), (2, "c", at(0), HIGH)],
        "k int, l string, effective_from timestamp_ntz, effective_to timestamp_ntz",
    )
    right = spark.createDataFrame(
        [(1, "x", at(0), at(49)), (1, "y", at(50), at(149)), (2, "z", at(0), at(10))],
        "k int, r string, effective_from timestamp_ntz, effective_to timestamp_ntz",
    )
    got = op.valid_together(left, right, "k").select("l", "r", "effective_from", "effective_to")
    assert sorted(map(tuple, got.collect())) == [
        ("a", "x", at(0), at(49)),
        ("a", "y", at(50), at(99)),
        ("b", "y", at(100), at(149)),
        ("c", "z", at(0), at(10)),
    ]


@pytest.mark.parametrize("name", ["txn_enriched_event", "fraud_report_event"])
def test_transactions_are_read_once_and_met_in_one_window(spark, name):
    plan = contract.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "l_orderkey" in line]
    assert len(scans) == 1 and "LessThanOrEqual(l_shipdate,2024-01-15T23:59:59)" in scans[0]
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert len(re.findall(r"Window \[last\(_version", plan)) == 1


def test_rules_at_the_time_of_the_event(spark):
    """The card passes from one holder to another; each transaction is judged by its own holder and day."""
    span = "effective_from timestamp_ntz, effective_to timestamp_ntz, deleted_flg string"
    cards = spark.createDataFrame(
        [("1", "a", at(0), at(999), "N"), ("1", "b", at(1000), HIGH, "N")], f"card_num string, account_num string, {span}"
    )
    accounts = spark.createDataFrame(
        [("a", None, "A", T0, HIGH, "N"), ("b", at(2000), "B", T0, HIGH, "N")],
        f"account_num string, valid_to timestamp_ntz, client string, {span}",
    )
    clients = spark.createDataFrame(
        [("A", "L", "F", "P", "pa", at(500), "+1", T0, HIGH, "N"), ("B", "M", "F", "P", "pb", None, "+2", T0, HIGH, "N")],
        "client_id string, last_name string, first_name string, patronymic string, passport_num string,"
        f" passport_valid_to timestamp_ntz, phone string, {span}",
    )
    blacklist = spark.createDataFrame([("pb", at(3000)), ("pb", at(4000))], "passport_num string, entry_dt timestamp_ntz")
    facts = spark.createDataFrame(
        [("1", at(s)) for s in (500, 501, 1000, 2000, 2001, 2999, 3000, 9000)], "card_num string, trans_date timestamp_ntz"
    )
    got = op.fraud_at_event(facts, cards, accounts, clients, blacklist, at(5000))
    assert sorted((r.event_id, r.passport, r.event_type) for r in got.collect()) == [
        (at(501), "pa", "1"),
        (at(2001), "pb", "2"),
        (at(2999), "pb", "2"),
        (at(3000), "pb", "1"),
        (at(3000), "pb", "2"),
    ]
