"""What the physical plans look like, and that a dominating key is split."""

import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tidemark import operators as op
from tidemark.operators import chain
from tidemark.plans import Warehouse, report
from tidemark.schemas import HIGH
from tidemark.session import settings

FOLDER = "/root/testdata/sf0.001"
T0 = datetime(2021, 1, 1)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The adaptive plan after it has run."""
    df.collect()
    return physical(df)


@pytest.fixture
def shuffled(spark):
    """No broadcasts, and skew thresholds that small test data can reach."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.shuffle.partitions": "8",
    }
    with settings(spark, conf):
        yield spark


LAZY = [
    "snapshot_new",
    "snapshot_changed",
    "snapshot_deleted",
    "scd2_close_versions",
    "scd2_apply_snapshot",
    "scd2_apply_incremental",
    "dim_first_seen",
    "validate_history",
    "txn_enriched",
    "fraud_report_passport",
    "fraud_report_all",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join(shuffled, name):
    plan = physical(contract.queries()[name](shuffled, FOLDER))
    assert "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("name", ["snapshot_new", "snapshot_deleted"])
def test_absence_is_an_anti_join(shuffled, name):
    assert "LeftAnti" in physical(contract.queries()[name](shuffled, FOLDER))


@pytest.mark.parametrize("name", ["fraud_report_passport", "fraud_report_all", "txn_enriched"])
def test_transactions_are_read_once_and_shuffled_once(shuffled, name):
    plan = physical(contract.queries()[name](shuffled, FOLDER))
    scans = [line for line in plan.splitlines() if "FileScan" in line and "l_orderkey" in line]
    assert len(scans) == 1
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>", scans[0])
    assert "LessThanOrEqual(l_shipdate,2024-01-15T23:59:59)" in scans[0]
    # From the scan up to the join with the cards there is one exchange, by card.
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if line in scans)
    depth = lines[at].index("FileScan")
    above = []
    for line in reversed(lines[:at]):
        position = re.search(r"[A-Za-z]", line).start()
        if position < depth:
            depth = position
            above.append(line)
    exchanges = [line for line in above if "Exchange hashpartitioning" in line]
    assert len([e for e in exchanges if "card_num" in e]) == 1
    assert len(exchanges) == (1 if name == "txn_enriched" else 2)  # and one for DISTINCT


def test_snapshot_apply_shuffles_each_side_once(shuffled):
    plan = physical(contract.queries()["scd2_apply_snapshot"](shuffled, FOLDER))
    assert plan.count("Exchange hashpartitioning(k") == 2


def dims(spark, cards):
    """One account and client per card; every passport has expired."""
    validity = [F.lit(T0).cast("timestamp_ntz"), F.lit(HIGH).cast("timestamp_ntz"), F.lit("N")]
    names = ["effective_from", "effective_to", "deleted_flg"]
    validity = [v.alias(n) for v, n in zip(validity, names)]
    ids = spark.range(cards).select(F.col("id").cast("string").alias("id"))
    return (
        ids.select(F.col("id").alias("card_num"), F.col("id").alias("account_num"), *validity),
        ids.select(
            F.col("id").alias("account_num"),
            F.lit(None).cast("timestamp_ntz").alias("valid_to"),
            F.col("id").alias("client"),
            *validity,
        ),
        ids.select(
            F.col("id").alias("client_id"),
            F.col("id").alias("last_name"),
            F.col("id").alias("first_name"),
            F.col("id").alias("patronymic"),
            F.col("id").alias("passport_num"),
            F.lit(T0).cast("timestamp_ntz").alias("passport_valid_to"),
            F.col("id").alias("phone"),
            *validity,
        ),
    )


def hot_facts(spark, rows):
    """A third of the transactions are made with card 7."""
    card = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500)
    return spark.range(0, rows, 1, 8).select(
        card.cast("string").alias("card_num"),
        (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id"))).alias("trans_date"),
    )


def test_card_with_a_third_of_the_transactions_is_split(shuffled):
    facts = hot_facts(shuffled, 120_000)
    blacklist = shuffled.createDataFrame([], "passport_num string, entry_dt timestamp_ntz")
    rows = op.fraud_passport(facts, *dims(shuffled, 500), blacklist, T0 + timedelta(days=90))
    assert "skew=true" in final_plan(rows)
    assert rows.count() == 120_000


def test_client_with_a_third_of_the_accounts_is_split(shuffled):
    cards, accounts, clients = dims(shuffled, 60_000)
    client = F.when(F.col("account_num").cast("int") % 3 == 0, "7").otherwise(F.col("account_num"))
    subjects = op.expired_subjects(accounts.withColumn("client", client), clients, T0 + timedelta(1))
    assert "skew=true" in final_plan(subjects)


def test_account_with_a_third_of_the_cards_is_split(shuffled):
    cards, accounts, clients = dims(shuffled, 60_000)
    account = F.when(F.col("card_num").cast("int") % 3 == 0, "7").otherwise(F.col("card_num"))
    at = T0 + timedelta(1)
    subjects = op.expired_subjects(accounts, clients, at)
    flagged = op.flagged_cards(cards.withColumn("account_num", account), subjects, at)
    assert "skew=true" in final_plan(flagged)
    assert flagged.count() == 60_000


def test_passport_shared_by_a_third_of_the_clients_is_split(shuffled):
    """A placeholder typed in for want of a passport, and listed on many days."""
    _, accounts, clients = dims(shuffled, 60_000)
    shared = F.when(F.col("client_id").cast("int") % 3 == 0, "0000").otherwise(F.col("client_id"))
    clients = clients.withColumn("passport_num", shared)
    number = F.col("id").cast("string")
    day = F.date_add(F.lit(T0.date()), (F.col("id") % 50).cast("int"))
    listed = shuffled.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "0000").otherwise(number).alias("passport_num"),
        day.cast("timestamp_ntz").alias("entry_dt"),
    )
    subjects = op.blacklisted_subjects(accounts, clients, listed, T0 + timedelta(days=90))
    assert "skew=true" in final_plan(subjects)
    assert subjects.where("passport = '0000'").count() == 20_000
    ids = [r.account_num for r in subjects.where("passport <> '0000'").collect()]
    assert sorted(map(int, ids)) == [n for n in range(30_000) if n % 3]


def test_stored_key_that_dominates_a_load_is_split(shuffled):
    rows = hot_facts(shuffled, 120_000).withColumn(
        "trans_date", F.lit(T0).cast("timestamp_ntz")
    ).withColumnRenamed("card_num", "trans_id")
    stored = rows.where(F.col("trans_id") == "8")
    fresh = op.append_fact(rows, stored)
    assert "skew=true" in final_plan(fresh)
    assert fresh.count() == rows.count() - stored.count()


def hot_rows(spark, rows):
    """Unique times, a third of them of key 0."""
    return spark.range(0, rows, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id"))).alias("at"),
    )


def same_rows(one, other):
    return one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


@pytest.mark.parametrize("hot_from", [1_000, 1_000_000])
def test_chain_of_a_dominating_key_matches_one_window(spark, monkeypatch, hot_from):
    """A key with a third of all rows, divided or not, against the plain window."""
    monkeypatch.setattr(chain, "HOT_ROWS", hot_from)
    rows = hot_rows(spark, 60_000)
    hot = chain.hot_keys(rows, "k")
    assert hot is None if hot_from == 1_000_000 else [r.k for r in hot.collect()] == [0]
    by_time = Window.partitionBy("k").orderBy("at")
    chained = chain.with_successor(rows, "k", "at", "n")
    assert same_rows(chained, rows.withColumn("n", F.lead("at").over(by_time)))
    first = chain.with_first(rows, "k", "at", "n")
    assert same_rows(first, rows.withColumn("n", F.min("at").over(by_time)))


def test_hot_keys_are_bounded_in_number(spark, monkeypatch):
    """However small the keys, no more than the limit can be hot."""
    monkeypatch.setattr(chain, "HOT_ROWS", 0)
    monkeypatch.setattr(chain, "MAX_HOT_KEYS", 50)
    even = spark.range(10_000).select((F.col("id") % 50).alias("k"))
    assert chain.hot_keys(even, "k") is None
    uneven = even.unionByName(spark.range(7).select(F.col("id").alias("k")))
    assert chain.hot_keys(uneven, "k").count() == 7


def test_rows_are_shuffled_once_when_no_key_is_hot(shuffled):
    plan = physical(chain.with_successor(hot_rows(shuffled, 60_000), "k", "at"))
    assert plan.count("Exchange hashpartitioning(k") == 1 and "Join" not in plan


def test_windows_of_hot_keys_are_divided(shuffled, monkeypatch):
    monkeypatch.setattr(chain, "HOT_ROWS", 1_000)
    plan = physical(chain.with_successor(hot_rows(shuffled, 60_000), "k", "at"))
    for window in re.findall(r"Window \[.*", plan):
        assert "_bucket" in window, window  # the rows of a month, or the links of a key
    plan = physical(chain.with_first(hot_rows(shuffled, 60_000), "k", "at", "n"))
    assert "LeftAnti" in plan[: plan.index("Window [") + 2000]


def test_copies_collapse_before_the_shuffle(shuffled):
    """A million copies of one row leave each reading task as one row."""
    rows = shuffled.range(0, 1_000_000, 1, 4).select(F.lit(1).alias("k"), F.lit("x").alias("v"))
    unique = op.one_row_per(rows, ["k"], ["v"])
    plan = physical(unique)
    assert plan.index("Exchange") < plan.index("partial_max")
    assert [tuple(r) for r in unique.collect()] == [(1, "x")]


def loaded(spark, root):
    warehouse = Warehouse.bootstrap(spark, root)
    commit = warehouse.begin()
    for name, rows in zip(("cards", "accounts", "clients"), dims(spark, 500)):
        state = rows.withColumn("state", F.lit("open"))
        if name == "clients":
            state = state.withColumn("date_of_birth", F.lit(T0).cast("timestamp_ntz"))
        commit.put_history(name, state)
    facts = hot_facts(spark, 30_000)
    for name in ("trans_id", "oper_type", "oper_result", "terminal"):
        facts = facts.withColumn(name, F.lit("x"))
    commit.add_transactions(facts.withColumn("amt", F.lit(1).cast("decimal(18,2)")))
    commit.publish()
    return warehouse


def test_report_by_each_kind_of_join(spark, tmp_path, monkeypatch):
    """Broadcast, filtered before the shuffle, or shuffled whole: the report is the same."""
    warehouse = loaded(spark, str(tmp_path / "w"))
    at = T0 + timedelta(days=90)
    scan = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    with settings(spark, {scan: "1KB", "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        broadcast = sorted(map(str, report.run_report(warehouse, at).collect()))
        filtered = sorted(map(str, report.run_report(warehouse, at, broadcast_bytes=0).collect()))
        monkeypatch.setattr(report, "MAX_FILTER_CARDS", 0)
        shuffled = sorted(map(str, report.run_report(warehouse, at, broadcast_bytes=0).collect()))
    assert broadcast == filtered == shuffled and len(broadcast) == 30_000


def test_large_card_sets_filter_the_transactions_before_their_shuffle(spark, tmp_path):
    warehouse = loaded(spark, str(tmp_path / "w"))
    path = str(tmp_path / "flagged")
    spark.range(300).selectExpr(
        "string(id) AS card_num", "'p' AS passport", "'f' AS fio", "'+7' AS phone", "'1' AS event_type"
    ).write.parquet(path)
    stored = spark.read.parquet(path)
    scan = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"

    def plan(limit, expected_rows):
        flagged, conf = report.plan_card_join(stored, limit)
        conf = {**conf, scan: "1KB", "spark.sql.autoBroadcastJoinThreshold": "-1"}
        with settings(spark, conf):
            rows = op.fraud_events(warehouse.transactions(), flagged, T0 + timedelta(days=90))
            text = physical(rows)
            assert rows.count() == expected_rows
        return text

    expected = warehouse.transactions().where("int(card_num) < 300").select("trans_date").distinct()
    small, large = plan(1_000_000, expected.count()), plan(0, expected.count())
    assert "BroadcastHashJoin" in small and "might_contain" not in small
    assert "might_contain" in large
    lines = large.splitlines()
    at = next(i for i, line in enumerate(lines) if "might_contain" in line)
    assert any("Exchange hashpartitioning(card_num" in line for line in lines[at - 3 : at])
    assert spark.conf.get("spark.sql.optimizer.runtime.bloomFilter.maxNumItems") == "4000000"


def test_large_open_sets_are_written_by_many_tasks(shuffled, tmp_path):
    """Rows of one folder share a hash, but AQE splits what they would send to one task."""
    warehouse = Warehouse.bootstrap(shuffled, str(tmp_path / "w"), buckets=1)
    cards, _, _ = dims(shuffled, 60_000)
    state = F.when(F.col("card_num").cast("int") % 1000 == 0, "closed").otherwise("open")
    commit = warehouse.begin()
    commit.put_history("cards", cards.withColumn("state", state))
    commit.publish()
    # A split is at least what one task has sent, and there are eight.
    assert len(warehouse.open_rows("cards").inputFiles()) == 8
    assert len(warehouse.history("cards", "closed").inputFiles()) == 1
    assert warehouse.history("cards").count() == 60_000


def test_shuffle_partitions_follow_the_input():
    from tidemark.session import build_session, shuffle_partitions

    assert shuffle_partitions(1 << 20) == 200
    assert shuffle_partitions(100 << 40) == 819_200
    with pytest.raises(ValueError, match="input_bytes"):
        build_session("t", "spark://host:7077")


def test_every_kind_of_card_passes_the_filter(spark, tmp_path):
    """Blank and numeric cards meet the same transactions on the broadcast and the filter path."""
    for kind, values in (("string", ["", "c"]), ("bigint", [1, 2])):
        path = str(tmp_path / kind)
        spark.createDataFrame([(v,) for v in values], f"card_num {kind}").write.parquet(path)
        stored = spark.read.parquet(path)
        for limit in (1 << 20, 0):
            flagged, _ = report.plan_card_join(stored, limit)
            assert sorted(r.card_num for r in flagged.collect()) == values
