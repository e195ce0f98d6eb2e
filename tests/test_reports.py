"""Details of the rules and of validity at a moment."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark import operators as op
from tidemark.functions import ntz, parse_dates, to_second
from tidemark.functions.clean import SECOND_PATTERN
from tidemark.schemas import HIGH

T0 = datetime(2020, 1, 1)
DAY = datetime(2021, 3, 1)
END = datetime(2021, 3, 1, 23, 59, 59)
NEXT = datetime(2021, 3, 2, 23, 59, 59)
SPAN = ", effective_from timestamp_ntz, effective_to timestamp_ntz, deleted_flg string"


@pytest.fixture(scope="module")
def bank(spark):
    valid = (T0, HIGH, "N")
    cards = [
        ("c1", "a1", *valid),
        ("c2", "a2", *valid),
        ("c3", "a1", T0, HIGH, "Y"),  # deleted
        ("c4", "a1", T0, datetime(2021, 3, 1, 23, 59, 58), "N"),  # ended before the report
    ]
    accounts = [("a1", None, "p1", *valid), ("a2", DAY, "p2", *valid)]
    clients = [
        ("p1", "L", None, "P", "n1", DAY, "1", *valid),
        ("p2", "L", "F", None, None, None, "2", *valid),
    ]
    facts = [(c, DAY) for c in ("c1", "c1", "c2", "c3", "c4", None)]
    facts.append(("c1", datetime(2021, 3, 2)))
    return {
        "facts": spark.createDataFrame(facts, "card_num string, trans_date timestamp_ntz"),
        "cards": spark.createDataFrame(cards, "card_num string, account_num string" + SPAN),
        "accounts": spark.createDataFrame(
            accounts, "account_num string, valid_to timestamp_ntz, client string" + SPAN
        ),
        "clients": spark.createDataFrame(
            clients,
            "client_id string, last_name string, first_name string, patronymic string, "
            "passport_num string, passport_valid_to timestamp_ntz, phone string" + SPAN,
        ),
    }


@pytest.fixture(scope="module")
def nobody(spark):
    return spark.createDataFrame([], "passport_num string, entry_dt timestamp_ntz")


def rows_of(df):
    return sorted(((r.event_id, r.passport, r.fio, r.event_type) for r in df.collect()), key=str)


def test_last_day_of_a_passport(bank, nobody):
    """By default it counts as expired from the start of that day; optionally after it."""

    def found(at, grace):
        return op.fraud_passport(*bank.values(), nobody, at, grace_last_day=grace).count()

    assert found(END, False) == 1 and found(END, True) == 0
    assert found(NEXT, False) == 2 and found(NEXT, True) == 2


def test_only_cards_valid_at_the_report_time_count(bank, nobody):
    event = (DAY, "n1", "L  P", "1")
    assert rows_of(op.fraud_passport(*bank.values(), nobody, END)) == [event]
    every = op.fraud_passport(*bank.values(), nobody, END, distinct=False)
    assert rows_of(every) == [event, event]


def test_missing_passport_never_matches_the_list(spark, bank):
    listed = spark.createDataFrame(
        [(None, T0), ("n1", T0), ("n1", DAY)], "passport_num string, entry_dt timestamp_ntz"
    )
    subjects = op.blacklisted_subjects(bank["accounts"], bank["clients"], listed, END)
    assert [r.account_num for r in subjects.collect()] == ["a1"]


def test_both_rules_in_one_report(bank, nobody):
    assert rows_of(op.fraud_report_all(*bank.values(), nobody, END)) == [
        (DAY, "n1", "L  P", "1"),
        (DAY, None, "L F ", "2"),
    ]


def test_validity_includes_both_ends(spark):
    history = spark.createDataFrame([(1, T0, DAY, "N")], "k int" + SPAN)
    at = [T0, DAY, datetime(2019, 12, 31, 23, 59, 59), datetime(2021, 3, 1, 0, 0, 1)]
    assert [op.dim_as_of(history, m).count() for m in at] == [1, 1, 0, 0]


def test_fraction_of_a_second_falls_into_no_gap(spark):
    moment = datetime(2021, 3, 1, 23, 59, 59, 500_000)
    history = spark.createDataFrame(
        [(1, T0, END, "N"), (2, datetime(2021, 3, 2), HIGH, "N")], "k int" + SPAN
    )
    assert [r.k for r in op.dim_as_of(history, moment).collect()] == [1]


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    """02:30 on 28 March 2021 does not exist in Berlin, but is a valid zone-free time."""
    moments = [
        (datetime(2021, 3, 1, 23, 59, 59, 500_000), END),
        (datetime(2021, 3, 28, 2, 30, 0, 999_999), datetime(2021, 3, 28, 2, 30)),
        (datetime(1899, 1, 1, 0, 0, 0, 250_000), datetime(1899, 1, 1)),
        (None, None),
    ]
    df = spark.createDataFrame(moments, "t timestamp_ntz, wanted timestamp_ntz")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = df.select(to_second(F.col("t")).alias("cut"), "wanted").collect()
        parsed = spark.sql("SELECT '2021-03-28 02:30:00' AS t").select(
            parse_dates(F.col("t"), SECOND_PATTERN)
        )
        assert parsed.first()[0] == moments[1][1]
        literal = spark.range(1).select(ntz(moments[1][0]))
        assert literal.first()[0] == moments[1][1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [r.cut for r in rows] == [r.wanted for r in rows]
