"""Three days of feeds and source tables, loaded and reported day by day."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from feeds import blacklist_drop, terminals_drop, transactions_drop
from tidemark import schemas
from tidemark.operators import validate_history
from tidemark.plans import FrameBank, Warehouse, run_load, run_report

D1, D2, D3 = (datetime(2021, 3, d) for d in (1, 2, 3))
SECOND_BEFORE = {D2: datetime(2021, 3, 1, 23, 59, 59), D3: datetime(2021, 3, 2, 23, 59, 59)}
HIGH = schemas.HIGH
OLD = datetime(2020, 1, 1)
CARD = " 1234 5678 9012 3456 "


def terminals_of(day):
    rows = [("A8966", "ATM", "Town", f"Street {day.day}"), ("T0001", "POS", "Town", "Quay 1")]
    if day == D2:
        rows.append(("P9111", "ATM", "Town", "Hill 5"))
    if day != D2:
        rows.append(("R0001", "POS", "Town", "Lane 7"))
    if day == D1:
        rows.append(("G0001", "POS", "Town", "Gone 1"))
    return rows


def transactions_of(day):
    at = day.strftime("%Y-%m-%d 10:00:0")
    n = day.day
    return [
        (f"{n}001", at + "1", "1234,56", "1234 5678 9012 3456", "PAYMENT", "SUCCESS", "A8966"),
        (f"{n}002", at + "2", "10,5", "card-b", "DEPOSIT", "REJECT", "T0001"),
        (f"{n}003", at + "3", "7", "card-c", "WITHDRAW", "SUCCESS", "T0001"),
    ]


def blacklist_of(day):
    entries = [(D1, "never-used")]
    if day >= D2:
        entries.append((D2, "pass-b"))
    return entries


def bank_of(spark, day):
    accounts = [
        ("acc-a" + " " * 15, datetime(2030, 1, 1), "cli-a", OLD, None),
        ("acc-b", datetime(2021, 3, 1), "cli-b", OLD, None),
        ("acc-c", datetime(2030, 1, 1), "cli-c", OLD, None),
    ]
    cards = [(CARD, "acc-a", OLD, None), ("card-b", "acc-b", OLD, None), ("card-c", "acc-c", OLD, None)]
    clients = [
        ("cli-a", "Ray", "Ann", None, datetime(1990, 1, 1), "pass-a", None, "+71", OLD, None),
        ("cli-b", "Bee", "Bob", "B", datetime(1990, 1, 1), "pass-b", datetime(2030, 1, 1), "+72", OLD, None),
        ("cli-c", "Cee", "Cat", "C", datetime(1990, 1, 1), "pass-c", datetime(2021, 3, 2), "+73", OLD, None),
    ]
    if day == D3:  # client a moves
        clients[0] = (*clients[0][:7], "+79", OLD, datetime(2021, 3, 2, 12))
    return FrameBank(
        {
            "accounts": spark.createDataFrame(accounts, schemas.STG_ACCOUNTS),
            "cards": spark.createDataFrame(cards, schemas.STG_CARDS),
            "clients": spark.createDataFrame(clients, schemas.STG_CLIENTS),
        }
    )


def end_of(day):
    return day.replace(hour=23, minute=59, second=59)


def run_time(day):
    return day.replace(hour=12, minute=45)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("golden")
    feeds, archive = root / "feeds", root / "archive"
    feeds.mkdir()
    warehouse = Warehouse.bootstrap(spark, str(root / "warehouse"))
    reports = {}
    for day in (D1, D2, D3):
        blacklist_drop(feeds, day, blacklist_of(day))
        transactions_drop(feeds, day, transactions_of(day))
        terminals_drop(feeds, day, terminals_of(day))
        run_load(warehouse, str(feeds), bank_of(spark, day), run_time(day), str(archive))
        rows = run_report(warehouse, end_of(day)).collect()
        reports[day] = sorted((r.event_id, r.passport, r.fio, r.phone, r.event_type) for r in rows)
    return warehouse, reports, feeds, archive


def versions(warehouse, name, key):
    spec = schemas.DIMS[name]
    rows = warehouse.history(name).where(F.col(spec.key) == key).collect()
    return sorted((r.effective_from, r.effective_to, r.deleted_flg) for r in rows)


def test_terminal_that_changes_daily(loaded):
    assert versions(loaded[0], "terminals", "A8966") == [
        (D1, SECOND_BEFORE[D2], "N"),
        (D2, SECOND_BEFORE[D3], "N"),
        (D3, HIGH, "N"),
    ]


def test_terminal_that_appears_and_goes(loaded):
    assert versions(loaded[0], "terminals", "P9111") == [
        (D2, SECOND_BEFORE[D3], "N"),
        (D3, HIGH, "Y"),
    ]


def test_unchanged_terminal_keeps_one_version(loaded):
    assert versions(loaded[0], "terminals", "T0001") == [(D1, HIGH, "N")]


def test_terminal_that_returns_unchanged_is_reopened(loaded):
    assert versions(loaded[0], "terminals", "R0001") == [
        (D1, SECOND_BEFORE[D2], "N"),
        (D2, SECOND_BEFORE[D3], "Y"),
        (D3, HIGH, "N"),
    ]


def test_tombstone_of_an_absent_key_does_not_multiply(loaded):
    assert versions(loaded[0], "terminals", "G0001") == [
        (D1, SECOND_BEFORE[D2], "N"),
        (D2, HIGH, "Y"),
    ]


def test_padded_keys_are_trimmed_and_never_deleted(loaded):
    warehouse = loaded[0]
    assert versions(warehouse, "cards", CARD.strip()) == [(OLD, HIGH, "N")]
    assert versions(warehouse, "accounts", "acc-a") == [(OLD, HIGH, "N")]


def test_changed_client_gets_a_second_version(loaded):
    changed = datetime(2021, 3, 2, 12)
    assert versions(loaded[0], "clients", "cli-a") == [
        (OLD, datetime(2021, 3, 2, 11, 59, 59), "N"),
        (changed, HIGH, "N"),
    ]


def test_amount_keeps_its_cents(loaded):
    rows = loaded[0].transactions().orderBy("trans_id").collect()
    assert len(rows) == 9
    assert str(rows[0].amt) == "1234.56" and str(rows[1].amt) == "10.50"


def test_reports(loaded):
    _, reports, _, _ = loaded

    def event(day, n, passport, fio, phone, kind):
        return (day.replace(hour=10, second=n), passport, fio, phone, kind)

    contract_b = [event(d, 2, "pass-b", "Bee Bob B", "+72", "2") for d in (D1, D2, D3)]
    blocked_b = [event(d, 2, "pass-b", "Bee Bob B", "+72", "1") for d in (D1, D2, D3)]
    expired_c = [event(d, 3, "pass-c", "Cee Cat C", "+73", "1") for d in (D1, D2, D3)]
    # Listed on the second day only; the contract's last day already counts as lapsed.
    assert reports[D1] == contract_b[:1]
    assert reports[D2] == sorted(contract_b[:2] + blocked_b[:2] + expired_c[:2])
    assert reports[D3] == sorted(contract_b + blocked_b + expired_c)


def test_missing_expiry_never_counts_as_expired(loaded):
    assert not [r for day in loaded[1].values() for r in day if r[1] == "pass-a"]


def test_histories_are_sound(loaded):
    for name, spec in schemas.DIMS.items():
        found = validate_history(loaded[0].history(name), spec.key).collect()
        assert {r.check_name: r.violations for r in found} == {
            "open_rows": 0,
            "reversed": 0,
            "duplicate_start": 0,
            "broken_chain": 0,
        }


def test_watermarks_and_archive(loaded):
    warehouse, _, feeds, archive = loaded
    marks = {r.tablename: r.last_update for r in warehouse.watermarks().collect()}
    assert marks == {
        "terminals": D3,
        "blacklist": D2,
        "transactions": datetime(2021, 3, 3, 10, 0, 3),
        "accounts": OLD,
        "cards": OLD,
        "clients": datetime(2021, 3, 2, 12),
    }
    assert not list(feeds.iterdir())
    assert len([p for p in archive.iterdir() if p.name.endswith(".backup")]) == 9


def test_same_load_again_changes_nothing(spark, loaded):
    warehouse, reports, feeds, archive = loaded

    def state():
        tables = {n: warehouse.history(n) for n in schemas.DIMS}
        tables |= {"tx": warehouse.transactions(), "bl": warehouse.blacklist()}
        tables |= {"marks": warehouse.watermarks(), "report": warehouse.report()}
        return {n: sorted(map(str, df.collect())) for n, df in tables.items()}

    before = state()
    blacklist_drop(feeds, D3, blacklist_of(D3))
    transactions_drop(feeds, D3, transactions_of(D3))
    terminals_drop(feeds, D3, terminals_of(D3))
    run_load(warehouse, str(feeds), bank_of(spark, D3), run_time(D3), str(archive))
    run_report(warehouse, end_of(D3))
    assert state() == before


def test_older_feeds_after_newer_ones(spark, loaded):
    """The marks do not move back, no row doubles, and the snapshot deletes nothing."""
    warehouse, _, feeds, archive = loaded
    before = {n: sorted(map(str, warehouse.history(n).collect())) for n in schemas.DIMS}
    marks = sorted(map(str, warehouse.watermarks().collect()))
    listed = sorted(map(str, warehouse.blacklist().collect()))
    blacklist_drop(feeds, D1, blacklist_of(D1))
    transactions_drop(feeds, D1, transactions_of(D1))
    terminals_drop(feeds, D1, terminals_of(D1))
    run_load(warehouse, str(feeds), bank_of(spark, D3), run_time(D3), str(archive))
    assert {n: sorted(map(str, warehouse.history(n).collect())) for n in schemas.DIMS} == before
    assert sorted(map(str, warehouse.watermarks().collect())) == marks
    assert sorted(map(str, warehouse.blacklist().collect())) == listed
    assert warehouse.transactions().count() == 9
    assert warehouse.rejected_transactions().count() == 0
    late = warehouse.rejected_rows("terminals")
    assert late.count() == len(terminals_of(D1))
    assert {r["effective_from"] for r in late.collect()} == {D1}
