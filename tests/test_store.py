import json
from datetime import datetime
from pathlib import Path

import pytest

from feeds import blacklist_drop, terminals_drop, transactions_drop
from tidemark import schemas
from tidemark.operators import read_watermark, scd2_apply_snapshot
from tidemark.plans.load import load_bank_table, load_terminals, load_transactions
from tidemark.plans import ConcurrentLoadError, FrameBank, Warehouse, run_backlog, run_load, run_report
from tidemark.sources import MissingFeedError, waiting_days
from tidemark.streaming import feed_stream

D1, D2, D3 = (datetime(2021, 3, d) for d in (1, 2, 3))


def bank(spark):
    return FrameBank(
        {
            "accounts": spark.createDataFrame([("a", D3, "c", D1, None)], schemas.STG_ACCOUNTS),
            "cards": spark.createDataFrame([("card", "a", D1, None)], schemas.STG_CARDS),
            "clients": spark.createDataFrame(
                [("c", "L", "F", "P", D1, "pass", D3, "+7", D1, None)], schemas.STG_CLIENTS
            ),
        }
    )


def transaction(n, day):
    return (str(n), day.strftime("%Y-%m-%d 08:00:00"), "1,5", "card", "PAYMENT", "SUCCESS", "T1")


def drop_all(feeds, day, terminals=(("T1", "ATM", "c", "a"),)):
    blacklist_drop(feeds, day, [(day, f"p{day.day}")])
    transactions_drop(feeds, day, [transaction(day.day, day)])
    terminals_drop(feeds, day, list(terminals))


@pytest.fixture
def place(spark, tmp_path):
    feeds = tmp_path / "feeds"
    feeds.mkdir()
    return Warehouse.bootstrap(spark, str(tmp_path / "w")), feeds, tmp_path / "archive"


def test_bootstrap_seeds_and_empty_tables(spark, place):
    warehouse = place[0]
    marks = warehouse.watermarks()
    assert marks.schema == schemas.WATERMARK
    assert sorted(r.tablename for r in marks.collect()) == sorted(schemas.WATERMARKED)
    assert read_watermark(marks, "cards") == schemas.SEED == read_watermark(marks, "unknown")
    with pytest.raises(ValueError):
        read_watermark(marks.union(marks), "cards")
    for name, spec in schemas.DIMS.items():
        assert warehouse.history(name).schema == spec.schema and warehouse.history(name).isEmpty()
    assert warehouse.transactions().schema == schemas.FACT_TRANSACTIONS
    assert warehouse.blacklist().schema == schemas.FACT_BLACKLIST
    assert warehouse.report().schema == schemas.REPORT
    assert Warehouse.bootstrap(spark, warehouse.root).manifest()["version"] == 0
    assert run_report(warehouse, D1).isEmpty()


def test_failed_run_changes_nothing_and_keeps_its_files(spark, place):
    warehouse, feeds, archive = place
    drop_all(feeds, D1)
    broken = FrameBank({**bank(spark).tables, "clients": spark.range(1)})
    with pytest.raises(Exception):
        run_load(warehouse, str(feeds), broken, D1, str(archive))
    assert warehouse.manifest()["version"] == 0 and warehouse.transactions().isEmpty()
    assert len(list(feeds.glob("*_01032021.*"))) == 3 and not archive.exists()
    staging = Path(warehouse.root) / "staging"
    assert len(list(staging.iterdir())) == 1  # the failed run's input
    run_load(warehouse, str(feeds), bank(spark), D1, str(archive))
    assert warehouse.manifest()["version"] == 1 and warehouse.transactions().count() == 1
    assert len(list(staging.iterdir())) == 1  # a run that succeeds leaves none
    warehouse.expire(keep=5)
    assert not list(staging.iterdir()) and warehouse.transactions().count() == 1


BAD = ("1", "yesterday", "1", "card", "t", "r", "x")


def test_bad_date_fails_a_strict_run(spark, place):
    warehouse, feeds, archive = place
    drop_all(feeds, D1)
    transactions_drop(feeds, D1, [BAD])
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        run_load(warehouse, str(feeds), bank(spark), D1, str(archive), strict=True)
    assert warehouse.manifest()["version"] == 0


def test_bad_lines_are_kept_aside(spark, place):
    """Other lines of the drop are loaded; nothing is set aside where all can be read."""
    warehouse, feeds, archive = place
    drop_all(feeds, D1)
    short = ("2", "2021-03-01 08:00:00", "1")
    amount = ("3", "2021-03-01 08:00:00", "1,2,3", "card", "t", "r", "x")
    transactions_drop(feeds, D1, [BAD, transaction(7, D1), short, amount])
    run_load(warehouse, str(feeds), bank(spark), D1, str(archive))
    assert [r.trans_id for r in warehouse.transactions().collect()] == ["7"]
    assert sorted(map(tuple, warehouse.unread_lines().collect())) == [
        ("1;yesterday;1;card;t;r;x", "transaction_date"),
        ("2;2021-03-01 08:00:00;1", "width"),
        ("3;2021-03-01 08:00:00;1,2,3;card;t;r;x", "amount"),
    ]
    drop_all(feeds, D2)
    run_load(warehouse, str(feeds), bank(spark), D2, str(archive))
    assert len(warehouse.manifest()["tables"]["transactions_unread"]["parts"]) == 1
    drop_all(feeds, D3)
    transactions_drop(feeds, D3, [BAD, transaction(8, D3)])
    drain(warehouse, feeds, "transactions")
    assert warehouse.transactions().count() == 3 and warehouse.unread_lines().count() == 4
    assert warehouse.expire(keep=1) is not None and warehouse.unread_lines().count() == 4


def test_empty_drop_touches_no_history(spark, place):
    warehouse, feeds, _ = place
    commit = warehouse.begin()
    rows = spark.createDataFrame([(str(n), D1, "c", None, None, None, None) for n in range(3)], schemas.FACT_TRANSACTIONS)
    commit.add_transactions(rows)
    commit.publish()
    commit = warehouse.begin()
    looked = []
    warehouse.transaction_folders = lambda *a: looked.append(a) or []
    newest = load_transactions(commit, spark.createDataFrame([], schemas.STG_TRANSACTIONS))
    assert newest == {"transactions": None} and not looked
    assert commit.next["tables"]["transactions"] == commit.base["tables"]["transactions"]
    commit.advance_watermarks(newest)
    assert commit.next["watermarks"] == commit.base["watermarks"]


def test_drop_is_parsed_once(spark, place):
    """One scan of the text a night, also where stored days are met again; then months part."""
    warehouse, feeds, _ = place
    for days, jobs in (((D1, D2), 1), ((D1, D3), 1), ((datetime(2021, 4, 1), datetime(2021, 6, 9)), 1)):
        parsed = spark.sparkContext.accumulator(0)

        def seen(batches, parsed=parsed):
            for batch in batches:
                parsed.add(batch.num_rows)
                yield batch

        rows = [transaction(d.month * 100 + d.day, d) for d in days]
        text = spark.createDataFrame(rows, schemas.STG_TRANSACTIONS)
        commit = warehouse.begin()
        load_transactions(commit, text.mapInArrow(seen, text.schema))
        commit.publish()
        assert parsed.value == jobs * len(days)
    assert warehouse.transactions().count() == 5
    spans = [(p["first"][:10], p["last"][:10]) for p in warehouse.manifest()["tables"]["transactions"]["parts"]]
    assert spans == [
        ("2021-03-01", "2021-03-02"),
        ("2021-03-01", "2021-03-03"),
        ("2021-04-01", "2021-04-30"),
        ("2021-06-01", "2021-06-09"),
    ]


def test_stored_rows_are_skipped_and_differing_ones_set_aside(spark, place):
    warehouse = place[0]
    undated = ("9", None, "1", "card", "t", "r", "x")
    changed = ("1", "2021-03-01 08:00:00", "9", "card", "PAYMENT", "SUCCESS", "T1")
    for rows in ([transaction(1, D1), undated], [changed, transaction(2, D1), undated], [undated]):
        commit = warehouse.begin()
        load_transactions(commit, spark.createDataFrame(rows, schemas.STG_TRANSACTIONS))
        commit.publish()
    assert sorted(r.trans_id for r in warehouse.transactions().collect()) == ["1", "2", "9"]
    assert [str(r.amt) for r in warehouse.rejected_transactions().collect()] == ["9.00"]
    assert [r.trans_id for r in warehouse.transactions(D2, D3).collect()] == ["9"]


def open_files(warehouse, name):
    return {f.split("key_bucket=")[1].split("/")[0]: f for f in warehouse.open_rows(name).inputFiles()}


def test_changed_row_leaves_other_folders_alone(spark, place):
    warehouse, feeds, _ = place
    spec = schemas.TERMINALS

    def load(day, changed=(), gone=(), extra=()):
        rows = [(f"T{n}", "ATM", "moved" if n in changed else None, "a") for n in range(60) if n not in gone]
        rows += list(extra)
        commit = warehouse.begin()
        schema = ", ".join(f"{c} string" for c in ("terminal_id", "terminal_type", "terminal_city", "terminal_address"))
        load_terminals(commit, spark.createDataFrame(rows, schema), day)
        commit.publish()
        return open_files(warehouse, "terminals")

    first = load(D1)
    assert len(first) > 10
    assert load(datetime(2021, 3, 1, 12)) == first, "an equal snapshot rewrites nothing"
    second = load(D2, changed=(5,))
    assert sum(second[b] != first[b] for b in first) == 1
    third = load(D3, changed=(5,), gone=(6,), extra=[("T99", "ATM", None, "a")])
    assert 1 <= sum(third.get(b) != second.get(b) for b in third) <= 2
    rows = {(r[spec.key], r.effective_from, r.deleted_flg) for r in warehouse.history("terminals").collect()}
    assert {("T5", D1, "N"), ("T5", D2, "N"), ("T6", D1, "N"), ("T6", D3, "Y"), ("T99", D3, "N")} <= rows
    assert len(rows) == 60 + 3
    # values that move between columns are a change, though the same values are there
    swapped = load(datetime(2021, 3, 4), changed=(5,), gone=(6, 7), extra=[("T99", "ATM", None, "a"), ("T7", "ATM", "a", None)])
    assert swapped != third


def test_bank_change_leaves_other_folders_alone(spark, place):
    warehouse = place[0]
    cards = [(f"c{n}", "a", D1, None) for n in range(60)]

    def load(rows, run_ts):
        commit = warehouse.begin()
        source = FrameBank({"cards": spark.createDataFrame(rows, schemas.STG_CARDS)})
        commit.advance_watermarks(load_bank_table(commit, source, "cards", run_ts))
        commit.publish()
        return open_files(warehouse, "cards")

    first = load(cards, D1)
    changed = [("c1", "b", D1, datetime(2021, 3, 1, 9)), *[c for c in cards if c[0] not in ("c1", "c2")]]
    second = load(changed, D2)
    assert 1 <= sum(second[b] != first[b] for b in first) <= 2
    assert warehouse.watermark("cards") == datetime(2021, 3, 1, 9)
    assert load(changed, D3) == second
    third = load([*changed, ("c2", "a", D1, None)], D3)  # returned without a newer change
    assert sum(third[b] != second[b] for b in second) == 1
    flags = [(r.card_num, r.deleted_flg) for r in warehouse.open_rows("cards").collect()]
    assert len(flags) == 60 and ("c2", "N") in flags


def test_missing_feed_stops_the_run(spark, place):
    warehouse, feeds, archive = place
    drop_all(feeds, D1)
    next(feeds.glob("terminals*")).unlink()
    with pytest.raises(MissingFeedError, match="terminals"):
        run_load(warehouse, str(feeds), bank(spark), D1, str(archive))
    assert warehouse.manifest()["version"] == 0


def test_days_are_never_mixed(spark, place):
    """A day without one of its drops stops the backlog there, with the days before loaded."""
    warehouse, feeds, archive = place
    for day in (D1, D2, D3):
        drop_all(feeds, day)
    next(feeds.glob("passport_blacklist_02032021*")).unlink()
    with pytest.raises(MissingFeedError, match=r"2021-03-02 has no drop of blacklist; gaps: .*'2021-03-02'"):
        run_backlog(warehouse, str(feeds), bank(spark), D3, str(archive))
    assert warehouse.manifest()["version"] == 1 and warehouse.watermark("terminals") == D1
    days = waiting_days(spark, str(feeds))
    assert [sorted(d) for d in days.values()] == [["terminals", "transactions"], ["blacklist", "terminals", "transactions"]]
    blacklist_drop(feeds, D2, [(D2, "p2")])
    assert run_backlog(warehouse, str(feeds), bank(spark), D3, str(archive)) == 2
    assert warehouse.watermark("terminals") == D3


def test_of_two_runs_at_once_one_must_start_again(spark, place):
    warehouse = place[0]
    one, other = warehouse.begin(), warehouse.begin()
    for commit, passport in ((one, "first"), (other, "second")):
        row = [(passport, D1)]
        commit.add_blacklist(spark.createDataFrame(row, schemas.FACT_BLACKLIST))
    one.publish()
    with pytest.raises(ConcurrentLoadError):
        other.publish()
    assert [r.passport_num for r in warehouse.blacklist().collect()] == ["first"]
    assert warehouse.expire(keep=1) and warehouse.blacklist().count() == 1


def test_backlog_in_date_order_then_expiry(spark, place):
    warehouse, feeds, archive = place
    drop_all(feeds, D2, [("T1", "ATM", "c", "moved")])
    drop_all(feeds, D1)
    drop_all(feeds, D3, [("T1", "ATM", "c", "moved")])
    assert run_backlog(warehouse, str(feeds), bank(spark), D3, str(archive)) == 3
    assert [r.effective_from for r in warehouse.history("terminals").orderBy("effective_from").collect()] == [D1, D2]
    assert warehouse.blacklist().count() == 3 and warehouse.transactions().count() == 3

    before = {n: sorted(map(str, warehouse.history(n).collect())) for n in schemas.DIMS}
    deleted = warehouse.expire(keep=1)
    # The first open set is gone; its closed rows and the facts are still in use.
    assert any(d.startswith("data/terminals/v=1-") for d in deleted)
    assert not any(d.startswith("data/transactions/") for d in deleted)
    assert {n: sorted(map(str, warehouse.history(n).collect())) for n in schemas.DIMS} == before
    assert warehouse.transactions().count() == 3 and len(warehouse._versions()) == 1


def test_reset_empties_tables_and_reseeds(spark, place):
    warehouse, feeds, archive = place
    drop_all(feeds, D1)
    run_load(warehouse, str(feeds), bank(spark), D1, str(archive))
    warehouse.reset()
    assert warehouse.transactions().isEmpty() and warehouse.history("cards").isEmpty()
    assert warehouse.watermark("cards") == schemas.SEED


def test_report_is_replaced_not_doubled(spark, place):
    warehouse, feeds, archive = place
    drop_all(feeds, D1)
    run_load(warehouse, str(feeds), bank(spark), D1, str(archive))
    late = datetime(2021, 3, 4, 23, 59, 59)
    first = sorted(map(str, run_report(warehouse, late).collect()))
    assert first and sorted(map(str, run_report(warehouse, late).collect())) == first
    run_report(warehouse, D1)
    assert sorted(map(str, warehouse.report(late).collect())) == first
    assert len(warehouse.manifest()["reports"]) == 2


def test_reads_touch_only_the_days_and_parts_in_question(spark, place):
    warehouse, feeds, archive = place
    for day in (D1, D2, D3):
        drop_all(feeds, day, [("T1", "ATM", "c", f"a{day.day}")])
        run_load(warehouse, str(feeds), bank(spark), day, str(archive))
    day = (D2, datetime(2021, 3, 2, 23, 59, 59))
    found = warehouse.transactions(*day)
    assert {f.split("/v=")[1].split("-")[0] for f in found.inputFiles()} == {"2"}
    assert len(warehouse.transaction_folders()) == 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(trans_date" in plan and "LessThanOrEqual(trans_date" in plan
    opened = warehouse.open_rows("terminals")
    assert all("state=open" in f for f in opened.inputFiles())
    assert warehouse.transactions(*day).count() == 1


# Streams.


def drain(warehouse, feeds, feed, **options):
    query = feed_stream(warehouse, str(feeds), feed, **options)
    query.awaitTermination()
    assert query.exception() is None


def test_streams_load_what_waits_once(spark, place):
    warehouse, feeds, archive = place
    drop_all(feeds, D1)
    drop_all(feeds, D2, [("T2", "POS", "c", "a")])
    for _ in range(2):
        for feed in ("transactions", "blacklist", "terminals"):
            drain(warehouse, feeds, feed, archive=str(archive))
    assert warehouse.transactions().count() == 2
    assert warehouse.blacklist().count() == 2
    terminals = warehouse.history("terminals").collect()
    got = sorted((r.terminal_id, r.effective_from, r.deleted_flg) for r in terminals)
    assert got == [("T1", D1, "N"), ("T1", D2, "Y"), ("T2", D2, "N")]

    drop_all(feeds, D3, [("T2", "POS", "c", "a")])
    for feed in ("transactions", "blacklist", "terminals"):
        drain(warehouse, feeds, feed, archive=str(archive))
    assert warehouse.transactions().count() == 3 and warehouse.blacklist().count() == 3
    assert warehouse.watermark("terminals") == D3
    # Files of an earlier batch have been moved once a later one committed.
    assert not (feeds / "transactions_01032021.txt").exists()


def test_repeated_stream_batch_is_skipped(spark, place):
    """A batch published just before a failure comes again under the same number."""
    warehouse, feeds, _ = place
    transactions_drop(feeds, D1, [transaction(1, D1)])
    commit = warehouse.begin()
    commit.put_stream_batch("transactions", 0)
    commit.publish()
    drain(warehouse, feeds, "transactions")
    assert warehouse.transactions().isEmpty()
    assert json.dumps(warehouse.manifest()["streams"]) == '{"transactions": 0}'


def test_rejected_input_is_kept_aside(spark, place):
    warehouse = place[0]
    spec = schemas.TERMINALS
    snap = spark.createDataFrame([(None, "ATM", "c", "a"), ("T1", "ATM", "c", "a")], ", ".join(
        f"{c} string" for c in (spec.key, *spec.attrs)))
    commit = warehouse.begin()
    commit.put_history("terminals", scd2_apply_snapshot(warehouse.open_rows("terminals"), snap, spec.key, spec.attrs, D1))
    commit.publish()
    assert warehouse.history("terminals").count() == 1
    assert warehouse.rejected_rows("terminals").count() == 1
