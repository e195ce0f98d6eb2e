"""One query per operator, over the whole sample tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acceptance.relations import REPORT_TS, Sample
from acceptance.workbooks import workbook_bytes
from tidemark import operators as op
from tidemark.functions import change_time, full_name, normalize_keys, parse_amount, parse_dates
from tidemark.functions.clean import (
    DAY_PATTERN,
    DOTTED_DAY_PATTERN,
    SECOND_PATTERN,
    to_iso_text,
)
from tidemark.plans import FrameBank, Warehouse, run_report
from tidemark.plans.load import (
    load_bank_table,
    load_blacklist,
    load_terminals,
    load_together,
    load_transactions,
)
from tidemark.schemas import STG_TRANSACTIONS
from tidemark.session import scratch_path
from tidemark.sources import (
    discover_feed,
    files,
    read_delimited,
    stamp_file_date,
    workbook_rows,
    write_delimited,
)
from tidemark.sources.discovery import FILE_DATE_PATTERN
from tidemark.streaming import feed_stream

KEY, ATTRS = "k", ["nm", "seg", "nk"]
DAY_1, DAY_2, RUN_2 = "2021-03-01", "2021-03-02", "2021-03-02 00:45:00"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str) -> Callable:
    def register(build: Callable[[Sample], DataFrame]) -> Callable[[Sample], DataFrame]:
        QUERIES[name] = lambda spark, folder: build(Sample(spark, folder))
        return build

    return register


def _text_schema(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _decimal_comma(col: str) -> Column:
    return F.replace(F.col(col).cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))


# Sources and scalar functions.


@query("src_delimited")
def _src_delimited(s: Sample) -> DataFrame:
    path = scratch_path(s.spark, "orders-feed")
    drop = s.table("orders").select(
        F.col("o_orderkey").alias("id"),
        F.date_format("o_orderdate", SECOND_PATTERN).alias("date"),
        _decimal_comma("o_totalprice").alias("amount"),
        F.concat(F.lit('"'), "o_orderstatus", F.lit('" \\; "x\\')).alias("note"),
    )
    write_delimited(drop, path)
    staged = read_delimited(
        s.spark, path, _text_schema("transaction_id", "transaction_date", "amount", "note")
    )
    return staged.select(
        F.col("transaction_id").cast("bigint").alias("transaction_id"),
        parse_dates(F.col("transaction_date"), SECOND_PATTERN).alias("trans_date"),
        parse_amount(F.col("amount")).alias("amt"),
        "note",
    )


@query("src_delimited_rejected")
def _src_delimited_rejected(s: Sample) -> DataFrame:
    """Orders as lines of which some miss a value or hold bad ones; those not read, and why."""
    path, key = scratch_path(s.spark, "lines"), F.col("o_orderkey") % 50
    day = F.date_format("o_orderdate", SECOND_PATTERN)
    lines = s.table("orders").select(
        F.concat_ws(
            ";",
            "o_orderkey",
            F.when(key == 1, F.concat(day, F.lit("?"))).when(key == 4, F.lit("")).otherwise(day),
            F.when(key.isin(1, 2), F.lit("many")).when(key == 5, F.lit(None)).otherwise(_decimal_comma("o_totalprice")),
            F.concat(F.lit("card"), "o_custkey"),
            F.when(key == 3, F.lit("a;b;c;d")).otherwise(F.lit("PAYMENT")),
            F.lit("SUCCESS"),
            F.lit("T1"),
        )
    )
    lines.write.text(path)
    staged = read_delimited(s.spark, path, STG_TRANSACTIONS, keep_bad=True, header="false")
    kept = op.fact_transactions(staged, strict=False).select(
        F.col("trans_id").alias("line"), F.lit("read").alias("reason")
    )
    return op.rejected_lines(staged).unionByName(kept)


@query("src_file_date")
def _src_file_date(s: Sample) -> DataFrame:
    """Orders in one drop per month, found by name and stamped with the drop's date."""
    written, feeds = scratch_path(s.spark, "drops"), scratch_path(s.spark, "feeds")
    month = F.date_format(F.date_trunc("month", "o_orderdate"), FILE_DATE_PATTERN)
    orders = s.table("orders").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("transactions_"), month, F.lit(".txt")).alias("drop"),
    )
    orders.write.partitionBy("drop").options(sep=";", header="true").csv(written)
    files.make_folder(s.spark, feeds)
    for name in files.list_names(s.spark, written):
        if name.startswith("drop="):
            files.rename(s.spark, f"{written}/{name}", f"{feeds}/{name.removeprefix('drop=')}")
    paths = [drop.path for drop in discover_feed(s.spark, feeds, "transactions")]
    staged = read_delimited(s.spark, paths, _text_schema("id"))
    return stamp_file_date(staged).select(F.col("id").cast("bigint").alias("id"), "file_date")


@query("src_workbook")
def _src_workbook(s: Sample) -> DataFrame:
    """Customers as workbooks of up to 500 rows, with numbers, text and dates, behind a sheet of notes."""
    rows = s.table("customer").select(
        "c_custkey",
        "c_name",
        "c_nationkey",
        (F.col("c_custkey") % 800).alias("days"),
        F.floor(F.col("c_custkey") / 500).alias("book"),
    )

    def write(book: pd.DataFrame) -> pd.DataFrame:
        header = ["id", "name", "nation", "valid"]
        start = datetime(2023, 1, 1)
        sheet = [
            [int(r.c_custkey), r.c_name, int(r.c_nationkey), start + timedelta(r.days)]
            for r in book.itertuples()
        ]
        content = workbook_bytes({"notes": [["id"], ["none"]], "customers": [header, *sheet]})
        return pd.DataFrame({"path": [f"book-{book.book.iloc[0]}"], "content": [content]})

    books = rows.groupBy("book").applyInPandas(write, "path string, content binary")
    schema = _text_schema("id", "name", "nation", "valid")
    return workbook_rows(books, "customers", schema, dates=("valid",)).select(
        F.col("id").cast("bigint").alias("id"),
        "name",
        F.col("nation").cast("int").alias("nation"),
        parse_dates(F.col("valid"), DAY_PATTERN).alias("valid_to"),
    )


@query("normalize_keys")
def _normalize_keys(s: Sample) -> DataFrame:
    padded = s.table("customer").select(F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("key"))
    return normalize_keys(padded, "key")


@query("parse_dates")
def _parse_dates(s: Sample) -> DataFrame:
    dotted = F.date_format("o_orderdate", DOTTED_DAY_PATTERN)
    parsed = parse_dates(dotted, DOTTED_DAY_PATTERN)
    return s.table("orders").select(
        "o_orderkey", parsed.alias("dt"), to_iso_text(parsed).alias("iso")
    )


@query("change_time")
def _change_time(s: Sample) -> DataFrame:
    return s.acct_changes().select("account_num", change_time().alias("change_ts"))


@query("full_name")
def _full_name(s: Sample) -> DataFrame:
    fio = full_name("last_name", "first_name", "patronymic")
    return s.dim_clients().select("client_id", fio.alias("fio"))


# Watermarks.


@query("watermark_extract")
def _watermark_extract(s: Sample) -> DataFrame:
    return op.incremental(s.acct_changes(), "2000-01-01").select(
        "account_num", "status", change_time().alias("change_ts")
    )


@query("watermark_advance")
def _watermark_advance(s: Sample) -> DataFrame:
    stored = s.spark.sql(
        "SELECT tablename, TIMESTAMP_NTZ '2000-01-01 00:00:00' AS last_update "
        "FROM VALUES ('accounts'), ('empty') AS t(tablename)"
    )
    nothing = s.table("orders").where(F.col("o_orderkey") < 0)
    return op.advance_watermark(
        stored,
        {
            "accounts": (s.acct_changes(), change_time()),
            "empty": (nothing, F.col("o_orderdate")),
        },
    )


# Snapshot comparison.


@query("snapshot_new")
def _snapshot_new(s: Sample) -> DataFrame:
    return op.snapshot_new(s.cust_v2(), s.cust_v1(), KEY)


@query("snapshot_changed")
def _snapshot_changed(s: Sample) -> DataFrame:
    return op.snapshot_changed(s.cust_v2(), s.cust_v1(), KEY, ATTRS)


@query("snapshot_deleted")
def _snapshot_deleted(s: Sample) -> DataFrame:
    return op.snapshot_deleted(s.cust_v1(), s.cust_v2(), KEY)


# History.


def _open_v1(s: Sample) -> DataFrame:
    return op.scd2_insert_versions(s.cust_v1(), KEY, ATTRS, DAY_1)


def _new_or_changed(s: Sample) -> DataFrame:
    new = op.snapshot_new(s.cust_v2(), _open_v1(s), KEY)
    return new.unionByName(op.snapshot_changed(s.cust_v2(), _open_v1(s), KEY, ATTRS))


@query("scd2_insert_versions")
def _scd2_insert_versions(s: Sample) -> DataFrame:
    return op.scd2_insert_versions(_new_or_changed(s), KEY, ATTRS, DAY_2)


@query("scd2_close_versions")
def _scd2_close_versions(s: Sample) -> DataFrame:
    return op.scd2_close_versions(_open_v1(s), _new_or_changed(s), KEY, ATTRS, DAY_2)


@query("scd2_tombstones")
def _scd2_tombstones(s: Sample) -> DataFrame:
    return op.scd2_tombstones(_open_v1(s), s.cust_v2(), KEY, ATTRS, RUN_2)


@query("scd2_apply_snapshot")
def _scd2_apply_snapshot(s: Sample) -> DataFrame:
    applied = op.scd2_apply_snapshot(_open_v1(s), s.cust_v2(), KEY, ATTRS, DAY_2, RUN_2)
    return op.history_of(applied)


@query("scd2_apply_incremental")
def _scd2_apply_incremental(s: Sample) -> DataFrame:
    changes = s.acct_changes().withColumn("change_ts", change_time())
    nothing_yet = op.scd2_insert_versions(
        changes.where(F.lit(False)), "account_num", ["status"], F.col("change_ts")
    )
    applied = op.scd2_apply_incremental(
        nothing_yet,
        changes,
        "account_num",
        ["status"],
        "change_ts",
        "2002-01-01 00:45:00",
        s.live_accounts(),
    )
    return op.history_of(applied)


@query("dim_current")
def _dim_current(s: Sample) -> DataFrame:
    return op.dim_current(s.dim_cards())


@query("dim_as_of")
def _dim_as_of(s: Sample) -> DataFrame:
    return op.dim_as_of(s.dim_cards(), REPORT_TS)


@query("dim_first_seen")
def _dim_first_seen(s: Sample) -> DataFrame:
    return op.dim_first_seen(s.acct_versions(), "account_num", "change_ts").drop("status")


@query("dim_first_seen_hot")
def _dim_first_seen_hot(s: Sample) -> DataFrame:
    """Shipments by return flag, a third or more of all rows each; some have none."""
    flag = F.when(F.col("l_returnflag") != "A", F.col("l_returnflag"))
    rows = s.table("lineitem").select(
        "l_orderkey", "l_linenumber", flag.alias("flag"), "l_shipdate"
    )
    return op.dim_first_seen(rows, "flag", "l_shipdate", hot_rows=1_000)


@query("validate_history")
def _validate_history(s: Sample) -> DataFrame:
    """Orders as versions that last a month each: they overlap, and leave gaps."""
    history = s.table("orders").select(
        F.col("o_custkey").alias("account_num"),
        F.col("o_orderdate").alias("effective_from"),
        F.when(
            F.col("o_orderstatus") != "O", F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")
        ).otherwise(F.expr("TIMESTAMP_NTZ '2999-12-31 00:00:00'")).alias("effective_to"),
    )
    return op.validate_history(history, "account_num")


# Facts.


@query("fact_transactions_load")
def _fact_transactions_load(s: Sample) -> DataFrame:
    staged = s.table("lineitem").select(
        F.col("l_linenumber").alias("transaction_id"),
        F.col("l_shipdate").alias("transaction_date"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_orderkey").alias("card_num"),
    )
    return op.append_fact(op.fact_transactions(staged))


@query("fact_blacklist_load")
def _fact_blacklist_load(s: Sample) -> DataFrame:
    return op.fact_blacklist(s.fact_blacklist(), "2024-01-10")


# Reports.


@query("txn_enriched")
def _txn_enriched(s: Sample) -> DataFrame:
    return op.enrich_as_of(s.fact_tx(), *s.dims(), REPORT_TS).select(
        "trans_date", "client_id", "passport_num", "valid_to"
    )


@query("txn_enriched_event")
def _txn_enriched_event(s: Sample) -> DataFrame:
    return op.enrich_at_event(s.fact_tx(), *s.histories(), REPORT_TS).select(
        "card_num", "trans_date", "account_num", "client_id", "passport_num", "valid_to"
    )


@query("txn_enriched_event_hot")
def _txn_enriched_event_hot(s: Sample) -> DataFrame:
    """Orders of seven keys with the account version of that number, on the path of keys with very many rows."""
    facts = s.table("orders").select(
        (F.col("o_custkey") % 7).alias("key"), "o_orderkey", F.col("o_orderdate").alias("at")
    )
    owners = s.account_history().where(F.col("account_num") < 7).withColumnRenamed("account_num", "key")
    versions = owners.select("key", "valid_to", "effective_from", "effective_to")
    return op.as_of_join(facts, versions, "key", "at", hot_rows=50).select("key", "o_orderkey", "valid_to")


@query("fraud_report_event")
def _fraud_report_event(s: Sample) -> DataFrame:
    return op.fraud_at_event(s.fact_tx(), *s.histories(), s.early_blacklist(), REPORT_TS)


@query("fraud_passport_blacklisted")
def _fraud_passport_blacklisted(s: Sample) -> DataFrame:
    cards, accounts, clients = s.dims()
    subjects = op.blacklisted_subjects(accounts, clients, s.fact_blacklist(), REPORT_TS)
    return op.fraud_events(s.fact_tx(), op.flagged_cards(cards, subjects, REPORT_TS), REPORT_TS)


@query("fraud_passport_expired")
def _fraud_passport_expired(s: Sample) -> DataFrame:
    cards, accounts, clients = s.dims()
    subjects = op.expired_subjects(accounts, clients, REPORT_TS)
    return op.fraud_events(s.fact_tx(), op.flagged_cards(cards, subjects, REPORT_TS), REPORT_TS)


@query("fraud_report_passport")
def _fraud_report_passport(s: Sample) -> DataFrame:
    return op.fraud_passport(s.fact_tx(), *s.dims(), s.fact_blacklist(), REPORT_TS)


@query("fraud_passport_all_rows")
def _fraud_passport_all_rows(s: Sample) -> DataFrame:
    return op.fraud_passport(s.fact_tx(), *s.dims(), s.fact_blacklist(), REPORT_TS, distinct=False)


@query("fraud_report_contract")
def _fraud_report_contract(s: Sample) -> DataFrame:
    return op.fraud_contract(s.fact_tx(), *s.dims(), REPORT_TS)


@query("fraud_report_all")
def _fraud_report_all(s: Sample) -> DataFrame:
    return op.fraud_report_all(s.fact_tx(), *s.dims(), s.fact_blacklist(), REPORT_TS)


# Whole loads into a warehouse.


def _new_warehouse(s: Sample) -> Warehouse:
    return Warehouse.bootstrap(s.spark, scratch_path(s.spark, "warehouse"))


def _text(col: str) -> Column:
    return F.col(col).cast("string")


def _orders_as_drop(s: Sample) -> str:
    """All orders as one drop of the transactions feed."""
    feeds = scratch_path(s.spark, "feeds")
    drop = s.table("orders").select(
        F.col("o_orderkey").alias("id"),
        F.date_format("o_orderdate", SECOND_PATTERN).alias("date"),
        _decimal_comma("o_totalprice").alias("amount"),
        F.concat(F.lit(" "), _text("o_custkey")).alias("card"),
        F.col("o_orderpriority").alias("type"),
        F.col("o_orderstatus").alias("result"),
        F.lit("T1").alias("terminal"),
    )
    write_delimited(drop, f"{feeds}/transactions_15012024.txt")
    return feeds


@query("feed_stream")
def _feed_stream(s: Sample) -> DataFrame:
    """Orders as text, streamed into the warehouse; the second start finds nothing new."""
    feeds, warehouse = _orders_as_drop(s), _new_warehouse(s)
    for _ in range(2):
        feed_stream(warehouse, feeds, "transactions").awaitTermination()
    return warehouse.transactions()


@query("terminals_load")
def _terminals_load(s: Sample) -> DataFrame:
    """Both customer snapshots loaded as terminals, in two commits."""
    warehouse = _new_warehouse(s)
    for snapshot, day in ((s.cust_v1(), DAY_1), (s.cust_v2(), DAY_2)):
        commit = warehouse.begin()
        rows = snapshot.select(
            _text("k").alias("terminal_id"),
            F.col("seg").alias("terminal_type"),
            F.col("nm").alias("terminal_city"),
            _text("nk").alias("terminal_address"),
        )
        load_terminals(commit, rows, datetime.fromisoformat(day))
        commit.publish()
    return warehouse.history("terminals")


@query("cards_load")
def _cards_load(s: Sample) -> DataFrame:
    """Orders loaded as cards: all at first, later some updated and some gone."""
    orders = s.table("orders").select(
        F.col("o_orderkey").alias("n"),
        F.concat(F.lit(" "), _text("o_orderkey"), F.lit("  ")).alias("card_num"),
        _text("o_custkey").alias("account"),
        F.col("o_orderdate").alias("create_dt"),
        F.expr("CAST(NULL AS TIMESTAMP_NTZ)").alias("update_dt"),
    )
    moved = F.col("n") % 3 == 0
    later = (
        orders.where(F.col("n") % 11 != 5)
        .withColumn("account", F.when(moved, F.lit("moved")).otherwise(F.col("account")))
        .withColumn("update_dt", F.when(moved, F.expr("TIMESTAMP_NTZ '2010-01-01 08:00:00'")))
    )
    warehouse = _new_warehouse(s)
    for source, run_ts in ((orders, "2009-01-01"), (later, "2010-01-02")):
        commit = warehouse.begin()
        newest = load_bank_table(commit, FrameBank({"cards": source}), "cards", run_ts)
        commit.advance_watermarks(newest)
        commit.publish()
    return warehouse.history("cards")


@query("report_stored")
def _report_stored(s: Sample) -> DataFrame:
    """The sample as source tables and feeds, loaded, reported and read from the store."""
    created = [
        F.expr("TIMESTAMP_NTZ '1990-01-01 00:00:00'").alias("create_dt"),
        F.expr("CAST(NULL AS TIMESTAMP_NTZ)").alias("update_dt"),
    ]
    cards, accounts, clients = s.dims()
    bank = FrameBank(
        {
            "cards": cards.select(
                _text("card_num").alias("card_num"), _text("account_num").alias("account"), *created
            ),
            "accounts": accounts.select(
                _text("account_num").alias("account"),
                "valid_to",
                _text("client").alias("client"),
                *created,
            ),
            "clients": clients.select(
                _text("client_id").alias("client_id"),
                "last_name",
                "first_name",
                "patronymic",
                F.col("effective_from").alias("date_of_birth"),
                "passport_num",
                "passport_valid_to",
                "phone",
                *created,
            ),
        }
    )
    staged = s.table("lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"),
        F.col("l_shipdate").alias("transaction_date"),
        F.col("l_extendedprice").alias("amount"),
        _text("l_orderkey").alias("card_num"),
        F.lit("PAYMENT").alias("oper_type"),
        F.lit("SUCCESS").alias("oper_result"),
        F.lit("T1").alias("terminal"),
    )
    listed = s.fact_blacklist().select(
        F.date_format("entry_dt", DAY_PATTERN).alias("entry_dt"), "passport_num"
    )
    warehouse = _new_warehouse(s)
    commit = warehouse.begin()
    load_together(
        [
            partial(load_transactions, commit, staged),
            partial(load_blacklist, commit, listed),
            *[partial(load_bank_table, commit, bank, t, "2020-01-01") for t in bank.tables],
        ]
    )
    commit.publish()
    return run_report(warehouse, REPORT_TS)
