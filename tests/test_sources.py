from datetime import datetime

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acceptance.workbooks import workbook_bytes
from feeds import blacklist_drop, terminals_drop, transactions_drop
from tidemark import schemas
from tidemark.functions import full_name, normalize_keys, parse_amount, parse_dates, to_iso_text
from tidemark.operators import append_fact, changed_since, differing_copies, fact_transactions
from tidemark.plans.load import read_blacklist, read_terminals
from tidemark.sources import (
    SINGLE_TASK,
    JdbcSource,
    MissingFeedError,
    WorkbookError,
    archive_drops,
    discover_feed,
    next_drop,
    read_delimited,
    read_workbook,
    stamp_file_date,
    write_delimited,
)
from tidemark.sources.jdbc import changed_rows_query

D1, D2 = datetime(2021, 3, 1), datetime(2021, 3, 2)


def test_delimited_is_positional_text(spark, tmp_path):
    path = tmp_path / "feed.txt"
    path.write_text("whatever;names;here\n007;1234,56;a\n8;;b\n")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "amount", "x")])
    rows = read_delimited(spark, str(path), schema)
    assert [tuple(r) for r in rows.collect()] == [("007", "1234,56", "a"), ("8", None, "b")]
    amounts = rows.select(parse_amount(F.col("amount"))).collect()
    assert [str(r[0]) for r in amounts] == ["1234.56", "None"]


@pytest.mark.parametrize("line", ["1;2", "1;2;3;4"])
def test_delimited_row_of_another_width_fails(spark, tmp_path, line):
    path = tmp_path / "feed.txt"
    path.write_text(f"a;b;c\n{line}\n")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in "abc"])
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILFAST"):
        read_delimited(spark, str(path), schema).collect()


def test_discovery_orders_by_business_date_and_ignores_other_names(spark, tmp_path):
    for name in (
        "transactions_02032021.txt",
        "transactions_10022021.txt",
        "transactions_1.txt",
        "transactions_02032021.txt.backup",
        "old_transactions_02032021.txt",
        "terminals_02032021.xlsx",
    ):
        (tmp_path / name).write_text("")
    found = discover_feed(spark, str(tmp_path), "transactions")
    assert [d.name for d in found] == ["transactions_10022021.txt", "transactions_02032021.txt"]
    assert next_drop(spark, str(tmp_path), "transactions").date == datetime(2021, 2, 10)
    with pytest.raises(MissingFeedError, match="blacklist"):
        next_drop(spark, str(tmp_path), "blacklist")
    with pytest.raises(MissingFeedError):
        next_drop(spark, str(tmp_path / "no such folder"), "blacklist")


def test_file_date_from_file_and_from_folder_drop(spark, tmp_path):
    transactions_drop(tmp_path, D1, [("1", "2021-03-01 00:00:00", "1", "c", "t", "r", "x")])
    folder = tmp_path / "transactions_02032021.txt"
    folder.mkdir()
    (folder / "part-0.csv").write_text("h;h;h;h;h;h;h\n2;2021-03-02 00:00:00;1;c;t;r;x\n")
    paths = [d.path for d in discover_feed(spark, str(tmp_path), "transactions")]
    rows = stamp_file_date(read_delimited(spark, paths, schemas.STG_TRANSACTIONS))
    got = {r.transaction_id: r.file_date for r in rows.collect()}
    assert got == {"1": D1, "2": D2}


def test_archive_keeps_earlier_copies(spark, tmp_path):
    feeds, archive = tmp_path / "feeds", tmp_path / "new" / "archive"
    feeds.mkdir()
    for n in range(3):
        (feeds / "transactions_01032021.txt").write_text(str(n))
        archive_drops(spark, discover_feed(spark, str(feeds), "transactions"), str(archive))
    kept = {p.name: p.read_text() for p in archive.iterdir() if not p.name.startswith(".")}
    base = "transactions_01032021.txt.backup"
    assert kept == {base: "0", f"{base}.1": "1", f"{base}.2": "2"}


def test_blacklist_workbook(spark, tmp_path):
    path = blacklist_drop(tmp_path, D1, [(D1, "1234 567890"), (datetime(2021, 2, 27, 6, 30), "0099")])
    rows = read_blacklist(spark, str(path)).drop("path").collect()
    assert [tuple(r) for r in rows] == [("2021-03-01", "1234 567890"), ("2021-02-27 06:30:00", "0099")]


def test_terminals_workbooks_of_two_days(spark, tmp_path):
    paths = [
        str(terminals_drop(tmp_path, D1, [("A1", "ATM", "Town & Co", None), ("A2", None, "x", "y")])),
        str(terminals_drop(tmp_path, D2, [("A1", "ATM", "Город", "ул. 1")])),
    ]
    got = sorted(map(tuple, read_terminals(spark, paths).collect()), key=str)
    assert got == [
        ("A1", "ATM", "Town & Co", None, D1),
        ("A1", "ATM", "Город", "ул. 1", D2),
        ("A2", None, "x", "y", D1),
    ]


def test_workbook_numbers_stay_text(spark, tmp_path):
    path = tmp_path / "w.xlsx"
    path.write_bytes(workbook_bytes({"s": [["h", "i"], [12, 1.5], [1.2e15, None], ["01", "x"]]}))
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    rows = read_workbook(spark, str(path), "s", schema).drop("path").collect()
    assert [tuple(r) for r in rows] == [("12", "1.5"), ("1200000000000000", None), ("01", "x")]


def test_workbook_larger_than_a_batch(spark, tmp_path):
    path = tmp_path / "w.xlsx"
    path.write_bytes(workbook_bytes({"s": [["h"], *[[f"r{n}"] for n in range(25_001)]]}))
    rows = read_workbook(spark, str(path), "s", T.StructType([T.StructField("a", T.StringType())]))
    assert rows.select("a").distinct().count() == 25_001


@pytest.mark.parametrize("sheets", [{"other": [["h"], ["x"]]}, {"s": [["h", "i"], ["x", "y"]]}])
def test_workbook_that_does_not_fit(spark, tmp_path, sheets):
    path = tmp_path / "w.xlsx"
    path.write_bytes(workbook_bytes(sheets))
    schema = T.StructType([T.StructField("a", T.StringType())])
    with pytest.raises(Exception, match=WorkbookError.__name__):
        read_workbook(spark, str(path), "s", schema).collect()


def test_keys_dates_and_names(spark):
    df = spark.createDataFrame(
        [("  a\t ", "   ", 5, "01.03.2021"), (None, "x", 6, "bad")],
        "k string, l string, n int, d string",
    )
    cleaned = normalize_keys(df, "k", "l", "n").select("k", "l", "n").collect()
    assert [tuple(r) for r in cleaned] == [("a\t", None, 5), (None, "x", 6)]
    lenient = df.select(parse_dates(F.col("d"), "dd.MM.yyyy", strict=False).alias("t"))
    assert [r.t for r in lenient.collect()] == [D1, None]
    assert lenient.schema["t"].dataType == T.TimestampNTZType()
    assert lenient.select(to_iso_text(F.col("t")).alias("t")).first().t == "2021-03-01"
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        df.select(parse_dates(F.col("d"), "dd.MM.yyyy")).collect()
    assert [r[0] for r in df.select(full_name("k", "l", "d")).collect()] == [
        "  a\t      01.03.2021",
        " x bad",
    ]


def test_stored_transactions_are_skipped_but_copies_in_a_load_kept(spark):
    staged = spark.createDataFrame(
        [("1", "2021-03-01 10:00:00", "1,00"), ("2", "2021-03-01 10:00:00", "2"), ("2", "2021-03-01 10:00:00", "2")],
        "transaction_id string, transaction_date string, amount string",
    ).withColumn("card_num", F.lit(" c "))
    rows = fact_transactions(staged)
    stored = rows.where("trans_id = '1'")
    assert append_fact(rows, stored).count() == 2
    assert append_fact(rows).count() == 3
    assert rows.first().card_num == "c"


def test_change_filter_is_plain_comparisons(spark, tmp_path):
    """The filter must reach the source, so it may not hide behind a coalesce."""
    path = str(tmp_path / "t")
    spark.createDataFrame(
        [(1, D1, None), (2, D1, D2), (3, D2, None)],
        "id int, create_dt timestamp_ntz, update_dt timestamp_ntz",
    ).write.parquet(path)
    changed = spark.read.parquet(path).where(changed_since("update_dt", "create_dt", D1))
    assert sorted(r.id for r in changed.collect()) == [2, 3]
    plan = changed._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThan(update_dt" in pushed and "GreaterThan(create_dt" in pushed


def test_corrected_copies_are_told(spark):
    schema = "trans_id string, trans_date timestamp_ntz, amt int"
    stored = spark.createDataFrame([("a", D1, 1), (None, D1, 2), ("c", D1, None)], schema)
    rows = [("a", D1, 1), ("a", D1, 5), (None, D1, 2), ("c", D1, 3), ("d", D1, 4), ("a", D2, 1)]
    again = spark.createDataFrame(rows, schema)
    differing = differing_copies(again, stored).collect()
    assert sorted(r.amt for r in differing) == [3, 5]
    assert sorted(r.amt for r in append_fact(again, stored).collect()) == [1, 4]


def test_jdbc_options():
    """Each table is split by its own key, for its changes and for its list of keys."""
    keys = {"bank.accounts": "account", "bank.cards": "card_num", "bank.clients": "client_id"}
    ranges = {t: (key, "0", "9", 64) for t, key in keys.items()}
    source = JdbcSource("jdbc:x:y", {"driver": "d"}, ranges | {"small": SINGLE_TASK})
    for table, key in keys.items():
        for query in (None, "(SELECT 1) changed"):
            options = source.options(table, query)
            assert options["dbtable"] == (query or table)
            assert options["partitionColumn"] == key and options["numPartitions"] == "64"
            assert options["preferTimestampNTZ"] == "true" and options["driver"] == "d"
    assert "numPartitions" not in source.options("small")
    with pytest.raises(ValueError, match="say how to split"):
        source.options("other")


def test_quotes_and_backslashes_in_text(spark, tmp_path):
    """Doubled quotes are one quote, and a backslash is a character like others."""
    from pyspark.sql import types as T

    texts = ['a "b" c', "x\\", "semi;colon", '"', '\\"', "plain"]
    schema = T.StructType([T.StructField("n", T.StringType()), T.StructField("t", T.StringType())])
    drop = tmp_path / "given.txt"
    lines = ["n;t"] + [f'{i};"' + t.replace('"', '""') + '"' for i, t in enumerate(texts)]
    drop.write_text("\n".join(lines) + "\n")
    read = read_delimited(spark, str(drop), schema)
    assert [r.t for r in sorted(read.collect(), key=lambda r: r.n)] == texts
    write_delimited(read, str(tmp_path / "written"))
    again = read_delimited(spark, str(tmp_path / "written"), schema)
    assert [r.t for r in sorted(again.collect(), key=lambda r: r.n)] == texts


def test_jdbc_extract_query():
    """What the database is asked for, run here by another engine in place of a driver."""
    query = changed_rows_query("t", ["id"], D1, "update_dt", "create_dt")
    assert query.count("{ts '2021-03-01 00:00:00'}") == 2
    connection = duckdb.connect()
    connection.execute(
        "CREATE TABLE t AS SELECT * FROM (VALUES (1, TIMESTAMP '2021-03-01', NULL), "
        "(2, TIMESTAMP '2021-03-01', TIMESTAMP '2021-03-02'), (3, TIMESTAMP '2021-03-02', NULL), "
        "(4, TIMESTAMP '2021-03-02', TIMESTAMP '2021-02-28')) AS v(id, create_dt, update_dt)"
    )
    translated = query.replace("{ts ", "TIMESTAMP ").replace("}", "")
    assert sorted(connection.execute(translated).fetchall()) == [(2,), (3,)]
