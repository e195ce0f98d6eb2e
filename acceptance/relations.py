"""The sample tables seen as a bank warehouse.

Orders stand for cards, customers for accounts and clients, line items for
transactions, error events for blocked passports.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import before, change_time, high, ntz
from tidemark.operators.chain import one_row_per, with_successor

REPORT_TS = "2024-01-15 23:59:59"


def _open_since_1990() -> list[Column]:
    return [
        ntz("1990-01-01").alias("effective_from"),
        high().alias("effective_to"),
        F.lit("N").alias("deleted_flg"),
    ]


def _plus_days(start: Column, days: Column) -> Column:
    return start + F.make_dt_interval(days=days.cast("int"))


@dataclass(frozen=True)
class Sample:
    spark: SparkSession
    folder: str
    _tables: dict[str, DataFrame] = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        """A sample table; its footer is looked at once per query."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    # Two daily snapshots of customers.

    def cust_v1(self) -> DataFrame:
        return (
            self.table("customer")
            .where(F.col("c_custkey") % 10 != 3)
            .select(
                F.col("c_custkey").alias("k"),
                F.col("c_name").alias("nm"),
                F.col("c_mktsegment").alias("seg"),
                F.col("c_nationkey").alias("nk"),
            )
        )

    def cust_v2(self) -> DataFrame:
        changed = F.when(F.col("c_custkey") % 7 == 0, F.lit("CHANGED"))
        return (
            self.table("customer")
            .where(F.col("c_custkey") % 11 != 5)
            .select(
                F.col("c_custkey").alias("k"),
                F.col("c_name").alias("nm"),
                changed.otherwise(F.col("c_mktsegment")).alias("seg"),
                F.col("c_nationkey").alias("nk"),
            )
        )

    # Dimensions and facts of the reports.

    def dim_cards(self) -> DataFrame:
        ended = before(_plus_days(F.col("o_orderdate"), F.lit(9000)))
        return self.table("orders").select(
            F.col("o_orderkey").alias("card_num"),
            F.col("o_custkey").alias("account_num"),
            F.col("o_orderdate").alias("effective_from"),
            F.when(F.col("o_orderkey") % 5 == 0, ended).otherwise(high()).alias("effective_to"),
            F.when(F.col("o_orderkey") % 17 == 0, "Y").otherwise("N").alias("deleted_flg"),
        )

    def dim_accounts(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.table("customer").select(
            key.alias("account_num"),
            _plus_days(ntz("2023-01-01"), key % 800).alias("valid_to"),
            key.alias("client"),
            *_open_since_1990(),
        )

    def dim_clients(self) -> DataFrame:
        key, text = F.col("c_custkey"), F.col("c_custkey").cast("string")
        expiry = _plus_days(ntz("2023-06-01"), key % 900)
        return (
            self.table("customer")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                key.alias("client_id"),
                F.col("c_name").alias("last_name"),
                F.col("c_mktsegment").alias("first_name"),
                F.when(key % 4 != 0, F.col("n_name")).alias("patronymic"),
                F.concat(F.lit("P"), text).alias("passport_num"),
                F.when(key % 6 != 0, expiry).alias("passport_valid_to"),
                F.concat(F.lit("+7"), text).alias("phone"),
                *_open_since_1990(),
            )
        )

    def fact_blacklist(self) -> DataFrame:
        return (
            self.table("events")
            .where(F.col("event_type") == "error")
            .select(
                F.concat(F.lit("P"), F.col("user_id").cast("string")).alias("passport_num"),
                ntz(F.date_trunc("day", F.col("ts"))).alias("entry_dt"),
            )
            .distinct()
        )

    def fact_tx(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("card_num"), F.col("l_shipdate").alias("trans_date")
        )

    # A change log with several changes per account.

    def acct_changes(self) -> DataFrame:
        updated = _plus_days(F.col("o_orderdate"), F.lit(5))
        rows = self.table("orders").select(
            F.col("o_custkey").alias("account_num"),
            F.col("o_orderdate").alias("create_dt"),
            F.when(F.col("o_orderkey") % 3 == 0, updated).alias("update_dt"),
            F.col("o_orderstatus").alias("status"),
        )
        return one_row_per(rows, ["account_num", "create_dt", "update_dt"], ["status"])

    def acct_versions(self) -> DataFrame:
        """The change log with one row per account and change time."""
        changes = self.acct_changes().select(
            "account_num", change_time().alias("change_ts"), "status"
        )
        return one_row_per(changes, ["account_num", "change_ts"], ["status"])

    def live_accounts(self) -> DataFrame:
        return (
            self.table("customer")
            .where(F.col("c_custkey") % 13 != 4)
            .select(F.col("c_custkey").alias("account_num"))
        )

    # Histories of several versions, for what held at the time of an event.

    def card_history(self) -> DataFrame:
        """Cards that move on to the next account some days after their start."""
        order, account, start = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
        moved = _plus_days(start, order % 40 + 10)
        live, ended = F.lit("N"), F.when(order % 17 == 0, "Y").otherwise("N")
        versions = F.array(
            F.struct(account.alias("account_num"), start.alias("effective_from"),
                     before(moved).alias("effective_to"), live.alias("deleted_flg")),
            F.struct((account + 1).alias("account_num"), moved.alias("effective_from"),
                     high().alias("effective_to"), ended.alias("deleted_flg")),
        )
        rows = self.table("orders").select(order.alias("card_num"), F.explode(versions).alias("v"))
        return rows.select("card_num", "v.*")

    def account_history(self) -> DataFrame:
        """The change log of accounts as versions."""
        chained = with_successor(self.acct_versions(), "account_num", "change_ts")
        key, start = F.col("account_num"), F.col("change_ts")
        return chained.select(
            "account_num",
            _plus_days(start, key % 90 + 20).alias("valid_to"),
            key.alias("client"),
            start.alias("effective_from"),
            F.coalesce(before(F.col("next_from")), high()).alias("effective_to"),
            F.when(F.col("status") == "P", "Y").otherwise("N").alias("deleted_flg"),
        )

    def client_history(self) -> DataFrame:
        """Clients with a second passport from some day on."""
        key = F.col("client_id")
        changed = _plus_days(ntz("1996-01-01"), key % 1000)
        second = F.concat(F.lit("Q"), key.cast("string"))
        versions = F.array(
            F.struct(F.col("passport_num").alias("number"), ntz("1990-01-01").alias("effective_from"),
                     before(changed).alias("effective_to"), changed.alias("valid_to")),
            F.struct(second.alias("number"), changed.alias("effective_from"),
                     high().alias("effective_to"), _plus_days(changed, key % 700).alias("valid_to")),
        )
        names = ("client_id", "last_name", "first_name", "patronymic", "phone", "deleted_flg")
        rows = self.dim_clients().select(*names, F.explode(versions).alias("v"))
        return rows.select(
            *names,
            F.col("v.number").alias("passport_num"),
            F.col("v.valid_to").alias("passport_valid_to"),
            "v.effective_from",
            "v.effective_to",
        )

    def early_blacklist(self) -> DataFrame:
        """Both passports of some users, listed years before."""
        number = F.substring("passport_num", 2, 20)
        day = F.col("entry_dt") - F.make_dt_interval(days=F.lit(9400))
        both = F.explode(F.array(F.concat(F.lit("P"), number), F.concat(F.lit("Q"), number)))
        return self.fact_blacklist().select(both.alias("passport_num"), day.alias("entry_dt"))

    def histories(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return self.card_history(), self.account_history(), self.client_history()

    def dims(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return self.dim_cards(), self.dim_accounts(), self.dim_clients()
