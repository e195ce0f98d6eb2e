"""Dimensions as they were at the time of each event.

The report looks at the holders valid at the report time. Here every transaction meets the
versions valid at its own. The dimensions are put together first, on their side: a card's
timeline has a version for every stretch in which its own, its account's and its client's
version stay the same. So the transactions are shuffled once, by card, and not again by
account and client.

Transactions and version starts then pass in one sorted run per card, each transaction taking
the last start before it. A join on ``from <= time <= to`` would compare every transaction
of a card with every version of it.

A history must be sound (see ``validate_history``): versions of a key do not overlap. Times are
whole seconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.clean import full_name
from tidemark.functions.times import Moment, ntz
from tidemark.operators.chain import BUCKET, hot_keys
from tidemark.operators.fraud import HOLDER, listed_passports
from tidemark.schemas import CONTRACT_EVENT, LIVE, PASSPORT_EVENT

SPAN = ("effective_from", "effective_to")


def living(history: DataFrame) -> DataFrame:
    """Versions that are no tombstones, without the flag."""
    return history.where(F.col("deleted_flg") == LIVE).drop("deleted_flg")


def valid_together(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Versions of both sides joined by ``key`` wherever they were valid at the same time,
    for just that time. The reference of ``left`` may have had several versions meanwhile.

    Both sides are plain shuffles by key, so AQE splits a key that dominates either.
    """
    other = right.withColumnsRenamed({c: f"_{c}" for c in SPAN})
    start, end = SPAN
    overlap = (F.col(start) <= F.col(f"_{end}")) & (F.col(f"_{start}") <= F.col(end))
    joined = left.join(other, key).where(overlap)
    return joined.withColumns(
        {start: F.greatest(start, f"_{start}"), end: F.least(end, f"_{end}")}
    ).drop(*[f"_{c}" for c in SPAN])


def card_timeline(cards: DataFrame, accounts: DataFrame, clients: DataFrame) -> DataFrame:
    """What held for each card and when: columns of card, account and client, and the span.

    Versions of a card do not overlap; in times when one of the three is missing or deleted
    there is none.
    """
    owners = valid_together(
        living(accounts), living(clients).withColumnRenamed("client_id", "client"), "client"
    )
    return valid_together(living(cards), owners, "account_num")


def as_of_join(
    events: DataFrame, versions: DataFrame, key: str, at: str, hot_rows: int | None = None
) -> DataFrame:
    """Events with the version of their key valid at their time ``at``; others are left out.

    Versions have ``key``, the span and any further columns, which are added to the events.
    A version starting in the very second of an event is valid for it. Events of hot keys (see
    ``chain``; ``hot_rows`` sets the limit) are divided by day, and the version that a day starts
    with comes from one narrow row per hot key and day.
    """
    start, end = SPAN
    told = [c for c in versions.columns if c not in (key, *SPAN)]
    started = versions.select(
        key, F.col(start).alias(at), F.struct(end, *told).alias("_version"), F.lit(0).alias("_event")
    )
    rows = events.where(F.col(key).isNotNull() & F.col(at).isNotNull()).withColumn("_event", F.lit(1))
    rows = rows.unionByName(started, allowMissingColumns=True)

    hot = hot_keys(events, key, hot_rows)
    group = [key]
    if hot is not None:
        day = F.datediff(F.col(at), F.lit("1970-01-01"))
        marked = rows.join(hot.withColumn("_hot", F.lit(True)), key, "left")
        rows = marked.withColumn(BUCKET, F.when(F.col("_hot"), day)).drop("_hot")
        group = [key, BUCKET]
    in_order = Window.partitionBy(*group).orderBy(at, "_event")
    seen = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn("_last", F.last("_version", ignorenulls=True).over(seen))
    if hot is not None:
        earlier = Window.partitionBy(key).orderBy(BUCKET)
        days = (
            rows.where(F.col(BUCKET).isNotNull())
            .groupBy(*group)
            .agg(F.max_by("_version", F.when(F.col("_event") == 0, F.col(at))).alias("_of_day"))
            .withColumn(
                "_carried",
                F.last("_of_day", ignorenulls=True).over(
                    earlier.rowsBetween(Window.unboundedPreceding, -1)
                ),
            )
            .drop("_of_day")
        )
        placed = placed.join(days, group, "left").withColumn("_last", F.coalesce("_last", "_carried"))
    return placed.where((F.col("_event") == 1) & (F.col(at) <= F.col(f"_last.{end}"))).select(
        *events.columns, *[F.col(f"_last.{c}").alias(c) for c in told]
    )


def enrich_at_event(
    facts: DataFrame,
    cards: DataFrame,
    accounts: DataFrame,
    clients: DataFrame,
    report_ts: Moment | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Transactions with the card, account and client valid at their own time."""
    rows = facts if report_ts is None else facts.where(F.col("trans_date") <= ntz(report_ts))
    timeline = card_timeline(cards, accounts, clients)
    return as_of_join(rows, timeline, "card_num", "trans_date", hot_rows).withColumnRenamed(
        "client", "client_id"
    )


def _just_after(col: str, days: int = 0) -> Column:
    return F.col(col) + F.make_dt_interval(days=F.lit(days), secs=F.lit(1))


def flagged_timeline(
    cards: DataFrame,
    accounts: DataFrame,
    clients: DataFrame,
    blacklist: DataFrame,
    report_ts: Moment,
    grace_last_day: bool = False,
) -> DataFrame:
    """The stretches of ``card_timeline`` in which a rule held at some time, with the holder and
    since when: ``passport_from``, ``contract_from``.

    Within a stretch a rule holds from one moment on: a passport stays listed, and expired.
    """
    version = ["client_id", "effective_from"]
    holders = living(clients)
    listed = holders.join(listed_passports(blacklist, report_ts), "passport_num")
    # by version, of which none is hot, not by passport
    listed = listed.groupBy(*version).agg(F.min("entry_dt").alias("listed_from"))
    expired = _just_after("passport_valid_to", 1 if grace_last_day else 0)
    holders = holders.join(listed, version, "left").select(
        "client_id",
        F.col("passport_num").alias("passport"),
        full_name("last_name", "first_name", "patronymic").alias("fio"),
        "phone",
        F.least("listed_from", expired).alias("passport_from"),
        *SPAN,
        F.lit(LIVE).alias("deleted_flg"),
    )
    contracts = accounts.select(
        "account_num", "client", *SPAN, "deleted_flg", _just_after("valid_to").alias("contract_from")
    )
    timeline = card_timeline(
        cards.select("card_num", "account_num", *SPAN, "deleted_flg"), contracts, holders
    )
    first = F.least("passport_from", "contract_from")
    return timeline.where(first <= F.col("effective_to")).drop("account_num", "client")


def fraud_at_event(
    facts: DataFrame,
    cards: DataFrame,
    accounts: DataFrame,
    clients: DataFrame,
    blacklist: DataFrame,
    report_ts: Moment,
    grace_last_day: bool = False,
    hot_rows: int | None = None,
) -> DataFrame:
    """Both rules decided at the time of each transaction up to the report time: who held the
    card then, and whether the passport was listed or had expired, or the contract had lapsed, then.
    """
    flagged = flagged_timeline(cards, accounts, clients, blacklist, report_ts, grace_last_day)
    used = facts.where(F.col("trans_date") <= ntz(report_ts)).select("card_num", "trans_date")
    found = as_of_join(used, flagged, "card_num", "trans_date", hot_rows)
    at = F.col("trans_date")
    rules = F.array_compact(
        F.array(
            F.when(F.col("passport_from") <= at, F.lit(PASSPORT_EVENT)),
            F.when(F.col("contract_from") <= at, F.lit(CONTRACT_EVENT)),
        )
    )
    return (
        found.select(at.alias("event_id"), *HOLDER, F.explode(rules).alias("event_type"))
        .distinct()
        .withColumn("report_dt", ntz(report_ts))
    )
