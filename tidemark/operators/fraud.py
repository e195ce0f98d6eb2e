"""Fraud reports: transactions by holders of blocked or expired passports, or under a
lapsed contract.

Both rules look only at the client and the account, at the report time. So the rules
are decided on the dimension side, where the tables are small, and give *subjects*:
accounts with what the report says about their holder. Cards are joined to subjects,
and only then are the transactions, once for both rules and shuffled only by card.
Following the foreign keys from the transactions instead would shuffle the largest
table three times per rule.

Every join here has a plain shuffle on either side, which is the shape AQE splits when
a card, account, client or passport dominates (``skewJoin``), and broadcasts when the
side turns out small at run time.
"""

from __future__ import annotations

from datetime import timedelta
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clean import full_name
from tidemark.functions.times import Moment, as_datetime, ntz
from tidemark.operators.dims import dim_as_of
from tidemark.schemas import CONTRACT_EVENT, PASSPORT_EVENT

HOLDER = ("passport", "fio", "phone")


def _holders(clients: DataFrame) -> DataFrame:
    return clients.select(
        F.col("client_id").alias("client"),
        F.col("passport_num").alias("passport"),
        full_name("last_name", "first_name", "patronymic").alias("fio"),
        "phone",
    )


def enrich_as_of(
    facts: DataFrame,
    cards: DataFrame,
    accounts: DataFrame,
    clients: DataFrame,
    report_ts: Moment,
) -> DataFrame:
    """Transactions up to the report time with the card, account and client valid then."""
    validity = ("effective_from", "effective_to", "deleted_flg")
    owners = (
        dim_as_of(accounts, report_ts)
        .drop(*validity)
        .join(
            dim_as_of(clients, report_ts).drop(*validity).withColumnRenamed("client_id", "client"),
            "client",
        )
    )
    owned_cards = dim_as_of(cards, report_ts).drop(*validity).join(owners, "account_num")
    return (
        facts.where(F.col("trans_date") <= ntz(report_ts))
        .join(owned_cards, "card_num")
        .withColumnRenamed("client", "client_id")
    )


def _lapsed(col: str, report_ts: Moment, grace_last_day: bool = False) -> Column:
    """True where ``col`` is before the report time; NULL never is.

    The end dates are midnights, so their own day already counts as lapsed by the end
    of that day. ``grace_last_day`` lets the document be used until its last day ends.
    """
    limit = as_datetime(report_ts)
    if grace_last_day:
        limit = limit - timedelta(days=1)
    return F.col(col) < ntz(limit)


def listed_passports(blacklist: DataFrame, report_ts: Moment) -> DataFrame:
    """Passports listed up to the report time, at most one row per passport and day.

    Kept per day on purpose: a join to a side aggregated by its own key cannot be split.
    """
    return (
        blacklist.where(F.col("entry_dt") <= ntz(report_ts))
        .select("passport_num", "entry_dt")
        .distinct()
    )


def _subjects(accounts: DataFrame, clients: DataFrame, event_type: str) -> DataFrame:
    return (
        accounts.select("account_num", "client")
        .join(_holders(clients), "client")
        .select("account_num", *HOLDER, F.lit(event_type).alias("event_type"))
    )


def blacklisted_subjects(
    accounts: DataFrame, clients: DataFrame, blacklist: DataFrame, report_ts: Moment
) -> DataFrame:
    """Accounts whose client holds a listed passport."""
    listed = dim_as_of(clients, report_ts).join(
        listed_passports(blacklist, report_ts), "passport_num", "left_semi"
    )
    return _subjects(dim_as_of(accounts, report_ts), listed, PASSPORT_EVENT)


def expired_subjects(
    accounts: DataFrame, clients: DataFrame, report_ts: Moment, grace_last_day: bool = False
) -> DataFrame:
    """Accounts whose client's passport has expired."""
    expired = dim_as_of(clients, report_ts).where(
        _lapsed("passport_valid_to", report_ts, grace_last_day)
    )
    return _subjects(dim_as_of(accounts, report_ts), expired, PASSPORT_EVENT)


def passport_subjects(
    accounts: DataFrame,
    clients: DataFrame,
    blacklist: DataFrame,
    report_ts: Moment,
    grace_last_day: bool = False,
) -> DataFrame:
    """Accounts whose client's passport is listed or has expired.

    The two arms are disjoint: expired clients need no look at the list.
    """
    valid = dim_as_of(clients, report_ts)
    expired = _lapsed("passport_valid_to", report_ts, grace_last_day)
    listed = valid.where(~F.coalesce(expired, F.lit(False))).join(
        listed_passports(blacklist, report_ts), "passport_num", "left_semi"
    )
    flagged = valid.where(expired).unionByName(listed)
    return _subjects(dim_as_of(accounts, report_ts), flagged, PASSPORT_EVENT)


def contract_subjects(accounts: DataFrame, clients: DataFrame, report_ts: Moment) -> DataFrame:
    """Accounts whose contract has lapsed."""
    lapsed = dim_as_of(accounts, report_ts).where(_lapsed("valid_to", report_ts))
    return _subjects(lapsed, dim_as_of(clients, report_ts), CONTRACT_EVENT)


def report_subjects(
    accounts: DataFrame,
    clients: DataFrame,
    blacklist: DataFrame,
    report_ts: Moment,
    grace_last_day: bool = False,
) -> DataFrame:
    """The subjects of both rules; one account can be a subject of each."""
    passports = passport_subjects(accounts, clients, blacklist, report_ts, grace_last_day)
    return passports.unionByName(contract_subjects(accounts, clients, report_ts))


def flagged_cards(cards: DataFrame, subjects: DataFrame, report_ts: Moment) -> DataFrame:
    """The subjects' cards with what the report says about their holders."""
    valid = dim_as_of(cards, report_ts).select("card_num", "account_num")
    return valid.join(subjects, "account_num").drop("account_num")


def fraud_events(
    facts: DataFrame, flagged: DataFrame, report_ts: Moment, distinct: bool = True
) -> DataFrame:
    """Report rows for the transactions made with flagged cards: when, what ``flagged``
    tells about the card, and the report time.

    Hand over ``broadcast(flagged)`` where its size has been checked: the transactions
    are then not shuffled at all, only the rows found.
    """
    told = [c for c in flagged.columns if c != "card_num"]
    events = (
        facts.where(F.col("trans_date") <= ntz(report_ts))
        .select("card_num", F.col("trans_date").alias("event_id"))
        .join(flagged, "card_num")
        .select("event_id", *told)
    )
    if distinct:
        events = events.distinct()
    return events.withColumn("report_dt", ntz(report_ts))


def number_holders(subjects: DataFrame) -> DataFrame:
    """The distinct holders with a number each, as short as they are long.

    Store the result before using it: the numbers are not the same when computed again.
    """
    holders = subjects.select(*HOLDER).distinct()
    return holders.withColumn("holder", F.monotonically_increasing_id())


def by_holder_number(subjects: DataFrame, holders: DataFrame) -> DataFrame:
    """Subjects with the number of their holder in place of the holder's columns."""
    numbered = holders.alias("h")
    same = reduce(and_, [F.col(f"s.{c}").eqNullSafe(F.col(f"h.{c}")) for c in HOLDER])
    return subjects.alias("s").join(numbered, same).select("account_num", "holder", "event_type")


def fraud_passport(
    facts: DataFrame,
    cards: DataFrame,
    accounts: DataFrame,
    clients: DataFrame,
    blacklist: DataFrame,
    report_ts: Moment,
    distinct: bool = True,
    grace_last_day: bool = False,
) -> DataFrame:
    """Rule 1: operations on a blocked or expired passport."""
    subjects = passport_subjects(accounts, clients, blacklist, report_ts, grace_last_day)
    return fraud_events(facts, flagged_cards(cards, subjects, report_ts), report_ts, distinct)


def fraud_contract(
    facts: DataFrame,
    cards: DataFrame,
    accounts: DataFrame,
    clients: DataFrame,
    report_ts: Moment,
) -> DataFrame:
    """Rule 2: operations under a lapsed contract."""
    subjects = contract_subjects(accounts, clients, report_ts)
    return fraud_events(facts, flagged_cards(cards, subjects, report_ts), report_ts)


def fraud_report_all(
    facts: DataFrame,
    cards: DataFrame,
    accounts: DataFrame,
    clients: DataFrame,
    blacklist: DataFrame,
    report_ts: Moment,
    grace_last_day: bool = False,
) -> DataFrame:
    """Both rules in one pass over the transactions."""
    subjects = report_subjects(accounts, clients, blacklist, report_ts, grace_last_day)
    return fraud_events(facts, flagged_cards(cards, subjects, report_ts), report_ts)
