"""The daily fraud report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import Moment
from tidemark.operators.fraud import (
    by_holder_number,
    flagged_cards,
    fraud_events,
    number_holders,
    report_subjects,
)
from tidemark.plans.store import Warehouse
from tidemark.session import settings

BROADCAST_BYTES = 256 * 1024 * 1024
ROW_OVERHEAD = 64

# A filter of 8 bits per card lets about 2% of the other cards through. At this many
# cards it takes 32 MB, which every task of the scan loads; beyond, the join goes without.
MAX_FILTER_CARDS = 32 * 1024 * 1024
FILTER_BITS = 8


def _measure(rows: DataFrame) -> tuple[int, int]:
    """Number of rows, and the bytes they take in memory: their text and a fixed part."""
    text = sum(
        (F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in rows.dtypes if kind == "string"),
        F.lit(ROW_OVERHEAD),
    )
    number, size = rows.agg(F.count("*"), F.sum(text.cast("long"))).first()
    return number, size or 0


def plan_card_join(
    flagged: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> tuple[DataFrame, dict[str, str]]:
    """How the transactions are to meet the flagged cards: the cards as to be joined, and
    the settings to do it under. ``flagged`` must be stored, as it is measured here.

    Small: broadcast, the transactions are only scanned. Larger: Spark builds a Bloom
    filter of the cards and drops most other transactions before they are shuffled. It
    does so only for a side with a selective-looking predicate, hence the comparison,
    which every card passes, and sizes the filter by settings. Larger still: a shuffle.
    """
    cards, size = _measure(flagged)
    if size <= broadcast_bytes:
        return F.broadcast(flagged), {}
    if cards > MAX_FILTER_CARDS:
        return flagged, {}
    prefix = "spark.sql.optimizer.runtime.bloomFilter"
    return flagged.where(F.col("card_num").cast("string") >= ""), {
        f"{prefix}.enabled": "true",
        f"{prefix}.creationSideThreshold": str(2 * size + 1),
        f"{prefix}.expectedNumItems": str(cards),
        f"{prefix}.maxNumItems": str(cards),
        f"{prefix}.numBits": str(FILTER_BITS * cards),
        f"{prefix}.maxNumBits": str(FILTER_BITS * cards),
    }


def run_report(
    warehouse: Warehouse,
    report_ts: Moment,
    grace_last_day: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Both rules at ``report_ts``, over all transactions up to then, stored in place of
    an earlier report of the same time.

    The flagged cards come from the dimensions alone. They are written first, so that
    their size is known before the transactions are touched: AQE would start shuffling
    both sides of the join together. Next to the transactions a holder is only a number,
    so the rows made distinct are short; passport, name and phone are joined at the end.
    """
    commit = warehouse.begin()
    subjects = commit.stage(
        "subjects",
        report_subjects(
            warehouse.history("accounts"),
            warehouse.history("clients"),
            warehouse.blacklist(),
            report_ts,
            grace_last_day,
        ),
    )
    holders = commit.stage("holders", number_holders(subjects))
    numbered = by_holder_number(subjects, holders)
    stored = commit.stage(
        "flagged_cards", flagged_cards(warehouse.history("cards"), numbered, report_ts)
    )
    flagged, conf = plan_card_join(stored, broadcast_bytes)
    if _measure(holders)[1] <= broadcast_bytes:
        holders = F.broadcast(holders)
    with settings(warehouse.spark, conf):
        events = fraud_events(warehouse.transactions(last=report_ts), flagged, report_ts)
        commit.put_report(report_ts, events.join(holders, "holder"))
    commit.publish()
    return warehouse.report(report_ts)
