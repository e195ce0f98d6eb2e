"""The warehouse operators, each a function from DataFrames to a DataFrame."""

from tidemark.operators.asof import (
    as_of_join,
    card_timeline,
    enrich_at_event,
    flagged_timeline,
    fraud_at_event,
    valid_together,
)
from tidemark.operators.chain import hot_keys, one_row_per, with_first, with_successor
from tidemark.operators.diff import snapshot_changed, snapshot_deleted, snapshot_new
from tidemark.operators.dims import dim_as_of, dim_current, dim_first_seen, validate_history
from tidemark.operators.facts import (
    append_fact,
    differing_copies,
    fact_blacklist,
    fact_transactions,
    rejected_lines,
)
from tidemark.operators.fraud import (
    blacklisted_subjects,
    by_holder_number,
    contract_subjects,
    enrich_as_of,
    expired_subjects,
    flagged_cards,
    fraud_contract,
    fraud_events,
    fraud_passport,
    fraud_report_all,
    number_holders,
    passport_subjects,
    report_subjects,
)
from tidemark.operators.scd2 import (
    history_of,
    scd2_apply_incremental,
    scd2_apply_snapshot,
    scd2_close_versions,
    scd2_insert_versions,
    scd2_tombstones,
)
from tidemark.operators.watermark import (
    advance_watermark,
    changed_since,
    incremental,
    read_watermark,
    seed_watermarks,
)

__all__ = [
    "advance_watermark",
    "append_fact",
    "as_of_join",
    "blacklisted_subjects",
    "card_timeline",
    "enrich_at_event",
    "flagged_timeline",
    "fraud_at_event",
    "valid_together",
    "by_holder_number",
    "changed_since",
    "contract_subjects",
    "differing_copies",
    "dim_as_of",
    "dim_current",
    "dim_first_seen",
    "enrich_as_of",
    "expired_subjects",
    "fact_blacklist",
    "fact_transactions",
    "flagged_cards",
    "fraud_contract",
    "fraud_events",
    "fraud_passport",
    "fraud_report_all",
    "history_of",
    "hot_keys",
    "incremental",
    "number_holders",
    "one_row_per",
    "passport_subjects",
    "read_watermark",
    "rejected_lines",
    "report_subjects",
    "scd2_apply_incremental",
    "scd2_apply_snapshot",
    "scd2_close_versions",
    "scd2_insert_versions",
    "scd2_tombstones",
    "seed_watermarks",
    "snapshot_changed",
    "snapshot_deleted",
    "snapshot_new",
    "validate_history",
    "with_first",
    "with_successor",
]
