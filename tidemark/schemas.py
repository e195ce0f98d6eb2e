"""Table schemas, fixed dates and the description of each history table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import types as T

# Fixed values shared by every table.
HIGH = datetime(2999, 12, 31)  # end of a version that is still open
SEED = datetime(1899, 1, 1)  # high-water mark before the first load
LIVE = "N"
DELETED = "Y"
PASSPORT_EVENT = "1"
CONTRACT_EVENT = "2"

VALIDITY = ("effective_from", "effective_to", "deleted_flg")


def _schema(**columns: str) -> T.StructType:
    kinds = {
        "text": T.StringType(),
        "time": T.TimestampNTZType(),
        "money": T.DecimalType(18, 2),
    }
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in columns.items()])


# Staging: the feeds arrive as text and are bound by position.
STG_BLACKLIST = _schema(entry_dt="text", passport_num="text")
STG_TRANSACTIONS = _schema(
    transaction_id="text",
    transaction_date="text",
    amount="text",
    card_num="text",
    oper_type="text",
    oper_result="text",
    terminal="text",
)
STG_TERMINALS_DRAFT = _schema(
    terminal_id="text", terminal_type="text", terminal_city="text", terminal_address="text"
)
STG_ACCOUNTS = _schema(
    account="text", valid_to="time", client="text", create_dt="time", update_dt="time"
)
STG_CARDS = _schema(card_num="text", account="text", create_dt="time", update_dt="time")
STG_CLIENTS = _schema(
    client_id="text",
    last_name="text",
    first_name="text",
    patronymic="text",
    date_of_birth="time",
    passport_num="text",
    passport_valid_to="time",
    phone="text",
    create_dt="time",
    update_dt="time",
)

# Warehouse.
FACT_TRANSACTIONS = _schema(
    trans_id="text",
    trans_date="time",
    card_num="text",
    oper_type="text",
    amt="money",
    oper_result="text",
    terminal="text",
)
FACT_BLACKLIST = _schema(passport_num="text", entry_dt="time")
REPORT = _schema(
    event_id="time",
    passport="text",
    fio="text",
    phone="text",
    event_type="text",
    report_dt="time",
)
WATERMARK = _schema(dbname="text", tablename="text", last_update="time")

DBNAME = "warehouse"


@dataclass(frozen=True)
class DimSpec:
    """One history table: its key, attributes and how its source columns map onto them."""

    name: str
    key: str
    attributes: dict[str, str]  # attribute -> kind, in table order
    source_columns: dict[str, str]  # source column -> history column, where they differ

    @property
    def attrs(self) -> list[str]:
        return list(self.attributes)

    @property
    def schema(self) -> T.StructType:
        return _schema(
            **{self.key: "text"},
            **self.attributes,
            effective_from="time",
            effective_to="time",
            deleted_flg="text",
        )


TERMINALS = DimSpec(
    "terminals",
    "terminal_id",
    {"terminal_type": "text", "terminal_city": "text", "terminal_address": "text"},
    {},
)
CARDS = DimSpec("cards", "card_num", {"account_num": "text"}, {"account": "account_num"})
ACCOUNTS = DimSpec(
    "accounts",
    "account_num",
    {"valid_to": "time", "client": "text"},
    {"account": "account_num"},
)
CLIENTS = DimSpec(
    "clients",
    "client_id",
    {
        "last_name": "text",
        "first_name": "text",
        "patronymic": "text",
        "date_of_birth": "time",
        "passport_num": "text",
        "passport_valid_to": "time",
        "phone": "text",
    },
    {},
)
DIMS = {d.name: d for d in (TERMINALS, CARDS, ACCOUNTS, CLIENTS)}

# The six tables that carry a high-water mark.
WATERMARKED = ("terminals", "cards", "accounts", "clients", "blacklist", "transactions")
