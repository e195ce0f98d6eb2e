"""Append-only fact tables."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clean import DAY_PATTERN, SECOND_PATTERN, parse_amount, parse_dates
from tidemark.functions.times import Moment, ntz, to_second
from tidemark.sources.delimited import BAD_LINE


def _text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def _time(df: DataFrame, name: str, pattern: str, strict: bool = True) -> Column:
    col = F.col(name)
    return parse_dates(F.trim(col), pattern, strict) if _text(df, name) else to_second(col)


def _amount(df: DataFrame, name: str, strict: bool = True) -> Column:
    col = F.col(name)
    return parse_amount(col, strict=strict) if _text(df, name) else col.cast("decimal(18,2)")


def _key(df: DataFrame, name: str) -> Column:
    col = F.col(name)
    return F.nullif(F.trim(col), F.lit("")) if _text(df, name) else col


def fact_transactions(staged: DataFrame, strict: bool = True) -> DataFrame:
    """Staged transactions as fact rows: renamed, reordered, typed.

    Text is parsed; columns that arrive typed are taken as they are. Columns the stage
    does not carry are left out. Bad text raises; when not ``strict``, rows with bad text
    are left out, and ``rejected_lines`` gives them.
    """
    columns = {
        "trans_id": _key(staged, "transaction_id"),
        "trans_date": _time(staged, "transaction_date", SECOND_PATTERN, strict),
        "card_num": _key(staged, "card_num"),
        "amt": _amount(staged, "amount", strict),
    }
    if not strict:
        staged = staged.where(bad_text(staged).isNull())
    for name in ("oper_type", "oper_result", "terminal"):
        if name in staged.columns:
            columns[name] = _key(staged, name)
    order = ("trans_id", "trans_date", "card_num", "oper_type", "amt", "oper_result", "terminal")
    return staged.select(*[columns[c].alias(c) for c in order if c in columns])


def bad_text(staged: DataFrame) -> Column:
    """Why a staged transaction cannot be read: ``width`` of its line, or the name of the first
    column whose text is bad; NULL if it can. A missing value is not bad text."""
    reason = F.lit(None).cast("string")
    parsed = {
        "transaction_date": _time(staged, "transaction_date", SECOND_PATTERN, strict=False),
        "amount": _amount(staged, "amount", strict=False),
    }
    for name in reversed(list(parsed)):
        if _text(staged, name):
            bad = F.col(name).isNotNull() & parsed[name].isNull()
            reason = F.when(bad, F.lit(name)).otherwise(reason)
    if BAD_LINE in staged.columns:
        reason = F.when(F.col(BAD_LINE).isNotNull(), F.lit("width")).otherwise(reason)
    return reason


def rejected_lines(staged: DataFrame) -> DataFrame:
    """(line, reason) of the staged transactions that cannot be read: the line as it came if its
    width is wrong, else its values."""
    values = [F.coalesce(F.col(c), F.lit("")) for c in staged.columns if c != BAD_LINE]
    line = F.concat_ws(";", *values)
    if BAD_LINE in staged.columns:
        line = F.coalesce(F.col(BAD_LINE), line)
    return staged.select(line.alias("line"), bad_text(staged).alias("reason")).where("reason is not null")


def fact_blacklist(staged: DataFrame, mark: Moment) -> DataFrame:
    """Staged blocked passports entered strictly after the mark.

    Each feed repeats the whole list, so the mark decides what is new.
    """
    typed = staged.select(
        _key(staged, "passport_num").alias("passport_num"),
        _time(staged, "entry_dt", DAY_PATTERN).alias("entry_dt"),
    )
    return typed.where(F.col("entry_dt") > ntz(mark))


def differing_copies(
    new_rows: DataFrame,
    existing: DataFrame,
    keys: tuple[str, ...] = ("trans_id", "trans_date"),
) -> DataFrame:
    """Rows whose keys are stored already, but with other values: corrections that an
    append leaves out, to be kept aside. Copies equal in all columns are not among them."""
    stored = existing.select(*[F.col(c).alias(f"_{c}") for c in new_rows.columns])
    same_key = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    same_row = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in new_rows.columns])
    return new_rows.join(stored, same_key, "left_semi").join(stored, same_row, "left_anti")


def append_fact(
    new_rows: DataFrame,
    existing: DataFrame | None = None,
    keys: tuple[str, ...] = ("trans_id", "trans_date"),
) -> DataFrame:
    """The rows to append: all of them, or those not stored yet when ``existing`` is given.

    Loading a file a second time then adds nothing, while equal rows inside one load are
    all kept. The caller hands over only the stored time span the load touches. The stored
    keys are not made unique first: both sides of the join are then plain shuffles,
    which AQE can split if one key dominates the load.
    """
    if existing is None:
        return new_rows
    stored = existing.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return new_rows.join(stored, same, "left_anti")
