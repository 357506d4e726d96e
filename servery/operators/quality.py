"""Checks: usable input, non-empty tables, sane periods, totals that add up."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from servery.functions.money import money
from servery.functions.payload import CORRUPT, decode_marked, with_parsed
from servery.operators.aggregates import order_totals

REASON = "reason"


def check_messages(
    messages: DataFrame,
    schema: StructType,
    required: Sequence[str],
    checks: Mapping[str, Column] | None = None,
    strict: bool = False,
    value: str = "value",
) -> DataFrame:
    """Decoded columns next to the message, and why the message is unusable (NULL if it is not).

    ``empty``: no text. ``malformed``: not a JSON object, or, if ``strict``, one with any field
    of a wrong type. ``incomplete``: a required field is missing or unreadable. ``checks`` adds
    named conditions that make a message unusable.
    """
    parsed = with_parsed(messages, decode_marked(F.col(value), schema), "_data")
    decoded = parsed.select(*messages.columns, "_data.*")
    fields = [F.col(field.name) for field in schema.fields]
    unreadable = F.col(CORRUPT).isNotNull()
    if not strict:
        unreadable = unreadable & F.coalesce(*[f.cast("string") for f in fields]).isNull()
    missing = F.lit(False)
    for name in required:
        missing = missing | F.col(name).isNull()
    reason = (
        F.when(F.trim(F.coalesce(F.col(value), F.lit(""))) == "", "empty")
        .when(unreadable, "malformed")
        .when(missing, "incomplete")
    )
    for name, condition in (checks or {}).items():
        reason = reason.when(condition, name)
    return decoded.withColumn(REASON, reason).drop(CORRUPT)


def not_money(column: str) -> Column:
    """A number that is present but no amount: NaN, infinite, or of more digits than any sum."""
    return F.col(column).isNotNull() & money(F.col(column)).isNull()


def check_documents(parsed: DataFrame, required: Sequence[str], document: str = "document") -> DataFrame:
    """Why a parsed document is unusable: ``malformed`` or ``incomplete``; NULL if it is not."""
    missing = F.lit(False)
    for name in required:
        missing = missing | F.col(f"{document}.{name}").isNull()
    return parsed.withColumn(
        REASON, F.when(F.col(document).isNull(), "malformed").when(missing, "incomplete")
    )


def usable(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(REASON).isNull()).drop(REASON)


def quarantined(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(REASON).isNotNull())


def unreadable_prices(items: DataFrame, raw: str = "price_text", price: str = "price") -> DataFrame:
    """Items whose price text gave no number."""
    return items.where(F.col(raw).isNotNull() & F.col(price).isNull())


def require_rows(table: DataFrame, name: str) -> DataFrame:
    """The table itself; raises if it has no row. Reads at most one."""
    if table.isEmpty():
        raise ValueError(f"table {name} is empty")
    return table


def check_period(start: date, end: date) -> None:
    if end <= start:
        raise ValueError("the end of a period must lie after its start")


def in_period(column: str, start: date, end: date) -> Column:
    """From the first day up to, but without, the midnight after the last: periods that follow
    each other share no moment."""
    moment = F.col(column)
    return (moment >= F.lit(start).cast("timestamp_ntz")) & (
        moment < F.date_add(F.lit(end), 1).cast("timestamp_ntz")
    )


def reconcile_order_totals(
    orders: DataFrame, order_items: DataFrame, menu_items: DataFrame
) -> DataFrame:
    """Stated against computed total of every order; one without items does not match."""
    computed = order_totals(order_items, menu_items).withColumnRenamed("total_cost", "computed")
    stated = orders.select("order_id", F.col("total_cost").alias("stated"))
    joined = stated.join(computed, F.col("order_id") == F.col("fk_order"), "left")
    same = F.coalesce(money(F.col("stated")) == money(F.col("computed")), F.lit(False))
    return joined.select("order_id", "stated", "computed", same.alias("matches"))


@dataclass(frozen=True)
class Split:
    usable: DataFrame
    quarantined: DataFrame


def split(checked: DataFrame) -> Split:
    return Split(usable(checked), quarantined(checked))
