"""Money as exact decimals with two places."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: 26 digits before the point; sums have ten more.
MONEY = "decimal(28,2)"


def money(amount: Column) -> Column:
    """The amount as written, rounded half up to whole cents: 1.015 is 1.02. NaN, infinities and
    what has more than 26 digits before the point give NULL."""
    return amount.try_cast(MONEY)


def total(amounts: Column) -> Column:
    """The exact sum of :func:`money` values."""
    return F.try_sum(amounts)


def amount(total_money: Column) -> Column:
    return total_money.cast("double")


def price_text(price: Column) -> Column:
    """Two decimals, whatever the engine's way of printing doubles; a price past all money as
    it stands."""
    return F.coalesce(money(price).cast("string"), price.cast("string"))


def item_label(name: Column, price: Column) -> Column:
    return F.concat(name, F.lit("\n$"), price_text(price))
