"""Prices written as text: ``$12``, ``FREE``, ``12$-20$``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A plain decimal number. The cast alone would also take 12d, 0x1p3, NaN and Infinity.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def number(text: Column) -> Column:
    """The number a text writes; NULL also where it is past all doubles."""
    value = text.try_cast("double")
    return F.when(text.rlike(_NUMBER) & (F.abs(value) < float("inf")), value)


def normalized_price(raw: Column) -> Column:
    """Free is 0, a range is the mean of its first two ends, anything unreadable is NULL."""
    text = F.replace(raw, F.lit("$"), F.lit(""))
    ends = F.split(text, "-")
    first = number(F.get(ends, F.lit(0)))
    return (
        F.when(F.lower(text) == "free", F.lit(0.0))
        .when(F.size(ends) > 1, (first + number(F.get(ends, F.lit(1)))) / 2)
        .otherwise(first)
    )
