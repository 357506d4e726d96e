"""Series of days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from servery.functions.dates import days_between


def day_series(bounds: DataFrame, start: Column, end: Column) -> DataFrame:
    """One row per day from start to end, both included, for each row of bounds."""
    return bounds.select(F.explode(days_between(start, end)).alias("day"))
