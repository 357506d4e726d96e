"""Dates of a simulated or replayed period."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_day(text: Column) -> Column:
    """``3/8/2024`` or ``03/08/2024``, month first; NULL for anything else."""
    return F.try_to_timestamp(text, F.lit("M/d/yyyy")).cast("date")


def days_between(start: Column, end: Column) -> Column:
    """Array of the days from start to end, both included; NULL if the end comes first."""
    return F.when(start <= end, F.sequence(start, end, F.expr("interval 1 day")))


def plus_seconds(moment: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, moment)
