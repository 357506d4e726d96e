"""Top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, value: str, tie_break: str, k: int = 10) -> DataFrame:
    """The k rows of the largest values, ties by the tie-break column.

    For a small k: each task sends its k best rows to one task. A long ranking is a
    :class:`~servery.operators.paging.Listing`.
    """
    return df.orderBy(F.desc_nulls_last(value), F.asc(tie_break)).limit(k)
