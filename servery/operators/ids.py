"""Consecutive numbers over a sorted table without sorting it in one task.

The table is range-partitioned, sorted inside each partition and written once; every row keeps
its partition and its place there in one number. The number of rows in each partition then
gives the partition's offset, and offset plus place is the row's global position. Only one
count per partition ever reaches the driver.

Writing the run is what makes two passes agree: range bounds are sampled anew whenever a plan
runs, and a lost executor must not renumber half of the table.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from servery.staging import discard, stored

# monotonically_increasing_id() is (partition << 33) + row within the partition.
_PLACE_BITS = 33
_SLOT = "_slot"


@dataclass(frozen=True)
class SortedRun:
    """A sorted table on shared storage with known partition sizes."""

    rows: DataFrame  # the table's columns and _slot
    partitions: list[int]  # non-empty ones, ascending
    offsets: list[int]  # rows before each of them
    total: int
    path: str  # where the rows are stored

    def close(self) -> None:
        """Delete the stored rows; nothing made of them can be read afterwards."""
        discard(self.rows.sparkSession, self.path)

    def numbered(self, column: str, start: int | Column = 0) -> DataFrame:
        """All rows with their position, counted from ``start``."""
        spark = self.rows.sparkSession
        offsets = spark.createDataFrame(
            list(zip(self.partitions, self.offsets, strict=True)), "_part long, _offset long"
        )
        part = F.shiftright(_SLOT, _PLACE_BITS)
        place = F.col(_SLOT) - F.shiftleft(part, _PLACE_BITS)
        # One row per partition of the run; Spark broadcasts it while it is small.
        joined = self.rows.withColumn("_part", part).join(offsets, "_part")
        first = start if isinstance(start, Column) else F.lit(start)
        position = (first + F.col("_offset") + place).cast("bigint")
        return joined.withColumn(column, position).drop("_part", "_offset", _SLOT)

    def slice(self, offset: int, count: int) -> DataFrame:
        """Rows ``offset`` to ``offset + count``, in order. Slots ascend through the run, so
        the scan skips all but the row groups that hold them."""
        end = min(offset + count, self.total)
        if count <= 0 or offset >= end:
            return self.rows.where(F.lit(False)).drop(_SLOT)
        wanted = F.col(_SLOT).between(self._slot(offset), self._slot(end - 1))
        return self.rows.where(wanted).orderBy(_SLOT).drop(_SLOT)

    def _slot(self, position: int) -> int:
        at = bisect_right(self.offsets, position) - 1
        return (self.partitions[at] << _PLACE_BITS) + position - self.offsets[at]


def sorted_run(df: DataFrame, order: Sequence[str | Column] | None) -> SortedRun:
    """Sort and store a table; without an order, store it as it lies, with no shuffle.

    The table is stored as it lies first. A range sort reads its input twice, which is then a
    plain scan; and the place a row was stored at settles ties, so that rows equal in all of
    ``order``, even exact copies, are divided among tasks like any others.
    """
    rows, path = stored(df.withColumn(_SLOT, F.monotonically_increasing_id()), "rows")
    if order is not None:
        keys = [*order, _SLOT]
        ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
        unsorted, (rows, path) = path, stored(ranged.withColumn(_SLOT, F.monotonically_increasing_id()), "run")
        discard(df.sparkSession, unsorted)
    sizes = (
        rows.groupBy(F.shiftright(_SLOT, _PLACE_BITS).alias("part"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    sizes = sorted((row["part"], row["n"]) for row in sizes)
    ends = list(accumulate(n for _, n in sizes))
    total = ends[-1] if ends else 0
    return SortedRun(rows, [part for part, _ in sizes], [0, *ends[:-1]] if ends else [], total, path)


def assign_ids(
    df: DataFrame, order: Sequence[str | Column] | None, column: str, start: int | Column = 0
) -> DataFrame:
    """Number the rows in the given order, or as they lie, counting from ``start``."""
    return sorted_run(df, order).numbered(column, start)


def next_id(table: DataFrame, column: str) -> Column:
    """One past the largest id of a table, 0 for an empty one; computed within the plan."""
    return table.agg((F.coalesce(F.max(column), F.lit(-1)) + 1).cast("bigint").alias("id")).scalar()
