"""Sorted listings, page by page."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from servery.operators.ids import SortedRun, sorted_run

# The page sizes on offer.
PAGE_SIZES = (10, 25, 50, 100)


def page_index(df: DataFrame, sizes: Sequence[int] = PAGE_SIZES) -> DataFrame:
    """Number of pages for each page size; the last page may be partial."""
    rows = df.agg(F.count(F.lit(1)).alias("n"))
    return rows.select(F.explode(F.array(*map(F.lit, sizes))).alias("page_size"), "n").select(
        "page_size", F.ceil(F.col("n") / F.col("page_size")).alias("total_pages")
    )


def listing(df: DataFrame, column: str, tie_break: str, size: int, ascending: bool = True) -> Listing:
    """Sorted by a chosen column with a key behind it, so that pages do not overlap."""
    if column == tie_break:
        return Listing(df, [column], size, [ascending])
    return Listing(df, [column, tie_break], size, [ascending, True])


def _checked(number: int) -> int:
    if number < 1:
        raise ValueError("pages count from 1")
    return number


class Listing:
    """A sorted table seen one page at a time, as it is now; pages count from 1.

    A page is a top-k query whose tasks each pass on their first rows up to the page's end. For
    many pages, or deep ones, :meth:`stored` sorts the table once.
    """

    def __init__(self, df: DataFrame, order: Sequence[str], size: int, ascending: Sequence[bool]):
        if size < 1:
            raise ValueError("page size must be at least 1")
        self._df, self._order, self._size, self._ascending = df, list(order), size, list(ascending)

    def _sorting(self, forward: bool = True) -> list[Column]:
        """NULLs come last, and first when turned round."""
        pairs = zip(self._order, self._ascending, strict=True)
        if forward:
            return [F.asc_nulls_last(c) if up else F.desc_nulls_last(c) for c, up in pairs]
        return [F.desc_nulls_first(c) if up else F.asc_nulls_first(c) for c, up in pairs]

    def total_pages(self) -> int:
        return -(-self._df.count() // self._size)

    def page(self, number: int) -> DataFrame:
        """The rows of one page in order; none past the end."""
        offset = (_checked(number) - 1) * self._size
        return self._df.orderBy(*self._sorting()).offset(offset).limit(self._size)

    def last_page(self) -> DataFrame:
        """The last page: the first rows of the order turned round, as many as it has."""
        rows = self._df.count()
        last = rows % self._size or min(rows, self._size)
        return self._df.orderBy(*self._sorting(forward=False)).limit(last).orderBy(*self._sorting())

    def cursor(self, row: Row) -> list:
        """Where a row stands in the order, as plain values that can be written as JSON."""
        values = [row[c] for c in self._order]
        return [str(v) if isinstance(v, dt.date) else v for v in values]

    def next_page(self, after: Sequence | None = None) -> DataFrame:
        """The rows behind a cursor; the first ones without it. However deep, a page is a small top-k
        of what the cursor leaves, and rows that came or went before it move nothing."""
        rows = self._df if after is None else self._df.where(self._beyond(after, forward=True))
        return rows.orderBy(*self._sorting()).limit(self._size)

    def previous_page(self, before: Sequence) -> DataFrame:
        """The rows in front of a cursor."""
        rows = self._df.where(self._beyond(before, forward=False))
        return rows.orderBy(*self._sorting(forward=False)).limit(self._size).orderBy(*self._sorting())

    def _beyond(self, cursor: Sequence, forward: bool) -> Column:
        """Rows that come later than the cursor, or earlier. NULLs come last. Comparisons of bare
        columns, which are pushed into the scan."""
        if len(cursor) != len(self._order):
            raise ValueError(f"a cursor has values for {self._order}")
        found, same = F.lit(False), F.lit(True)
        for name, up, value in zip(self._order, self._ascending, cursor):
            column, at = F.col(name), F.lit(value).cast(self._df.schema[name].dataType)
            if value is None:
                beyond = F.lit(False) if forward else column.isNotNull()
                here = column.isNull()
            else:
                beyond = column > at if up == forward else column < at
                beyond = beyond | column.isNull() if forward else beyond
                here = column == at
            found, same = found | (same & beyond), same & here
        return found

    def stored(self) -> StoredListing:
        """The listing as it is now, sorted and stored: any page of it is a small read."""
        return StoredListing(sorted_run(self._df, self._sorting()), self._size)


class StoredListing:
    """Pages of a listing as it was when stored. Close it to delete it; or use it in a ``with``
    statement."""

    def __init__(self, run: SortedRun, size: int):
        self._run, self._size = run, size
        self.total_pages = -(-run.total // size)

    def page(self, number: int) -> DataFrame:
        return self._run.slice((_checked(number) - 1) * self._size, self._size)

    def last_page(self) -> DataFrame:
        return self.page(max(self.total_pages, 1))

    def close(self) -> None:
        self._run.close()

    def __enter__(self) -> StoredListing:
        return self

    def __exit__(self, *_) -> None:
        self.close()
