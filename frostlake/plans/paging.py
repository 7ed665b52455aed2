"""Q5 by bookmark: a page begins after the last row of the one before it.

Page k of ``page_table`` orders the table up to the page's end, so a late page of a large table costs a sort of nearly
all of it. A page from a bookmark costs a scan and a bounded top-k wherever it lies: rows before the bookmark are
filtered out in the scan, by the first order column's Parquet statistics where the files are clustered by it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from frostlake.plans.serving import DEFAULT_PAGE_LIMIT


@dataclass(frozen=True)
class Bookmark:
    """``last``: the last row's values in the page's order of columns; ``seen``: how many rows equal to it were given."""

    last: tuple[Any, ...]
    seen: int


def page_order(df: DataFrame, order_by: Sequence[str] | None = None) -> list[str]:
    """The columns that pages are ordered by: ``order_by``, then all others."""
    first = list(order_by or ())
    return [*first, *(c for c in df.columns if c not in first)]


def _after(column: Column, value: Any) -> Column:
    """Whether the column comes after ``value``, nulls first, NaN last."""
    return column.isNotNull() if value is None else F.coalesce(column > value, F.lit(False))


def seek_page(
    df: DataFrame, limit: int = DEFAULT_PAGE_LIMIT, after: Bookmark | None = None, order_by: Sequence[str] | None = None
) -> DataFrame:
    """The first ``limit`` rows after the bookmark, in ``page_table``'s order (nulls first).

    Without a bookmark, the first page. Rows that are equal in every column may lie on both sides of a bookmark: it counts
    those already given, and the page skips as many. Rows added before the bookmark between two calls do not shift later
    pages. An empty table, or a bookmark at the end, gives no rows. Timestamps go through the driver's time zone, as
    ``collect`` takes them; run it in a zone without clock changes (UTC).
    """
    if limit < 0:
        raise ValueError("limit must be >= 0")
    order = page_order(df, order_by)
    keys = [F.col(f"`{c}`").asc_nulls_first() for c in order]
    if after is None:
        return df.orderBy(*keys).limit(limit)
    if len(after.last) != len(order):
        raise ValueError("the bookmark is of a table with other columns")
    types = {f.name: f.dataType for f in df.schema.fields}
    terms = [(F.col(f"`{c}`"), v, F.lit(v).cast(types[c])) for c, v in zip(order, after.last)]
    not_before = reduce(
        lambda rest, t: _after(t[0], None if t[1] is None else t[2]) | (t[0].eqNullSafe(t[2]) & rest), reversed(terms), F.lit(True)
    )
    column, value, literal = terms[0]
    if value is not None:  # implied by the rest; in this form the scan can use it
        not_before = (column >= literal) & not_before
    return df.where(not_before).orderBy(*keys).offset(after.seen).limit(limit)


def _same(a: Any, b: Any) -> bool:
    return a == b or (isinstance(a, float) and isinstance(b, float) and a != a and b != b)


def next_bookmark(
    page: Sequence[Row], df: DataFrame, after: Bookmark | None = None, order_by: Sequence[str] | None = None
) -> Bookmark | None:
    """The bookmark behind a collected ``page`` of ``df`` that began at ``after``; an empty page moves nothing."""
    if not page:
        return after
    order = page_order(df, order_by)
    tuples = [tuple(row[c] for c in order) for row in page]
    last, seen = tuples[-1], 0
    for values in reversed(tuples):
        if not all(map(_same, values, last)):
            return Bookmark(last, seen)
        seen += 1
    again = after is not None and all(map(_same, after.last, last))
    return Bookmark(last, seen + (after.seen if again else 0))
