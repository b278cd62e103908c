"""Dense codes: the place of every value in sorted order among the distinct ones, for any number of values."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.sources.staging import stage

_PART, _PLACE, _BEFORE = "_range", "_place_in_range", "_rows_before"
_ROW_BITS = 33  # a generated row id is the partition's number above this many bits of place


def _ordered(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def _in_ranges(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` dealt by ranges of the order, sorted within each, with range and place, as a stored table."""
    row = F.monotonically_increasing_id()
    return stage(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({
        _PART: F.shiftright(row, _ROW_BITS), _PLACE: row.bitwiseAND((1 << _ROW_BITS) - 1)}), "ranges")


def _with_offsets(placed: DataFrame, size: Column) -> DataFrame:
    """``_before``, the sum over all earlier ranges; one number for each range reaches every task."""
    sizes = {r[0]: r[1] for r in placed.groupBy(_PART).agg(size).collect()}
    offsets = itertools.accumulate((sizes[p] for p in sorted(sizes)), initial=0)
    table = placed.sparkSession.createDataFrame(list(zip(sorted(sizes), offsets)), f"{_PART} long, {_BEFORE} long")
    return placed.join(F.broadcast(table), _PART)


def numbered(rows: DataFrame, order: Sequence[Column | str], column: str = "position") -> DataFrame:
    """``rows`` with their 0-based place in the given order, as a stored table.

    Rows are dealt by ranges of the order and sorted within them; a range's first place is the
    number of rows in those before it, so no task sees more than its range. Rows that are equal in
    the order get different places, in any order, and land in one task: the order should tell
    most rows apart.
    """
    placed = _with_offsets(_in_ranges(rows, _ordered(order)), F.count("*"))
    return placed.withColumn(column, F.col(_BEFORE) + F.col(_PLACE)).drop(_PART, _PLACE, _BEFORE)


def totals_before(rows: DataFrame, order: Sequence[Column | str], amount: str, column: str = "before") -> DataFrame:
    """``rows`` with the sum of ``amount``, a whole number, over all rows before them in the order.

    As ``numbered``, with a running sum inside each range.
    """
    placed = _with_offsets(_in_ranges(rows, _ordered(order)), F.sum(amount))
    inside = Window.partitionBy(_PART).orderBy(_PLACE)
    return placed.withColumn(column, F.col(_BEFORE) + F.sum(amount).over(inside) - F.col(amount)).drop(
        _PART, _PLACE, _BEFORE)


def dense_codes(values: DataFrame, column: str, by: Sequence[str] = (), code: str = "code") -> DataFrame:
    """Distinct non-null values of ``column`` (per group of ``by``) with codes 0, 1, ... in sorted order.

    Groups are numbered along with their values, and a group's first place is subtracted, so no
    group is sorted in one task. Groups are few: one row for each is joined back.
    """
    by = list(by)
    distinct = values.where(F.col(column).isNotNull()).select(*by, column).distinct()
    placed = numbered(distinct, [*by, column], code)
    if not by:
        return placed
    first = placed.groupBy(*[F.col(c).alias(f"_{c}") for c in by]).agg(F.min(code).alias("_first"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    return placed.join(first, same).select(*by, column, (F.col(code) - F.col("_first")).alias(code))
