"""Exact order statistics and quantiles without a global sort or a gathered group.

``percentile`` keeps one entry per distinct value in a single task and a global sort moves
every row. Here each pass counts rows per value interval (combined before the shuffle) and
only the intervals that hold a wanted rank are looked into again. The first pass cuts the
number line so that every interval spans at most 1/256 of its magnitude; later passes cut
linearly. Two passes settle billions of rows, three settle trillions, ties end at once.
At most 100,000 interval counts, or else only the intervals of wanted ranks,
reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.sources.staging import stage

_SLOTS = 256  # intervals per power of two in the first pass
_GATHERED_SLOTS = 100_000  # so few interval counts are looked through on the driver
_CUTS = 65536  # linear intervals in later passes
_LIST_ROWS = 200_000  # an interval of so few rows is listed value by value
_INTERVALS_PER_PASS = 100  # intervals refined by one scan
MAX_SERIES = 1000  # series of one call; strata, of any number, are ranked in ``strata``

_Found = tuple[float | int, int | None]  # a value and the rows up to it


def _magnitude_slot(value: Column) -> Column:
    """Monotone interval number of any finite or infinite value."""
    real = value.cast("double")
    size = F.abs(real)
    power = F.floor(F.log2(size))
    slot = (power + 1076) * _SLOTS + F.floor(size / F.pow(F.lit(2.0), power) * _SLOTS)
    signed = F.when(real > 0, slot).otherwise(-slot)
    return (
        F.when(real == 0, F.lit(0))
        .when(size == F.lit(math.inf), F.when(real > 0, F.lit(1 << 40)).otherwise(F.lit(-(1 << 40))))
        .when(size < 2.3e-308, F.when(real > 0, F.lit(1)).otherwise(F.lit(-1)))
        .otherwise(signed)
        .cast("long")
    )


@dataclass(frozen=True)
class _Interval:
    series: str
    low: float | int
    high: float | int
    below: int  # rows of the series before this interval
    rows: int
    ranks: tuple[int, ...]  # wanted 1-based ranks inside, counted from the series start

    def settle(self, counted: bool) -> tuple[dict[tuple[str, int], _Found], _Interval | None]:
        """Ranks known from the bounds, and what is left to look into."""
        known, open_ranks = {}, []
        for rank in self.ranks:
            if self.low == self.high:
                known[self.series, rank] = (self.low, self.below + self.rows)
            elif not counted and rank == self.below + 1:
                known[self.series, rank] = (self.low, None)
            elif not counted and rank == self.below + self.rows:
                known[self.series, rank] = (self.high, None)
            else:
                open_ranks.append(rank)
        if not open_ranks:
            return known, None
        return known, replace(self, ranks=tuple(open_ranks))


def _running(counts: DataFrame, by: str) -> DataFrame:
    """Rows up to each interval. The windows see interval counts, never data rows."""
    ordered = Window.partitionBy(by).orderBy("low")
    return counts.withColumn("upto", F.sum("rows").over(ordered))


def series_values(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns as (series, value) pairs, without nulls and NaN, in one scan."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("series"), F.col(f"`{c}`").cast("double").alias("value"))
            for c in columns
        ]
    )
    return (
        frame.select(F.inline(pairs))
        .filter(F.col("value").isNotNull() & ~F.isnan("value"))
    )


def order_statistics(
    values: DataFrame,
    wanted: Callable[[dict[str, int]], dict[str, Sequence[int]]],
    counted: bool = False,
) -> tuple[dict[tuple[str, int], _Found], dict[str, int]]:
    """Values at 1-based ranks.

    ``values`` has a text column ``series`` of few distinct values and a numeric column
    ``value`` without nulls. ``wanted`` maps the row count of every series to the ranks
    looked for. Returns {(series, rank): (value, rows up to that value)} and the row
    counts; the second figure is only sure to be known if ``counted``.
    """
    slots = (
        values.groupBy("series", _magnitude_slot(F.col("value")).alias("slot"))
        .agg(F.count("*").alias("rows"), F.min("value").alias("low"), F.max("value").alias("high"))
    )
    counts = slots.limit(_GATHERED_SLOTS + 1).collect()
    few = len(counts) <= _GATHERED_SLOTS
    if not few:
        slots = stage(slots, "interval_counts")
        counts = slots.groupBy("series").agg(F.sum("rows").alias("rows")).limit(MAX_SERIES + 1).collect()
    sizes = _sizes(counts)
    ranks = {s: sorted({k for k in ks if 1 <= k <= sizes[s]}) for s, ks in wanted(sizes).items()}
    ranks = {s: ks for s, ks in ranks.items() if ks}
    if not ranks:
        return {}, sizes
    hits = _local_hits(counts, ranks) if few else _hits(_running(slots, "series"), "series", ranks)
    pending = [
        _Interval(r.series, r.low, r.high, upto - r.rows, r.rows,
                  tuple(k for k in ranks[r.series] if upto - r.rows < k <= upto))
        for r, upto in hits
    ]
    found: dict[tuple[str, int], _Found] = {}
    while True:
        unsettled = []
        for interval in pending:
            known, rest = interval.settle(counted)
            found.update(known)
            if rest:
                unsettled.append(rest)
        if not unsettled:
            return found, sizes
        pending = []
        for start in range(0, len(unsettled), _INTERVALS_PER_PASS):
            pending += _refine(values, unsettled[start : start + _INTERVALS_PER_PASS])


def _sizes(counts: list) -> dict[str, int]:
    """Rows per series; refuses more series than can be ranked apart."""
    sizes: dict[str, int] = {}
    for r in counts:
        sizes[r.series] = sizes.get(r.series, 0) + r.rows
    if len(sizes) > MAX_SERIES:
        raise ValueError(f"more than {MAX_SERIES} groups to rank within")
    return sizes


def _local_hits(counts: list, ranks: dict[str, list[int]]) -> list[tuple]:
    """``_hits`` on interval counts that are at hand."""
    hits, upto = [], dict.fromkeys(ranks, 0)
    for r in sorted((r for r in counts if r.series in ranks), key=lambda r: r.low):
        upto[r.series] += r.rows
        if any(upto[r.series] - r.rows < k <= upto[r.series] for k in ranks[r.series]):
            hits.append((r, upto[r.series]))
    return hits


def _hits(running: DataFrame, by: str, ranks: dict) -> list[tuple]:
    """Counted intervals that hold a wanted rank, each with the rows up to its end."""
    holds = F.lit(False)
    for key, wanted_ranks in ranks.items():
        inside = F.lit(False)
        for rank in wanted_ranks:
            inside = inside | ((F.col("upto") - F.col("rows") < rank) & (F.col("upto") >= rank))
        holds = holds | ((F.col(by) == F.lit(key)) & inside)
    return [(r, r.upto) for r in running.filter(holds).collect()]


def _first_case(conditions: Sequence[Column], results: Sequence[Column]) -> Column:
    """One flat CASE, so that many intervals do not nest."""
    case = F.when(conditions[0], results[0])
    for condition, result in zip(conditions[1:], results[1:]):
        case = case.when(condition, result)
    return case


def _refine(values: DataFrame, intervals: list[_Interval]) -> list[_Interval]:
    """Count once more inside the given intervals, which do not overlap within a series."""
    value = F.col("value")
    insides, cuts = [], []
    for part in intervals:
        insides.append((F.col("series") == part.series) & value.between(part.low, part.high))
        width = (float(part.high) - float(part.low)) / _CUTS
        if part.rows <= _LIST_ROWS or float(part.low) + width == float(part.low):
            # Few rows, or an interval too narrow to cut: one slot per value.
            cuts.append((value - F.lit(part.low)).cast("double"))
        else:
            cuts.append(F.floor((value.cast("double") - float(part.low)) / width).cast("double"))
    owner = _first_case(insides, [F.lit(i) for i in range(len(intervals))])
    slot = _first_case(insides, cuts)
    exact = all(p.rows <= _LIST_ROWS for p in intervals)
    keys = [owner.alias("owner"), value.alias("value")] + ([] if exact else [slot.alias("slot")])
    by = ["owner", "value"] if exact else ["owner", "slot"]
    counts = (
        values.select("series", "value").select(*keys)
        .filter("owner IS NOT NULL")
        .groupBy(*by)
        .agg(F.count("*").alias("rows"), *(
            [] if exact else [F.min("value").alias("low"), F.max("value").alias("high")]))
    )
    if exact:
        counts = counts.withColumns({"low": F.col("value"), "high": F.col("value")})
    # Ranks are counted inside the interval.
    inner = {i: [k - p.below for k in p.ranks] for i, p in enumerate(intervals)}
    result = []
    for r, upto in _hits(_running(counts, "owner"), "owner", inner):
        part = intervals[r.owner]
        below = part.below + upto - r.rows
        held = tuple(k for k in part.ranks if below < k <= below + r.rows)
        result.append(_Interval(part.series, r.low, r.high, below, r.rows, held))
    return result


def _interpolation_ranks(n: int, probability: float) -> tuple[int, int, float]:
    position = (n - 1) * probability
    below = math.floor(position)
    return below + 1, min(below + 2, n), position - below


def exact_quantiles(
    frame: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of numeric columns; nulls and NaN do not count."""
    if len(columns) > MAX_SERIES:
        return exact_quantiles(frame, columns[:MAX_SERIES], probabilities) | exact_quantiles(
            frame, columns[MAX_SERIES:], probabilities)

    def wanted(sizes: dict[str, int]) -> dict[str, list[int]]:
        return {s: [k for p in probabilities for k in _interpolation_ranks(n, p)[:2]]
                for s, n in sizes.items()}

    found, sizes = order_statistics(series_values(frame, columns), wanted)
    result: dict[str, list[float | None]] = {}
    for column in columns:
        n = sizes.get(column, 0)
        quantiles: list[float | None] = []
        for p in probabilities:
            if n == 0:
                quantiles.append(None)
                continue
            lower, upper, share = _interpolation_ranks(n, p)
            low, high = found[column, lower][0], found[column, upper][0]
            quantiles.append(low if low == high else low + (high - low) * share)
        result[column] = quantiles
    return result
