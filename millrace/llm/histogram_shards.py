"""Shards of near equal size by a histogram sort.

Rows are ordered by a key of several integer columns. The key's range is cut at candidate
boundaries, the exact size below each is counted in all partitions, and the candidates are
refined around each wanted splitter until the size below it is within tolerance. Only the
counts of candidates reach the driver. Then rows are exchanged once.

The first key column keeps groups together: a splitter lies between two of its values
wherever the tolerance allows it, and only a group too large for that is cut, by the next
column. Everything is made of DataFrame functions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.sources.staging import stage

#: Candidates in each interval and round.
CANDIDATES = 1024
#: Distance of a splitter from its place, as a share of one shard.
TOLERANCE = 0.002
#: Sizes summed in one bucket of the exchange, aimed at.
BUCKET_SIZE = 128 << 20
LEAST_BUCKETS, MOST_BUCKETS = 64, 100_000


@dataclass(frozen=True)
class Interval:
    """Keys whose first columns equal ``prefix`` and whose next lies in [low, high]."""

    prefix: tuple[int, ...]
    low: int
    high: int


def find_splitters(rows: DataFrame, size: str, key: list[str], shards: int,
                   tolerance: float = TOLERANCE) -> list[tuple[int, ...] | None]:
    """For each inner boundary the smallest key above it; None where all rows lie below.

    ``rows`` has integer columns without nulls and is scanned once a round, so it should be
    a stored narrow table. A key holds as many columns as were needed.
    """
    first = rows.agg(F.sum(size), F.min(key[0]), F.max(key[0])).first()
    total = first[0] or 0
    if not total:
        return [None] * (shards - 1)
    wanted = {j: total * j / shards for j in range(1, shards)}
    slack = tolerance * total / shards
    within = {j: (Interval((), first[1], first[2]), 0) for j in wanted}  # and the size below it
    done: dict[int, tuple[int, ...] | None] = {}
    while within:
        counted = _count(rows, size, key, {interval for interval, _ in within.values()})
        refined = {}
        for j, (interval, below) in within.items():
            for low, high, held, next_low, next_high in counted[interval]:
                if below + held > wanted[j] or high == interval.high:
                    break
                below += held
            best = min((wanted[j] - below, (*interval.prefix, low)),
                       (below + held - wanted[j], _after(counted[interval], high, interval)),
                       key=lambda x: (abs(x[0]), x[1] is None))
            if abs(best[0]) <= slack and best[1] is not None:
                done[j] = best[1]
            elif low < high:
                refined[j] = (Interval(interval.prefix, low, high), below)
            elif len(interval.prefix) + 1 < len(key):
                refined[j] = (Interval((*interval.prefix, low), next_low, next_high), below)
            else:
                done[j] = best[1] or (*interval.prefix, low + 1)
        within = refined
    return [done[j] for j in sorted(done)]


def _after(bins, high: int, interval: Interval) -> tuple[int, ...] | None:
    """The least key above a bin, where the interval has one."""
    later = [low for low, *_ in bins if low > high]
    return (*interval.prefix, min(later)) if later else None


def _count(rows: DataFrame, size: str, key: list[str], intervals: set[Interval]) -> dict:
    """Bins with rows of each interval: least and largest value, size, range of the next column."""
    numbered = sorted(intervals, key=lambda i: (i.prefix, i.low))
    place = F.lit(None).cast("struct<interval:int,bin:bigint,value:bigint,next:bigint>")
    for n, x in enumerate(numbered):
        value, level = F.col(key[len(x.prefix)]), len(x.prefix)
        inside = reduce(lambda a, b: a & b, [F.col(k) == v for k, v in zip(key, x.prefix)], F.lit(True))
        after = F.col(key[level + 1]) if level + 1 < len(key) else F.lit(None)
        # decimals, as the distance of two long values may not be one
        width = max(1, -(-(x.high - x.low + 1) // CANDIDATES))
        step = F.floor((value.cast("decimal(20,0)") - F.lit(x.low).cast("decimal(20,0)"))
                       / F.lit(width).cast("decimal(20,0)"))
        place = F.when(inside & value.between(x.low, x.high), F.struct(
            F.lit(n).alias("interval"), step.cast("long").alias("bin"), value.alias("value"),
            after.cast("long").alias("next"))).otherwise(place)
    counts = (
        rows.select(F.col(size).alias("_size"), place.alias("_at")).where("_at IS NOT NULL")
        .groupBy("_at.interval", "_at.bin")
        .agg(F.min("_at.value"), F.max("_at.value"), F.sum("_size"), F.min("_at.next"), F.max("_at.next")).collect())
    out: dict = {x: [] for x in numbered}
    for interval, _, *held in sorted(tuple(c) for c in counts):
        out[numbered[interval]].append(tuple(held))
    return out


def at_or_above(key: list[str], splitter: tuple[int, ...] | None) -> Column:
    """Whether a row's key is not below a splitter."""
    if splitter is None:
        return F.lit(False)
    above = F.col(key[len(splitter) - 1]) >= splitter[-1]
    for k, v in reversed(list(zip(key, splitter[:-1]))):
        above = (F.col(k) > v) | ((F.col(k) == v) & above)
    return above


def histogram_shards(frame: DataFrame, size: Column, group: Column, row: Column, shards: int = 8,
                     tolerance: float = TOLERANCE) -> DataFrame:
    """``frame`` with shard (0 to shards - 1) and slot (gapless from 0 in each shard).

    Rows of equal ``group`` value follow each other in the key's order; ``row`` is the
    column that tells the rows of a group apart, so a group of any size can be cut. Only where rows
    of the same group and ``row`` are too large together for that, all rows are stored with a number. Else
    just sizes and keys are, and ``frame``, which should be a stored table, is exchanged as it is. Columns shard and slot of the input are replaced. Null sizes
    count as nothing, null keys as one value. An empty table gives no rows.
    """
    kept = [c for c in frame.columns if c not in ("shard", "slot")]
    whole = frame.select(
        F.struct(*kept).alias("_all") if kept else F.struct(F.lit(1)).alias("_all"),
        F.coalesce(size.cast("long"), F.lit(0)).alias("_size"), F.xxhash64(group).alias("_group"), F.xxhash64(row).alias("_row"))
    key = ["_group", "_row"]
    narrow = stage(whole.select("_size", *key), "shard-keys")
    allowed = tolerance * (narrow.agg(F.sum("_size")).first()[0] or 0) / shards
    if narrow.groupBy(*key).agg(F.sum("_size").alias("n"), F.count("*").alias("rows")).where(
            (F.col("n") > allowed) & (F.col("rows") > 1)).isEmpty():
        rows = whole
    else:  # rows that nothing tells apart are too large together: each gets a number, which has to be stored
        key = [*key, "_number"]
        rows = stage(whole.withColumn("_number", F.monotonically_increasing_id()), "shard-rows")
        narrow = rows.select("_size", *key)
    splitters = find_splitters(narrow, "_size", key, shards, tolerance)
    shard = reduce(lambda a, b: a + b, [at_or_above(key, s).cast("int") for s in splitters], F.lit(0))
    buckets = narrow.agg(F.sum("_size")).first()[0] or 0
    buckets = min(MOST_BUCKETS, max(LEAST_BUCKETS, buckets // shards // BUCKET_SIZE))
    dealt = rows.withColumns({"_shard": shard, "_bucket": F.pmod(F.xxhash64(*key), F.lit(buckets))})
    counts = narrow.withColumns({"_shard": shard, "_bucket": F.pmod(F.xxhash64(*key), F.lit(buckets))}).groupBy(
        "_shard", "_bucket").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("_shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_shard", "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_shard", "_bucket").orderBy(*key)) - 1
    return (
        dealt.withColumn("_place", place).join(starts, ["_shard", "_bucket"])
        .select("_all.*", F.col("_shard").alias("shard"), (F.col("_start") + F.col("_place")).alias("slot"))
        .select(*[F.col(f"`{c}`") for c in kept], "shard", "slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder for each shard."""
    sharded.write.partitionBy("shard").parquet(path)
