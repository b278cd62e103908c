"""Exact shares of any number of strata: how many rows of each, and which.

Strata are rows of a table, never names in a plan or on the driver. How many rows a stratum gives
follows from one distributed numbering of the strata; which ones from order statistics of the rows' places
(64-bit hashes), found for all strata at once: rows are counted by stratum and leading bits, combined
before the shuffle, and only intervals that hold a cut are looked into again with more bits. A stratum of
any size is so spread over its intervals, and no more than 65,536 counts of one meet in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.operators.codes import numbered, totals_before
from millrace.operators.joins import lookup_join
from millrace.sources.staging import stage

_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
_BITS = 16  # further leading bits per pass
_LIST_ROWS = 20_000  # intervals of so few rows are listed value by value


def stratum_sizes(rows: DataFrame) -> DataFrame:
    """series, n: the rows of each stratum, stored."""
    return stage(rows.groupBy("series").agg(F.count("*").alias("n")), "strata")


def apportioned(strata: DataFrame, total: int) -> DataFrame:
    """``strata`` with ``quota``: ``total`` shared out in proportion to n.

    Left-over units go to the largest remainders, on a tie to the first stratum in order. Whole numbers throughout.
    """
    rows = strata.agg(F.sum("n")).first()[0] or 1
    product, whole = f"cast(n as decimal(19)) * cast({total} as decimal(19))", f"cast({rows} as decimal(19))"
    shared = stage(strata.withColumns({
        "quota": F.expr(f"({product}) div {whole}"), "_rest": F.expr(f"cast(({product}) % {whole} as bigint)")}), "quotas")
    left = total - (shared.agg(F.sum("quota")).first()[0] or 0)
    placed = numbered(shared, [F.desc("_rest"), F.asc("series")], "_place")
    return placed.withColumn("quota", F.col("quota") + (F.col("_place") < left).cast("long")).drop("_rest", "_place")


def fold_quotas(strata: DataFrame, folds: int) -> DataFrame:
    """``strata`` with ``quotas``: rows per fold when the rows sorted by stratum are dealt out in turn."""
    started = totals_before(strata, ["series"], "n", "_start")

    def dealt(upto: Column, fold: Column) -> Column:
        return F.floor((upto - fold + (folds - 1)) / folds)

    counts = F.transform(F.sequence(F.lit(0), F.lit(folds - 1)), lambda i: (
        dealt(F.col("_start") + F.col("n"), i) - dealt(F.col("_start"), i)).cast("long"))
    return started.withColumn("quotas", counts).drop("_start")


def cuts_after(strata: DataFrame, quotas: Column) -> DataFrame:
    """series, n, ks: the rows up to the end of each part but the last, from the parts' sizes."""
    sums = F.aggregate(quotas, F.array().cast("array<bigint>"), lambda done, size: F.concat(
        done, F.array(F.coalesce(F.get(done, F.size(done) - 1), F.lit(0)) + size)))
    return strata.select("series", "n", F.slice(sums, 1, F.size(sums) - 1).alias("ks"))


def order_statistics_of(values: DataFrame, cuts: DataFrame) -> DataFrame:
    """series, k, value, upto for all 1 <= k < n: the k-th value of its series, and the rows up to that value.

    ``values`` has series and value, a 64-bit integer; ``cuts`` has series, n and ks.
    """
    wanted = cuts.select("series", F.filter("ks", lambda k: (k > 0) & (k < F.col("n"))).alias("ks")).where(F.size("ks") > 0)
    inside = stage(wanted.select("series", F.lit(0).cast("long").alias("slot"), F.lit(0).cast("long").alias("below"), "ks"), "cuts")
    bits = 0
    while True:
        few = bits and (inside.agg(F.max("rows")).first()[0] or 0) <= _LIST_ROWS
        bits, last = 64 if few else bits + _BITS, bits
        old = F.shiftright("value", 64 - last) if last else F.lit(0).cast("long")
        counted = (values.select("series", "value", old.alias("slot")).join(inside.select("series", "slot"), ["series", "slot"])
                   .groupBy("series", "slot", F.shiftright("value", 64 - bits).alias("next")).agg(F.count("*").alias("rows")))
        up = Window.partitionBy("series", "slot").orderBy("next")
        counted = counted.withColumn("_upto", F.sum("rows").over(up)).join(inside.drop("rows"), ["series", "slot"])
        counted = counted.withColumn("upto", F.col("below") + F.col("_upto"))
        held = F.filter("ks", lambda k: (k > F.col("upto") - F.col("rows")) & (k <= F.col("upto")))
        inside = stage(counted.withColumn("ks", held).where(F.size("ks") > 0).select(
            "series", F.col("next").alias("slot"), (F.col("upto") - F.col("rows")).alias("below"), "ks", "rows"), "cuts")
        if bits == 64:
            return inside.select("series", F.explode("ks").alias("k"), F.col("slot").alias("value"),
                                 (F.col("below") + F.col("rows")).alias("upto"))


def with_parts(rows: DataFrame, cuts: DataFrame, series: Column, place: Column, part: str) -> DataFrame:
    """``rows`` with the number of their stratum's cuts that they come after.

    Rows of equal places at a cut are told apart by a row number stored beside the data.
    """
    values = rows.select(series.alias("series"), place.alias("value"))
    found = order_statistics_of(values, cuts)
    ends = found.select("series", "k", "value", F.lit(_MOST).alias("copy"))
    tied = stage(found.where("upto > k"), "ties")
    if not tied.isEmpty():
        rows = stage(rows.withColumn("_copy", F.monotonically_increasing_id()), "split")
        ends = ends.join(tied.select("series", "k"), ["series", "k"], "left_anti").unionByName(
            _within_ties(rows.select(series.alias("series"), place.alias("value"), "_copy"), found, tied))
    none = cuts.select("series", F.explode(F.filter("ks", lambda k: k <= 0)).alias("k"), F.lit(_LEAST).alias("value"),
                       F.lit(-1).cast("long").alias("copy"))
    ends = stage(ends.unionByName(none).groupBy(F.col("series").alias("_series")).agg(
        F.collect_list(F.struct("value", "copy")).alias("_cuts")), "cuts")
    placed = lookup_join(rows.withColumns({"_series": series, "_place": place}), ends, "_series", how="left")
    copy = F.col("_copy") if "_copy" in rows.columns else F.lit(0).cast("long")
    after = F.filter("_cuts", lambda c: (F.col("_place") > c["value"]) | ((F.col("_place") == c["value"]) & (copy > c["copy"])))
    return placed.withColumn(part, F.coalesce(F.size(after), F.lit(0)).cast("int")).drop("_series", "_place", "_cuts", "_copy")


def _within_ties(copies: DataFrame, found: DataFrame, tied: DataFrame) -> DataFrame:
    """The last row number before each cut that falls among equal places."""
    at = tied.groupBy("series", "value", "upto").agg(F.sort_array(F.collect_list("k")).alias("ks"))
    among = copies.join(at.select("series", "value"), ["series", "value"])
    name = F.concat_ws("/", F.col("value"), F.col("series"))
    sizes = among.groupBy("series", "value").agg(F.count("*").alias("n"))
    before = F.col("upto") - F.col("n")
    inner = stage(at.join(sizes, ["series", "value"]).select(
        "series", "value", name.alias("name"), "n", before.alias("before"), "ks"), "ties")
    ranks = inner.select(F.col("name").alias("series"), "n", F.transform("ks", lambda k: k - F.col("before")).alias("ks"))
    last = order_statistics_of(among.select(name.alias("series"), F.col("_copy").alias("value")), ranks)
    return last.select(F.col("series").alias("name"), F.col("k").alias("r"), F.col("value").alias("copy")).join(
        inner, "name").select("series", (F.col("r") + F.col("before")).alias("k"), "value", "copy")
