"""Table profiles: types, nulls, summaries, counts, box statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from millrace.functions.numeric import nan_to_null
from millrace.operators.selection import exact_quantiles


def _tall(frame: DataFrame, aggregates: Sequence[tuple[str, Mapping[str, object]]]) -> DataFrame:
    """One aggregation of everything, then one row per column."""
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"), *[v.alias(k) for k, v in values.items()])
        for c, values in aggregates
    ])
    return frame.agg(rows.alias("rows")).select(F.inline("rows"))


def schema_report(frame: DataFrame) -> DataFrame:
    """Name, type and number of present values of every column."""
    return _tall(frame, [
        (c, {"data_type": F.lit(kind), "non_null": F.count(f"`{c}`")}) for c, kind in frame.dtypes
    ])


def null_profile(frame: DataFrame) -> DataFrame:
    """Null count and null share of every column."""
    return _tall(frame, [
        (c, {"null_count": F.count_if(F.col(f"`{c}`").isNull()),
             "null_ratio": F.try_divide(F.count_if(F.col(f"`{c}`").isNull()).cast("double"),
                                        F.count("*").cast("double"))})
        for c in frame.columns
    ])


def preview(frame: DataFrame, key: Sequence[str], n: int = 5) -> DataFrame:
    """The first rows by key: a top-n per task, not a sort of the table."""
    return frame.orderBy(*key).limit(n)


def value_counts(frame: DataFrame, column: str) -> DataFrame:
    return (frame.groupBy(column).agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), F.asc(column)))


def flag_counts(frame: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Zeros and ones of every 0/1 column, in one pass."""
    return _tall(frame, [
        (c, {"non_failure": F.count_if(F.col(c) == 0), "failure": F.count_if(F.col(c) == 1)})
        for c in flags
    ])


def true_counts(frame: DataFrame, flags: Sequence[str]) -> DataFrame:
    """How often each flag (boolean or 1) is set."""
    return _tall(frame, [(c, {"n": F.count_if(F.col(c).cast("boolean"))}) for c in flags])


def column_means(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _tall(frame, [
        (c, {"mean": F.avg(nan_to_null(F.col(f"`{c}`").cast("double")))}) for c in columns])


def quantile_table(
    frame: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> DataFrame:
    """Exact quantiles, one row per column and probability."""
    quantiles = exact_quantiles(frame, columns, probabilities)
    rows = [(c, float(p), quantiles[c][i]) for c in columns for i, p in enumerate(probabilities)]
    return frame.sparkSession.createDataFrame(
        rows, "column_name string, probability double, value double")


def describe_numbers(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum of numeric columns."""
    def value(c):
        return nan_to_null(F.col(f"`{c}`").cast("double"))

    basics = _tall(frame, [
        (c, {"count": F.count(value(c)), "mean": F.avg(value(c)), "std": F.stddev_samp(value(c)),
             "min": F.min(value(c)), "max": F.max(value(c))}) for c in columns
    ])
    quartiles = exact_quantiles(frame, columns, [0.25, 0.5, 0.75])

    def of(i: int):
        named = F.create_map(*[x for c in columns for x in (F.lit(c), F.lit(quartiles[c][i]).cast("double"))])
        return F.element_at(named, F.col("column_name"))

    return basics.select("column_name", "count", "mean", "std", "min",
                         of(0).alias("q25"), of(1).alias("q50"), of(2).alias("q75"), "max")


def describe_text(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, distinct values, most frequent value and its frequency of text columns.

    Counting per (column, value) first lets a frequent value combine before the shuffle. On
    a tie the smallest value is the most frequent one.
    """
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value"))
        for c in columns
    ])
    counts = (frame.select(F.inline(pairs)).filter("value IS NOT NULL")
              .groupBy("column_name", "value").agg(F.count("*").alias("n")))
    most = F.min(F.struct((-F.col("n")).alias("m"), "value"))
    return (counts.groupBy("column_name")
            .agg(F.sum("n").alias("count"), F.count("*").alias("unique"), most.alias("most"))
            .select("column_name", "count", "unique", F.col("most.value").alias("top"),
                    (-F.col("most.m")).alias("freq")))


def describe(frame: DataFrame) -> DataFrame:
    """Both summaries for all columns of a table; dates and times count as text."""
    numeric = [f.name for f in frame.schema.fields if isinstance(f.dataType, T.NumericType)]
    text = [f.name for f in frame.schema.fields if isinstance(f.dataType, (T.StringType, T.DatetimeType))]
    parts = ([describe_numbers(frame, numeric)] if numeric else []) + (
        [describe_text(frame, text)] if text else [])
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def box_statistics(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers (the outermost values within 1.5 iqr) and outliers per column."""
    quartiles = exact_quantiles(frame, columns, [0.25, 0.5, 0.75])
    rows = []
    for c in columns:
        q1, q2, q3 = quartiles[c]
        value = nan_to_null(F.col(f"`{c}`").cast("double"))
        inside = value.between(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)) if q1 is not None else F.lit(False)
        number = lambda q: F.lit(q).cast("double")
        rows.append((c, {
            "min": F.min(value), "q1": number(q1), "median": number(q2), "q3": number(q3),
            "max": F.max(value), "whisker_low": F.min(F.when(inside, value)),
            "whisker_high": F.max(F.when(inside, value)), "outliers": F.count_if(~inside),
        }))
    return _tall(frame, rows)


def box_outliers(frame: DataFrame, columns: Sequence[str], key: Sequence[str]) -> DataFrame:
    """The points beyond the whiskers, as (key, column_name, value)."""
    quartiles = exact_quantiles(frame, columns, [0.25, 0.75])
    points = []
    for c in columns:
        q1, q3 = quartiles[c]
        value = nan_to_null(F.col(f"`{c}`").cast("double"))
        if q1 is not None:
            beyond = (value < q1 - 1.5 * (q3 - q1)) | (value > q3 + 1.5 * (q3 - q1))
            points.append(F.struct(F.lit(c).alias("column_name"), F.when(beyond, value).alias("value")))
    return frame.select(*key, F.inline(F.array(*points))).filter("value IS NOT NULL")


def row_lineage(steps: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns after each named step."""
    counted = [
        frame.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("step"), "rows", F.lit(len(frame.columns)).alias("columns"))
        for name, frame in steps.items()
    ]
    return reduce(DataFrame.unionByName, counted)
