"""Schema operators, fit-and-apply steps, profiles."""

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.operators import cleaning, columns, profile


def test_mostly_null_columns(spark):
    rows = spark.range(100).select(
        F.col("id").alias("kept"),
        F.when(F.col("id") >= 79, 1).alias("null_79"), F.when(F.col("id") >= 80, 1).alias("null_80"),
        F.lit(None).cast("int").alias("null_100"))
    assert columns.drop_mostly_null(rows).columns == ["kept", "null_79"]
    with pytest.raises(ValueError, match="null_80"):
        columns.drop_mostly_null(rows, required=["kept", "null_80"])
    assert columns.drop_mostly_null(rows.filter("false")).columns == rows.columns


def test_insert_and_rename(spark):
    rows = spark.createDataFrame([(1, 2)], "`A [K]` int, `B c` int")
    named = columns.rename_all(rows, lambda c: c.lower())
    assert columns.insert_column(named, 1, "x", F.lit(9)).columns == ["a [k]", "x", "b c"]


def test_enforced_types(spark):
    rows = spark.createDataFrame([("1", "2.5"), (None, "3")], "a string, b string")
    kept = columns.enforce_types(rows, {"b": "double", "a": "bigint"})
    assert kept.dtypes == [("b", "double"), ("a", "bigint")]
    assert [tuple(r) for r in kept.collect()] == [(2.5, 1), (3.0, None)]
    with pytest.raises(PySparkException):
        columns.enforce_types(rows, {"a": "bigint"}, strict=True).collect()


def test_clip_at_percentiles(spark):
    values = np.random.default_rng(1).normal(size=1000) * 100
    rows = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    bounds = cleaning.fit_clip(rows, "x")
    low, high = pd.Series(values).quantile([0.01, 0.99])
    assert (bounds.low, bounds.high) == pytest.approx((low, high))
    clipped = bounds.apply(rows, digits=None)
    got = clipped.agg(F.min("x"), F.max("x"), F.count("x"), F.count("*")).first()
    assert tuple(got) == (bounds.low, bounds.high, 1000, 1001)


def test_imputation(spark):
    rows = spark.createDataFrame([(1.0, 1), (None, 2), (float("nan"), None), (6.0, 4), (2.0, 9)], "x double, n int")
    by_mean = cleaning.fit_imputation(rows, ["x", "n"]).apply(rows)
    assert [r.x for r in by_mean.collect()] == [1.0, 3.0, 3.0, 6.0, 2.0]
    assert [r.n for r in by_mean.collect()] == [1.0, 2.0, 4.0, 4.0, 9.0]
    by_median = cleaning.fit_imputation(rows, ["x"], "median").apply(rows)
    assert [r.x for r in by_median.collect()] == [1.0, 2.0, 2.0, 6.0, 2.0]
    with pytest.raises(ValueError):
        cleaning.fit_imputation(rows, ["x"], "mode")


def test_outlier_fences(spark):
    rows = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 5.5, 100, -90]], "x double")
    values = [r.x for r in rows.collect()]
    q1, q3 = np.quantile(values, [0.25, 0.75])
    for upper, bound in (("code", q3 + 1), ("tukey", q3 + 1.5 * (q3 - q1))):
        flags = [r.x_outlier for r in cleaning.fit_outlier_fences(rows, ["x"], upper).apply(rows).collect()]
        assert flags == [int(v < q1 - 1.5 * (q3 - q1) or v > bound) for v in values]


def test_describe_matches_pandas(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, None, 4.0], "t": ["x", "y", "x", None]})
    rows = spark.createDataFrame([(1.0, "x"), (2.0, "y"), (None, "x"), (4.0, None)], "a double, t string")
    got = {r.column_name: r for r in profile.describe(rows).collect()}
    want = pdf.describe(include="all")
    assert (got["a"]["count"], got["a"].mean, got["a"].std, got["a"].q25, got["a"].max) == pytest.approx(
        tuple(want["a"][["count", "mean", "std", "25%", "max"]]))
    assert (got["t"]["count"], got["t"].unique, got["t"].top, got["t"].freq) == (3, 2, "x", 2)


def test_box_statistics(spark):
    rows = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 2, 3, 4, 100])], "id int, x double")
    box = profile.box_statistics(rows, ["x"]).first()
    assert (box.q1, box.median, box.q3, box.whisker_low, box.whisker_high, box.outliers) == (2, 3, 4, 1, 4, 1)
    assert [tuple(r) for r in profile.box_outliers(rows, ["x"], ["id"]).collect()] == [(4, "x", 100.0)]
