"""Exact order statistics against numpy, on plain and awkward data."""

import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from millrace.operators import selection
from millrace.operators.selection import exact_quantiles, order_statistics


def _frame(spark, values, name="x"):
    return spark.createDataFrame([(float(v) if v is not None else None,) for v in values], f"{name} double")


@pytest.mark.parametrize("values", [
    [1.0], [1.0, 2.0], [3.0] * 50, list(range(100)), [-5, -5, 0, 0, 7, 1e300, -1e300],
    [1e-310, -1e-310, 0.0, -0.0, 5e-324], [math.inf, -math.inf, 1, 2], [0.1 * i for i in range(1000)],
    [2.0**i for i in range(-60, 60)], [1 - 2**-53, 1.0, 1 + 2**-52, 2 - 2**-52, 2.0],
], ids=range(10))
def test_against_numpy(spark, values):
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = exact_quantiles(_frame(spark, values), ["x"], probabilities)["x"]
    want = [float(np.quantile(np.array(values, dtype=float), p)) if not any(map(math.isinf, values)) else None
            for p in probabilities]
    for g, w in zip(got, want):
        if w is not None:
            assert g == pytest.approx(w, rel=1e-12, abs=1e-300)


def test_nulls_and_nan_do_not_count(spark):
    assert exact_quantiles(_frame(spark, [None, float("nan"), 1, 3]), ["x"], [0.5]) == {"x": [2.0]}
    assert exact_quantiles(_frame(spark, [None]), ["x"], [0.5]) == {"x": [None]}


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=64), min_size=1, max_size=60), st.integers(0, 100))
def test_any_rank(spark, values, percent):
    rank = max(1, math.ceil(len(values) * percent / 100))
    frame = _frame(spark, values, "value").select(F.lit("s").alias("series"), "value")
    found, sizes = order_statistics(frame, lambda n: {"s": [rank]}, counted=True)
    value, upto = found["s", rank]
    assert value == sorted(values)[rank - 1] and sizes == {"s": len(values)}
    assert upto == sum(v <= value for v in values)


def test_refines_in_several_passes(spark, monkeypatch):
    """Small limits force every kind of pass that trillions of rows would need."""
    monkeypatch.setattr(selection, "_LIST_ROWS", 3)
    monkeypatch.setattr(selection, "_CUTS", 4)
    monkeypatch.setattr(selection, "_GATHERED_SLOTS", 2)
    rng = random.Random(5)
    values = [rng.gauss(1000, 1) for _ in range(2000)] + [1000.5] * 500
    got = exact_quantiles(_frame(spark, values), ["x"], [0.1, 0.5, 0.9])["x"]
    assert got == pytest.approx(list(np.quantile(values, [0.1, 0.5, 0.9])), rel=1e-13)


def test_longs_beyond_double_precision(spark, monkeypatch):
    monkeypatch.setattr(selection, "_LIST_ROWS", 3)
    base = 2**62
    values = [base + i for i in range(100)] + [-base - i for i in range(100)]
    frame = spark.createDataFrame([("s", v) for v in values], "series string, value bigint")
    ranks = [1, 50, 100, 101, 137, 200]
    found, _ = order_statistics(frame, lambda n: {"s": ranks}, counted=True)
    assert [found["s", k] for k in ranks] == [(sorted(values)[k - 1], k) for k in ranks]


def test_several_columns_at_once(spark):
    rows = spark.range(1000).select(F.col("id").alias("a"), (F.col("id") * 3.5 - 100).alias("b"))
    got = exact_quantiles(rows, ["a", "b"], [0.25, 0.5])
    assert got == {"a": [249.75, 499.5], "b": [249.75 * 3.5 - 100, 499.5 * 3.5 - 100]}
