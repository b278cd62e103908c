"""Numbers and codes by ranges: dense, in order, for any number of values, without a window over all rows."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.operators import codes, features, models
from millrace.operators.reports import dispatch_queue


def unpartitioned_windows(frame):
    plan = frame._jdf.queryExecution().toString()
    return plan.count("Exchange SinglePartition") + plan.count("windowspecdefinition(specified")


def test_numbers_and_totals(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v"), (F.col("id") % 5).alias("n"))
    got = [tuple(r) for r in codes.numbered(rows.repartition(11), [F.desc("v")]).select("v", "position").collect()]
    assert sorted(got) == [(v, 4999 - v) for v in range(5000)]
    kept = sorted((r.v, r.n) for r in rows.collect())
    totals, before = {}, 0
    for v, n in kept:
        totals[v], before = before, before + n
    assert {r.v: r.before for r in codes.totals_before(rows, ["v"], "n").collect()} == totals
    for empty in (codes.numbered(rows.where("v < 0"), ["v"]), codes.totals_before(rows.where("v < 0"), ["v"], "n")):
        assert empty.collect() == []


def test_codes_by_group(spark):
    rows = spark.createDataFrame([("a", "x"), ("a", "é"), ("b", "z"), ("a", "x"), ("b", None), (None, "q"), (None, "p")], "c string, v string")
    assert sorted(map(tuple, codes.dense_codes(rows, "v", ["c"]).collect()), key=str) == sorted(
        [("a", "x", 0), ("a", "é", 1), ("b", "z", 0), (None, "p", 0), (None, "q", 1)], key=str)


@pytest.fixture(scope="module")
def wide(spark):
    """100,001 values in one column, with a null and a column of one value."""
    i = F.col("id")
    return spark.range(100_003).select(
        F.when(i < 100_002, F.format_string("v%06d", i % 100_001)).alias("k"), F.lit("one").alias("only"),
        F.element_at(F.lit(["p", "q", "r"]), (i % 3 + 1).cast("int")).alias("m"), (i % 10).cast("double").alias("x"),
        (i % 3 + i % 2).cast("double").alias("y"))


def test_100001_categories_as_indicators(spark, wide):
    encoder = features.fit_feature_encoder(wide, ["k", "only", "m"], ["x"])
    assert encoder.width == 1 + 100_000 + 2
    slots = {r.feature: r.slot for r in encoder.slots.where("slot < 2 or slot > 99999").collect()}
    assert slots == {"x": 0, "k_v000001": 1, "k_v100000": 100_000, "m_q": 100_001, "m_r": 100_002}
    rows = encoder.apply(wide, ["k", "m", "x"], "y")
    some = rows.where("k in ('v000000', 'v000001', 'v099999') or k is null").select("k", "m", "x", "features").collect()
    assert len(some) == 5
    for r in some:
        want = {0: r.x} | ({int(r.k[1:]): 1.0} if r.k not in (None, "v000000") else {}) | ({"q": {100_001: 1.0}, "r": {100_002: 1.0}}.get(r.m, {}))
        assert {k: v for k, v in zip(r.features.indices.tolist(), r.features.values.tolist()) if v} == {k: v for k, v in want.items() if v}
    sums = {r.feature: r.total for r in features.feature_sums(rows, encoder.slots).where(
        "feature in ('x', 'k_v000000', 'k_v000001', 'k_v000002', 'm_r')").collect()}
    assert sums == pytest.approx({"x": wide.agg(F.sum("x")).first()[0], "k_v000001": 1, "k_v000002": 1, "m_r": 33334})
    assert unpartitioned_windows(rows) == 0


def test_100001_categories_as_nominal_slots(wide):
    encoder = features.fit_index_encoder(wide, ["k", "only", "m"], ["x"])
    assert [r.feature for r in encoder.slots.orderBy("slot").collect()] == ["x", "k_digit0", "k_digit1", "only", "m"]
    assert encoder.bins == 1024 and encoder.width == 5
    rows = encoder.apply(wide, ["k"], "y")
    low, high = (vector_to_array("features")[i] for i in (1, 2))
    assert rows.select(low, high).distinct().count() == 100_002  # nulls have a code of their own
    model = models.boosted_regressor(maxIter=3, maxDepth=3, maxBins=encoder.bins).fit(rows)
    table = {r.feature: r.importance for r in models.importances(model, encoder.slots).collect()}
    assert len(table) == 5 and sum(table.values()) == pytest.approx(1) and table["m"] > 0.2


def test_queue_ranks_without_one_task(spark):
    rows = spark.range(3000).select(F.col("id").alias("machine_id"), F.when(F.col("id") % 100 < 99, F.col("id") % 700 / 7.0).alias("failure_probability"))
    queue = dispatch_queue(rows)
    got = queue.collect()
    values = sorted((r.failure_probability for r in rows.collect()), key=lambda p: (p is None, -(p or 0)))
    assert [r.failure_probability for r in got] == values
    assert all(r.queue_rank == 1 + values.index(r.failure_probability) for r in got)
    assert unpartitioned_windows(queue) == 0
