"""Bucketed facts and lookup join without an exchange, hot and null keys included."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import colocated


@pytest.mark.parametrize("bucket_bytes", [1 << 27, 30_000])
def test_join_without_an_exchange(spark, bucket_bytes):
    i = F.col("id")
    facts = spark.range(6000).select(i, F.when(i % 3 == 0, 7).when(i % 97 == 0, None).otherwise(i % 500).alias("k"), (i * 2).alias("v"))
    lookup = spark.range(400).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    stored = colocated.store_colocated(facts, lookup, "k", bucket_bytes=bucket_bytes)
    assert (stored.buckets > 1) == (bucket_bytes < 1 << 20)
    for how in ("inner", "left"):
        joined, plain = stored.join(how), facts.join(lookup, "k", how)
        assert sorted(map(tuple, joined.select("id", "k", "v", "name").collect())) == sorted(
            map(tuple, plain.select("id", "k", "v", "name").collect()))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    if bucket_bytes < 1 << 20:  # the hot key's rows, a third of all, are spread
        spread = stored.facts.where("k = 7").groupBy("_salt").count().collect()
        assert len(spread) == 4 and max(r["count"] for r in spread) < 1000
        assert stored.facts.where("k IS NULL").select("_salt").distinct().count() > 4


def test_sizes_are_measured(spark):
    facts = spark.range(100).select((F.col("id") % 2).alias("k"))
    assert colocated.key_salts(facts, "k", 10.0, 100) == {0: 5, 1: 5}
    assert colocated.key_salts(facts, "k", 1.0, 100) == {}
