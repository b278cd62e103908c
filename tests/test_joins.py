"""Lookup joins and integrity checks, hot keys included."""

from pyspark.sql import functions as F

from millrace.operators.integrity import duplicate_keys, one_row_per_key, orphan_counts, orphan_rows
from millrace.operators.joins import hot_keys, lookup_join, measured_bytes


def skewed(spark):
    """A third of all rows has one key; some keys are null, some have no lookup row."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 400)
    return spark.range(3000).select("id", key.alias("k"))


def lookup(spark):
    return spark.range(350).select(F.col("id").alias("k"), F.concat(F.lit("name-"), "id").alias("name"))


def test_hot_keys_are_found(spark):
    assert hot_keys(skewed(spark), "k", 0.1) == [7]


def test_every_way_of_joining_agrees(spark):
    facts, names = skewed(spark), lookup(spark)
    want = sorted(map(tuple, facts.join(names, "k").collect()))
    for limit, share in ((10**9, 0.1), (0, 0.1), (0, 0.9)):
        joined = lookup_join(facts, names, "k", broadcast_bytes=limit, hot_share=share)
        assert sorted(map(tuple, joined.select("k", "id", "name").collect())) == want


def test_hot_rows_are_dealt_out(spark):
    joined = lookup_join(skewed(spark), lookup(spark), "k", broadcast_bytes=0, hot_share=0.1)
    salts = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in salts and "Union" not in salts
    assert joined.columns == ["k", "id", "name"]


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_large_lookups_are_hashed_and_facts_not_sorted(spark, monkeypatch):
    facts, names = skewed(spark), lookup(spark)
    want = sorted(map(tuple, facts.join(names, "k").collect()))
    for share in (0.1, 0.9):
        joined = lookup_join(facts, names, "k", broadcast_bytes=0, hot_share=share)
        assert "ShuffledHashJoin" in _plan(joined) and "Sort " not in _plan(joined)
        assert sorted(map(tuple, joined.select("k", "id", "name").collect())) == want
    monkeypatch.setattr("millrace.operators.joins.HASHED_BYTES", 0)
    merged = lookup_join(facts, names, "k", broadcast_bytes=0, hot_share=0.9)
    assert "ShuffledHashJoin" not in _plan(merged)
    assert sorted(map(tuple, merged.select("k", "id", "name").collect())) == want


def test_chained_joins_read_the_facts_once(spark, tmp_path):
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 40)
    spark.range(3000).select("id", *[key.alias(f"k{i}") for i in range(3)]).write.parquet(f"{tmp_path}/facts")
    joined = facts = spark.read.parquet(f"{tmp_path}/facts")
    for i in range(3):
        names = spark.range(40).select(F.col("id").alias(f"k{i}"), F.lit("x").alias(f"name{i}"))
        joined = lookup_join(joined, names, f"k{i}", broadcast_bytes=0, hot_share=0.1, hot_in=facts)
    assert joined._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1
    assert joined.count() == 3000


def test_nested_columns_are_measured(spark):
    lists = spark.range(10).select(F.sequence(F.lit(1), F.lit(1000)).alias("x"))
    assert measured_bytes(lists) > 10 * 8 * 1000


def test_names_may_differ(spark):
    renamed = lookup(spark).withColumnRenamed("k", "key")
    assert lookup_join(skewed(spark), renamed, ("k", "key")).columns == ["k", "id", "name"]


def test_measured_bytes_counts_text(spark):
    short = spark.range(10).select(F.lit("a").alias("x"))
    long = spark.range(10).select(F.repeat(F.lit("a"), F.lit(1000)).alias("x"))
    assert measured_bytes(long) - measured_bytes(short) == 10 * 999
    assert measured_bytes(short.filter("false")) == 0


def test_orphans(spark):
    facts, names = skewed(spark), lookup(spark).filter("k <> 7")
    got = orphan_rows(facts, names, "k")
    want = facts.filter("k = 7 OR k >= 350")
    assert sorted(r.id for r in got.collect()) == sorted(r.id for r in want.collect())
    counts = {r.k: r.rows for r in orphan_counts(facts, names, "k").collect()}
    assert counts[7] == 1000 + facts.filter("k = 7 AND id % 3 <> 0").count()


def test_one_row_per_key(spark):
    rows = spark.createDataFrame(
        [(1, "b", 2.0), (1, "a", 9.0), (1, "a", 3.0), (2, None, 1.0), (2, "z", 0.0), (None, "q", 1.0)],
        "k int, name string, price double")
    got = {tuple(r) for r in one_row_per_key(rows, ["k"]).collect()}
    assert got == {(1, "a", 3.0), (2, None, 1.0), (None, "q", 1.0)}
    assert [(r.k, r.rows) for r in duplicate_keys(rows, ["k"]).orderBy("k").collect()] == [(1, 3), (2, 2)]
