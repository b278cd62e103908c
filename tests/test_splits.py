"""Splits: exact sizes, disjoint, complete, independent of partitioning, ties included."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import strata
from millrace.operators.splits import (
    fold_sizes, holdout_size, holdout_split, stratified_split, vault_split, with_folds,
)


def _ids(frame):
    return sorted(r.id for r in frame.select("id").collect())


@pytest.mark.parametrize("n", [1, 4, 5, 99, 1001])
def test_holdout_is_exact_and_complete(spark, n):
    rows = spark.range(n)
    train, test = holdout_split(rows, 0.2, 16, ["id"])
    assert len(_ids(test)) == holdout_size(n, 0.2)
    assert sorted(_ids(train) + _ids(test)) == list(range(n))


def test_published_sizes():
    assert holdout_size(13172, 0.2) == 2635 and 13172 - 2635 == 10537


def test_membership_survives_repartitioning(spark):
    rows = spark.range(500)
    first = _ids(holdout_split(rows, 0.2, 16, ["id"])[1])
    second = _ids(holdout_split(rows.repartition(7).orderBy(F.desc("id")), 0.2, 16, ["id"])[1])
    assert first == second
    assert first != _ids(holdout_split(rows, 0.2, 17, ["id"])[1])


def test_copies_are_split_exactly(spark):
    """A third and more of all rows are copies of one row."""
    rows = spark.range(300).select((F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id"))).alias("id"))
    train, test = holdout_split(rows, 0.2, 3)
    assert (train.count(), test.count()) == (240, 60)
    only_copies = spark.range(103).select(F.lit(1).alias("id"))
    train, test = holdout_split(only_copies, 0.2, 3)
    assert (train.count(), test.count()) == (82, 21)
    sizes = with_folds(only_copies, 5).groupBy("fold").count().collect()
    assert sorted(r["count"] for r in sizes) == [20, 20, 21, 21, 21]


def test_stratified_split_keeps_shares(spark):
    rows = spark.range(1000).withColumn("y", (F.col("id") % 29 == 0).cast("int"))
    train, test = stratified_split(rows, "y", 0.2, 99, ["id"])
    counts = {r.y: r["count"] for r in test.groupBy("y").count().collect()}
    assert sum(counts.values()) == 200 and counts[1] == 7
    assert sorted(_ids(train) + _ids(test)) == list(range(1000))


def largest_remainder(counts, total):
    n = sum(counts.values())
    quota = {k: total * c // n for k, c in counts.items()}
    for k in sorted(counts, key=lambda k: (-(total * counts[k] % n), k))[:total - sum(quota.values())]:
        quota[k] += 1
    return quota


def stratified_fold_sizes(counts, folds):
    dealt, start = {}, 0
    for k in sorted(counts):
        dealt[k] = [sum(p % folds == i for p in range(start, start + counts[k])) for i in range(folds)]
        start += counts[k]
    return dealt


@pytest.mark.parametrize("counts,total", [
    ({"0": 14319, "1": 681}, 3000), ({"a": 3, "b": 3, "c": 3}, 4), ({f"c{i}": i % 13 + 1 for i in range(1001)}, 1400),
    ({"big": 10**15, "one": 1, "two": 2}, 2 * 10**14 + 1), ({"a": 1}, 0), ({}, 0)])
def test_shares_and_folds_of_strata(spark, counts, total):
    table = spark.createDataFrame(list(counts.items()), "series string, n long")
    quotas = {r.series: r.quota for r in strata.apportioned(table, total).collect()}
    assert quotas == (largest_remainder(counts, total) if counts else {})
    assert sum(quotas.values()) == total
    if sum(counts.values()) < 10**6:
        dealt = {r.series: r.quotas for r in strata.fold_quotas(table, 3).collect()}
        assert dealt == stratified_fold_sizes(counts, 3)


def test_golden_shares():
    assert largest_remainder({"0": 14319, "1": 681}, 3000) == {"0": 2864, "1": 136}
    assert fold_sizes(13, 5) == [3, 3, 3, 2, 2]
    assert stratified_fold_sizes({"0": 7, "1": 4}, 3) == {"0": [3, 2, 2], "1": [1, 2, 1]}


@pytest.mark.parametrize("classes", [1001, 200_000])
def test_any_number_of_strata(spark, classes):
    """A third of all rows in one class, null its own class, the rest spread over many."""
    i = F.col("id")
    rows = spark.range(2 * classes).withColumn("y", F.when(i % 3 == 0, "hot").when(i % 3 == 1, (i % classes).cast("string")))
    counts = {r.y or "": r.n for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    quotas = largest_remainder(counts, holdout_size(2 * classes, 0.2))
    train, test = stratified_split(rows, "y", 0.2, 5, ["id"])
    found = {r.y or "": r.n for r in test.groupBy("y").agg(F.count("*").alias("n")).collect()}
    assert found == {k: n for k, n in quotas.items() if n}
    assert train.count() == 2 * classes - sum(quotas.values()) and train.join(test, "id").isEmpty()
    if classes == 1001:
        dealt = stratified_fold_sizes(counts, 5)
        folds = with_folds(rows, 5, 5, ["id"], label="y").groupBy("y", "fold").agg(F.count("*").alias("n")).collect()
        assert {(r.y or "", r.fold): r.n for r in folds} == {(k, f): n for k, ns in dealt.items() for f, n in enumerate(ns) if n}


def test_strata_of_copies_are_cut_exactly(spark, monkeypatch):
    monkeypatch.setattr(strata, "_LIST_ROWS", 3)
    i = F.col("id")
    rows = spark.range(4000).select((i % 4).alias("y"), F.when(i % 4 < 2, 0).otherwise(i % 40).alias("x"))
    folds = with_folds(rows, 7, 1, label="y").groupBy("y", "fold").agg(F.count("*").alias("n")).collect()
    dealt = stratified_fold_sizes({str(k): 1000 for k in range(4)}, 7)
    assert {(str(r.y), r.fold): r.n for r in folds} == {(k, f): n for k, ns in dealt.items() for f, n in enumerate(ns)}


def test_no_plan_names_a_stratum(spark):
    rows = spark.range(3000).withColumn("y", F.concat(F.lit("stratum-"), F.col("id") % 1500))
    _, test = stratified_split(rows, "y", 0.2, 5, ["id"])
    assert "stratum-1499" not in test._jdf.queryExecution().toString()


def test_folds_are_balanced(spark):
    rows = spark.range(103).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    plain = {r.fold: r["count"] for r in with_folds(rows, 5, key=["id"]).groupBy("fold").count().collect()}
    assert plain == dict(enumerate(fold_sizes(103, 5)))
    by_class = with_folds(rows, 5, key=["id"], label="y").filter("y = 1").groupBy("fold").count().collect()
    assert sorted(r["count"] for r in by_class) == [2, 2, 2, 2, 3]


def test_vault_split(spark):
    rows = spark.range(1000).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    train, test, vault = vault_split(rows, "y", key=["id"])
    assert (train.count(), test.count(), vault.count()) == (640, 160, 200)
    assert len(set(_ids(train)) | set(_ids(test)) | set(_ids(vault))) == 1000


def test_prepared_rows_do_not_depend_on_storage(spark):
    from millrace.operators.features import CATEGORIES, LABEL
    from millrace.plans.delivery import prepare_rows

    names = [F.concat(F.lit(f"{c}-"), F.col("id") % 5).alias(c) for c in CATEGORIES]
    view = spark.range(1000).select(*names, (F.col("id") / 7).alias("product_price"), (F.col("id") % 9).alias(LABEL))
    held = [sorted(r.row_id for r in prepare_rows(view.repartition(n)).vault.collect()) for n in (1, 3)]
    assert held[0] == held[1] and len(held[0]) == 200
