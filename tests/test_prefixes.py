"""First trees of an ensemble score like ensembles of that many trees."""

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from millrace.operators import models
from millrace.operators.metrics import confusion_counts
from millrace.operators.prefixes import confusion_by_size, negative_mae_by_size, with_prefixes


@pytest.fixture(scope="module")
def rows(spark):
    i = F.col("id")
    return spark.range(800).select(
        i, array_to_vector(F.array((i % 7).cast("double"), (i % 11).cast("double"), (i % 3).cast("double"))).alias("features"),
        ((i % 7) * (i % 3) + F.sin(i)).cast("double").alias("label")).persist()


@pytest.fixture(scope="module")
def failures(rows):
    return rows.withColumn("label", (F.col("label") > 5).cast("double")).withColumn("weight", 1 + 2 * F.col("label")).persist()


def test_sums_are_those_of_the_trees(rows):
    model = models.forest_regressor(numTrees=7, maxDepth=4).fit(rows)
    found = {r.id: r.sums for r in with_prefixes(model, rows, [1, 4, 7]).collect()}
    wanted = {r.id: [0.0] * 3 for r in rows.collect()}
    for k, tree in enumerate(model.trees):
        for r in tree.transform(rows).collect():
            for at, size in enumerate((1, 4, 7)):
                wanted[r.id][at] += r.prediction if k < size else 0.0
    assert all(found[i] == pytest.approx(wanted[i]) for i in wanted)
    whole = {r.id: r.prediction for r in model.transform(rows).collect()}
    assert all(found[i][2] / 7 == pytest.approx(whole[i]) for i in whole)
    assert negative_mae_by_size(model, rows, [7])[0] == pytest.approx(models.negative_mae(model.transform(rows)))


def test_rounds_of_a_classifier_score_like_separate_fits(failures):
    params = {"maxDepth": 2, "stepSize": 0.3, "subsamplingRate": 0.8}
    longest = models.boosted_classifier(maxIter=6, **params).fit(failures)
    by_size = {r.rounds: r for r in confusion_by_size(longest, failures, [1, 3, 6]).collect()}
    for n, row in by_size.items():
        alone = models.boosted_classifier(maxIter=n, **params).fit(failures).transform(failures)
        counts = confusion_counts(alone, F.col("label") == 1, F.col("prediction") == 1).first()
        assert (row.true_p, row.true_n, row.false_p, row.false_n) == tuple(counts)


def test_searches_share_fits(failures, rows, monkeypatch):
    fits = []
    for build, score, grid, size in (
            (models.boosted_classifier, models.failure_f1, {"maxIter": [2, 5], "maxDepth": [2, 3]}, "maxIter"),
            (models.forest_regressor, models.negative_mae, {"numTrees": [3, 6], "maxDepth": [3]}, "numTrees")):
        counted = lambda **params: fits.append(params) or build(**params)  # noqa: B023, E731
        data = failures if size == "maxIter" else rows
        found = models.grid_search(data, counted, grid, score, folds=3, key=["id"])
        trained = [p for p in fits if p]
        assert [p for p, _ in found.scores] == models.candidates(grid)
        groups = len(found.scores) // 2
        assert len(trained) == 3 * groups + 1 and all(p[size] == max(grid[size]) for p in trained[:-1])
        fits.clear()
        if size == "maxIter":  # one size at a time scores the same
            few = models.grid_search(data, build, {**grid, size: grid[size][:1]}, score, folds=3, key=["id"])
            alone = {str(p): s for p, s in few.scores}
            assert all(alone[str(p)] == pytest.approx(s) for p, s in found.scores if str(p) in alone)
