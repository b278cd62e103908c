"""Features, searches, scoring and streaming on small data."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.operators import features, models
from millrace.operators.metrics import FOREST, BOOSTED, regression_metrics
from millrace.plans import delivery, maintenance
from millrace.plans.scoring_batch import TEST_MACHINES, literal_batch
from millrace.plans.stand_ins import telemetry_extract
from millrace.plans.telemetry import clean_telemetry, fit_telemetry_cleaner
from millrace.streaming.scoring import score_available

EVENTS = "/root/testdata/sf0.001/events.parquet"


def test_wide_and_vector_indicators_agree(spark):
    rows = spark.createDataFrame([("b", "x", 1.0), ("a", "x", 2.0), (None, "x", 3.0), ("c", "x", 4.0)],
                                 "k string, only string, n double")
    wide = features.fit_wide_indicators(rows, ["k", "only"]).apply(rows)
    assert wide.columns == ["n", "k_b", "k_c"]
    assert sorted(map(tuple, wide.collect())) == [
        (1.0, True, False), (2.0, False, False), (3.0, False, False), (4.0, False, True)]
    encoder = features.fit_feature_encoder(rows, ["k", "only"], ["n"])
    assert [r.feature for r in encoder.slots.orderBy("slot").collect()] == ["n", "k_b", "k_c"]
    unseen = spark.createDataFrame([("zz", "y", 5.0)], rows.schema)
    vectors = encoder.apply(rows.unionByName(unseen), []).select(vector_to_array("features").alias("v"))
    assert sorted(tuple(r.v) for r in vectors.collect()) == [(1, 1, 0), (2, 0, 0), (3, 0, 0), (4, 0, 1), (5, 0, 0)]


def test_too_many_categories_are_refused(spark):
    rows = spark.range(20).select(F.col("id").cast("string").alias("k"))
    with pytest.raises(ValueError, match="more than 10"):
        features.fit_wide_indicators(rows, ["k"], limit=10)


def test_indexed_encoding_is_nominal(spark, view):
    rows = delivery.prepare_rows(view, encoding="indexed")
    assert rows.encoder.width == rows.encoder.slots.count() == 10 and rows.encoder.bins == 8
    search = delivery.train_boosted(rows, {"maxIter": [6], "maxDepth": [4], "stepSize": [0.3]}, folds=2)
    baseline = rows.vault.agg(F.stddev_pop("label")).first()[0]
    assert regression_metrics(search.model.transform(rows.vault)).first().rmse < 0.5 * baseline


def test_grid_sizes():
    assert len(models.candidates(models.BOOSTED_REGRESSION_GRID)) == 24
    assert len(models.candidates(models.FOREST_GRID)) == 24
    assert len(models.candidates(models.BOOSTED_CLASS_GRID)) == 36


@pytest.fixture(scope="module")
def view(spark):
    """A learnable stand-in for the training view."""
    i = F.col("id")
    return spark.range(600).select(
        F.element_at(F.array(*[F.lit(x) for x in "abcd"]), (i % 4 + 1).cast("int")).alias("shipping_mode"),
        F.element_at(F.array(*[F.lit(x) for x in "xyz"]), (i % 3 + 1).cast("int")).alias("customer_segment"),
        (i % 7).cast("string").alias("customer_city"), (i % 5).cast("string").alias("customer_state"),
        F.lit("one").alias("category_name"), (i % 2).cast("string").alias("department_name"),
        (i % 13).cast("double").alias("product_price"), (i % 4).cast("int").alias("days_for_shipment_scheduled"),
        ((i % 4) * 2 - (i % 3)).cast("int").alias("delivery_variance_days"),
        (i % 17).cast("double").alias("order_item_total"), (i % 19).cast("double").alias("order_profit_capped"))


def test_delivery_models(spark, view, tmp_path):
    rows = delivery.prepare_rows(view)
    assert (rows.train.count(), rows.vault.count()) == (480, 120)
    grid = {"maxIter": [3, 6], "maxDepth": [3], "stepSize": [0.3]}
    boosted = delivery.train_boosted(rows, grid, folds=2)
    forest = delivery.train_forest(rows, {"numTrees": [5], "maxDepth": [4]}, folds=2)
    assert [p["maxIter"] for p, _ in boosted.scores] == [3, 6] and boosted.best_params["maxIter"] == 6
    baseline = rows.vault.agg(F.stddev_pop("label")).first()[0]
    quality = regression_metrics(boosted.model.transform(rows.vault)).first()
    assert quality.rmse < 0.6 * baseline
    report = delivery.compare_models(rows, boosted, forest)
    assert [r.model for r in report.metrics.collect()] == [BOOSTED, FOREST]
    assert report.champion.first().winner in (BOOSTED, FOREST)
    top = report.importances.collect()
    assert len(top) == 10 and top[0].importance >= top[1].importance
    path = str(tmp_path / "model")
    models.save_model(boosted.model, path)
    again = regression_metrics(models.load_model(path).transform(rows.vault)).first()
    assert again.rmse == pytest.approx(quality.rmse)


def test_shared_rounds_score_like_separate_fits(spark, view):
    rows = delivery.prepare_rows(view)
    shared = delivery.train_boosted(rows, {"maxIter": [2, 4], "maxDepth": [2], "subsamplingRate": [0.8]}, folds=2)
    alone = delivery.train_boosted(rows, {"maxIter": [2], "maxDepth": [2], "subsamplingRate": [0.8]}, folds=2)
    assert shared.scores[0][1] == pytest.approx(alone.scores[0][1])


def test_vault_job_and_stream(spark):
    events = spark.read.parquet(EVENTS)
    raw = telemetry_extract(events)
    n = raw.count()
    job = maintenance.vault_job(raw, grid={"maxDepth": [4], "maxIter": [8], "stepSize": [0.3]}, folds=2)
    counts = job.counts.first()
    assert counts.true_p + counts.true_n + counts.false_p + counts.false_n == -(-n // 5)
    revised = job.revised_counts.first()
    assert revised.true_p >= counts.true_p and revised.false_n <= counts.false_n
    batch = maintenance.score_machines(job.classifier.search.model, literal_batch(spark))
    assert batch.count() == len(TEST_MACHINES) == 20
    score = lambda rows: maintenance.score_machines(
        job.classifier.search.model, job.cleaner.apply(telemetry_extract(rows)))
    streamed = score_available(spark, EVENTS + "*", events.schema, score)
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, score(events).collect()))


def test_cleaner_learns_once_and_applies_elsewhere(spark):
    raw = telemetry_extract(spark.read.parquet(EVENTS))
    cleaner = fit_telemetry_cleaner(raw)
    one = cleaner.apply(raw.limit(1))
    assert one.columns[5] == "temp_difference_k" and one.columns == clean_telemetry(raw).columns
    assert cleaner.apply(raw).filter("torque_nm IS NULL").count() == 0


def test_fits_side_by_side_keep_a_bounded_number_of_bytes(spark, view, monkeypatch):
    assert models.fits_at_once(0, 1_500) == models.fits_at_once(125_000, 1_538) == 4
    assert models.fits_at_once(750_000, 1_538) == models.fits_at_once(10**9, 1_538) == 1
    assert models.fits_at_once(7_500_000, 10) == 4 and models.fits_at_once(7_500_000, 10, most=2) == 2
    rows = delivery.prepare_rows(view)
    one = rows.train.count() // 2 * (4 * rows.encoder.width + models.ROW_BYTES)
    monkeypatch.setattr(delivery, "grid_search", lambda *_, parallelism, **__: parallelism)
    for train in (delivery.train_boosted, delivery.train_forest):
        found = []
        for room in (one // 2, 2 * one, 9 * one):
            monkeypatch.setattr(models, "FIT_BYTES", room)
            found.append(train(rows, {}, folds=2))
        assert found == [1, 2, 4]
