"""Nulls and NaN in every input train and score; fills are those of each fit's own rows."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.operators import missing, models
from millrace.plans import delivery, maintenance
from millrace.plans.scoring_batch import literal_batch
from millrace.plans.telemetry import MODEL_INPUTS
from millrace.operators.features import CATEGORIES, LABEL


@pytest.fixture(scope="module")
def view(spark):
    i = F.col("id")
    names = [F.concat(F.lit(f"{c}-"), i % (k + 2)).alias(c) for k, c in enumerate(CATEGORIES)]
    return spark.range(700).select(
        *names, F.when(i % 11 > 0, i % 13).cast("double").alias("product_price"),
        F.when(i % 7 > 0, (i % 4).cast("double")).otherwise(float("nan")).alias("days_for_shipment_scheduled"),
        (i % 17).cast("double").alias("order_item_total"), F.lit(None).cast("double").alias("order_profit_capped"),
        ((i % 4) * 2 - F.when(i % 11 == 0, 3).otherwise(0)).cast("int").alias(LABEL))


@pytest.mark.parametrize("encoding", ["indicators", "indexed"])
def test_regressors_train_on_gaps(spark, view, encoding, tmp_path):
    rows = delivery.prepare_rows(view, encoding=encoding)
    assert rows.encoder.gaps == ("product_price", "days_for_shipment_scheduled")
    slots = [r.feature for r in rows.encoder.slots.orderBy("slot").collect()]
    assert slots[-4:] == ["product_price", "days_for_shipment_scheduled", "product_price_missing", "days_for_shipment_scheduled_missing"]
    assert "order_profit_capped" not in slots and len(slots) == rows.encoder.width
    boosted = delivery.train_boosted(rows, {"maxIter": [3, 6], "maxDepth": [3], "stepSize": [0.3]}, folds=2)
    forest = delivery.train_forest(rows, {"numTrees": [4, 8], "maxDepth": [4]}, folds=2)
    assert len(boosted.scores) == len(forest.scores) == 2
    assert delivery.vault_predictions(rows, boosted, forest).where("boosted IS NULL OR forest IS NULL").isEmpty()
    table = {r.feature: r.importance for r in models.importances(boosted.model, rows.encoder.slots).collect()}
    assert sum(table.values()) == pytest.approx(1) and table["product_price_missing"] > 0
    models.save_model(boosted.model, str(tmp_path / "m"))
    again = models.load_model(str(tmp_path / "m"), PipelineModel)
    assert again.transform(rows.vault).agg(F.sum("prediction")).first() == boosted.model.transform(rows.vault).agg(F.sum("prediction")).first()


def test_fill_is_learnt_from_the_rows_of_the_fit(spark):
    rows = spark.createDataFrame([(1.0, 1.0, 0.0), (3.0, None, 1.0), (float("nan"), 5.0, 1.0), (8.0, 9.0, 0.0)], "a double, b double, label double")
    build = missing.filling(models.boosted_regressor, ["a", "b"], known=False)
    for part in (rows, rows.where("a <> 8 or a is null")):
        model = build(maxIter=1, maxDepth=1).fit(part)
        means = part.select(*[F.avg(F.nanvl(F.col(c), F.lit(None).cast("double"))) for c in "ab"]).first()
        seen = [tuple(r[0]) for r in missing.with_features(model, rows).select(vector_to_array("features")).collect()]
        assert seen == [(1.0, 1.0, 0.0, 0.0), (3.0, means[1], 0.0, 1.0), (means[0], 5.0, 1.0, 0.0), (8.0, 9.0, 0.0, 0.0)]
    assert missing.gap_counts(rows, ["a", "b", "label"]) == {"a": 1, "b": 1}


def test_classifier_trains_and_scores_with_gaps_in_every_input(spark, tmp_path):
    i = F.col("id")
    inputs = [F.when((i + k) % 11 > 0, (i * (k + 3) % 29).cast("double")).otherwise(
        F.lit(float("nan")) if k % 2 else F.lit(None).cast("double")).alias(c) for k, c in enumerate(MODEL_INPUTS)]
    cleaned = spark.range(600).select(i.alias("udi"), *inputs, (i * 5 % 29 < 6).cast("int").alias("machine_failure"))
    trained = maintenance.train_classifier(cleaned, grid={"maxDepth": [3], "maxIter": [2, 5], "stepSize": [0.3]}, folds=2)
    assert isinstance(trained.search.model, PipelineModel) and trained.test.where("prediction IS NULL").isEmpty()
    models.save_model(trained.search.model, str(tmp_path / "m"))
    model = models.load_model(str(tmp_path / "m"), PipelineModel)
    batch = literal_batch(spark)
    empty = batch.withColumns({c: F.lit(None).cast("double") for c in MODEL_INPUTS})
    assert maintenance.score_machines(model, batch.unionByName(empty)).where("failure_probability IS NOT NULL").count() == 40
    # A model trained without gaps takes rows with gaps too.
    whole = maintenance.train_classifier(cleaned.fillna(0.0).replace(float("nan"), 0.0), grid={"maxDepth": [2], "maxIter": [2]}, folds=2)
    assert isinstance(whole.search.model, GBTClassificationModel)
    assert maintenance.score_machines(whole.search.model, empty).where("failure_probability IS NOT NULL").count() == 20
