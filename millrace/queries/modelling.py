"""Splits, feature vectors, searches, scoring and model reports."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from millrace.functions.machine import FAILURE, NORMAL
from millrace.functions.numeric import percent, round_half_even
from millrace.operators.features import CATEGORIES, LABEL, feature_sums, fit_feature_encoder, slot_table
from millrace.operators.metrics import BOOSTED, FOREST, choose_champion, class_weight, regression_metrics
from millrace.operators.missing import predicted
from millrace.operators.models import candidates, importances, load_model, save_model, top_importances
from millrace.operators.scoring import flagged_machines
from millrace.operators.splits import (
    holdout_split, stratified_split, vault_split, with_folds,
)
from millrace.plans.delivery import ROW, metrics_report, train_boosted, vault_predictions
from millrace.plans.maintenance import labelled_vectors, score_machines
from millrace.plans.scoring_batch import TEST_MACHINES, literal_batch
from millrace.plans.stand_ins import telemetry_extract
from millrace.plans.telemetry import MODEL_INPUTS, telemetry_names, with_temperature_difference
from millrace.plans.warehouse import SMALL_BOOSTED_GRID, SMALL_CLASS_GRID, SMALL_FOREST_GRID
from millrace.queries.registry import query
from millrace.sources.staging import new_location, stage
from millrace.streaming.scoring import score_available


def _sizes(**parts: DataFrame) -> DataFrame:
    counted = [p.agg(F.count("*").alias("rows")).select(F.lit(n).alias("part"), "rows") for n, p in parts.items()]
    return reduce(DataFrame.unionByName, counted)


@query("a14_class_weight", """
SELECT count(*) AS n, sum(machine_failure)::BIGINT AS positives,
  (count(*) - sum(machine_failure)) / sum(machine_failure) AS weight FROM {{recorded}}""")
def weight_of_failures(w):
    return class_weight(telemetry_names(w.telemetry_raw), "machine_failure")


@query("sp1_holdout_split", """
SELECT 'vault' AS part, ceil(0.2 * count(*))::BIGINT AS rows FROM {{joined}}
UNION ALL SELECT 'train', count(*) - ceil(0.2 * count(*))::BIGINT FROM {{joined}}""")
def holdout(w):
    train, vault = holdout_split(w.training, 0.2, 16)
    return _sizes(vault=vault, train=train)


@query("sp2_telemetry_split", """
SELECT 'test' AS part, ceil(0.2 * count(*))::BIGINT AS rows FROM {{readings}}
UNION ALL SELECT 'train', count(*) - ceil(0.2 * count(*))::BIGINT FROM {{readings}}""")
def telemetry_holdout(w):
    train, test = holdout_split(w.telemetry, 0.2, 42, ["udi"])
    return _sizes(test=test, train=train)


_QUOTAS = """(SELECT label, n, floor(share) + CASE WHEN row_number() OVER (ORDER BY share - floor(share) DESC, label)
    <= total - sum(floor(share)) OVER () THEN 1 ELSE 0 END AS quota
  FROM (SELECT label, n, ceil(0.2 * sum(n) OVER ()) AS total, ceil(0.2 * sum(n) OVER ()) * n / sum(n) OVER () AS share
    FROM (SELECT machine_failure AS label, count(*) AS n FROM {{recorded}} GROUP BY ALL)))"""


@query("sp3_stratified_split", f"""
SELECT 'vault' AS part, label AS machine_failure, quota::BIGINT AS rows FROM {_QUOTAS}
UNION ALL SELECT 'history', label, (n - quota)::BIGINT FROM {_QUOTAS}""")
def stratified(w):
    history, vault = stratified_split(w.telemetry, "machine_failure", 0.2, 99, ["udi"])
    both = vault.select(F.lit("vault").alias("part"), "machine_failure").unionByName(
        history.select(F.lit("history").alias("part"), "machine_failure"))
    return both.groupBy("part", "machine_failure").agg(F.count("*").alias("rows"))


@query("sp4_folds", """
SELECT f::INT AS fold, (n // 5 + CASE WHEN f < n % 5 THEN 1 ELSE 0 END)::BIGINT AS rows
FROM (SELECT count(*) AS n FROM {{joined}}) CROSS JOIN range(5) r(f)""")
def folds(w):
    return with_folds(w.training, 5).groupBy("fold").agg(F.count("*").alias("rows"))


@query("sp4_stratified_folds", """
SELECT (position % 5)::INT AS fold, label AS machine_failure, count(*) AS rows FROM (
  SELECT machine_failure AS label, row_number() OVER (ORDER BY machine_failure) - 1 AS position FROM {{recorded}})
GROUP BY ALL""")
def stratified_folds(w):
    rows = with_folds(w.telemetry, 5, 42, ["udi"], label="machine_failure")
    return rows.groupBy("fold", "machine_failure").agg(F.count("*").alias("rows"))


@query("sp5_vault_split", """
SELECT 'vault' AS part, v AS rows FROM (SELECT ceil(0.2 * count(*))::BIGINT AS v FROM {{recorded}})
UNION ALL SELECT 'test', ceil(0.2 * (n - v))::BIGINT FROM (SELECT count(*) AS n, ceil(0.2 * count(*))::BIGINT AS v FROM {{recorded}})
UNION ALL SELECT 'train', (n - v) - ceil(0.2 * (n - v))::BIGINT FROM (
  SELECT count(*) AS n, ceil(0.2 * count(*))::BIGINT AS v FROM {{recorded}})""")
def double_split(w):
    train, test, vault = vault_split(w.telemetry, "machine_failure", key=["udi"])
    return _sizes(vault=vault, test=test, train=train)


_NUMBERS = ["product_price", "days_for_shipment_scheduled", "order_item_total", "order_profit_capped"]


@query("m1_feature_sums", " UNION ALL ".join(
    [f"SELECT '{c}' AS feature, round_even(sum({c}) * 1000, 0) / 1000 AS total FROM {{{{joined}}}}" for c in _NUMBERS]
    + [f"SELECT concat('{c}_', {c}), count(*)::DOUBLE FROM {{{{joined}}}} "
       f"WHERE {c} <> (SELECT min({c}) FROM {{{{joined}}}}) GROUP BY {c}" for c in CATEGORIES]))
def indicator_sums(w):
    encoder = fit_feature_encoder(w.training, CATEGORIES, _NUMBERS)
    sums = feature_sums(encoder.apply(w.training, [], LABEL), encoder.slots)
    return sums.withColumn("total", round_half_even(F.col("total"), 3))


@query("m2_feature_vectors", """
SELECT udi, machine_failure::DOUBLE AS label, air_temperature_k, process_temperature_k,
  process_temperature_k - air_temperature_k AS temp_difference_k,
  rotational_speed_rpm::DOUBLE AS rotational_speed_rpm, torque_nm, tool_wear_min::DOUBLE AS tool_wear_min
FROM (SELECT *, greatest(hdf, pwf, osf) AS machine_failure FROM {{readings}})""")
def vectors(w):
    rows = labelled_vectors(with_temperature_difference(w.readings), "udi")
    values = vector_to_array("features")
    return rows.select("udi", "label", *[values[i].alias(c) for i, c in enumerate(MODEL_INPUTS)])


# What a trained model says has no SQL form. Its queries return what must hold of every model: how many
# rows of which kind it says something about, and how often a rule between its outputs is broken.
_VAULT = "SELECT ceil(0.2 * count(*))::BIGINT FROM {{joined}}"
_MACHINES = "SELECT ceil(0.2 * count(*))::BIGINT FROM {{recorded}}"
_FAILURES = f"SELECT quota::BIGINT FROM {_QUOTAS} WHERE label = 1"
_TESTED = "SELECT ceil(0.2 * (count(*) - ceil(0.2 * count(*))))::BIGINT FROM {{recorded}}"


def _expected(**facts: int | str) -> str:
    return " UNION ALL ".join(f"SELECT '{k}' AS fact, ({v})::BIGINT AS value" for k, v in facts.items())


def _facts(w, **facts: int) -> DataFrame:
    return w.spark.createDataFrame([(k, int(v)) for k, v in facts.items()], "fact string, value long")


def _counted(rows: DataFrame, **conditions) -> dict[str, int]:
    """How many rows there are, and how many meet each condition."""
    return rows.agg(F.count("*").alias("rows"), *[F.count_if(c).alias(k) for k, c in conditions.items()]).first().asDict()


def _far(a, b) -> bool:
    return abs(a - b) > 1e-9 * max(1.0, abs(a), abs(b))


_REGRESSION = {"rows": _VAULT, "unpredicted": 0, "candidates": 2, "wrong_trees": 0, "wrong_metrics": 0}


def _regression_facts(w, search, rows, size: str) -> dict[str, int]:
    """Predictions of all vault rows by a model of the chosen size; metrics as counted by hand."""
    predicted = stage(search.model.transform(rows.vault).select("label", "prediction"), "predicted")
    found, error = regression_metrics(predicted).first(), F.col("label") - F.col("prediction")
    by_hand = predicted.agg(F.sum(error * error).alias("s"), F.sum(F.abs(error)).alias("a"), F.count("*").alias("n"),
                            F.var_pop("label").alias("v")).first()
    wanted = {"mae": by_hand.a / by_hand.n, "rmse": math.sqrt(by_hand.s / by_hand.n), "r2": 1 - by_hand.s / (by_hand.v * by_hand.n)}
    return {**_counted(predicted, unpredicted=F.col("prediction").isNull() | F.isnan("prediction")),
            "candidates": len([score for _, score in search.scores if score <= 0]),
            "wrong_trees": search.model.getNumTrees != search.best_params[size],
            "wrong_metrics": sum(_far(found[k], v) for k, v in wanted.items())}


@query("m3_boosted_regression", _expected(**_REGRESSION))
def boosted_quality(w):
    return _facts(w, **_regression_facts(w, w.boosted, w.prepared, "maxIter"))


@query("m3_boosted_regression_indexed", _expected(**_REGRESSION))
def boosted_on_indexed(w):
    search = train_boosted(w.indexed, SMALL_BOOSTED_GRID, folds=2)
    return _facts(w, **_regression_facts(w, search, w.indexed, "maxIter"))


@query("m4_forest_regression", _expected(**_REGRESSION, beyond_labels=0))
def forest_quality(w):
    low, high = w.prepared.train.agg(F.min("label"), F.max("label")).first()
    beyond = w.forest.model.transform(w.prepared.vault).where(~F.col("prediction").between(low - 1e-9, high + 1e-9)).count()
    return _facts(w, **_regression_facts(w, w.forest, w.prepared, "numTrees"), beyond_labels=beyond)


def _wrong_ratios(row) -> int:
    def ratio(a, b):
        return a / b if b else None

    precision, recall = ratio(row.true_p, row.true_p + row.false_p), ratio(row.true_p, row.true_p + row.false_n)
    f1 = ratio(2 * row.true_p, 2 * row.true_p + row.false_p + row.false_n) if precision and recall else None
    pairs = ((row.precision, precision), (row.recall, recall), (row.f1, f1))
    return sum((a or 0) != (b or 0) and _far(a or 0, b or 0) for a, b in pairs)


@query("m5_boosted_classifier", _expected(rows=_MACHINES, failures=_FAILURES, wrong_ratios=0))
def classifier_counts(w):
    row = w.vault.counts.first()
    return _facts(w, rows=row.true_p + row.true_n + row.false_p + row.false_n, failures=row.true_p + row.false_n,
                  wrong_ratios=_wrong_ratios(row))


def _searched(grid) -> str:
    """One row for each candidate of a grid."""
    texts = [str(p).replace("'", "''") for p in candidates(grid)]
    return " UNION ALL ".join(f"SELECT '{text}' AS params, true AS scored" for text in texts)


@query("m6_regression_search", f"{_searched(SMALL_BOOSTED_GRID)} UNION ALL {_searched(SMALL_FOREST_GRID)}")
def regression_search(w):
    tables = w.boosted.table(w.training).unionByName(w.forest.table(w.training))
    return tables.select("params", (F.col("score") <= 0).alias("scored"))


@query("m7_classifier_search", _searched(SMALL_CLASS_GRID))
def classifier_search(w):
    return w.vault.classifier.search.table(w.telemetry).select("params", F.col("score").between(0, 1).alias("scored"))


@query("m8_vault_predictions", _expected(rows=_VAULT, without_boosted=0, without_forest=0, other_rows=0))
def predicted_values(w):
    rows = stage(vault_predictions(w.prepared, w.boosted, w.forest), "both")
    other = rows.join(w.prepared.vault.select(ROW, "label"), [ROW, "label"], "left_anti").count()
    return _facts(w, **_counted(rows, without_boosted=F.col("boosted").isNull(), without_forest=F.col("forest").isNull()),
                  other_rows=other)


@query("m9_failure_probabilities", _expected(rows=_TESTED, machines=_TESTED, no_probability=0, wrong_sums=0, wrong_flags=0))
def probabilities(w):
    both = vector_to_array("probability")
    rows = w.vault.classifier.test.select("udi", "prediction", both[0].alias("sound"), both[1].alias("failure"))
    found = _counted(rows, no_probability=~F.col("failure").between(0, 1),
                     wrong_sums=F.abs(F.col("sound") + F.col("failure") - 1) > 1e-9,
                     wrong_flags=(F.col("prediction") == 1) != (F.col("failure") > 0.5))
    return _facts(w, **found, machines=rows.select("udi").distinct().count())


@query("m10_importances", " UNION ALL ".join(f"SELECT '{c}' AS feature, false AS negative, 1.0::DOUBLE AS total" for c in MODEL_INPUTS))
def feature_importances(w):
    rows = importances(w.vault.classifier.search.model, slot_table(w.spark, MODEL_INPUTS))
    total = rows.agg(F.sum("importance")).first()[0]
    return rows.select("feature", (F.col("importance") < 0).alias("negative"), round_half_even(F.lit(total), 6).alias("total"))


@query("l2_top_importances", _expected(rows=10, unknown=0, out_of_order=0, more_important_left_out=0))
def most_important(w):
    rows = importances(w.boosted.model, w.prepared.encoder.slots)
    top = top_importances(rows, 10).collect()
    least, names = top[-1].importance, [r.feature for r in top]
    left_out = rows.where((F.col("importance") > least) & ~F.col("feature").isin(names)).count()
    return _facts(w, rows=len(top), unknown=len(top) - rows.where(F.col("feature").isin(names)).count(),
                  out_of_order=sum(a.importance < b.importance for a, b in zip(top, top[1:])), more_important_left_out=left_out)


@query("f17_failure_percent", _expected(rows=_MACHINES, machines=_MACHINES, no_percent=0, more_than_three_digits=0, wrong_status=0))
def percentages(w):
    value = F.col("failure_probability")
    found = _counted(w.vault.results, no_percent=~value.between(0, 100), more_than_three_digits=F.abs(value - F.round(value, 3)) > 1e-9,
                     wrong_status=((F.col("status") == FAILURE) & (value < 50)) | ((F.col("status") == NORMAL) & (value > 50)))
    return _facts(w, **found, machines=w.vault.results.select("udi").distinct().count())


@query("f17_percent_of_load", """
SELECT udi, failure_probability FROM {{scored}}""")
def load_percent(w):
    load = F.least(F.lit(1.0), F.col("tool_wear_min") * F.col("torque_nm") / 13000)
    return w.readings.select("udi", percent(load).alias("failure_probability"))


@query("m11_batch_scoring", _expected(rows=len(TEST_MACHINES), vault_rows=_MACHINES, wrongly_flagged=0, wrongly_left=0))
def batch_scoring(w):
    batch = stage(score_machines(w.vault.classifier.search.model, literal_batch(w.spark)), "batch")
    both = batch.unionByName(w.vault.results.drop("udi"))
    due = (F.col("status") == FAILURE) | (F.col("failure_probability") > 40)
    flagged = flagged_machines(both)
    return _facts(w, rows=batch.count(), vault_rows=w.vault.results.count(), wrongly_flagged=flagged.where(~due).count(),
                  wrongly_left=both.where(due).count() - flagged.count())


@query("m12_vault_validation", _expected(
    rows=_MACHINES, rows_revised=_MACHINES, failures=_FAILURES, failures_revised=_FAILURES, fewer_found=0, wrong_ratios=0))
def vault_validation(w):
    model, revised = w.vault.counts.first(), w.vault.revised_counts.first()
    total = lambda r: r.true_p + r.true_n + r.false_p + r.false_n
    return _facts(w, rows=total(model), rows_revised=total(revised), failures=model.true_p + model.false_n,
                  failures_revised=revised.true_p + revised.false_n, fewer_found=revised.true_p < model.true_p,
                  wrong_ratios=_wrong_ratios(model) + _wrong_ratios(revised))


@query("l5_trained_champion", _expected(rows=1, wrong_winner=0))
def trained_champion(w):
    reports = stage(metrics_report(vault_predictions(w.prepared, w.boosted, w.forest), w.boosted, w.forest), "reports")
    by = {r.model: r for r in reports.collect()}
    tests = [("rmse", 0.01), ("mae", 0.01), ("training_seconds", 0)]
    apart = [k for k, tolerance in tests if abs(by[FOREST][k] - by[BOOSTED][k]) > tolerance]
    winner = min((BOOSTED, FOREST), key=lambda m: by[m][apart[0]]) if apart else BOOSTED
    found = choose_champion(reports).collect()
    return _facts(w, rows=len(found), wrong_winner=found[0].winner != winner)


@query("s8_model_sink", _expected(rows=_VAULT, other_predictions=0, wrong_trees=0))
def reloaded_model(w):
    path = new_location(w.spark, "boosted-model")
    save_model(w.boosted.model, path)
    model = load_model(path)
    both = predicted(model, predicted(w.boosted.model, w.prepared.vault, "kept"), "again")
    return _facts(w, **_counted(both, other_predictions=~F.col("kept").eqNullSafe(F.col("again"))),
                  wrong_trees=model.getNumTrees != w.boosted.model.getNumTrees)


@query("s9_metrics_report", " UNION ALL ".join(
    f"SELECT '{model}' AS model, {len(grid)}::INT AS params, false AS impossible"
    for model, grid in ((BOOSTED, SMALL_BOOSTED_GRID), (FOREST, SMALL_FOREST_GRID))))
def report(w):
    rows = metrics_report(vault_predictions(w.prepared, w.boosted, w.forest), w.boosted, w.forest)
    impossible = ((F.col("mae") < 0) | (F.col("rmse") < F.col("mae") - 1e-9) | (F.col("r2") > 1) | (F.col("training_seconds") < 0))
    return rows.select("model", F.size("best_params").alias("params"), impossible.alias("impossible"))


@query("st1_streamed_scores", _expected(rows="SELECT count(*) FROM {{recorded}}", not_in_batch=0, not_in_stream=0))
def streamed_scores(w):
    """All readings scored as a stream, against the same readings scored as a table."""
    cleaner, model = w.vault.cleaner, w.vault.classifier.search.model
    score = lambda rows: score_machines(model, cleaner.apply(telemetry_extract(rows)), "udi")
    streamed = score_available(w.spark, f"{w.folder}/events.parquet*", w.table("events").schema, score)
    batch = stage(score(w.table("events")), "batch")
    return _facts(w, rows=streamed.count(), not_in_batch=streamed.exceptAll(batch).count(),
                  not_in_stream=batch.exceptAll(streamed).count())
