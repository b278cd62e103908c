"""The two jobs end to end: delimited files in, tables, reports and models out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace.operators.columns import accepted, reject_counts, rejected
from millrace.operators.features import slot_table
from millrace.operators.lineage import Lineage
from millrace.operators.metrics import classification_report, confusion_matrix, threshold_table
from millrace.operators.models import (
    BOOSTED_CLASS_GRID, BOOSTED_REGRESSION_GRID, FOLDS, FOREST_GRID, importances, save_model,
    top_importances,
)
from millrace.operators.profile import describe, null_profile, schema_report
from millrace.operators.reports import dispatch_queue, state_rollup, variance_extremes
from millrace.operators.scoring import flagged_machines, validation_rows
from millrace.plans.delivery import compare_models, prepare_rows, train_boosted, train_forest
from millrace.plans.maintenance import OUTCOME, score_machines, train_classifier, vault_job
from millrace.plans.star import (
    NEEDED, Star, build_star, cleaned_rows, country_rows, extract_types, key_report, reporting_view, temporal_view,
    training_view,
)
from millrace.plans.telemetry import MODEL_INPUTS, clean_telemetry
from millrace.sources.delimited import LATIN_1, read_checked, read_delimited_text, write_delimited
from millrace.sources.staging import stage, stage_all

# Headers of a telemetry file and the types behind them.
TELEMETRY_TYPES = {
    "UDI": "bigint", "Product ID": "string", "Type": "string", "Air temperature [K]": "double",
    "Process temperature [K]": "double", "Rotational speed [rpm]": "int", "Torque [Nm]": "double",
    "Tool wear [min]": "int", "Machine failure": "int", "TWF": "int", "HDF": "int", "PWF": "int",
    "OSF": "int", "RNF": "int",
}
_TYPES = {"bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType()}
VIEWS = {"training": training_view, "temporal": temporal_view}


def _stored(checked: DataFrame, label: str, output: str) -> DataFrame:
    """The accepted rows of a checked scan, stored; what was turned away is written beside the results."""
    stored = stage(checked, label)
    rejected(stored).write.mode("overwrite").json(f"{output}/rejects")
    reject_counts(stored).write.mode("overwrite").json(f"{output}/reject_counts")
    return accepted(stored)


def load_orders(
    spark: SparkSession, path: str, output: str, country: str | None = None, encoding: str = LATIN_1,
) -> Star:
    """Clean an order extract, check its fields and keys, write its star schema as delimited files.

    Row counts come from the jobs that write the tables. Mostly empty columns are told from the nulls counted while
    the cleaned rows are written.
    """
    lineage = Lineage()
    kinds = extract_types(read_delimited_text(spark, path, encoding).columns)
    schema = T.StructType([T.StructField(c, _TYPES[kind]) for c, kind in kinds.items()])
    rows = _stored(lineage.watch("extract", read_checked(spark, path, schema, encoding)), "extract", output)
    if country is not None:
        rows = lineage.watch("country", country_rows(rows, country))
    cleaned = stage(lineage.watch("cleaned", cleaned_rows(rows), nulls=True), "cleaned_orders")
    star = build_star(cleaned.drop(*lineage.mostly_null("cleaned", required=NEEDED)))
    for name, table in star.tables().items():
        write_delimited(lineage.watch(name, table), f"{output}/{name}", mode="overwrite")
    key_report(star).write.mode("overwrite").json(f"{output}/key_checks")
    lineage.table(spark).write.mode("overwrite").json(f"{output}/row_counts")
    return star


def report_orders(star: Star, output: str) -> None:
    """State rollup and extremes of the reporting view."""
    view = stage(reporting_view(star), "reporting_view")
    write_delimited(state_rollup(view), f"{output}/state_rollup", mode="overwrite")
    write_delimited(variance_extremes(view), f"{output}/variance_extremes", mode="overwrite")


def train_orders(
    star: Star, output: str, view: str = "training", encoding: str = "indicators",
    boosted_grid: Mapping = BOOSTED_REGRESSION_GRID, forest_grid: Mapping = FOREST_GRID, folds: int = FOLDS,
) -> DataFrame:
    """Tune both regressors, compare them, keep models and reports; returns the champion."""
    rows = prepare_rows(stage(VIEWS[view](star), "training_view"), encoding=encoding)
    boosted = train_boosted(rows, boosted_grid, folds)
    forest = train_forest(rows, forest_grid, folds)
    save_model(boosted.model, f"{output}/boosted_model")
    save_model(forest.model, f"{output}/forest_model")
    comparison = compare_models(rows, boosted, forest)
    for name in ("metrics", "t_test", "champion", "importances"):
        getattr(comparison, name).write.mode("overwrite").json(f"{output}/{name}")
    return comparison.champion


def read_telemetry(spark: SparkSession, path: str, output: str, encoding: str = "UTF-8") -> DataFrame:
    """Raw readings with types by header, stored; rejected fields and lines are written to ``output``."""
    header = read_delimited_text(spark, path, encoding).columns
    schema = T.StructType([T.StructField(c, _TYPES[TELEMETRY_TYPES.get(c, "string")]) for c in header])
    return _stored(read_checked(spark, path, schema, encoding), "readings", output).select(
        *[F.col(f"`{c}`") for c in TELEMETRY_TYPES])


def clean_machines(raw: DataFrame, output: str) -> DataFrame:
    """Impute, flag and write the readings; returns them as stored."""
    cleaned = stage(clean_telemetry(raw), "telemetry")
    write_delimited(cleaned, f"{output}/telemetry", mode="overwrite")
    return cleaned


def train_machines(
    cleaned: DataFrame, output: str, grid: Mapping = BOOSTED_CLASS_GRID, folds: int = FOLDS
) -> DataFrame:
    """Tune the classifier on cleaned readings; returns its most important inputs.

    The report and the confusion matrix are those of its predictions on the rows held out.
    """
    trained = train_classifier(cleaned, grid=grid, folds=folds)
    save_model(trained.search.model, f"{output}/failure_model")
    tested = stage(trained.test.select("label", "prediction"), "tested")
    classification_report(tested, "label", "prediction").write.mode("overwrite").json(f"{output}/classification_report")
    confusion_matrix(tested, "label", "prediction").write.mode("overwrite").json(f"{output}/confusion_matrix")
    return top_importances(importances(trained.search.model, slot_table(cleaned.sparkSession, MODEL_INPUTS)), 3)


def score_file(model, rows: DataFrame, output: str) -> DataFrame:
    """Score machines, write the report and return those to look at, most urgent first."""
    results = stage(score_machines(model, rows), "results")
    write_delimited(results, f"{output}/results", mode="overwrite")
    return dispatch_queue(flagged_machines(results))


def validate_machines(
    raw: DataFrame, output: str, grid: Mapping = BOOSTED_CLASS_GRID, folds: int = FOLDS,
    thresholds: tuple[float, ...] = (20.0, 30.0, 40.0, 50.0),
) -> DataFrame:
    """Hold a vault back, train on the rest, write both parts and the vault's results; returns its counts
    by status, after relabelling near misses, and for a range of thresholds."""
    report = vault_job(raw, grid=grid, folds=folds)
    truth = raw.select(F.col("UDI").alias("udi"), F.col("`Machine failure`").alias(OUTCOME))
    validated = stage(validation_rows(report.results, truth, "udi"), "validated")
    parts = stage_all({"counts": report.counts.withColumn("labels", F.lit("model")),
                       "revised": report.revised_counts.withColumn("labels", F.lit("revised"))})
    for name in ("history", "vault"):
        write_delimited(getattr(report, name), f"{output}/{name}", mode="overwrite")
    write_delimited(report.results, f"{output}/vault_results", mode="overwrite")
    threshold_table(validated, thresholds).write.mode("overwrite").json(f"{output}/thresholds")
    return parts["counts"].unionByName(parts["revised"])


def profile_table(rows: DataFrame, output: str) -> None:
    """Types, nulls and summaries of all columns, as JSON."""
    for name, report in (("schema", schema_report(rows)), ("nulls", null_profile(rows)), ("summary", describe(rows))):
        report.write.mode("overwrite").json(f"{output}/{name}")
