"""From predictions to a maintenance report."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.machine import FAILURE, NORMAL, status_label, status_mark
from millrace.functions.numeric import percent
from millrace.operators.joins import lookup_join

REVIEW_PERCENT = 40

# Layout of the report, before the marker and status columns.
RESULT_COLUMNS = ["machine_id", "rotational_speed_rpm", "torque_nm", "tool_wear_min",
                  "failure_probability"]


def with_predictions(predicted: DataFrame) -> DataFrame:
    """Flag and percentage out of a classifier's output columns."""
    failure = vector_to_array("probability").getItem(1)
    return predicted.withColumns({
        "predicted_failure_flag": F.col("prediction").cast("int"),
        "failure_probability": percent(failure),
    })


def result_report(scored: DataFrame, *carried: str) -> DataFrame:
    """Report rows with a marker at position 5 and the status at position 6."""
    flag = F.col("predicted_failure_flag")
    return scored.select(
        *RESULT_COLUMNS, status_mark(flag).alias("test"), status_label(flag).alias("status"), *carried)


def is_near_miss(threshold: float = REVIEW_PERCENT) -> Column:
    """Normal by the model, yet more probable to fail than the review threshold."""
    return (F.col("status") == NORMAL) & (F.col("failure_probability") > threshold)


def flagged_machines(results: DataFrame, threshold: float = REVIEW_PERCENT) -> DataFrame:
    """Failures by status or by probability."""
    return results.filter((F.col("status") == FAILURE) | (F.col("failure_probability") > threshold))


def near_misses(results: DataFrame, threshold: float = REVIEW_PERCENT) -> DataFrame:
    return results.filter(is_near_miss(threshold))


def actual_or_flagged(validated: DataFrame) -> DataFrame:
    """Recorded failures and predicted ones."""
    return validated.filter((F.col("machine_failure") == 1) | (F.col("status") == FAILURE))


def relabel_near_misses(results: DataFrame, threshold: float = REVIEW_PERCENT) -> DataFrame:
    """Near misses become failures."""
    return results.withColumn(
        "status", F.when(is_near_miss(threshold), FAILURE).otherwise(F.col("status")))


def validation_rows(
    results: DataFrame, truth: DataFrame, key: str = "machine_id", outcome: str = "machine_failure"
) -> DataFrame:
    """Results next to the recorded outcome, paired by key instead of row position."""
    paired = lookup_join(results.drop(outcome), truth.select(key, outcome), key)
    return paired.select(key, outcome, "status", "failure_probability")
