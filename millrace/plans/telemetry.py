"""Machine telemetry: names, imputation, outlier flags, thermal stress."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from millrace.functions.machine import temperature_difference
from millrace.functions.text import bracketed_name
from millrace.operators.cleaning import (
    Imputation, OutlierFences, fit_imputation, fit_outlier_fences,
)
from millrace.operators.columns import insert_column, missing_as_null, rename_all

# The measured columns and the model's inputs.
MEASURES = ["air_temperature_k", "process_temperature_k", "rotational_speed_rpm", "torque_nm",
            "tool_wear_min"]
MODEL_INPUTS = ["air_temperature_k", "process_temperature_k", "temp_difference_k",
                "rotational_speed_rpm", "torque_nm", "tool_wear_min"]
FAILURE_MODES = ["twf", "hdf", "pwf", "osf", "rnf"]
KEY_NAMES = {"product_id": "machine_id", "type": "machine_type"}


def telemetry_names(raw: DataFrame) -> DataFrame:
    return rename_all(raw, bracketed_name).withColumnsRenamed(KEY_NAMES)


def with_temperature_difference(rows: DataFrame, position: int = 5) -> DataFrame:
    stress = temperature_difference(F.col("process_temperature_k"), F.col("air_temperature_k"))
    return insert_column(rows, position, "temp_difference_k", stress)


@dataclass(frozen=True)
class TelemetryCleaner:
    """Fills and fences learned from one set of readings, to apply to any other."""

    imputation: Imputation
    fences: OutlierFences

    def apply(self, raw: DataFrame) -> DataFrame:
        rows = self.fences.apply(self.imputation.apply(missing_as_null(telemetry_names(raw))))
        return with_temperature_difference(rows)


def fit_telemetry_cleaner(
    raw: DataFrame, strategy: str = "mean", upper: str = "code"
) -> TelemetryCleaner:
    rows = missing_as_null(telemetry_names(raw))
    imputation = fit_imputation(rows, MEASURES, strategy)
    return TelemetryCleaner(imputation, fit_outlier_fences(imputation.apply(rows), MEASURES, upper))


def clean_telemetry(raw: DataFrame, strategy: str = "mean", upper: str = "code") -> DataFrame:
    """Fit on the readings themselves and apply."""
    return fit_telemetry_cleaner(raw, strategy, upper).apply(raw)
