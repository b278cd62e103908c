"""From raw readings to a validated failure classifier."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Model, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from millrace.operators.metrics import class_weight, validation_counts
from millrace.operators.missing import filling, gap_counts, without_nan
from millrace.operators.models import (
    BOOSTED_CLASS_GRID, FOLDS, Search, boosted_classifier, failure_f1, grid_search,
    with_class_weight,
)
from millrace.operators.scoring import (
    relabel_near_misses, result_report, validation_rows, with_predictions,
)
from millrace.operators.splits import holdout_split, stratified_split
from millrace.plans.telemetry import MODEL_INPUTS, TelemetryCleaner, fit_telemetry_cleaner
from millrace.sources.staging import stage, stage_all

OUTCOME = "machine_failure"
TEST_SEED, VAULT_SEED = 42, 99


def as_vectors(rows: DataFrame, *keep: str) -> DataFrame:
    """The model's inputs as a vector, beside the columns to keep; a missing input is NaN."""
    return VectorAssembler(inputCols=MODEL_INPUTS, outputCol="features", handleInvalid="keep").transform(rows).select(
        *keep, "features")


def labelled(rows: DataFrame) -> DataFrame:
    return rows.withColumn("label", F.col(OUTCOME).cast("double"))


def labelled_vectors(rows: DataFrame, *keep: str) -> DataFrame:
    return as_vectors(labelled(rows), *keep, "label")


def model_rows(rows: DataFrame, gaps: Sequence[str], *keep: str) -> DataFrame:
    """What a classifier trains on: vectors, or the inputs as columns where some have gaps."""
    if not gaps:
        return as_vectors(rows, *keep)
    return without_nan(rows, MODEL_INPUTS).select(*keep, *MODEL_INPUTS)


@dataclass(frozen=True)
class TrainedClassifier:
    search: Search
    test: DataFrame  # predictions on the held-out rows
    weight: float


def train_classifier(
    cleaned: DataFrame, key: str = "udi", grid: Mapping = BOOSTED_CLASS_GRID, folds: int = FOLDS,
    parallelism: int = 4,
) -> TrainedClassifier:
    """Hold out a fifth, weigh failures by their rarity, search by F1 of the failures.

    Where inputs have gaps, all are filled, and marked, by what each fit learns from its own rows.
    """
    gaps = gap_counts(cleaned, MODEL_INPUTS)
    rows = stage(model_rows(labelled(cleaned), list(gaps), key, "label"), "labelled")
    train, test = holdout_split(rows, 0.2, TEST_SEED, [key])
    weight = class_weight(train, "label").first().weight
    if not weight:
        raise ValueError("the training rows hold no failure, or nothing else")
    build = filling(boosted_classifier, MODEL_INPUTS if gaps else [], known=False)
    search = grid_search(with_class_weight(train, weight), build, grid, failure_f1, folds,
                         key=[key], stratify=True, parallelism=parallelism)
    return TrainedClassifier(search, search.model.transform(test), weight)


def score_machines(model: Model, rows: DataFrame, *carried: str) -> DataFrame:
    """Report rows for machines with the model's inputs; the machine id is no input."""
    if isinstance(model, PipelineModel):
        scored = model.transform(without_nan(rows, MODEL_INPUTS))
    else:
        scored = model.transform(VectorAssembler(
            inputCols=MODEL_INPUTS, outputCol="features", handleInvalid="keep").transform(rows))
    return result_report(with_predictions(scored), *carried)


@dataclass(frozen=True)
class VaultReport:
    history: DataFrame
    vault: DataFrame
    classifier: TrainedClassifier
    cleaner: TelemetryCleaner
    results: DataFrame
    counts: DataFrame
    revised_counts: DataFrame


def vault_job(
    raw: DataFrame, outcome: str = "Machine failure", key: str = "UDI", grid: Mapping = BOOSTED_CLASS_GRID,
    folds: int = FOLDS, fit_apart: bool = False,
) -> VaultReport:
    """Set a stratified vault aside, train on the history, validate on the vault.

    Fills and fences are learnt from the history; ``fit_apart`` learns the vault's own.
    """
    history, vault = stratified_split(raw, outcome, 0.2, VAULT_SEED, [key])
    parts = stage_all({"history": history, "vault": vault})
    history, vault = parts["history"], parts["vault"]
    cleaner = fit_telemetry_cleaner(history)
    classifier = train_classifier(stage(cleaner.apply(history), "clean_history"), grid=grid, folds=folds)
    vault_cleaner = fit_telemetry_cleaner(vault) if fit_apart else cleaner
    clean_vault = vault_cleaner.apply(vault)
    results = stage(score_machines(classifier.search.model, clean_vault, "udi"), "vault_results")
    validated = validation_rows(results, clean_vault, "udi", OUTCOME)
    return VaultReport(history, vault, classifier, cleaner, results, validation_counts(validated),
                       validation_counts(relabel_near_misses(validated)))
