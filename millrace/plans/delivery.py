"""From the training view to the better of two delivery-variance models."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, functions as F

from millrace.operators.features import (
    CATEGORIES, LABEL, FeatureEncoder, fit_feature_encoder, fit_index_encoder,
)
from millrace.operators.metrics import (
    BOOSTED, FOREST, choose_champion, metrics_table, model_metrics, paired_t_test,
)
from millrace.operators.missing import filling, predicted
from millrace.operators.models import (
    BOOSTED_REGRESSION_GRID, FOLDS, FOREST_GRID, Search, boosted_regressor, fits_at_once, forest_regressor,
    grid_search, importances, negative_mae, top_importances,
)
from millrace.operators.splits import holdout_split
from millrace.sources.staging import stage, stage_all

ROW = "row_id"


@dataclass(frozen=True)
class PreparedRows:
    """Encoded rows at rest, split into training and vault rows."""

    train: DataFrame
    vault: DataFrame
    encoder: FeatureEncoder


def prepare_rows(
    view: DataFrame, share: float = 0.2, seed: int = 16, encoding: str = "indicators"
) -> PreparedRows:
    """Encode a training view and hold out an exact share.

    ``encoding`` is "indicators" (one 0/1 feature per category value) or "indexed" (one
    nominal feature per column, or per digit of its code past 10,000 values: far smaller rows,
    for large tables). Categories are learnt
    from all rows, before the split. A row's id is a hash of its values and nulls, so split and
    folds are the same however the view is stored; only complete copies share an id.
    """
    numbers = [c for c in view.columns if c not in CATEGORIES and c != LABEL]
    fit = {"indicators": fit_feature_encoder, "indexed": fit_index_encoder}[encoding]
    encoder = fit(view, CATEGORIES, numbers)
    values = [v for c in view.columns for v in (F.col(c), F.col(c).isNull())]
    numbered = view.withColumn(ROW, F.xxhash64(*values))
    encoded = stage(encoder.apply(numbered, [ROW], LABEL), "encoded_rows")
    train, vault = holdout_split(encoded, share, seed, [ROW])
    parts = stage_all({"train_rows": train, "vault_rows": vault})
    return PreparedRows(parts["train_rows"], parts["vault_rows"], encoder)


def _with_bins(build, rows: PreparedRows):
    """An estimator with bins enough for the widest nominal feature, behind the fill of numbers with gaps."""
    return filling(partial(build, maxBins=max(32, rows.encoder.bins)), rows.encoder.gaps)


def _search(rows: PreparedRows, build, grid: Mapping, folds: int, parallelism: int) -> Search:
    """Fits run side by side only as far as what they keep stays bounded; larger ones have the cluster to themselves."""
    fitted = rows.train.count() * (folds - 1) // folds
    return grid_search(rows.train, _with_bins(build, rows), grid, negative_mae, folds, key=[ROW],
                       parallelism=fits_at_once(fitted, rows.encoder.width, parallelism))


@dataclass(frozen=True)
class Comparison:
    metrics: DataFrame
    t_test: DataFrame
    champion: DataFrame
    importances: DataFrame


def train_boosted(
    rows: PreparedRows, grid: Mapping = BOOSTED_REGRESSION_GRID, folds: int = FOLDS, parallelism: int = 4
) -> Search:
    return _search(rows, boosted_regressor, grid, folds, parallelism)


def train_forest(
    rows: PreparedRows, grid: Mapping = FOREST_GRID, folds: int = FOLDS, parallelism: int = 4
) -> Search:
    return _search(rows, forest_regressor, grid, folds, parallelism)


def vault_predictions(rows: PreparedRows, boosted: Search, forest: Search) -> DataFrame:
    """Both predictions on the same row: one model after the other, no join."""
    both = predicted(forest.model, predicted(boosted.model, rows.vault, "boosted"), "forest")
    return both.select(ROW, "label", "boosted", "forest")


def metrics_report(predictions: DataFrame, boosted: Search, forest: Search) -> DataFrame:
    return metrics_table([
        model_metrics(predictions.withColumnRenamed(column, "prediction"), name,
                      {k: str(v) for k, v in found.best_params.items()}, found.seconds)
        for column, name, found in (("boosted", BOOSTED, boosted), ("forest", FOREST, forest))])


def compare_models(rows: PreparedRows, boosted: Search, forest: Search) -> Comparison:
    """Metrics of both, the paired test on their errors, the winner and its top features."""
    predictions = stage(vault_predictions(rows, boosted, forest), "vault_predictions")
    metrics = stage(metrics_report(predictions, boosted, forest), "metrics")
    champion = choose_champion(metrics)
    best = forest if champion.first().winner == FOREST else boosted
    return Comparison(
        metrics, paired_t_test(predictions, "label", "forest", "boosted"), champion,
        top_importances(importances(best.model, rows.encoder.slots)))
