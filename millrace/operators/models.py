"""Tree models: grids, exhaustive search over folds, predictions, importances."""

from __future__ import annotations

import itertools
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from millrace.operators.metrics import confusion_counts, with_ratios
from millrace.operators.missing import trees_of, with_features
from millrace.operators.prefixes import failure_f1_by_size, negative_mae_by_size
from millrace.operators.splits import with_folds
from millrace.sources.staging import spread, stage

# The searched grids, seeds and number of folds. Spark's trees stop at depth
# 30, which stands for "unlimited"; a minimum of 2 or 5 rows to split a node becomes a
# minimum of 1 or 2 rows per child; column sampling is per node.
BOOSTED_REGRESSION_GRID = {
    "maxIter": [100, 200], "maxDepth": [5, 7, 9], "stepSize": [0.05, 0.1],
    "subsamplingRate": [0.8], "featureSubsetStrategy": ["0.7", "all"],
}
FOREST_GRID = {
    "numTrees": [100, 200], "maxDepth": [10, 15, 30], "minInstancesPerNode": [1, 2],
    "featureSubsetStrategy": ["0.33", "all"],
}
BOOSTED_CLASS_GRID = {
    "maxDepth": [3, 5, 7], "stepSize": [0.01, 0.1, 0.2], "maxIter": [100, 200],
    "subsamplingRate": [0.8, 1.0],
}
FOLDS = 5
BOOSTED_SEED, FOREST_SEED = 42, 16
#: Bytes of rows that fits running side by side may keep. A tree fit keeps one integer for every feature of a
#: row, however sparse its vector is, and some 100 bytes beside them.
FIT_BYTES = 4 << 30
ROW_BYTES = 100

Params = dict[str, object]


def boosted_regressor(seed: int = BOOSTED_SEED, **params) -> GBTRegressor:
    """Boosted trees with squared loss."""
    return GBTRegressor(featuresCol="features", labelCol="label", lossType="squared", seed=seed, **params)


def forest_regressor(seed: int = FOREST_SEED, **params) -> RandomForestRegressor:
    return RandomForestRegressor(featuresCol="features", labelCol="label", seed=seed, **params)


def boosted_classifier(seed: int = BOOSTED_SEED, **params) -> GBTClassifier:
    """Boosted trees for two classes; rows weigh what their ``weight`` column says."""
    return GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", seed=seed, **params)


def with_class_weight(rows: DataFrame, weight: float, label: str = "label") -> DataFrame:
    """``weight`` for positive rows, 1 for the others."""
    return rows.withColumn("weight", F.when(F.col(label) == 1, F.lit(float(weight))).otherwise(F.lit(1.0)))


def candidates(grid: Mapping[str, Sequence[object]]) -> list[Params]:
    """Every combination of the grid's values."""
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def fits_at_once(rows: int, width: int, most: int = 4) -> int:
    """How many fits of so many rows and features may run side by side: one at least, whatever their size."""
    return max(1, min(most, FIT_BYTES // max(1, rows * (4 * width + ROW_BYTES))))


def negative_mae(predicted: DataFrame) -> float:
    return -predicted.agg(F.avg(F.abs(F.col("label") - F.col("prediction")))).first()[0]


def failure_f1(predicted: DataFrame) -> float:
    """F1 of class 1; 0 where it is undefined."""
    counts = confusion_counts(predicted, F.col("label") == 1, F.col("prediction") == 1)
    return with_ratios(counts).first().f1 or 0.0


@dataclass(frozen=True)
class Search:
    """A refitted best model with the scores of all candidates."""

    model: Model
    best_params: Params
    scores: list[tuple[Params, float]]
    seconds: float

    def table(self, rows: DataFrame) -> DataFrame:
        """One row per candidate, best score first."""
        ranked = sorted(((str(dict(p)), s) for p, s in self.scores), key=lambda x: -x[1])
        return rows.sparkSession.createDataFrame(ranked, "params string, score double")


def _negative_mae_by_round(model: GBTRegressionModel, rows: DataFrame, sizes: Sequence[int]) -> list[float]:
    by_round = model.evaluateEachIteration(rows, "absolute")
    return [-by_round[n - 1] for n in sizes]


def _last_stage(estimator: Estimator) -> Estimator:
    return estimator.getStages()[-1] if isinstance(estimator, Pipeline) else estimator


def _shared_size(build: Callable[..., Estimator], score: Callable[[DataFrame], float]):
    """(parameter, score by size) where the largest of several ensembles holds the smaller ones."""
    return {
        (GBTRegressor, negative_mae): ("maxIter", _negative_mae_by_round),
        (RandomForestRegressor, negative_mae): ("numTrees", negative_mae_by_size),
        (GBTClassifier, failure_f1): ("maxIter", failure_f1_by_size),
    }.get((type(_last_stage(build())), score), (None, None))


def _scores_of_fold(
    build: Callable[..., Estimator], group: list[Params], score: Callable[[DataFrame], float],
    train: DataFrame, held_out: DataFrame,
) -> list[float]:
    """Scores of candidates that differ at most in the number of trees or rounds: one fit of the largest."""
    if len(group) == 1:
        return [score(build(**group[0]).fit(train).transform(held_out))]
    size, by_size = _shared_size(build, score)
    sizes = sorted({p[size] for p in group})
    model = build(**max(group, key=lambda p: p[size])).fit(train)
    found = dict(zip(sizes, by_size(trees_of(model), with_features(model, held_out), sizes)))
    return [found[p[size]] for p in group]


def grid_search(
    rows: DataFrame, build: Callable[..., Estimator], grid: Mapping[str, Sequence[object]],
    score: Callable[[DataFrame], float], folds: int = FOLDS, seed: int = FOREST_SEED,
    key: Sequence[str] | None = None, stratify: bool = False, parallelism: int = 4,
) -> Search:
    """Score every candidate on every fold, then refit the best one on all rows.

    The rows with their fold numbers are written once and cached; fits run concurrently,
    each of them distributed. Candidates that differ in the number of trees or rounds alone share
    a fit (see ``prefixes``). Of equal candidates the first in grid order wins.
    """
    start = time.perf_counter()
    label = "label" if stratify else None
    numbered = spread(stage(with_folds(rows, folds, seed, key, label), "folds")).persist()
    try:
        points = candidates(grid)
        size, _ = _shared_size(build, score)
        groups: dict[tuple, list[int]] = {}
        for i, p in enumerate(points):
            same = tuple((k, v) for k, v in p.items() if k != size) if size in p else (i,)
            groups.setdefault(same, []).append(i)
        tasks = [(f, members) for f in range(folds) for members in groups.values()]

        def run(task):
            fold, members = task
            train = numbered.filter(F.col("fold") != fold).drop("fold")
            held_out = numbered.filter(F.col("fold") == fold).drop("fold")
            scored = _scores_of_fold(build, [points[i] for i in members], score, train, held_out)
            return list(zip(members, scored))

        with ThreadPool(parallelism) as pool:
            outcomes = pool.map(inheritable_thread_target(numbered.sparkSession)(run), tasks)
        totals = [0.0] * len(points)
        for outcome in outcomes:
            for i, value in outcome:
                totals[i] += value / folds
        best = max(range(len(points)), key=lambda i: (totals[i], -i))
        model = build(**points[best]).fit(numbered.drop("fold"))
    finally:
        numbered.unpersist()
    return Search(model, points[best], list(zip(points, totals)), time.perf_counter() - start)


def importances(model: Model, slots: DataFrame) -> DataFrame:
    """Importance of every feature, by name, for all rows of ``slots`` (slot, feature)."""
    vector = trees_of(model).featureImportances
    used = {int(k): float(v) for k, v in enumerate(vector.toArray()) if v} if not hasattr(vector, "indices") else dict(
        zip(vector.indices.tolist(), vector.values.tolist()))
    found = slots.sparkSession.createDataFrame(list(used.items()), "slot long, importance double")
    return slots.join(found, "slot", "left").select("feature", F.coalesce("importance", F.lit(0.0)).alias("importance"))


def top_importances(table: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most important features, largest first."""
    return table.orderBy(F.desc("importance"), F.asc("feature")).limit(k)


def save_model(model: Model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str, kind: type[Model] = GBTRegressionModel) -> Model:
    """Read a saved model back; ``kind`` is its class."""
    return kind.load(path)
