"""Scores of an ensemble's first trees, so that candidates with fewer trees need no fit of their own.

A fitted ensemble is read back as a table of its leaves. Each row learns from the model which leaf it
falls into in every tree; what the first 100, 200, ... trees say is then a running sum over these leaves'
values, all sizes from one pass over the rows and one aggregation.

For boosted trees this is exactly what a fit with fewer rounds gives, as more rounds repeat the
shorter run first. A forest's first trees are a forest of that many trees on draws of the same distribution, but not
the draws of a separate fit, since these depend on the number of trees asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.metrics import with_ratios
from millrace.sources.staging import new_location

_LEAF = "_leaf"


def leaf_table(model: Model, rows: DataFrame) -> DataFrame:
    """One row, ``trees``: for every tree the values of its leaves from left to right, times the tree's weight."""
    path = new_location(rows.sparkSession, "trees")
    model.write().save(path)
    nodes = rows.sparkSession.read.parquet(f"{path}/data").select("treeID", "nodeData.*").where("leftChild < 0")
    weight = F.element_at(F.lit([float(w) for w in model.treeWeights]), F.col("treeID") + 1)
    one = lambda key, value: F.transform(
        F.array_sort(F.collect_list(F.struct(key, value.alias("value")))), lambda x: x["value"])
    trees = nodes.groupBy("treeID").agg(one("id", F.col("prediction") * weight).alias("leaves"))
    return trees.agg(one("treeID", F.col("leaves")).alias("trees"))


def with_prefixes(model: Model, rows: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """``rows`` with ``sums``: the sum over the first trees, for each of ``sizes`` in ascending order."""
    quiet = {p: "" for p in (model.predictionCol, getattr(model, "rawPredictionCol", None),
                             getattr(model, "probabilityCol", None)) if p is not None}
    leaves = model.copy({**quiet, model.leafCol: _LEAF}).transform(rows)
    leaves = leaves.withColumn(_LEAF, vector_to_array(_LEAF)).withColumn("_trees", leaf_table(model, rows).scalar())

    def add(total: Column, tree: Column) -> Column:
        return total + F.get(F.get(F.col("_trees"), tree), F.get(F.col(_LEAF), tree).cast("int"))

    sums, total = [], F.lit(0.0)
    for k, (low, high) in enumerate(zip([0, *sizes], sizes)):
        name = f"_sum{k}"
        leaves = leaves.withColumn(name, F.aggregate(F.sequence(F.lit(low), F.lit(high - 1)), total, add))
        total = F.col(name)
        sums.append(total)
    return leaves.withColumn("sums", F.array(*sums)).drop(_LEAF, "_trees", *[f"_sum{k}" for k in range(len(sizes))])


def negative_mae_by_size(model: Model, rows: DataFrame, sizes: Sequence[int]) -> list[float]:
    """Negative mean absolute error of the first trees, for each size."""
    parts = [float(n) if isinstance(model, RandomForestRegressionModel) else 1.0 for n in sizes]
    errors = [F.avg(F.abs(F.col("label") - F.col("sums")[k] / F.lit(part))) for k, part in enumerate(parts)]
    return [-e for e in with_prefixes(model, rows, sizes).agg(*errors).first()]


def confusion_by_size(model: GBTClassificationModel, rows: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """Confusion counts and ratios after each number of rounds, from one aggregation."""
    failed = F.col("label") == 1

    def counts(k: int, size: int) -> Column:
        flagged = F.col("sums")[k] > 0
        return F.struct(
            F.lit(size).alias("rounds"), F.count_if(failed & flagged).alias("true_p"),
            F.count_if(~failed & ~flagged).alias("true_n"), F.count_if(~failed & flagged).alias("false_p"),
            F.count_if(failed & ~flagged).alias("false_n"))

    found = with_prefixes(model, rows, sizes).agg(F.array(*[counts(k, n) for k, n in enumerate(sizes)]).alias("rows"))
    return with_ratios(found.select(F.inline("rows")))


def failure_f1_by_size(model: GBTClassificationModel, rows: DataFrame, sizes: Sequence[int]) -> list[float]:
    """F1 of class 1 after each number of rounds; 0 where it is undefined."""
    found = {r.rounds: r.f1 or 0.0 for r in confusion_by_size(model, rows, sizes).collect()}
    return [found[n] for n in sizes]
