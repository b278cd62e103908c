"""Training on missing numbers: a mark for each column that has gaps, and a fill learnt with the model.

The marks and the fill are stages of the model's own pipeline. So every fit, one fold's or the
last, learns its fill from its own training rows alone, a saved model carries it along, and rows to score
may have gaps in any column.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame, functions as F

from millrace.functions.numeric import nan_to_null

KNOWN = "known"  # the vector of what has no gaps


def gap_counts(frame: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Nulls and NaN of each column that has some, in one pass."""
    if not columns:
        return {}
    gaps = [F.count_if(nan_to_null(F.col(f"`{c}`").cast("double")).isNull()) for c in columns]
    return {c: n for c, n in zip(columns, frame.agg(*gaps).first()) if n}


def without_nan(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``columns`` as doubles, null where they are NaN."""
    return frame.withColumns({c: nan_to_null(F.col(f"`{c}`").cast("double")) for c in columns}) if columns else frame


def filled_slots(gaps: Sequence[str]) -> list[str]:
    """What the filled columns and their marks are called in the features, after those without gaps."""
    return [*gaps, *[f"{c}_missing" for c in gaps]]


def filling(build: Callable[..., Estimator], gaps: Sequence[str], known: bool = True) -> Callable[..., Estimator]:
    """``build`` behind stages that mark and fill the columns ``gaps`` and put them into the features.

    With ``known``, the vector of that name comes first in the features.
    """
    if not gaps:
        return build
    marks = ", ".join(f"CAST(`{c}` IS NULL OR isnan(`{c}`) AS DOUBLE) AS `{c}_missing`" for c in gaps)
    stages = [
        SQLTransformer(statement=f"SELECT *, {marks} FROM __THIS__"),
        Imputer(inputCols=list(gaps), outputCols=[f"{c}_filled" for c in gaps], strategy="mean"),
        VectorAssembler(inputCols=[*([KNOWN] if known else []), *[f"{c}_filled" for c in gaps],
                                   *[f"{c}_missing" for c in gaps]], outputCol="features")]
    return lambda **params: Pipeline(stages=[*stages, build(**params)])


def trees_of(model: Model) -> Model:
    """The tree model, which is the last stage where there are others."""
    return model.stages[-1] if isinstance(model, PipelineModel) else model


def with_features(model: Model, rows: DataFrame) -> DataFrame:
    """``rows`` as the tree model sees them."""
    return PipelineModel(model.stages[:-1]).transform(rows) if isinstance(model, PipelineModel) else rows


def predicted(model: Model, rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with the prediction under a name, and none of the columns made on the way."""
    return model.transform(rows).select(*rows.columns, F.col("prediction").alias(name))
