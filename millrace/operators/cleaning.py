"""Fit-and-apply cleaning steps.

Fitting runs the aggregation and keeps a handful of numbers; applying is a projection on
literals, so it costs no join, keeps whole-stage code and also works on a stream.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from millrace.functions.numeric import clip, nan_to_null, round_half_even
from millrace.operators.selection import exact_quantiles


@dataclass(frozen=True)
class ClipBounds:
    column: str
    low: float | None
    high: float | None

    def apply(self, frame: DataFrame, into: str | None = None, digits: int | None = 2) -> DataFrame:
        value = F.col(f"`{self.column}`")
        bounded = value if self.low is None else clip(value, self.low, self.high)
        if digits is not None:
            bounded = round_half_even(bounded, digits)
        return frame.withColumn(into or self.column, bounded)


def fit_clip(frame: DataFrame, column: str, lower: float = 0.01, upper: float = 0.99) -> ClipBounds:
    """Bounds at two quantiles."""
    low, high = exact_quantiles(frame, [column], [lower, upper])[column]
    return ClipBounds(column, low, high)


@dataclass(frozen=True)
class Imputation:
    fills: dict[str, float]

    def apply(self, frame: DataFrame) -> DataFrame:
        """Fill missing values; the columns become doubles, as a mean need not be whole."""
        return frame.withColumns({
            c: F.coalesce(nan_to_null(F.col(f"`{c}`").cast("double")), F.lit(fill))
            for c, fill in self.fills.items()
        }) if self.fills else frame


def fit_imputation(frame: DataFrame, columns: Sequence[str], strategy: str = "mean") -> Imputation:
    """Column means or medians of the values that are present."""
    if strategy == "median":
        quantiles = exact_quantiles(frame, columns, [0.5])
        fills = {c: quantiles[c][0] for c in columns}
    elif strategy == "mean":
        row = frame.agg(*[
            F.avg(nan_to_null(F.col(f"`{c}`").cast("double"))).alias(f"c{i}")
            for i, c in enumerate(columns)
        ]).first()
        fills = {c: row[i] for i, c in enumerate(columns)}
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return Imputation({c: v for c, v in fills.items() if v is not None})


@dataclass(frozen=True)
class OutlierFences:
    fences: dict[str, tuple[float, float]]
    suffix: str = "_outlier"

    def apply(self, frame: DataFrame) -> DataFrame:
        """Add a 0/1 flag per column; a missing value lies inside."""
        def flag(c: str):
            value = nan_to_null(F.col(f"`{c}`").cast("double"))
            low, high = self.fences[c]
            return F.when((value < low) | (value > high), 1).otherwise(0)

        return frame.withColumns({f"{c}{self.suffix}": flag(c) for c in self.fences})


def fit_outlier_fences(
    frame: DataFrame, columns: Sequence[str], upper: str = "code"
) -> OutlierFences:
    """Fences q1 - 1.5 iqr and, by default, q3 + 1; ``upper='tukey'`` takes q3 + 1.5 iqr."""
    if upper not in ("code", "tukey"):
        raise ValueError(f"unknown upper fence {upper!r}")
    fences = {}
    for c, (q1, q3) in exact_quantiles(frame, columns, [0.25, 0.75]).items():
        if q1 is not None:
            spread = q3 - q1
            fences[c] = (q1 - 1.5 * spread, q3 + (1.0 if upper == "code" else 1.5 * spread))
    return OutlierFences(fences)


@dataclass(frozen=True)
class QuartileFences:
    """Values beyond the quartiles themselves."""

    speed_high: float
    torque_low: float
    torque_high: float

    def apply(self, frame: DataFrame) -> DataFrame:
        speed, torque = F.col("rotational_speed_rpm"), F.col("torque_nm")
        beyond = (torque < self.torque_low) | (torque > self.torque_high)
        return frame.withColumns({
            "speed_beyond": F.coalesce(speed > self.speed_high, F.lit(False)),
            "torque_beyond": F.coalesce(beyond, F.lit(False)),
        })


def fit_quartile_fences(frame: DataFrame) -> QuartileFences:
    quartiles = exact_quantiles(frame, ["rotational_speed_rpm", "torque_nm"], [0.25, 0.75])
    return QuartileFences(quartiles["rotational_speed_rpm"][1], *quartiles["torque_nm"])
