"""Numeric expressions. Every null, NaN and rounding rule of the library lives here."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def nan_to_null(value: Column) -> Column:
    """NaN is missing data; Spark would otherwise rank it above every number."""
    return F.when(~F.isnan(value), value)


def round_half_even(value: Column, digits: int) -> Column:
    """Scale, round half to even, scale back: what array libraries do, unlike round()."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def clip(value: Column, low: float, high: float) -> Column:
    """Bound a value; null and NaN give null (greatest() alone would return a bound)."""
    return F.when(value.isNotNull() & ~F.isnan(value.cast("double")), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """A quotient that is null where the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def item_quantity(total: Column, price: Column) -> Column:
    """Units per order line, truncated toward zero; 1 where the price says nothing."""
    return F.when(price > 0, (total / price).cast("int")).otherwise(F.lit(1))


def profit_margin(profit: Column, total: Column) -> Column:
    """Profit share of the line total to 2 digits; 0 where the total is not positive."""
    return F.when(total > 0, round_half_even(profit / total, 2)).otherwise(F.lit(0.0))


def absolute_error(label: Column, prediction: Column) -> Column:
    return F.abs(label - prediction)


def percent(probability: Column, digits: int = 3) -> Column:
    """A probability in [0, 1] as percent."""
    return round_half_even(probability * 100.0, digits)
