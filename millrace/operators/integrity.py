"""Key checks and one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from millrace.operators.joins import lookup_join


def orphan_rows(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key has no dimension row; a null key refers to nothing and passes.

    Keys are compared once each, not once per fact row: the distinct keys are combined
    before the shuffle, and only the missing ones go back to the facts.
    """
    present = dimension.select(key).distinct()
    missing = facts.select(key).filter(F.col(key).isNotNull()).distinct().join(present, key, "left_anti")
    return lookup_join(facts, missing, key)


def orphan_counts(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Missing keys with the number of fact rows that refer to them."""
    counted = facts.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rows"))
    return counted.join(dimension.select(key).distinct(), key, "left_anti")


def duplicate_keys(frame: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return frame.groupBy(*key).agg(F.count("*").alias("rows")).filter("rows > 1")


def one_row_per_key(frame: DataFrame, key: Sequence[str]) -> DataFrame:
    """The smallest row of every key, compared by the other columns in order, nulls first.

    A minimum over a struct combines before the shuffle; a ranking window would bring every
    copy of a hot key into one task.
    """
    rest = [c for c in frame.columns if c not in key]
    if not rest:
        return frame.distinct()
    smallest = frame.groupBy(*key).agg(F.min(F.struct(*[f"`{c}`" for c in rest])).alias("_row"))
    return smallest.select(*[c if c in key else F.col(f"_row.`{c}`").alias(c) for c in frame.columns])
