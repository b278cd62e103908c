"""Schema operators: names, positions, types, mostly empty columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions.numeric import nan_to_null


def rename_all(frame: DataFrame, rule: Callable[[str], str]) -> DataFrame:
    """Apply a naming rule to every column."""
    return frame.toDF(*[rule(c) for c in frame.columns])


def insert_column(frame: DataFrame, position: int, name: str, value: Column) -> DataFrame:
    """Add a column at a position counted from 0."""
    names = [F.col(f"`{c}`") for c in frame.columns]
    return frame.select(*names[:position], value.alias(name), *names[position:])


def missing_as_null(frame: DataFrame) -> DataFrame:
    """Turn NaN into null in every floating-point column."""
    floating = [f.name for f in frame.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return frame.withColumns({c: nan_to_null(F.col(f"`{c}`")) for c in floating}) if floating else frame


def enforce_types(frame: DataFrame, types: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Project the columns of ``types`` in its order with these types.

    Nulls stay null. ``strict`` instead fails the job when an integer column has one, as
    a conversion to a null-less integer type does.
    """
    def cast(name: str, kind: str) -> Column:
        value = F.col(f"`{name}`").cast(kind)
        if strict and kind in ("int", "bigint", "long", "integer"):
            message = F.lit(f"null in integer column {name}")
            value = F.when(value.isNotNull(), value).otherwise(F.raise_error(message).cast(kind))
        return value.alias(name)

    return frame.select(*[cast(n, k) for n, k in types.items()])


REJECTED = "_rejected"
_WHOLE = ("tinyint", "smallint", "int", "bigint", "integer", "long")


def check_types(text: DataFrame, types: Mapping[str, str], also: Column | None = None) -> DataFrame:
    """The text columns of ``types`` in its order with these types, and what didn't fit in ``_rejected``.

    A field that is no value of its type is null in its place, and listed with its column, the cause and
    its text, so that nothing stops the job and nothing vanishes. Whole numbers may be written with a
    fraction of zero. ``also`` lists further rejects of the row.
    """
    columns, causes = [], []
    for name, kind in types.items():
        value = F.col(f"`{name}`")
        fitted = value.try_cast(kind)
        if kind in _WHOLE:
            real = value.try_cast("double")
            fitted = F.coalesce(fitted, F.when(real == F.floor(real), real.try_cast(kind)))
        columns.append(fitted.alias(name))
        if kind != "string":
            causes.append(F.when(value.isNotNull() & fitted.isNull(), _reject(name, f"no {kind}", value)))
    found = F.array_compact(F.array(*causes)) if causes else F.array().cast(_REJECTS)
    return text.select(*columns, (found if also is None else F.concat(also, found)).cast(_REJECTS).alias(REJECTED))


_REJECTS = "array<struct<column:string,cause:string,value:string>>"


def _reject(column: str, cause: str, value: Column) -> Column:
    return F.struct(F.lit(column).alias("column"), F.lit(cause).alias("cause"), value.alias("value"))


def malformed(line: Column) -> Column:
    """A reject of a whole line, where there is one."""
    return F.when(line.isNotNull(), F.array(_reject("", "fields", line))).otherwise(F.array()).cast(_REJECTS)


def accepted(checked: DataFrame) -> DataFrame:
    """The typed rows, without lines that were malformed as a whole."""
    return checked.where(~F.exists(REJECTED, lambda r: r["column"] == "")).drop(REJECTED)


def rejected(checked: DataFrame) -> DataFrame:
    """column, cause and value of every field and line that was turned away."""
    return checked.select(F.inline(REJECTED))


def reject_counts(checked: DataFrame) -> DataFrame:
    return rejected(checked).groupBy("column", "cause").agg(F.count("*").alias("n"))


def null_counts(frame: DataFrame) -> tuple[int, dict[str, int]]:
    """Row count and nulls per column, in one pass that returns one row."""
    row = frame.agg(
        F.count("*").alias("n"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"c{i}") for i, c in enumerate(frame.columns)],
    ).first()
    return row.n, {c: row[i + 1] for i, c in enumerate(frame.columns)}


def mostly_null_columns(frame: DataFrame, threshold: float = 0.8) -> list[str]:
    """Columns whose share of nulls reaches the threshold; none in an empty table."""
    n, nulls = null_counts(frame)
    return [c for c, missing in nulls.items() if n and missing and missing / n >= threshold]


def drop_mostly_null(
    frame: DataFrame, threshold: float = 0.8, required: Sequence[str] = ()
) -> DataFrame:
    """Drop columns whose share of nulls reaches the threshold.

    The resulting schema depends on the data, so this runs one aggregation when called.
    """
    empty = mostly_null_columns(frame, threshold)
    lost = [c for c in empty if c in required]
    if lost:
        raise ValueError(f"required columns are at least {threshold:.0%} null: {', '.join(lost)}")
    return frame.drop(*empty)
