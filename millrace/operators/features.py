"""Indicator columns and feature vectors."""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators.codes import dense_codes
from millrace.operators.joins import lookup_join
from millrace.operators.missing import KNOWN, filled_slots, gap_counts, without_nan
from millrace.sources.staging import stage

# The encoded columns of the training view and its label.
CATEGORIES = ["shipping_mode", "customer_segment", "customer_city", "customer_state",
              "category_name", "department_name"]
LABEL = "delivery_variance_days"

MAX_WIDE_COLUMNS = 2_000
#: Values that one nominal slot tells apart; a column of more takes several slots, as digits.
MAX_BINS = 10_000
_DIGIT = 1024

def distinct_values(
    frame: DataFrame, columns: Sequence[str], limit: int
) -> dict[str, list[str]]:
    """Sorted distinct values per column; refuses to gather more than ``limit`` in all."""
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns])
    rows = (frame.select(F.inline(pairs)).filter("v IS NOT NULL").distinct()
            .limit(limit + 1).collect())
    if len(rows) > limit:
        raise ValueError(f"more than {limit} categories in {', '.join(columns)}")
    values: dict[str, list[str]] = {c: [] for c in columns}
    for row in rows:
        values[row.c].append(row.v)
    return {c: sorted(v) for c, v in values.items()}


@dataclass(frozen=True)
class WideIndicators:
    """One 0/1 column per category but the first, named ``column_value``."""

    values: Mapping[str, list[str]]

    def apply(self, frame: DataFrame) -> DataFrame:
        """Other columns first, then the indicators; a null category has all zeros."""
        others = [c for c in frame.columns if c not in self.values]
        flags = [
            F.coalesce(F.col(c) == v, F.lit(False)).alias(f"{c}_{v}")
            for c, known in self.values.items() for v in known[1:]
        ]
        return frame.select(*others, *flags)


def fit_wide_indicators(
    frame: DataFrame, columns: Sequence[str] = CATEGORIES, limit: int = MAX_WIDE_COLUMNS
) -> WideIndicators:
    """Learn the categories. Past ``limit`` columns the vector form is the one to use."""
    return WideIndicators(distinct_values(frame, columns, limit))


def category_codes(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, value, code of every category: its place in sorted order among its column's, as a stored table."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    return stage(dense_codes(frame.select(F.inline(pairs)), "value", ["column"]), "category_codes")


@dataclass(frozen=True)
class _Category:
    """One coded column: how many values it has, and the bytes of its part of the code table."""

    column: str
    values: int
    size: int

    @property
    def digits(self) -> int:
        """Nominal slots it takes; one code more stands for null and unknown values."""
        if self.values < MAX_BINS:
            return 1
        return next(d for d in itertools.count(2) if _DIGIT**d > self.values)


@dataclass(frozen=True)
class FeatureEncoder:
    """Features as one vector, its categories looked up in a table of codes of any size.

    ``nominal`` gives trees one slot per column (or per digit of its code) instead of one per value.
    Null and unknown values have all zeros as indicators, and a code of their own as nominal slots.

    ``gaps`` are the numbers that had missing values when the encoder was fitted. They stay columns beside
    the vector, which is then called ``known``, until a model's own stages fill and mark them (see ``missing``).
    Numbers without any value are left out.
    """

    codes: DataFrame
    categories: list[_Category]
    numbers: list[str]
    nominal: bool = False
    gaps: tuple[str, ...] = ()

    @property
    def bins(self) -> int:
        """Bins that trees need to tell all values of a nominal slot apart."""
        if not self.nominal:
            return 2
        return max((c.values + 1 if c.digits == 1 else _DIGIT for c in self.categories), default=2)

    @property
    def width(self) -> int:
        """Slots of the features, with the filled numbers and their marks."""
        return 2 * len(self.gaps) + len(self.numbers) + sum(c.digits if self.nominal else c.values - 1 for c in self.categories)

    @property
    def slots(self) -> DataFrame:
        """slot, feature: what each slot of the vector is."""
        spark, names = self.codes.sparkSession, list(self.numbers)
        if self.nominal:
            for c in self.categories:
                names += [c.column] if c.digits == 1 else [f"{c.column}_digit{k}" for k in range(c.digits)]
        table = slot_table(spark, names)
        if not self.nominal and self.categories:
            starts = itertools.accumulate((c.values - 1 for c in self.categories), initial=len(self.numbers))
            start = F.element_at(F.create_map(*[F.lit(x) for c, at in zip(self.categories, starts) for x in (c.column, at)]),
                                 F.col("column"))
            table = table.unionByName(self.codes.where("code > 0").select(
                (start + F.col("code") - 1).alias("slot"), F.concat_ws("_", "column", "value").alias("feature")))
        last = slot_table(spark, filled_slots(self.gaps)).withColumn("slot", F.col("slot") + (self.width - 2 * len(self.gaps)))
        return table.unionByName(last) if self.gaps else table

    def apply(self, frame: DataFrame, keep: Sequence[str], label: str | None = None) -> DataFrame:
        """``keep`` columns, ``features`` (or ``known`` and the gaps) and, if named, the label as a double.

        A number that is missing where none was when the encoder was fitted is NaN, which trees take for large.
        """
        rows, inputs = without_nan(frame, self.gaps), list(self.numbers)
        for k, c in enumerate(self.categories):
            code = self.codes.where(F.col("column") == c.column).select(
                F.col("value").alias("_value"), F.col("code").alias(f"_code{k}"))
            rows = lookup_join(rows.withColumn("_value", F.col(c.column).cast("string")), code, "_value",
                               size=c.size, how="left").drop("_value")
        nominal = lambda values: {"ml_attr": {"type": "nominal", "num_vals": values}}
        for k, c in enumerate(self.categories):
            code = F.coalesce(F.col(f"_code{k}"), F.lit(c.values))
            if self.nominal:
                for d in range(c.digits):
                    radix = c.values + 1 if c.digits == 1 else _DIGIT
                    digit = F.floor(code / radix**d) % radix
                    rows = rows.withColumn(f"_slot{k}_{d}", digit.cast("double").alias("x", metadata=nominal(radix)))
                    inputs.append(f"_slot{k}_{d}")
            else:  # the first value shares the last index, which the encoder leaves out
                index = F.when(code.between(1, c.values - 1), code - 1).otherwise(c.values - 1)
                rows = rows.withColumn(f"_index{k}", index.cast("double").alias("x", metadata=nominal(c.values)))
        if not self.nominal and self.categories:
            indexed, flags = ([f"_{n}{k}" for k in range(len(self.categories))] for n in ("index", "flags"))
            rows = OneHotEncoder(inputCols=indexed, outputCols=flags, dropLast=True).fit(rows).transform(rows)
            inputs += flags
        vector = KNOWN if self.gaps else "features"
        rows = VectorAssembler(inputCols=inputs, outputCol=vector, handleInvalid="keep").transform(rows)
        extra = [] if label is None else [F.col(label).cast("double").alias("label")]
        return rows.select(*keep, *extra, vector, *self.gaps)


def slot_table(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """slot, feature of a vector whose slots have these names."""
    return spark.createDataFrame(list(enumerate(names)), "slot long, feature string")


def _fit(frame: DataFrame, categories: Sequence[str], numbers: Sequence[str], nominal: bool) -> FeatureEncoder:
    codes = category_codes(frame, categories or [frame.columns[0]])
    gaps = gap_counts(frame, numbers)
    n = frame.count() if gaps else 0
    complete, open_ = [c for c in numbers if c not in gaps], tuple(c for c in numbers if 0 < gaps.get(c, 0) < n)
    size = F.sum(F.octet_length("value") + 64)
    found = {r["column"]: r for r in codes.groupBy("column").agg(F.count("*").alias("n"), size.alias("size")).collect()}
    known = [_Category(c, found[c].n, found[c]["size"]) if c in found else _Category(c, 0, 0) for c in categories]
    return FeatureEncoder(codes, [c for c in known if nominal or c.values > 1], complete, nominal, open_)


def fit_feature_encoder(frame: DataFrame, categories: Sequence[str], numbers: Sequence[str]) -> FeatureEncoder:
    """The vector form of ``WideIndicators``: one slot for each category but a column's first, of any number."""
    return _fit(frame, categories, numbers, nominal=False)


def fit_index_encoder(frame: DataFrame, categories: Sequence[str], numbers: Sequence[str]) -> FeatureEncoder:
    """Numbers and one slot per category column, marked as nominal for the tree models.

    Spark's trees split nominal features into sets of values. A row then takes a few slots
    instead of one per category, which is what fits in memory on a large table.
    """
    return _fit(frame, categories, numbers, nominal=True)


def feature_sums(encoded: DataFrame, slots: DataFrame) -> DataFrame:
    """Sum of every feature, by name."""
    total = encoded.select(Summarizer.sum(F.col("features")).alias("total"))
    sums = total.select(F.posexplode(vector_to_array("total")).alias("slot", "total"))
    return sums.join(slots, "slot").select("feature", "total")
