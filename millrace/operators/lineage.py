"""Row and null counts taken while tables are written, at no scan of their own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


class Lineage:
    """Counts of named steps of a job.

    ``watch`` puts counters into a step's plan; they are filled by the first job that runs it, such as the
    one that writes it. Reading a count waits for that job. A task that runs again after a loss of its
    results is counted again, so on a cluster that loses executors the counts may be too high.
    """

    def __init__(self):
        self._steps: dict[str, tuple[Observation, list[str], bool]] = {}

    def watch(self, name: str, frame: DataFrame, nulls: bool = False) -> DataFrame:
        """``frame``, counted under a name; ``nulls`` counts those of every column as well."""
        counters = [F.count("*").alias("rows")]
        if nulls:
            counters += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"c{i}") for i, c in enumerate(frame.columns)]
        observed = Observation(name)
        self._steps[name] = (observed, frame.columns, nulls)
        return frame.observe(observed, *counters)

    def rows(self, name: str) -> int:
        return self._steps[name][0].get["rows"]

    def mostly_null(self, name: str, threshold: float = 0.8, required: Sequence[str] = ()) -> list[str]:
        """Columns of a step whose share of nulls reaches the threshold; raises where one is required."""
        observed, columns, _ = self._steps[name]
        n, found = observed.get["rows"], observed.get
        empty = [c for i, c in enumerate(columns) if n and found[f"c{i}"] and found[f"c{i}"] / n >= threshold]
        if lost := [c for c in empty if c in required]:
            raise ValueError(f"required columns are at least {threshold:.0%} null: {', '.join(lost)}")
        return empty

    def table(self, spark: SparkSession) -> DataFrame:
        """step, rows and columns, in the order in which the steps were named."""
        rows = [(name, self.rows(name), len(columns)) for name, (_, columns, _) in self._steps.items()]
        return spark.createDataFrame(rows, "step string, rows long, columns int")

    def nulls(self, spark: SparkSession) -> DataFrame:
        """step, column_name and null_count of the steps whose nulls are counted."""
        rows = [(name, c, observed.get[f"c{i}"]) for name, (observed, columns, counted) in self._steps.items() if counted
                for i, c in enumerate(columns)]
        return spark.createDataFrame(rows, "step string, column_name string, null_count long")
