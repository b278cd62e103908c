"""The tables derived from one input folder, each written once per session.

Queries on the star or on cleaned telemetry start from stored tables, as they would after
a nightly load; the load itself runs on the first request.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators.models import Search
from millrace.plans.delivery import PreparedRows, prepare_rows, train_boosted, train_forest
from millrace.plans.maintenance import VaultReport, vault_job
from millrace.plans.stand_ins import order_extract, telemetry_extract
from millrace.plans.star import Star, build_star, cleaned_rows, training_view, without_empty
from millrace.plans.telemetry import clean_telemetry, telemetry_names
from millrace.sources.staging import spread, stage

# Grids for the registered queries; the full grids are the operators' defaults.
SMALL_BOOSTED_GRID = {"maxIter": [5, 10], "maxDepth": [4], "stepSize": [0.1], "subsamplingRate": [0.8],
                      "featureSubsetStrategy": ["all"]}
SMALL_FOREST_GRID = {"numTrees": [10], "maxDepth": [5, 8], "minInstancesPerNode": [1],
                     "featureSubsetStrategy": ["0.33"]}
SMALL_CLASS_GRID = {"maxDepth": [3, 5], "stepSize": [0.2], "maxIter": [10], "subsamplingRate": [0.8]}


class Warehouse:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _stored_or(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The table of that name if it is at rest already, else what it would be written from."""
        return vars(self)[name] if name in vars(self) else build()

    def _extract_rows(self) -> DataFrame:
        tables = lambda name: spread(self.table(name)) if name == "lineitem" else self.table(name)
        return order_extract(tables)

    @cached_property
    def extract(self) -> DataFrame:
        """The wide order extract at rest."""
        return stage(self._extract_rows(), "order_extract")

    @property
    def extract_once(self) -> DataFrame:
        """The wide order extract for a single pass: nothing is written first."""
        return self._stored_or("extract", self._extract_rows)

    @cached_property
    def cleaned(self) -> DataFrame:
        """Cleaned rows, written straight from the joined tables; empty columns are found in what was written."""
        rows = cleaned_rows(self.extract_once)
        return without_empty(stage(rows, "cleaned_orders"))

    @cached_property
    def star(self) -> Star:
        return build_star(self.cleaned)

    @cached_property
    def training(self) -> DataFrame:
        return stage(training_view(self.star), "training_view")

    @property
    def training_once(self) -> DataFrame:
        """The training view for a single pass: of the columns that the pass reads, nothing is written first."""
        return self._stored_or("training", lambda: training_view(self.star))

    @property
    def telemetry_raw(self) -> DataFrame:
        """Raw readings: a projection of one table, cheap enough to recompute."""
        return telemetry_extract(self.table("events"))

    @cached_property
    def telemetry_dealt(self) -> DataFrame:
        """The same for a job of many passes: events of fewer files than cores are dealt out once, and stored."""
        events = self.table("events").select("event_id", "ts", "value")
        dealt = spread(events)
        return telemetry_extract(events if dealt is events else stage(dealt, "events"))

    @cached_property
    def telemetry(self) -> DataFrame:
        """Cleaned readings."""
        return stage(clean_telemetry(self.telemetry_raw), "telemetry")

    @property
    def readings(self) -> DataFrame:
        """Complete raw readings under the cleaned names."""
        return telemetry_names(telemetry_extract(self.table("events"), gaps=False))


    @cached_property
    def prepared(self) -> PreparedRows:
        """Encoded training view, split into training and vault rows."""
        return prepare_rows(self.training)

    @cached_property
    def indexed(self) -> PreparedRows:
        """The same with one nominal feature per category column."""
        return prepare_rows(self.training, encoding="indexed")

    @cached_property
    def boosted(self) -> Search:
        return train_boosted(self.prepared, SMALL_BOOSTED_GRID, folds=2)

    @cached_property
    def forest(self) -> Search:
        return train_forest(self.prepared, SMALL_FOREST_GRID, folds=2)

    @cached_property
    def vault(self) -> VaultReport:
        """Classifier trained on the history and validated on the vault."""
        return vault_job(self.telemetry_dealt, grid=SMALL_CLASS_GRID, folds=2)


_open: dict[tuple, Warehouse] = {}


def _fingerprint(spark: SparkSession, folder: str) -> tuple:
    """Names, times and lengths of the input files, so that changed inputs load anew."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{folder}/*.parquet")
    row = files.agg(F.bit_xor(F.xxhash64("path", "modificationTime", "length")), F.count("*")).first()
    return tuple(row)


def open_warehouse(spark: SparkSession, folder: str) -> Warehouse:
    key = (spark.sparkContext.applicationId, folder, *_fingerprint(spark, folder))
    if key not in _open:
        _open[key] = Warehouse(spark, folder)
    return _open[key]


def on_warehouse(build: Callable[[Warehouse], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: build(open_warehouse(spark, folder))
