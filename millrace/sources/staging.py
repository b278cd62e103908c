"""Tables written between stages, in the shared folder the cluster names.

A stage that several passes read (a fact table whose quantiles are fitted, a feature matrix
a grid search trains on) is written once as Parquet: later scans are column-pruned, lineage
is cut, and losing executors costs only the tasks they ran.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from multiprocessing.pool import ThreadPool
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

SMALL_TABLE_ROWS = 20_000_000

T = TypeVar("T")
R = TypeVar("R")


def staging_root(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; in local mode, where unset, a scratch folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    scratch = tempfile.mkdtemp(prefix="millrace-")
    spark.sparkContext.setCheckpointDir(scratch)
    return scratch


def new_location(spark: SparkSession, label: str) -> str:
    """A path no other stage uses."""
    application = spark.sparkContext.applicationId
    return f"{staging_root(spark)}/{application}/{label}-{uuid.uuid4().hex[:12]}"


def stage(frame: DataFrame, label: str) -> DataFrame:
    """Write ``frame`` and return a scan of what was written."""
    location = new_location(frame.sparkSession, label)
    frame.write.option("compression", "zstd").parquet(location)
    return frame.sparkSession.read.schema(frame.schema).parquet(location)


def side_by_side(spark: SparkSession, work: Callable[[T], R], items: Iterable[T]) -> list[R]:
    """Independent jobs, submitted together so that small ones fill idle cores."""
    items = list(items)
    with ThreadPool(len(items)) as pool:
        return pool.map(inheritable_thread_target(spark)(work), items)


def stage_all(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Write independent stages side by side."""
    spark = next(iter(frames.values())).sparkSession
    written = side_by_side(spark, lambda item: stage(item[1], item[0]), frames.items())
    return dict(zip(frames, written))


def spread(table: DataFrame) -> DataFrame:
    """A small table of fewer files than cores, dealt out to all of them.

    A file written as one block is one task, and so is everything computed from it. Tables
    of many files, or too large to be dealt out cheaply, stay as they are.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    if len(table.inputFiles()) >= cores or table.count() > SMALL_TABLE_ROWS:
        return table
    return table.repartition(cores)
