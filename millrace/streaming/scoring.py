"""Score readings as files arrive.

Scoring looks at one row at a time, so the stream keeps no state and needs no watermark.
Fitted cleaners and models are literals and broadcast trees; the same functions serve
batch and stream. The file sink with its checkpoint writes every input row exactly once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from millrace.sources.staging import new_location


def arriving_rows(
    spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files under ``path`` as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def start_scoring(
    rows: DataFrame, score: Callable[[DataFrame], DataFrame], output: str, checkpoint: str,
    interval: str | None = None,
) -> StreamingQuery:
    """Write scored rows to ``output``; without an interval, take what is there and stop."""
    writer = score(rows).writeStream.format("parquet").option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start(output)


def score_available(
    spark: SparkSession, path: str, schema: StructType, score: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Run the stream over the files present and return what it wrote."""
    output = new_location(spark, "scored")
    stream = start_scoring(arriving_rows(spark, path, schema), score, output,
                           new_location(spark, "scored-progress"))
    stream.awaitTermination()
    return spark.read.parquet(output)
