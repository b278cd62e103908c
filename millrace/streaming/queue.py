"""A dispatch queue kept while scored readings arrive.

The stream's state has one entry for each machine: its latest reading, and whether that one is flagged. A
newer reading opens, updates or closes the entry, and an entry that no reading renews for some time
expires. Each of these is a change, written once per micro-batch under the batch's number, so that a batch
that runs again after a failure writes the same again. The queue at any time is what the changes
leave open. State and changes both follow the checkpoint: a stream that stops goes on where it was.

Defined cases: readings of the same time go by their number; older readings than the latest one of their
machine change nothing; readings later than the watermark allows, and those without a machine or
a time, are left out; a flagged reading without a probability is in the queue, last.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from millrace.functions.machine import FAILURE
from millrace.operators.reports import dispatch_queue
from millrace.operators.scoring import REVIEW_PERCENT

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OPENED, UPDATED, CLOSED, EXPIRED = "opened", "updated", "closed", "expired"
#: Columns of the readings: what a change carries, and the order of a machine's readings.
READING = "machine_id string, failure_probability double, status string, seen timestamp, reading long"
_CHANGE = READING + ", change string"
_STATE = "seen_ms long, reading long, flagged boolean"


class _LatestReading(StatefulProcessor):
    def __init__(self, keep_ms: int, threshold: float):
        self._keep_ms, self._threshold = keep_ms, threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._latest = handle.getValueState("latest", _STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        before = self._latest.get() if self._latest.exists() else None
        newest = None
        for frame in rows:  # batch by batch, however many readings a machine sends
            last = frame.sort_values(["seen", "reading"]).iloc[-1]
            if newest is None or (last.seen, last.reading) > (newest.seen, newest.reading):
                newest = last
        if newest is None:
            return
        at = newest.seen.value // 1_000_000
        if before is not None and (at, newest.reading) <= (before[0], before[1]):
            return
        flagged = newest.status == FAILURE or newest.failure_probability > self._threshold
        was = before is not None and before[2]
        self._latest.update((int(at), int(newest.reading), bool(flagged)))
        self._handle.registerTimer(int(at) + self._keep_ms)
        if flagged or was:
            change = (UPDATED if was else OPENED) if flagged else CLOSED
            yield newest.to_frame().T.assign(change=change)[[c.split()[0] for c in _CHANGE.split(", ")]]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        latest = self._latest.get() if self._latest.exists() else None
        if latest is None or latest[0] + self._keep_ms > expiredTimerInfo.getExpiryTimeInMs():
            return  # a newer reading came meanwhile, with a timer of its own
        self._latest.clear()
        if latest[2]:
            yield pd.DataFrame({"machine_id": [key[0]], "failure_probability": [None], "status": [None],
                                "seen": [pd.Timestamp(latest[0], unit="ms")], "reading": [latest[1]], "change": [EXPIRED]})

    def close(self) -> None:
        pass


def start_queue(
    scored: DataFrame, output: str, checkpoint: str, keep: str = "24 hours", lateness: str = "1 hour",
    threshold: float = REVIEW_PERCENT, interval: str | None = None,
) -> StreamingQuery:
    """Keep the queue of a stream of readings (see ``READING``); changes are written under ``output``.

    An entry expires ``keep`` after its latest reading, by the watermark. Without an interval, take what is
    there and stop.
    """
    spark = scored.sparkSession
    spark.conf.set(_STORE, _ROCKS)
    keep_ms = int(pd.Timedelta(keep).total_seconds() * 1000)
    readings = scored.where("machine_id IS NOT NULL AND seen IS NOT NULL").withWatermark("seen", lateness)
    changes = readings.groupBy("machine_id").transformWithStateInPandas(
        _LatestReading(keep_ms, threshold), _CHANGE, "Update", "EventTime")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output}/batch={number}")

    writer = changes.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def open_queue(spark: SparkSession, output: str) -> DataFrame:
    """The machines that are open after all changes so far, ranked."""
    changes = spark.read.schema(_CHANGE + ", batch long").option("basePath", output).parquet(f"{output}/batch=*")
    last = changes.groupBy("machine_id").agg(F.max_by(F.struct(*changes.columns), F.struct("batch", "seen", "reading")).alias("c"))
    standing = last.select("c.*").where(F.col("change").isin(OPENED, UPDATED))
    return dispatch_queue(standing.drop("change", "batch"))


def latest_flagged(readings: DataFrame, threshold: float = REVIEW_PERCENT) -> DataFrame:
    """The same queue from a whole table of readings."""
    known = readings.where("machine_id IS NOT NULL AND seen IS NOT NULL")
    last = known.groupBy("machine_id").agg(F.max_by(F.struct(*known.columns), F.struct("seen", "reading")).alias("r")).select("r.*")
    return dispatch_queue(last.where((F.col("status") == FAILURE) | (F.col("failure_probability") > threshold)))
