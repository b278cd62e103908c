"""The kept queue is the batch queue, also after a stop; entries close, and expire by event time."""

import datetime

from pyspark.sql import functions as F

from millrace.functions.machine import FAILURE, NORMAL
from millrace.streaming import queue

BEGIN = datetime.datetime(2024, 1, 1)


def readings(spark, first, last):
    """Every second of one day a machine sends; a third of all readings come from one of them."""
    i = F.col("id")
    return spark.range(first, last).select(
        F.when(i % 3 == 0, "m0").otherwise(F.concat(F.lit("m"), i % 101)).alias("machine_id"),
        F.when(i % 41 > 0, (i * 37 % 1000) / 10.0).alias("failure_probability"),
        F.when(i * 37 % 1000 > 800, FAILURE).otherwise(NORMAL).alias("status"),
        (F.lit(BEGIN) + F.make_dt_interval(secs=i / 4)).alias("seen"), i.alias("reading"))


def run(spark, folder, **options):
    rows = spark.readStream.schema(queue.READING).parquet(f"{folder}/in")
    stream = queue.start_queue(rows, f"{folder}/out", f"{folder}/progress", **options)
    stream.awaitTermination()
    assert stream.exception() is None


def standing(frame):
    return [tuple(r) for r in frame.select("machine_id", "failure_probability", "status", "reading", "queue_rank").collect()]


def test_stop_and_restart_give_the_batch_queue(spark, tmp_path):
    whole = readings(spark, 0, 3000)
    for upto, part in ((1500, readings(spark, 0, 1500)), (3000, readings(spark, 1500, 3000))):
        part.write.mode("append").parquet(f"{tmp_path}/in")
        run(spark, tmp_path)
        want = standing(queue.latest_flagged(whole.where(F.col("reading") < upto)))
        assert standing(queue.open_queue(spark, f"{tmp_path}/out")) == want and len(want) > 20
    # Older readings and those of no machine change nothing.
    late = readings(spark, 2000, 2400).withColumn("status", F.lit(FAILURE))
    late.unionByName(late.withColumn("machine_id", F.lit(None).cast("string"))).write.mode("append").parquet(f"{tmp_path}/in")
    run(spark, tmp_path)
    assert standing(queue.open_queue(spark, f"{tmp_path}/out")) == want


def test_entries_close_and_expire(spark, tmp_path):
    def send(*rows):
        frame = spark.createDataFrame([(m, p, s, BEGIN + datetime.timedelta(minutes=t), n) for m, p, s, t, n in rows], queue.READING)
        frame.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        run(spark, tmp_path, keep="30 minutes", lateness="1 minute")
        return [r.machine_id for r in queue.open_queue(spark, f"{tmp_path}/out").collect()]

    assert send(("a", 90.0, FAILURE, 0, 1), ("b", 45.0, NORMAL, 0, 2), ("c", 10.0, NORMAL, 0, 3)) == ["a", "b"]
    assert send(("b", 5.0, NORMAL, 10, 4), ("c", 95.0, FAILURE, 10, 5), ("d", None, FAILURE, 10, 6)) == ["c", "a", "d"]
    assert send(("d", 60.0, NORMAL, 35, 7)) == ["c", "d"]  # a was last seen 35 minutes ago
    assert send(("e", 1.0, NORMAL, 50, 8)) == ["d"]
    changes = spark.read.parquet(f"{tmp_path}/out")
    assert {(r.machine_id, r.change) for r in changes.collect()} == {
        ("a", "opened"), ("b", "opened"), ("b", "closed"), ("c", "opened"), ("d", "opened"), ("d", "updated"),
        ("a", "expired"), ("c", "expired")}
