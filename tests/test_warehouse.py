"""The load of a folder: what it writes, on a few hand-made rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.plans import warehouse as warehouses
from millrace.plans.star import clean_extract
from millrace.plans.warehouse import Warehouse
from millrace.queries.evaluation import predictions
from millrace.queries.intake import scan_named_table


@pytest.fixture()
def warehouse(spark, tmp_path):
    day = lambda n: datetime(2024, 1, 1 + n % 28)
    tables = {
        "region": ([(0, "AMERICA"), (1, "ASIA")], "r_regionkey int, r_name string"),
        "nation": ([(0, "PERU", 0), (1, "CHINA", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(i, f"s{i % 2}", i % 2) for i in range(5)], "c_custkey long, c_mktsegment string, c_nationkey int"),
        "orders": ([(i, i % 5, day(i), ("1-URGENT", "2-HIGH", None)[i % 3]) for i in range(20)],
                   "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string"),
        "part": ([(i, i, f"t{i % 3}", f"p{i}", 10.0 + i) for i in range(4)],
                 "p_partkey long, p_size int, p_type string, p_name string, p_retailprice double"),
        "supplier": ([(i, f"d{i}") for i in range(3)], "s_suppkey long, s_name string"),
        "lineitem": ([(i % 20, i // 20, i % 4, i % 3, 100.0 + i, 0.01 * (i % 7), day(i + 2)) for i in range(60)],
                     "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, "
                     "l_discount double, l_shipdate timestamp_ntz"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return Warehouse(spark, str(tmp_path))


def _rows(frame):
    return sorted(map(str, frame.collect()))


def test_cleaned_orders_need_no_stored_extract(warehouse):
    cleaned = warehouse.cleaned
    assert "extract" not in vars(warehouse)
    assert cleaned.columns == clean_extract(warehouse.extract).columns
    assert "product_description" not in cleaned.columns
    assert _rows(cleaned) == _rows(clean_extract(warehouse.extract))


def test_a_named_view_of_one_pass_is_not_stored_first(warehouse):
    counts = _rows(scan_named_table(warehouse))
    assert "training" not in vars(warehouse)
    assert counts == _rows(warehouse.training.groupBy("shipping_mode").count().withColumnRenamed("count", "rows"))


def test_predictions_join_the_star_once(warehouse):
    rows = predictions(warehouse)
    assert rows.count() == warehouse.training.count() > 0
    assert not any("dim_" in f or "distinct_orders" in f for f in rows.inputFiles())


def test_the_vault_job_reads_events_dealt_out_to_all_cores(spark, tmp_path, monkeypatch):
    rows = spark.range(4000).select(F.col("id").alias("event_id"), F.lit(datetime(2024, 1, 1)).alias("ts"),
                                    (F.col("id") % 300).cast("double").alias("value"))
    rows = rows.unionByName(rows.where("event_id < 3")).unionByName(rows.limit(1).withColumn("event_id", F.lit(None).cast("long")))
    rows.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(warehouses, "vault_job", lambda raw, **_: raw)  # the rows that the job is given
    warehouse = Warehouse(spark, str(tmp_path))
    sizes = [r[0] for r in warehouse.vault.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(sizes) >= spark.sparkContext.defaultParallelism and max(sizes) < 2 * 4004 / len(sizes)
    assert _rows(warehouse.vault) == _rows(warehouse.telemetry_raw)
