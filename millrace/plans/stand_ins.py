"""Extracts with the layout of the jobs' inputs, derived from the benchmark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions.machine import (
    heat_dissipation_failure, overstrain_failure, power_failure,
)
from millrace.operators.joins import BROADCAST_BYTES, lookup_join, measured_bytes

# Order country written with an accent, to exercise non-ASCII text.
ACCENTED_COUNTRY = "México"


def order_extract(tables) -> DataFrame:
    """One row per order line with the headers and text dates of an ERP extract.

    ``tables(name)`` returns a benchmark table. Every table joined in is a lookup by its
    unique key, so hot customers, parts and suppliers are handled by the join operator.
    """
    places = lookup_join(
        tables("nation"), tables("region"), ("n_regionkey", "r_regionkey")
    ).select("n_nationkey", "n_name", "r_name")
    customers = lookup_join(
        tables("customer").select("c_custkey", "c_mktsegment", "c_nationkey"),
        places, ("c_nationkey", "n_nationkey"),
    ).drop("c_nationkey")
    placed = tables("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    orders = lookup_join(placed, customers, ("o_custkey", "c_custkey"))
    # Orders too large on their own are so with their customers; measure the join only if not.
    placed_size = measured_bytes(placed)
    orders_size = placed_size if placed_size > BROADCAST_BYTES else None
    parts = tables("part").select("p_partkey", "p_size", "p_type", "p_name", "p_retailprice")
    suppliers = tables("supplier").select("s_suppkey", "s_name")
    lines = tables("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount",
        "l_shipdate")
    joined = lookup_join(lines, orders, ("l_orderkey", "o_orderkey"), size=orders_size)
    joined = lookup_join(joined, parts, ("l_partkey", "p_partkey"), hot_in=lines)
    joined = lookup_join(joined, suppliers, ("l_suppkey", "s_suppkey"), hot_in=lines)

    priority = F.col("o_orderpriority")
    mode = (F.when(priority == "1-URGENT", "Same Day").when(priority == "2-HIGH", "First Class")
            .when(priority == "3-MEDIUM", "Second Class").otherwise("Standard Class"))
    scheduled = (F.when(priority == "1-URGENT", 0).when(priority == "2-HIGH", 1)
                 .when(priority == "3-MEDIUM", 2).otherwise(4))
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    country = F.when(F.col("r_name") == "AMERICA", ACCENTED_COUNTRY).otherwise(F.col("r_name"))
    city = F.concat("n_name", F.lit("-"), (F.col("o_custkey") % 20).cast("string"))
    return joined.select(
        F.col("l_orderkey").alias("Order Id"),
        F.col("l_linenumber").cast("bigint").alias("Order Item Id"),
        F.col("o_custkey").alias("Customer Id"),
        F.col("c_mktsegment").alias("Customer Segment"),
        city.alias("Customer City"),
        F.col("n_name").alias("Customer State"),
        F.col("r_name").alias("Customer Country"),
        F.concat(F.col("o_custkey").cast("string"), F.lit(".0")).alias("Customer Zipcode"),
        F.col("l_partkey").alias("Product Card Id"),
        F.col("p_size").cast("bigint").alias("Product Category Id"),
        F.col("p_type").alias("Category Name"),
        F.col("p_name").alias("Product Name"),
        F.col("p_retailprice").alias("Product Price"),
        F.col("l_suppkey").alias("Department Id"),
        F.col("s_name").alias("Department Name"),
        mode.alias("Shipping Mode"),
        F.date_format("o_orderdate", "M/d/yyyy H:mm").alias("order date (DateOrders)"),
        F.date_format("l_shipdate", "M/d/yyyy H:mm").alias("shipping date (DateOrders)"),
        F.date_diff("l_shipdate", "o_orderdate").alias("Days for shipping (real)"),
        scheduled.alias("Days for shipment (scheduled)"),
        (price * (1 - discount)).alias("Order Item Total"),
        (price * (0.2 - 3 * discount)).alias("Order Profit Per Order"),
        country.alias("Order Country"),
        F.when(F.col("l_orderkey") % 10 == 0, "x").alias("Product Description"),
    )


def telemetry_extract(events: DataFrame, gaps: bool = True) -> DataFrame:
    """One reading per event with bracketed headers; ``gaps`` leaves some torques missing."""
    event = F.col("event_id")
    machine_type = F.when(event % 10 < 6, "L").when(event % 10 < 9, "M").otherwise("H")
    readings = events.select(
        "event_id", "ts", machine_type.alias("kind"),
        (295.3 + ((event * 37) % 92).cast("double") / 10).alias("air"),
        (8.4 + ((event * 53) % 40).cast("double") / 10).alias("gap"),
        (1168 + F.floor(F.col("value") * 3.5).cast("int")).alias("rpm"),
        (28 + ((event * 7919) % 241).cast("double") / 10).alias("torque"),
        ((event * 31) % 254).cast("int").alias("wear"),
    )
    air, rpm, torque, wear = F.col("air"), F.col("rpm"), F.col("torque"), F.col("wear")
    process = air + F.col("gap")
    modes = readings.withColumns({
        "process": process,
        "TWF": F.when(wear.between(200, 240) & (event % 20 == 0), 1).otherwise(0),
        "HDF": heat_dissipation_failure(process, air, rpm),
        "PWF": power_failure(torque, rpm),
        "OSF": overstrain_failure(wear, torque, F.col("kind")),
        "RNF": F.when(event % 1000 == 7, 1).otherwise(0),
    })
    recorded = F.when((event + 1) % 17 != 0, torque) if gaps else torque
    return modes.select(
        (event + 1).alias("UDI"),
        F.concat("kind", F.lpad(event.cast("string"), 9, "0")).alias("Product ID"),
        F.col("kind").alias("Type"),
        air.alias("Air temperature [K]"),
        F.col("process").alias("Process temperature [K]"),
        rpm.alias("Rotational speed [rpm]"),
        recorded.alias("Torque [Nm]"),
        wear.alias("Tool wear [min]"),
        F.greatest("HDF", "PWF", "OSF").alias("Machine failure"),
        "TWF", "HDF", "PWF", "OSF", "RNF", "ts",
    )
