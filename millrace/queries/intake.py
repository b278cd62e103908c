"""Sources, sinks, schema operators and row-level functions of the order extract."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.calendar import monday_based_weekday, parse_timestamp, weekend_flag
from millrace.functions.numeric import round_half_even
from millrace.functions.text import bracketed_name, spaced_name, zip_code
from millrace.operators.columns import drop_mostly_null, enforce_types, insert_column, rename_all
from millrace.operators.profile import null_profile, preview, row_lineage, schema_report
from millrace.plans.stand_ins import ACCENTED_COUNTRY
from millrace.plans.star import (
    CUSTOMER_TYPES, LOOKUP_KEYS, ORDER_TYPES, REPORTING_COLUMNS, TEMPORAL_COLUMNS, TRAINING_COLUMNS,
    VALID_CUSTOMERS, VALID_FACTS,
    country_rows, training_view,
)
from millrace.plans.telemetry import KEY_NAMES
from millrace.queries.registry import query
from millrace.sources.delimited import (
    LATIN_1, read_delimited, read_delimited_text, write_delimited,
)
from millrace.sources.staging import new_location
from millrace.sources.tables import (
    TABLE_LAYOUTS, create_catalog, export_tables, load_delimited_tables, named_table, wide_keys,
)

_KEYS = ["order_id", "order_item_id"]


@query("s1_latin1_scan", """
SELECT order_country, customer_segment, count(*) AS rows, count(DISTINCT product_name) AS products,
  round_even(sum(order_item_total) * 10000, 0) / 10000 AS total
FROM {{extract}} GROUP BY ALL""")
def latin1_scan(w):
    path = new_location(w.spark, "latin1")
    extract = w.extract_once
    write_delimited(extract, path, LATIN_1, compression="gzip")
    rows = rename_all(read_delimited(w.spark, path, extract.schema, LATIN_1), spaced_name)
    return rows.groupBy("order_country", "customer_segment").agg(
        F.count("*").alias("rows"), F.count_distinct("product_name").alias("products"),
        round_half_even(F.sum("order_item_total"), 4).alias("total"))


@query("s2_utf8_scan", """
SELECT udi, machine_type, air_temperature_k, torque_nm, tool_wear_min FROM {{recorded}}""")
def utf8_scan(w):
    path = new_location(w.spark, "utf8")
    raw = w.telemetry_raw
    write_delimited(raw, path)
    rows = rename_all(read_delimited(w.spark, path, raw.schema), bracketed_name)
    return rows.withColumnsRenamed(KEY_NAMES).select(
        "udi", "machine_type", "air_temperature_k", "torque_nm", "tool_wear_min")


@query("s3_preview", """
SELECT udi, machine_id, rotational_speed_rpm FROM {{readings}} ORDER BY udi LIMIT 5""")
def first_rows(w):
    return preview(w.readings.select("udi", "machine_id", "rotational_speed_rpm"), ["udi"])


@query("s4_named_table", """
SELECT shipping_mode, count(*) AS rows FROM {{joined}} GROUP BY ALL""")
def scan_named_table(w):
    w.training_once.createOrReplaceTempView("millrace_training_view")
    rows = named_table(w.spark, "millrace_training_view")
    return rows.groupBy("shipping_mode").agg(F.count("*").alias("rows"))


@query("s5_bulk_load", """
SELECT 'dim_customers' AS table_name, count(*) AS rows, sum(customer_id)::DOUBLE AS checksum FROM {{customers}}
UNION ALL SELECT 'dim_products', count(*), sum(product_price::DECIMAL(10,2))::DOUBLE FROM {{products}}
UNION ALL SELECT 'dim_departments', count(*), sum(department_id)::DOUBLE FROM {{departments}}
UNION ALL SELECT 'fact_orders', count(*), sum(order_item_total::DECIMAL(10,2))::DOUBLE FROM {{facts}}""")
def bulk_load(w):
    layouts = {name: wide_keys(layout) for name, layout in TABLE_LAYOUTS.items()}
    paths = export_tables(w.star.tables(), layouts)
    loaded = load_delimited_tables(w.spark, paths, layouts)
    sums = {"dim_customers": "customer_id", "dim_products": "product_price",
            "dim_departments": "department_id", "fact_orders": "order_item_total"}
    parts = [
        loaded[name].agg(F.count("*").alias("rows"), F.sum(c).cast("double").alias("checksum"))
        .select(F.lit(name).alias("table_name"), "rows", "checksum")
        for name, c in sums.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("s7_delimited_sink", """
SELECT order_id, order_item_id, order_profit_capped, profit_margin, delivery_variance_days FROM {{facts}}""")
def delimited_sink(w):
    path = new_location(w.spark, "sink")
    write_delimited(w.star.orders, path)
    rows = read_delimited(w.spark, path, w.star.orders.schema)
    return rows.select(*_KEYS, "order_profit_capped", "profit_margin", "delivery_variance_days")


# The columns of the extract after renaming; dates come as text.
_EXTRACT_TYPES = {
    "order_id": "bigint", "order_item_id": "bigint", "customer_id": "bigint", "customer_segment": "string",
    "customer_city": "string", "customer_state": "string", "customer_country": "string",
    "order_country": "string", "customer_zipcode": "string", "product_card_id": "bigint",
    "product_category_id": "bigint", "category_name": "string", "product_name": "string",
    "product_price": "double", "department_id": "bigint", "department_name": "string",
    "shipping_mode": "string", "order_date_(dateorders)": "string",
    "shipping_date_(dateorders)": "string", "days_for_shipping_(real)": "int", "days_for_shipment_(scheduled)": "int", "order_item_total": "double",
    "order_profit_per_order": "double", "product_description": "string"}


def _each_column(select: str) -> str:
    """``select`` once for each column of the extract: {name} as in Spark, {column} as in the SQL."""
    return "\nUNION ALL ".join(
        select.format(name=name, kind=kind, column=name.replace("_(dateorders)", "").replace("(", "").replace(")", ""))
        for name, kind in _EXTRACT_TYPES.items())


@query("s10_schema_report", _each_column(
    "SELECT '{name}' AS column_name, '{kind}' AS data_type, count({column}) AS non_null FROM {{{{extract}}}}"))
def describe_schema(w):
    return schema_report(rename_all(w.extract, spaced_name))


@query("s11_catalog_views", """
SELECT 'ml_training' AS view_name, count(*) AS rows, sum(order_item_total::DECIMAL(10,2))::DOUBLE AS total,
  sum(order_profit_capped::DECIMAL(10,2))::DOUBLE AS profit FROM {{joined}}
UNION ALL SELECT 'ml_training_temporal', count(*), sum(order_item_total::DECIMAL(10,2))::DOUBLE,
  sum(profit_margin::DECIMAL(10,2))::DOUBLE FROM {{joined}}
UNION ALL SELECT 'visual', count(*), sum(order_item_total::DECIMAL(10,2))::DOUBLE,
  sum(order_id)::DOUBLE FROM {{joined}}""")
def catalog_views(w):
    views = {"ml_training": TRAINING_COLUMNS, "ml_training_temporal": TEMPORAL_COLUMNS,
             "visual": REPORTING_COLUMNS}
    sums = {"ml_training": "order_profit_capped", "ml_training_temporal": "profit_margin",
            "visual": "order_id"}
    layouts = {name: wide_keys(layout) for name, layout in TABLE_LAYOUTS.items()}
    create_catalog(w.spark, "millrace_catalog", w.star.tables(), views, layouts, LOOKUP_KEYS,
                   [VALID_FACTS, VALID_CUSTOMERS])
    parts = [
        named_table(w.spark, f"millrace_catalog.{name}").agg(
            F.count("*").alias("rows"), F.sum("order_item_total").cast("double").alias("total"),
            F.sum(c).cast("double").alias("profit"))
        .select(F.lit(name).alias("view_name"), "rows", "total", "profit")
        for name, c in sums.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("p1_country_filter", """
SELECT order_id, order_item_id, order_country, customer_state FROM {{extract}}
WHERE order_country = 'México'""")
def country_filter(w):
    rows = country_rows(w.extract, ACCENTED_COUNTRY)
    return rename_all(rows, spaced_name).select(*_KEYS, "order_country", "customer_state")


@query("p2_valid_rows", """
SELECT order_id, order_item_id, customer_state, days_for_shipping_real FROM {{cleaned}}
WHERE days_for_shipping_real >= 0 AND customer_state IS NOT NULL""")
def valid_rows(w):
    kept = (F.col("`days_for_shipping_(real)`") >= 0) & F.col("customer_state").isNotNull()
    return w.cleaned.filter(kept).select(
        *_KEYS, "customer_state", F.col("`days_for_shipping_(real)`").alias("days_for_shipping_real"))


@query("p3_spaced_names", """
SELECT order_id, shipping_mode, days_for_shipping_real AS "days_for_shipping_(real)",
  days_for_shipment_scheduled AS "days_for_shipment_(scheduled)" FROM {{extract}}""")
def spaced_names(w):
    return rename_all(w.extract, spaced_name).select(
        "order_id", "shipping_mode", "days_for_shipping_(real)", "days_for_shipment_(scheduled)")


@query("p4_bracketed_names", """
SELECT udi, machine_id AS product_id, machine_type AS type, air_temperature_k, rotational_speed_rpm
FROM {{readings}}""")
def bracketed_names(w):
    return rename_all(w.telemetry_raw, bracketed_name).select(
        "udi", "product_id", "type", "air_temperature_k", "rotational_speed_rpm")


@query("p5_renamed_keys", """
SELECT machine_id, machine_type, count(*) AS rows FROM {{readings}} GROUP BY ALL""")
def renamed_keys(w):
    rows = rename_all(w.telemetry_raw, bracketed_name).withColumnsRenamed(KEY_NAMES)
    return rows.groupBy("machine_id", "machine_type").agg(F.count("*").alias("rows"))


@query("p6_projection", """
SELECT customer_id, customer_segment, customer_city, customer_state, customer_country,
  customer_zipcode FROM {{cleaned}}""")
def projection(w):
    return w.cleaned.select(*CUSTOMER_TYPES)


@query("p7_dropped_columns", """
SELECT * EXCLUDE (udi, machine_id, ts, twf, hdf, pwf, osf, rnf) FROM {{recorded}}""")
def dropped_columns(w):
    rows = rename_all(w.telemetry_raw, bracketed_name).withColumnsRenamed(KEY_NAMES)
    return rows.drop("udi", "machine_id", "ts", "twf", "hdf", "pwf", "osf", "rnf")


@query("p8_inserted_column", """
SELECT udi, machine_id, process_temperature_k - air_temperature_k AS temp_difference_k FROM {{readings}}""")
def inserted_column(w):
    stress = F.col("process_temperature_k") - F.col("air_temperature_k")
    rows = insert_column(w.readings, 5, "temp_difference_k", stress)
    assert rows.columns[5] == "temp_difference_k"
    return rows.select("udi", "machine_id", "temp_difference_k")


@query("p9_mostly_null_columns", "SELECT column_name, rows, missing FROM (" + _each_column(
    "SELECT '{name}' AS column_name, count(*) AS rows, count(*) - count({column}) AS missing FROM {{{{extract}}}}")
    + ") WHERE NOT (missing > 0 AND missing / rows >= 0.8)")
def without_mostly_null(w):
    kept = drop_mostly_null(rename_all(w.extract, spaced_name))
    nulls = [F.struct(F.lit(c).alias("column_name"), F.count("*").alias("rows"),
                      F.count_if(F.col(f"`{c}`").isNull()).alias("missing")) for c in kept.columns]
    return kept.agg(F.array(*nulls).alias("rows")).select(F.inline("rows"))


@query("p10_enforced_types", """
SELECT order_id::BIGINT AS order_id, order_item_id::BIGINT AS order_item_id,
  order_item_total::DOUBLE AS order_item_total, days_for_shipping_real::INT AS days_for_shipping_real,
  order_date AS order_date_dateorders FROM {{cleaned}}""")
def enforced_types(w):
    path = new_location(w.spark, "untyped")
    write_delimited(w.cleaned.withColumnsRenamed({
        "days_for_shipping_(real)": "days_for_shipping_real",
        "order_date_(dateorders)": "order_date_dateorders"}), path, compression="gzip")
    chosen = ["order_id", "order_item_id", "order_item_total", "days_for_shipping_real",
              "order_date_dateorders"]
    return enforce_types(read_delimited_text(w.spark, path), {c: ORDER_TYPES[c] for c in chosen},
                         strict=True)


@query("f1_zip_codes", """
SELECT order_id, order_item_id, customer_zipcode FROM {{cleaned}}""")
def zip_codes(w):
    rows = rename_all(w.extract, spaced_name)
    return rows.select(*_KEYS, zip_code(F.col("customer_zipcode")).alias("customer_zipcode"))


@query("f1_zip_codes_parity", """
SELECT order_id, order_item_id, lpad(replace(z, '.0', ''),
  greatest(5, length(replace(z, '.0', '')))::INT, '0') AS customer_zipcode
FROM (SELECT order_id, order_item_id, coalesce(customer_zipcode, 'nan') AS z FROM {{extract}})""")
def zip_codes_parity(w):
    rows = rename_all(w.extract, spaced_name)
    return rows.select(*_KEYS, zip_code(F.col("customer_zipcode"), parity=True).alias("customer_zipcode"))


@query("f2_parsed_dates", """
SELECT order_id, order_item_id, order_date, shipping_date FROM {{extract}}""")
def parsed_dates(w):
    rows = rename_all(w.extract, spaced_name)
    return rows.select(*_KEYS,
                       parse_timestamp(F.col("`order_date_(dateorders)`")).alias("order_date"),
                       parse_timestamp(F.col("`shipping_date_(dateorders)`")).alias("shipping_date"))


@query("f3_year_and_month", """
SELECT order_id, order_item_id, year(order_date)::INT AS order_year, month(order_date)::INT AS order_month
FROM {{extract}}""")
def year_and_month(w):
    ordered = parse_timestamp(F.col("`order date (DateOrders)`"))
    return w.extract.select(F.col("`Order Id`").alias("order_id"), F.col("`Order Item Id`").alias("order_item_id"),
                            F.year(ordered).alias("order_year"), F.month(ordered).alias("order_month"))


@query("f4_weekday", """
SELECT order_id, order_item_id, (isodow(order_date) - 1)::INT AS order_day_of_week FROM {{extract}}""")
def weekday(w):
    ordered = parse_timestamp(F.col("`order date (DateOrders)`"))
    return w.extract.select(F.col("`Order Id`").alias("order_id"), F.col("`Order Item Id`").alias("order_item_id"),
                            monday_based_weekday(ordered).alias("order_day_of_week"))


@query("f5_weekend_flag", """
SELECT order_day_of_week, is_weekend, count(*) AS rows FROM {{cleaned}} GROUP BY ALL""")
def weekend(w):
    rows = w.cleaned.withColumn("is_weekend", weekend_flag(F.col("order_day_of_week")))
    return rows.groupBy("order_day_of_week", "is_weekend").agg(F.count("*").alias("rows"))


@query("f6_rounding", """
SELECT order_id, order_item_id, round_even(order_item_total * 100, 0) / 100 AS total_2,
  round_even(order_item_total * 1000, 0) / 1000 AS total_3,
  round_even(order_profit_per_order * 100, 0) / 100 AS profit_2 FROM {{extract}}""")
def rounding(w):
    rows = rename_all(w.extract, spaced_name)
    return rows.select(*_KEYS, round_half_even(F.col("order_item_total"), 2).alias("total_2"),
                       round_half_even(F.col("order_item_total"), 3).alias("total_3"),
                       round_half_even(F.col("order_profit_per_order"), 2).alias("profit_2"))


@query("a7_null_profile", _each_column(
    "SELECT '{name}' AS column_name, count(*) - count({column}) AS null_count, "
    "(count(*) - count({column})) / count(*) AS null_ratio FROM {{{{extract}}}}"))
def nulls(w):
    return null_profile(rename_all(w.extract, spaced_name))


@query("a19_row_lineage", """
SELECT 'extract' AS step, count(*) AS rows, 24 AS columns FROM {{extract}}
UNION ALL SELECT 'one country', count(*), 24 FROM {{extract}} WHERE order_country = 'México'
UNION ALL SELECT 'distinct orders', count(*), 19 FROM {{facts}}
UNION ALL SELECT 'training view', count(*), 11 FROM {{joined}}""")
def lineage(w):
    return row_lineage({
        "extract": w.extract, "one country": country_rows(w.extract, ACCENTED_COUNTRY),
        "distinct orders": w.star.orders, "training view": training_view(w.star)})
