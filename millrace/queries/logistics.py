"""Star schema, joins, integrity, quantiles and rollups of orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.calendar import delivery_variance
from millrace.functions.numeric import item_quantity, profit_margin, round_half_even
from millrace.operators.cleaning import fit_clip
from millrace.operators.colocated import store_colocated
from millrace.operators.features import LABEL, fit_wide_indicators
from millrace.operators.integrity import (
    duplicate_keys, one_row_per_key, orphan_counts, orphan_rows,
)
from millrace.operators.joins import lookup_join
from millrace.operators.profile import quantile_table
from millrace.operators.reports import (
    delay_by_mode, delay_calendar, risk_matrix, state_rollup, variance_extremes,
)
from millrace.plans.star import (
    CUSTOMER_TYPES, DEPARTMENT_TYPES, ORDER_TYPES, PRODUCT_TYPES, TABLE_NAMES, dimension,
    reporting_view, star_join, temporal_view, training_view,
)
from millrace.queries.registry import query

_KEYS = ["order_id", "order_item_id"]


def _rounded(rows, digits: int, *columns: str):
    return rows.withColumns({c: round_half_even(F.col(c), digits) for c in columns})


@query("a1_state_rollup", """
SELECT customer_state, count(order_id) AS total_orders,
  round_even(avg(delivery_variance_days) * 1000000, 0) / 1000000 AS avg_delay_days,
  round_even(avg(delivery_variance_days * 24) * 1000000, 0) / 1000000 AS avg_delay_hours,
  round_even(sum(order_profit_capped) * 10000, 0) / 10000 AS total_profit
FROM {{joined}} GROUP BY customer_state""")
def rollup_by_state(w):
    rows = _rounded(state_rollup(star_join(w.star)), 6, "avg_delay_days", "avg_delay_hours")
    return _rounded(rows, 4, "total_profit")


@query("a2_variance_extremes", """
SELECT min(delivery_variance_days) AS max_early_arrival_days,
  max(delivery_variance_days) AS max_late_delay_days,
  round_even(avg(delivery_variance_days) * 1000000, 0) / 1000000 AS mean_variance,
  round_even(stddev_pop(delivery_variance_days) * 1000000, 0) / 1000000 AS standard_deviation
FROM {{joined}}""")
def extremes(w):
    return _rounded(variance_extremes(reporting_view(w.star)), 6, "mean_variance", "standard_deviation")


_COUNT_TABLES = """
SELECT 'dim_customers' AS table_name, count(*) AS rows FROM (SELECT DISTINCT customer_id, customer_segment,
  customer_city, customer_state, customer_country, customer_zipcode FROM {{cleaned}})
UNION ALL SELECT 'dim_products', count(*) FROM (SELECT DISTINCT product_card_id, product_category_id,
  category_name, product_name, product_price FROM {{cleaned}})
UNION ALL SELECT 'dim_departments', count(*) FROM (SELECT DISTINCT department_id, department_name FROM {{cleaned}})
UNION ALL SELECT 'fact_orders', count(*) FROM {{orders_distinct}}"""


@query("a3_distinct_rows", _COUNT_TABLES)
def distinct_rows(w):
    named = w.cleaned.withColumnsRenamed(TABLE_NAMES)
    tables = {
        "dim_customers": dimension(w.cleaned, CUSTOMER_TYPES, unique=False),
        "dim_products": dimension(w.cleaned, PRODUCT_TYPES, unique=False),
        "dim_departments": dimension(w.cleaned, DEPARTMENT_TYPES, unique=False),
        "fact_orders": named.select(*ORDER_TYPES).distinct(),
    }
    counts = [t.agg(F.count("*").alias("rows")).select(F.lit(n).alias("table_name"), "rows")
              for n, t in tables.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


@query("a4_profit_percentiles", """
SELECT 'order_profit_per_order' AS column_name, 0.01::DOUBLE AS probability,
  round_even(quantile_cont(order_profit_per_order, 0.01) * 1000000, 0) / 1000000 AS value FROM {{cleaned}}
UNION ALL SELECT 'order_profit_per_order', 0.99::DOUBLE,
  round_even(quantile_cont(order_profit_per_order, 0.99) * 1000000, 0) / 1000000 FROM {{cleaned}}""")
def profit_percentiles(w):
    return _rounded(quantile_table(w.cleaned, ["order_profit_per_order"], [0.01, 0.99]), 6, "value")


@query("a20_delay_by_mode", """
SELECT shipping_mode, count(*) AS orders,
  round_even(avg(delivery_variance_days) * 1000000, 0) / 1000000 AS avg_delay_days
FROM {{joined}} GROUP BY ALL""")
def mode_delays(w):
    return _rounded(delay_by_mode(reporting_view(w.star)), 6, "avg_delay_days")


@query("a21_delay_calendar", """
SELECT order_month, order_day_of_week, count(*) AS orders,
  round_even(avg(delivery_variance_days) * 1000000, 0) / 1000000 AS avg_delay_days
FROM {{joined}} GROUP BY ALL""")
def calendar_delays(w):
    return _rounded(delay_calendar(reporting_view(w.star)), 6, "avg_delay_days")


@query("a22_risk_matrix", """
SELECT customer_state, customer_segment, count(*) AS orders,
  count_if(delivery_variance_days > 0)::BIGINT AS late_orders,
  round_even(coalesce(sum(CASE WHEN delivery_variance_days > 0 THEN order_profit_capped END), 0.0) * 10000, 0)
    / 10000 AS profit_at_risk
FROM {{joined}} GROUP BY customer_state, customer_segment""")
def risks(w):
    return _rounded(risk_matrix(reporting_view(w.star)), 4, "profit_at_risk")


@query("l1_states_by_orders", """
SELECT customer_state, count(*) AS total_orders FROM {{joined}} GROUP BY ALL
ORDER BY total_orders DESC, customer_state""")
def busiest_states(w):
    return state_rollup(star_join(w.star)).select("customer_state", "total_orders")


@query("l3_first_orders", """
SELECT order_id, order_item_id, customer_id, product_card_id, order_item_total FROM {{facts}}
ORDER BY order_id, order_item_id, customer_id, product_card_id, order_item_total LIMIT 20""")
def first_orders(w):
    chosen = [*_KEYS, "customer_id", "product_card_id", "order_item_total"]
    return w.star.orders.select(*chosen).orderBy(*chosen).limit(20)


@query("f7_clipped_profit", """
SELECT order_id, order_item_id, order_profit_per_order, order_profit_capped FROM {{capped}}""")
def clipped_profit(w):
    rows = w.star.distinct
    bounds = fit_clip(rows, "order_profit_per_order")
    return bounds.apply(rows, into="order_profit_capped").select(
        *_KEYS, "order_profit_per_order", "order_profit_capped")


@query("f8_item_quantity", """
SELECT order_id, order_item_id,
  CASE WHEN product_price > 0 THEN trunc(order_item_total / product_price)::INT ELSE 1 END AS item_quantity
FROM {{cleaned}}""")
def quantities(w):
    return w.cleaned.select(
        *_KEYS, item_quantity(F.col("order_item_total"), F.col("product_price")).alias("item_quantity"))


@query("f9_profit_margin", """
SELECT order_id, order_item_id, CASE WHEN order_item_total > 0
  THEN round_even(order_profit_capped / order_item_total * 100, 0) / 100 ELSE 0.0 END::DOUBLE AS profit_margin
FROM {{capped}}""")
def margins(w):
    return w.star.orders.select(
        *_KEYS, profit_margin(F.col("order_profit_capped"), F.col("order_item_total")).alias("profit_margin"))


@query("f10_delivery_variance", """
SELECT order_id, order_item_id, days_for_shipping_real - days_for_shipment_scheduled AS delivery_variance_days
FROM {{cleaned}}""")
def variances(w):
    real, scheduled = F.col("`days_for_shipping_(real)`"), F.col("`days_for_shipment_(scheduled)`")
    return w.cleaned.select(*_KEYS, delivery_variance(real, scheduled).alias("delivery_variance_days"))


@query("f12_delay_hours", """
SELECT customer_state, round_even(avg(delivery_variance_days * 24) * 1000000, 0) / 1000000 AS avg_delay_hours
FROM {{joined}} GROUP BY ALL""")
def delay_hours(w):
    rows = star_join(w.star).groupBy("customer_state").agg(
        F.avg(F.col("delivery_variance_days") * 24).alias("avg_delay_hours"))
    return _rounded(rows, 6, "avg_delay_hours")


@query("j1_training_view", """
SELECT shipping_mode, customer_segment, customer_city, customer_state, category_name, product_price,
  department_name, days_for_shipment_scheduled, delivery_variance_days, order_item_total, order_profit_capped
FROM {{joined}}""")
def base_view(w):
    return training_view(w.star)


@query("j2_temporal_view", """
SELECT shipping_mode, customer_segment, customer_city, customer_state, category_name, product_price,
  department_name, days_for_shipment_scheduled, delivery_variance_days, order_item_total, order_profit_capped,
  order_month, order_day_of_week, is_weekend, item_quantity, profit_margin
FROM {{joined}}""")
def with_time(w):
    return temporal_view(w.star)


@query("j3_reporting_view", """
SELECT order_id, shipping_mode, order_date_dateorders, shipping_date_dateorders, days_for_shipment_scheduled,
  days_for_shipping_real, delivery_variance_days, customer_segment, customer_city, customer_state, category_name,
  product_price, department_name, order_item_total, order_profit_capped, order_year, order_month,
  order_day_of_week, is_weekend, item_quantity, profit_margin
FROM {{joined}}""")
def for_reports(w):
    return reporting_view(w.star)


@query("j4_customer_rollup", """
SELECT customer_state, count(order_id) AS total_orders,
  round_even(avg(delivery_variance_days) * 1000000, 0) / 1000000 AS avg_delay_days,
  round_even(avg(delivery_variance_days * 24) * 1000000, 0) / 1000000 AS avg_delay_hours,
  round_even(sum(order_profit_capped) * 10000, 0) / 10000 AS total_profit
FROM {{facts}} JOIN {{customers}} USING (customer_id) GROUP BY customer_state""")
def customer_rollup(w):
    joined = lookup_join(w.star.orders, w.star.customers, "customer_id", size=w.star.sizes["dim_customers"])
    rows = _rounded(state_rollup(joined), 6, "avg_delay_days", "avg_delay_hours")
    return _rounded(rows, 4, "total_profit")


@query("j4_colocated_join", """
SELECT order_id, order_item_id, customer_id, order_profit_capped, customer_segment, customer_city, customer_state
FROM {{facts}} JOIN {{customers}} USING (customer_id)""")
def colocated_orders(w):
    stored = store_colocated(w.star.orders, w.star.customers, "customer_id")
    return stored.join().select("order_id", "order_item_id", "customer_id", "order_profit_capped", "customer_segment",
                                "customer_city", "customer_state")


@query("j5_paired_rows", """
SELECT f.order_id, f.order_item_id, f.item_quantity, f.order_item_total, f.product_price FROM (
  SELECT order_id, order_item_id, order_item_total, product_price,
    CASE WHEN product_price > 0 THEN trunc(order_item_total / product_price)::INT ELSE 1 END AS item_quantity
  FROM {{orders_distinct}}) f""")
def paired_rows(w):
    # The price travels with the row until the quantity is known; no positional pairing.
    quantity = item_quantity(F.col("order_item_total"), F.col("product_price"))
    return w.star.distinct.select(*_KEYS, quantity.alias("item_quantity"), "order_item_total", "product_price")


@query("j6_orphan_rows", """
SELECT order_id, order_item_id, customer_id FROM {{facts}}
WHERE customer_id NOT IN (SELECT customer_id FROM {{customers}} WHERE customer_state <> 'NATION_7')""")
def orphans(w):
    partial = w.star.customers.filter("customer_state <> 'NATION_7'")
    return orphan_rows(w.star.orders, partial, "customer_id").select(*_KEYS, "customer_id")


@query("j6_orphan_counts", """
SELECT 'customer_id' AS foreign_key, count(*) AS missing_keys, coalesce(sum(n), 0)::BIGINT AS rows FROM (
  SELECT customer_id, count(*) AS n FROM {{facts}} WHERE customer_id NOT IN (SELECT customer_id FROM {{customers}})
  GROUP BY ALL)
UNION ALL SELECT 'product_card_id', count(*), coalesce(sum(n), 0)::BIGINT FROM (
  SELECT product_card_id, count(*) AS n FROM {{facts}}
  WHERE product_card_id NOT IN (SELECT product_card_id FROM {{products}}) GROUP BY ALL)
UNION ALL SELECT 'department_id', count(*), coalesce(sum(n), 0)::BIGINT FROM (
  SELECT department_id, count(*) AS n FROM {{facts}}
  WHERE department_id NOT IN (SELECT department_id FROM {{departments}}) GROUP BY ALL)""")
def orphan_summary(w):
    dims = {"customer_id": w.star.customers, "product_card_id": w.star.products,
            "department_id": w.star.departments}
    parts = [
        orphan_counts(w.star.orders, dim, key).agg(
            F.count("*").alias("missing_keys"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
        .select(F.lit(key).alias("foreign_key"), "missing_keys", "rows")
        for key, dim in dims.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("j7_duplicate_keys", """
SELECT order_id, order_item_id, count(*) AS rows FROM {{facts}} GROUP BY ALL HAVING count(*) > 1""")
def repeated_keys(w):
    return duplicate_keys(w.star.orders, _KEYS)


@query("j7_one_row_per_key", """
SELECT DISTINCT ON (order_id, order_item_id) order_id, order_item_id, customer_id, product_card_id, department_id,
  order_item_total FROM {{facts}}
ORDER BY order_id, order_item_id, customer_id NULLS FIRST, product_card_id NULLS FIRST,
  department_id NULLS FIRST, order_item_total NULLS FIRST""")
def unique_rows(w):
    rows = w.star.orders.select(*_KEYS, "customer_id", "product_card_id", "department_id", "order_item_total")
    return one_row_per_key(rows, _KEYS)


@query("u2_distinct", """
SELECT DISTINCT shipping_mode, customer_segment, customer_state FROM {{joined}}""")
def distinct_combinations(w):
    return training_view(w.star).select("shipping_mode", "customer_segment", "customer_state").distinct()


@query("m1_wide_indicators", """
SELECT product_price, days_for_shipment_scheduled, delivery_variance_days, order_item_total, order_profit_capped,
  shipping_mode = 'Same Day' AS "shipping_mode_Same Day",
  shipping_mode = 'Second Class' AS "shipping_mode_Second Class",
  shipping_mode = 'Standard Class' AS "shipping_mode_Standard Class",
  customer_segment = 'BUILDING' AS "customer_segment_BUILDING",
  customer_segment = 'FURNITURE' AS "customer_segment_FURNITURE",
  customer_segment = 'HOUSEHOLD' AS "customer_segment_HOUSEHOLD",
  customer_segment = 'MACHINERY' AS "customer_segment_MACHINERY"
FROM {{joined}}""")
def wide_indicators(w):
    chosen = w.training.select(
        "shipping_mode", "customer_segment", "product_price", "days_for_shipment_scheduled", LABEL,
        "order_item_total", "order_profit_capped")
    return fit_wide_indicators(chosen, ["shipping_mode", "customer_segment"]).apply(chosen)
