"""Where queries are registered, and the SQL text they share."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from millrace.plans.warehouse import Warehouse, on_warehouse

_MODULES = ("intake", "logistics", "machines", "evaluation", "modelling")
_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_sql: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of the warehouse; ``sql`` may name shared parts as {{part}}."""
    def add(build: Callable[[Warehouse], DataFrame]):
        if name in _queries:
            raise ValueError(f"query {name} is registered twice")
        _queries[name] = on_warehouse(build)
        if sql is not None:
            _sql[name] = with_parts(sql)
        return build

    return add


def with_parts(sql: str) -> str:
    """Prefix a statement with the common table expressions it refers to."""
    chosen: list[str] = []

    def need(text: str) -> None:
        for part, body in PARTS.items():
            if "{{" + part + "}}" in text and part not in chosen:
                need(body)
                chosen.append(part)

    need(sql)

    def plain(text: str) -> str:
        for part in chosen:
            text = text.replace("{{" + part + "}}", part)
        return text.replace("{{", "{").replace("}}", "}")

    if not chosen:
        return sql
    if sql.lstrip().startswith("WITH "):
        sql = f"SELECT * FROM ({sql})"
    return "WITH " + ",\n".join(f"{p} AS ({plain(PARTS[p])})" for p in chosen) + "\n" + plain(sql)


def _load() -> None:
    for module in _MODULES:
        import_module(f"millrace.queries.{module}")


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_queries)


def oracles() -> dict[str, str]:
    _load()
    return dict(_sql)


# SQL of the derived tables, in dependency order.
PARTS = {
    "extract": """
SELECT l_orderkey AS order_id, l_linenumber::BIGINT AS order_item_id,
  c_custkey AS customer_id, c_mktsegment AS customer_segment,
  concat(n_name, '-', (c_custkey % 20)::VARCHAR) AS customer_city, n_name AS customer_state,
  r_name AS customer_country,
  CASE r_name WHEN 'AMERICA' THEN 'México' ELSE r_name END AS order_country,
  concat(c_custkey::VARCHAR, '.0') AS customer_zipcode,
  p_partkey AS product_card_id, p_size::BIGINT AS product_category_id, p_type AS category_name,
  p_name AS product_name, p_retailprice AS product_price,
  s_suppkey AS department_id, s_name AS department_name,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Same Day' WHEN '2-HIGH' THEN 'First Class'
    WHEN '3-MEDIUM' THEN 'Second Class' ELSE 'Standard Class' END AS shipping_mode,
  o_orderdate AS order_date, l_shipdate AS shipping_date,
  date_diff('day', o_orderdate, l_shipdate)::INT AS days_for_shipping_real,
  CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1
    WHEN '3-MEDIUM' THEN 2 ELSE 4 END AS days_for_shipment_scheduled,
  l_extendedprice * (1 - l_discount) AS order_item_total,
  l_extendedprice * (0.2 - 3 * l_discount) AS order_profit_per_order,
  CASE WHEN l_orderkey % 10 = 0 THEN 'x' END AS product_description
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey""",
    "cleaned": """
SELECT * REPLACE (
    lpad(regexp_replace(customer_zipcode, '\\.0$', ''),
         greatest(5, length(regexp_replace(customer_zipcode, '\\.0$', '')))::INT, '0') AS customer_zipcode,
    round_even(product_price * 100, 0) / 100 AS product_price,
    round_even(order_item_total * 100, 0) / 100 AS order_item_total,
    round_even(order_profit_per_order * 100, 0) / 100 AS order_profit_per_order),
  year(order_date)::INT AS order_year, month(order_date)::INT AS order_month,
  (isodow(order_date) - 1)::INT AS order_day_of_week,
  CASE WHEN isodow(order_date) - 1 >= 5 THEN 1 ELSE 0 END AS is_weekend
FROM {{extract}}""",
    "customers": """
SELECT DISTINCT ON (customer_id) customer_id, customer_segment, customer_city, customer_state,
  customer_country, customer_zipcode FROM {{cleaned}}
ORDER BY customer_id, customer_segment NULLS FIRST, customer_city NULLS FIRST,
  customer_state NULLS FIRST, customer_country NULLS FIRST, customer_zipcode NULLS FIRST""",
    "products": """
SELECT DISTINCT ON (product_card_id) product_card_id, product_category_id, category_name,
  product_name, product_price FROM {{cleaned}}
ORDER BY product_card_id, product_category_id NULLS FIRST, category_name NULLS FIRST,
  product_name NULLS FIRST, product_price NULLS FIRST""",
    "departments": """
SELECT DISTINCT ON (department_id) department_id, department_name FROM {{cleaned}}
ORDER BY department_id, department_name NULLS FIRST""",
    "orders_distinct": """
SELECT order_id, order_item_id, customer_id, product_card_id, department_id, shipping_mode,
  order_date AS order_date_dateorders, shipping_date AS shipping_date_dateorders,
  days_for_shipping_real, days_for_shipment_scheduled, order_item_total, order_profit_per_order,
  order_year, order_month, order_day_of_week, is_weekend, min(product_price) AS product_price
FROM {{cleaned}} GROUP BY ALL""",
    "profit_bounds": """
SELECT quantile_cont(order_profit_per_order, 0.01) AS low,
  quantile_cont(order_profit_per_order, 0.99) AS high FROM {{orders_distinct}}""",
    "capped": """
SELECT o.*, round_even(least(greatest(order_profit_per_order, low), high) * 100, 0) / 100
  AS order_profit_capped FROM {{orders_distinct}} o CROSS JOIN {{profit_bounds}}""",
    "facts": """
SELECT * EXCLUDE (order_profit_per_order, product_price),
  CASE WHEN product_price > 0 THEN trunc(order_item_total / product_price)::INT ELSE 1 END
    AS item_quantity,
  CASE WHEN order_item_total > 0 THEN round_even(order_profit_capped / order_item_total * 100, 0) / 100
    ELSE 0.0 END::DOUBLE AS profit_margin,
  days_for_shipping_real - days_for_shipment_scheduled AS delivery_variance_days
FROM {{capped}}""",
    "joined": """
SELECT f.*, c.* EXCLUDE (customer_id), p.* EXCLUDE (product_card_id), d.* EXCLUDE (department_id)
FROM {{facts}} f JOIN {{customers}} c ON f.customer_id = c.customer_id
JOIN {{products}} p ON f.product_card_id = p.product_card_id
JOIN {{departments}} d ON f.department_id = d.department_id
WHERE f.days_for_shipping_real >= 0 AND c.customer_state IS NOT NULL""",
    "readings": """
SELECT event_id + 1 AS udi, concat(machine_type, lpad(event_id::VARCHAR, 9, '0')) AS machine_id,
  machine_type, air AS air_temperature_k, air + gap AS process_temperature_k,
  rpm AS rotational_speed_rpm, torque AS torque_nm, wear AS tool_wear_min,
  CASE WHEN wear BETWEEN 200 AND 240 AND event_id % 20 = 0 THEN 1 ELSE 0 END AS twf,
  CASE WHEN air + gap - air < 8.6::DOUBLE AND rpm < 1380 THEN 1 ELSE 0 END AS hdf,
  CASE WHEN torque * rpm * 2 * pi() / 60 < 3500 OR torque * rpm * 2 * pi() / 60 > 9000
    THEN 1 ELSE 0 END AS pwf,
  CASE WHEN wear * torque > CASE machine_type WHEN 'L' THEN 11000 WHEN 'M' THEN 12000 ELSE 13000 END
    THEN 1 ELSE 0 END AS osf,
  CASE WHEN event_id % 1000 = 7 THEN 1 ELSE 0 END AS rnf,
  CASE WHEN (event_id + 1) % 17 <> 0 THEN torque END AS torque_recorded, ts
FROM (SELECT event_id, ts,
    CASE WHEN event_id % 10 < 6 THEN 'L' WHEN event_id % 10 < 9 THEN 'M' ELSE 'H' END AS machine_type,
    295.3::DOUBLE + ((event_id * 37) % 92)::DOUBLE / 10 AS air,
    8.4::DOUBLE + ((event_id * 53) % 40)::DOUBLE / 10 AS gap,
    1168 + floor(value * 3.5::DOUBLE)::INT AS rpm,
    (28 + ((event_id * 7919) % 241)::DOUBLE / 10) AS torque,
    ((event_id * 31) % 254)::INT AS wear FROM events)""",
    "recorded": """
SELECT * EXCLUDE (torque_recorded) REPLACE (torque_recorded AS torque_nm),
  greatest(hdf, pwf, osf) AS machine_failure FROM {{readings}}""",
    "imputed": """
SELECT * REPLACE (coalesce(torque_nm, (SELECT avg(torque_nm) FROM {{recorded}})) AS torque_nm)
FROM {{recorded}}""",
    # A failure probability in percent and a predicted flag, computed from load alone.
    "scored": """
SELECT udi, machine_id, machine_failure, rotational_speed_rpm, torque_nm, tool_wear_min,
  round_even(least(1.0::DOUBLE, tool_wear_min * torque_nm / 13000) * 100.0::DOUBLE * 1000, 0) / 1000
    AS failure_probability,
  CASE WHEN least(1.0::DOUBLE, tool_wear_min * torque_nm / 13000) > 0.5 THEN 1 ELSE 0 END
    AS predicted_failure_flag
FROM (SELECT *, greatest(hdf, pwf, osf) AS machine_failure FROM {{readings}})""",
    "results": """
SELECT machine_id, machine_failure, rotational_speed_rpm, torque_nm, tool_wear_min,
  failure_probability,
  CASE WHEN predicted_failure_flag = 1 THEN '\U0001f6a8' ELSE '✅' END AS test,
  CASE WHEN predicted_failure_flag = 1 THEN 'Failure' ELSE 'Normal operation' END AS status
FROM {{scored}}""",
    # Two predictors of the delivery variance: means by shipping mode and by segment.
    "predictions": """
SELECT order_id, order_item_id, delivery_variance_days::DOUBLE AS label,
  avg(delivery_variance_days) OVER (PARTITION BY shipping_mode) AS by_mode,
  avg(delivery_variance_days) OVER (PARTITION BY customer_segment) AS by_segment
FROM {{joined}}""",
}
