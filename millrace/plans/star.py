"""Wide order extract to star schema and to the joined views."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.calendar import (
    SLASHED_FORMAT, delivery_variance, monday_based_weekday, parse_timestamp, weekend_flag,
)
from millrace.functions.numeric import item_quantity, profit_margin, round_half_even
from millrace.functions.text import spaced_name, zip_code
from millrace.operators.cleaning import fit_clip
from millrace.operators.columns import drop_mostly_null, enforce_types, missing_as_null, rename_all
from millrace.operators.integrity import duplicate_keys, one_row_per_key, orphan_counts
from millrace.operators.joins import lookup_join, measured_bytes
from millrace.sources.staging import side_by_side, stage_all

# Table layouts and their types.
CUSTOMER_TYPES = {
    "customer_id": "bigint", "customer_segment": "string", "customer_city": "string",
    "customer_state": "string", "customer_country": "string", "customer_zipcode": "string",
}
PRODUCT_TYPES = {
    "product_card_id": "bigint", "product_category_id": "bigint", "category_name": "string",
    "product_name": "string", "product_price": "double",
}
DEPARTMENT_TYPES = {"department_id": "bigint", "department_name": "string"}
ORDER_TYPES = {
    "order_id": "bigint", "order_item_id": "bigint", "customer_id": "bigint",
    "product_card_id": "bigint", "department_id": "bigint", "shipping_mode": "string",
    "order_date_dateorders": "timestamp_ntz", "shipping_date_dateorders": "timestamp_ntz",
    "days_for_shipping_real": "int", "days_for_shipment_scheduled": "int",
    "order_item_total": "double", "order_profit_per_order": "double", "order_year": "int",
    "order_month": "int", "order_day_of_week": "int", "is_weekend": "int",
}
# Names of the extract that the table layouts write without parentheses.
TABLE_NAMES = {
    "order_date_(dateorders)": "order_date_dateorders",
    "shipping_date_(dateorders)": "shipping_date_dateorders",
    "days_for_shipping_(real)": "days_for_shipping_real",
    "days_for_shipment_(scheduled)": "days_for_shipment_scheduled",
}
# How facts meet their lookups in every view, and which rows count.
LOOKUP_KEYS = {"dim_customers": "customer_id", "dim_products": "product_card_id", "dim_departments": "department_id"}
VALID_FACTS, VALID_CUSTOMERS = "days_for_shipping_real >= 0", "customer_state IS NOT NULL"
MONEY = ["product_price", "order_item_total", "order_profit_per_order"]
NEEDED = [*CUSTOMER_TYPES, *PRODUCT_TYPES, *DEPARTMENT_TYPES,
          *[c for c in ORDER_TYPES if c not in TABLE_NAMES.values()], *TABLE_NAMES]
# Column lists of the three views.
TRAINING_COLUMNS = [
    "shipping_mode", "customer_segment", "customer_city", "customer_state", "category_name",
    "product_price", "department_name", "days_for_shipment_scheduled", "delivery_variance_days",
    "order_item_total", "order_profit_capped",
]
TEMPORAL_COLUMNS = TRAINING_COLUMNS + [
    "order_month", "order_day_of_week", "is_weekend", "item_quantity", "profit_margin",
]
REPORTING_COLUMNS = [
    "order_id", "shipping_mode", "order_date_dateorders", "shipping_date_dateorders",
    "days_for_shipment_scheduled", "days_for_shipping_real", "delivery_variance_days",
    "customer_segment", "customer_city", "customer_state", "category_name", "product_price",
    "department_name", "order_item_total", "order_profit_capped", "order_year", "order_month",
    "order_day_of_week", "is_weekend", "item_quantity", "profit_margin",
]


def country_rows(extract: DataFrame, country: str, column: str = "Order Country") -> DataFrame:
    """Rows of one country, compared exactly."""
    return extract.filter(F.col(f"`{column}`") == country)


def cleaned_rows(extract: DataFrame, pattern: str = SLASHED_FORMAT, zip_parity: bool = False) -> DataFrame:
    """Names, postal codes, dates and rounding; every column stays."""
    rows = missing_as_null(rename_all(extract, spaced_name))
    rows = rows.withColumn("customer_zipcode", zip_code(F.col("customer_zipcode"), zip_parity))
    rows = with_calendar(rows, pattern)
    return rows.withColumns({c: round_half_even(F.col(c).cast("double"), 2) for c in MONEY})


def clean_extract(
    extract: DataFrame, country: str | None = None, pattern: str = SLASHED_FORMAT,
    zip_parity: bool = False,
) -> DataFrame:
    """Filter first, then names, postal codes, dates, rounding and empty columns."""
    rows = extract if country is None else country_rows(extract, country)
    return without_empty(cleaned_rows(rows, pattern, zip_parity))


def without_empty(cleaned: DataFrame) -> DataFrame:
    """Drop mostly empty columns; one that is needed may not be."""
    return drop_mostly_null(cleaned, required=NEEDED)


def extract_types(header: list[str]) -> dict[str, str]:
    """Types of an extract's columns by their headers; dates, postal codes and unknown columns are text."""
    kinds = {**CUSTOMER_TYPES, **PRODUCT_TYPES, **DEPARTMENT_TYPES, **ORDER_TYPES}
    found = {c: kinds.get(TABLE_NAMES.get(spaced_name(c), spaced_name(c)), "string") for c in header}
    return {c: kind if kind in ("bigint", "int", "double") else "string" for c, kind in found.items()}


def with_calendar(rows: DataFrame, pattern: str = SLASHED_FORMAT) -> DataFrame:
    """Parsed order and shipping dates with year, month, weekday and weekend flag."""
    def parsed(name: str) -> Column:
        value = F.col(f"`{name}`")
        return parse_timestamp(value, pattern) if dict(rows.dtypes)[name] == "string" else value

    dates = ["order_date_(dateorders)", "shipping_date_(dateorders)"]
    rows = rows.withColumns({d: parsed(d) for d in dates})
    ordered = F.col("`order_date_(dateorders)`")
    rows = rows.withColumns({
        "order_year": F.year(ordered), "order_month": F.month(ordered),
        "order_day_of_week": monday_based_weekday(ordered),
    })
    return rows.withColumn("is_weekend", weekend_flag(F.col("order_day_of_week")))


@dataclass(frozen=True)
class Star:
    customers: DataFrame
    products: DataFrame
    departments: DataFrame
    orders: DataFrame
    distinct: DataFrame  # fact rows before clipping
    sizes: dict[str, int]

    def tables(self) -> dict[str, DataFrame]:
        return {"dim_customers": self.customers, "dim_products": self.products,
                "dim_departments": self.departments, "fact_orders": self.orders}


def mostly_distinct(rows: DataFrame, columns: list[str]) -> bool:
    """Whether at most about a tenth of the rows are copies, by a sketch of their hashes.

    Combining before the shuffle then saves nothing, and its tables of whole rows spill; where copies are many,
    it keeps them out of the shuffle. Either way gives the same rows.
    """
    found = rows.agg(F.count("*").alias("n"), F.approx_count_distinct(F.xxhash64(*columns), 0.02).alias("values")).first()
    return found["values"] >= 0.9 * found["n"]


def distinct_orders(cleaned: DataFrame) -> DataFrame:
    """Distinct fact rows, each with the price its quantity is derived from.

    The price is no fact column. Taking the smallest one per fact row keeps the whole-row
    distinct of the fact columns as it is and pairs the two without relying on row order.
    """
    named = cleaned.withColumnsRenamed(TABLE_NAMES)
    facts = enforce_types(named, {**ORDER_TYPES, "product_price": "double"})
    if mostly_distinct(facts, [*ORDER_TYPES]):
        facts = facts.repartition(*ORDER_TYPES)
    return facts.groupBy(*ORDER_TYPES).agg(F.min("product_price").alias("product_price"))


def order_features(distinct: DataFrame) -> DataFrame:
    """Clip the profit at its 1st and 99th percentile and add the derived columns.

    ``distinct`` is read three times, so it should be a stored table.
    """
    bounds = fit_clip(distinct, "order_profit_per_order")
    capped = bounds.apply(distinct, into="order_profit_capped")
    total = F.col("order_item_total")
    derived = capped.withColumns({
        "item_quantity": item_quantity(total, F.col("product_price")),
        "profit_margin": profit_margin(F.col("order_profit_capped"), total),
        "delivery_variance_days": delivery_variance(
            F.col("days_for_shipping_real"), F.col("days_for_shipment_scheduled")),
    })
    layout = ["order_profit_capped" if c == "order_profit_per_order" else c for c in ORDER_TYPES]
    return derived.select(*layout, "item_quantity", "profit_margin", "delivery_variance_days")


def dimension(cleaned: DataFrame, types: dict[str, str], unique: bool = True) -> DataFrame:
    """Distinct rows of the dimension's columns, or one row per key.

    A dimension with two rows for one key would multiply fact rows in every join. The
    distinct comes first in either case: hashing shrinks the extract to the few dimension
    rows, and only these are compared per key.
    """
    rows = enforce_types(cleaned, types).distinct()
    return one_row_per_key(rows, [next(iter(types))]) if unique else rows


def build_star(cleaned: DataFrame) -> Star:
    """Write the four tables. ``cleaned`` is read four times and should be a stored table."""
    tables = stage_all({
        "distinct_orders": distinct_orders(cleaned),
        "dim_customers": dimension(cleaned, CUSTOMER_TYPES),
        "dim_products": dimension(cleaned, PRODUCT_TYPES),
        "dim_departments": dimension(cleaned, DEPARTMENT_TYPES),
    })
    distinct, customers, products, departments = tables.values()
    dimensions = dict(zip(LOOKUP_KEYS, (customers, products, departments)))
    sizes = dict(zip(dimensions, side_by_side(cleaned.sparkSession, measured_bytes, dimensions.values())))
    return Star(customers, products, departments, order_features(distinct), distinct, sizes)


def star_join(star: Star) -> DataFrame:
    """Facts with all dimensions; real days not negative and the state known."""
    facts = joined = star.orders.filter(VALID_FACTS)
    for name, key in LOOKUP_KEYS.items():
        lookup = star.tables()[name]
        lookup = lookup.filter(VALID_CUSTOMERS) if name == "dim_customers" else lookup
        joined = lookup_join(joined, lookup, key, size=star.sizes[name], hot_in=facts)
    return joined


def training_view(star: Star) -> DataFrame:
    return star_join(star).select(*TRAINING_COLUMNS)


def temporal_view(star: Star) -> DataFrame:
    return star_join(star).select(*TEMPORAL_COLUMNS)


def reporting_view(star: Star) -> DataFrame:
    return star_join(star).select(*REPORTING_COLUMNS)


def key_report(star: Star) -> DataFrame:
    """check, table, key, keys, rows: keys without a dimension row, and keys of more than one row."""
    tables = star.tables()
    found = [("orphan", "fact_orders", [key], orphan_counts(star.orders, tables[name], key))
             for name, key in LOOKUP_KEYS.items()]
    found += [("duplicate", name, key, duplicate_keys(tables[name], key))
              for name, key in {"fact_orders": ["order_id", "order_item_id"], **{n: [k] for n, k in LOOKUP_KEYS.items()}}.items()]
    parts = [keys.agg(F.count("*").alias("keys"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).select(
        F.lit(check).alias("check"), F.lit(table).alias("table"), F.lit(", ".join(key)).alias("key"), "keys", "rows")
        for check, table, key, keys in found]
    return reduce(DataFrame.unionByName, parts)
