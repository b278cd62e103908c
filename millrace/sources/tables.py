"""Named tables, database tables and the catalog's tables and views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.sources.delimited import read_delimited, write_delimited
from millrace.sources.staging import new_location, side_by_side, stage_all

# Typed layout of the stored tables.
TABLE_LAYOUTS = {
    "dim_customers": "customer_id INT, customer_segment STRING, customer_city STRING, "
                     "customer_state STRING, customer_country STRING, customer_zipcode STRING",
    "dim_products": "product_card_id INT, product_category_id INT, category_name STRING, "
                    "product_name STRING, product_price DECIMAL(10,2)",
    "dim_departments": "department_id INT, department_name STRING",
    "fact_orders": "order_id INT, order_item_id INT, customer_id INT, product_card_id INT, "
                   "department_id INT, shipping_mode STRING, order_date_dateorders TIMESTAMP_NTZ, "
                   "shipping_date_dateorders TIMESTAMP_NTZ, days_for_shipping_real INT, "
                   "days_for_shipment_scheduled INT, order_item_total DECIMAL(10,2), "
                   "order_profit_capped DECIMAL(10,2), order_year INT, order_month INT, "
                   "order_day_of_week INT, is_weekend INT, item_quantity INT, "
                   "profit_margin DECIMAL(10,2), delivery_variance_days INT",
}


def wide_keys(layout: str) -> str:
    """The same layout with 64-bit identifiers, for data past the 32-bit range."""
    return ", ".join(
        part.replace(" INT", " BIGINT") if part.split()[0].endswith("_id") else part
        for part in layout.split(", ")
    )


def named_table(spark: SparkSession, name: str) -> DataFrame:
    """A table or view of the session's catalog."""
    return spark.table(name)


def database_table(
    spark: SparkSession, url: str, table: str, key: str, bounds: tuple[int, int],
    partitions: int, properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A table or view of a relational database, read in ranges of a numeric key.

    Filters and the column list are pushed into the database's query.
    """
    low, high = bounds
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=key, lowerBound=low, upperBound=high,
        numPartitions=partitions, fetchsize=10_000, **dict(properties or {}))
    return reader.load()


def typed(frame: DataFrame, layout: str) -> DataFrame:
    """Project by name to a column layout."""
    return frame.select(*[
        F.col(name).cast(kind).alias(name)
        for name, kind in (part.split(" ", 1) for part in layout.split(", "))
    ])


def load_delimited_tables(
    spark: SparkSession, paths: Mapping[str, str], layouts: Mapping[str, str]
) -> dict[str, DataFrame]:
    """Load delimited files into typed columnar tables, columns matched by name."""
    return stage_all({name: read_delimited(spark, path, layouts[name]) for name, path in paths.items()})


def export_tables(tables: Mapping[str, DataFrame], layouts: Mapping[str, str]) -> dict[str, str]:
    """Write tables as delimited files; returns where each one lies."""
    spark = next(iter(tables.values())).sparkSession
    paths = {name: new_location(spark, f"export_{name}") for name in tables}
    side_by_side(spark, lambda name: write_delimited(typed(tables[name], layouts[name]), paths[name]), tables)
    return paths


def create_catalog(
    spark: SparkSession, database: str, tables: Mapping[str, DataFrame], views: Mapping[str, list[str]],
    layouts: Mapping[str, str], keys: Mapping[str, str], conditions: Sequence[str],
) -> None:
    """A database with typed tables over ``tables`` and views that join them.

    ``views`` maps a view's name to its column list, ``keys`` a lookup table to the key that the one table
    without a key has too; ``conditions`` hold in every view. Spark enforces no keys; the integrity
    operators check them.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{new_location(spark, database)}'")
    for name, frame in tables.items():
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        spark.sql(f"CREATE TABLE {database}.{name} ({layouts[name]}) USING parquet "
                  f"LOCATION '{new_location(spark, name)}'")
        typed(frame, layouts[name]).write.insertInto(f"{database}.{name}")
    (facts,) = tables.keys() - keys.keys()
    lookups = " ".join(f"JOIN {database}.{name} USING ({key})" for name, key in keys.items())
    for name, columns in views.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT {', '.join(columns)} "
                  f"FROM {database}.{facts} {lookups} WHERE {' AND '.join(conditions)}")
