"""Cleaning, star schema and views on a small hand-made extract."""

import pytest
from pyspark.sql import functions as F

from millrace.plans import star
from millrace.sources.staging import stage

HEADER = ("`Order Id` bigint, `Order Item Id` bigint, `Customer Id` bigint, `Customer Segment` string, "
          "`Customer City` string, `Customer State` string, `Customer Country` string, `Customer Zipcode` string, "
          "`Product Card Id` bigint, `Product Category Id` bigint, `Category Name` string, `Product Name` string, "
          "`Product Price` double, `Department Id` bigint, `Department Name` string, `Shipping Mode` string, "
          "`order date (DateOrders)` string, `shipping date (DateOrders)` string, `Days for shipping (real)` int, "
          "`Days for shipment (scheduled)` int, `Order Item Total` double, `Order Profit Per Order` double, "
          "` Order Country ` string, Notes string")


def line(order, item=1, customer=1, product=1, price=10.0, real=3, total=25.0, profit=5.0,
         country="México", state="NL", ordered="1/6/2018 22:56", department=1):
    return (order, item, customer, "Consumer", "Monterrey", state, "EE. UU.", "725.0", product, 3, "Bikes",
            "Bike", price, department, "Outdoors", "Second Class", ordered, "1/9/2018 0:00", real, 2, total,
            profit, country, None)


@pytest.fixture(scope="module")
def extract(spark):
    rows = [line(i, customer=i % 3 + 1, product=i % 2 + 1, profit=float(i)) for i in range(1, 101)]
    rows += [line(1, customer=2, product=2, profit=1.0)]  # a complete copy
    rows += [line(200, product=9, price=5.0), line(201, product=9, price=7.0)]  # one product, two prices
    rows += [line(300, real=-1), line(301, state=None, customer=77), line(302, ordered="bad", total=0.0)]
    rows += [line(400, country="Peru")]
    return spark.createDataFrame(rows, HEADER)


@pytest.fixture(scope="module")
def cleaned(extract):
    return stage(star.clean_extract(
        extract.withColumnRenamed(" Order Country ", "Order Country"), "México"), "cleaned")


@pytest.fixture(scope="module")
def built(cleaned):
    return star.build_star(cleaned)


def test_cleaning(cleaned):
    assert cleaned.count() == 106 and "notes" not in cleaned.columns
    row = cleaned.filter("order_id = 5").first()
    assert (row.customer_zipcode, row.order_year, row.order_month, row.order_day_of_week, row.is_weekend) == (
        "00725", 2018, 1, 5, 1)
    bad = cleaned.filter("order_id = 302").first()
    assert (bad["order_date_(dateorders)"], bad.order_year, bad.is_weekend) == (None, None, 0)


def test_required_column_must_not_vanish(extract):
    hollow = extract.withColumnRenamed(" Order Country ", "Order Country").withColumn("Customer State", F.lit(None).cast("string"))
    with pytest.raises(ValueError, match="customer_state"):
        star.clean_extract(hollow)


def test_tables(built):
    assert built.orders.count() == 105  # the complete copy is gone
    assert built.orders.columns == [*[c if c != "order_profit_per_order" else "order_profit_capped" for c in star.ORDER_TYPES],
                                    "item_quantity", "profit_margin", "delivery_variance_days"]
    prices = [r.product_price for r in built.products.filter("product_card_id = 9").collect()]
    assert prices == [5.0]  # one row per key
    assert star.dimension(built.products, star.PRODUCT_TYPES, unique=False).count() == 3


def test_features(built):
    rows = {r.order_id: r for r in built.orders.collect()}
    assert (rows[5].item_quantity, rows[5].delivery_variance_days) == (2, 1)
    assert (rows[200].item_quantity, rows[201].item_quantity) == (5, 3)
    assert rows[302].profit_margin == 0.0
    assert rows[100].order_profit_capped < 100.0 and rows[1].order_profit_capped > 1.0


def test_views(built):
    view = star.reporting_view(built)
    assert view.columns == star.REPORTING_COLUMNS and len(star.REPORTING_COLUMNS) == 21
    assert len(star.TRAINING_COLUMNS) == 11 and len(star.TEMPORAL_COLUMNS) == 16
    # Neither dropped beyond the two filters nor multiplied by the double-priced product.
    assert view.count() == 103
    assert star.training_view(built).columns == star.TRAINING_COLUMNS
    assert star.temporal_view(built).columns == star.TEMPORAL_COLUMNS


def test_filters_and_columns_reach_the_scan(built):
    plan = star.training_view(built)._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(customer_state)" in plan and "GreaterThanOrEqual(days_for_shipping_real,0)" in plan
    assert "customer_zipcode" not in plan


def test_distinct_orders_combine_before_the_shuffle_only_where_copies_are_many(cleaned):
    many = cleaned.unionByName(cleaned).unionByName(cleaned)
    few, copied = star.distinct_orders(cleaned), star.distinct_orders(many)
    repartitioned = lambda frame: "RepartitionByExpression" in frame._jdf.queryExecution().optimizedPlan().toString()
    assert repartitioned(few) and not repartitioned(copied)
    rows = lambda frame: sorted(map(str, frame.collect()))
    assert rows(few) == rows(copied)
