"""Row-level expressions on edge values."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from millrace.functions import calendar, machine, numeric, text
from millrace.functions.student import two_sided_p


def column(spark, values, kind, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("x"))).collect()]


def test_name_rules():
    assert text.spaced_name(" Order Country ") == "order_country"
    assert text.spaced_name("Days for shipping (real)") == "days_for_shipping_(real)"
    assert text.bracketed_name("Air temperature [K]") == "air_temperature_k"


def test_zip_codes(spark):
    values = ["725.0", "12345", "123456", "30.05", None, "7"]
    assert column(spark, values, "string", text.zip_code) == ["00725", "12345", "123456", "30.05", None, "00007"]
    parity = column(spark, values, "string", lambda c: text.zip_code(c, parity=True))
    assert parity == ["00725", "12345", "123456", "00305", "00nan", "00007"]
    assert column(spark, [725.0, None], "double", text.zip_code) == ["00725", None]


def test_dates(spark):
    values = ["1/31/2018 22:56", "bad", None, "13/13/2018 0:00", "3/12/2017 2:30"]
    got = column(spark, values, "string", calendar.parse_timestamp)
    assert got == [dt.datetime(2018, 1, 31, 22, 56), None, None, None, dt.datetime(2017, 3, 12, 2, 30)]


def test_daylight_gap_keeps_wall_clock(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert column(spark, ["3/12/2017 2:30"], "string", lambda c: calendar.parse_timestamp(c).cast("string")) == [
            "2017-03-12 02:30:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_weekdays(spark):
    days = [dt.datetime(2024, 1, 6), dt.datetime(2024, 1, 8), None]
    got = column(spark, days, "timestamp_ntz", calendar.monday_based_weekday)
    assert got == [5, 0, None]
    assert column(spark, [5, 0, None, 6], "int", calendar.weekend_flag) == [1, 0, 0, 1]


def test_half_even_rounding(spark):
    values = [0.125, -0.125, 1.005, 2.675, None, 0.135]
    got = column(spark, values, "double", lambda c: numeric.round_half_even(c, 2))
    # Scale, round half to even, scale back.
    assert got == [None if v is None else round(v * 100) / 100 for v in values]


def test_clip_keeps_null_and_is_idempotent(spark):
    clip = lambda c: numeric.clip(c, -1.0, 2.0)
    assert column(spark, [None, -5.0, 0.5, 9.0], "double", clip) == [None, -1.0, 0.5, 2.0]
    assert column(spark, [-5.0, 9.0], "double", lambda c: clip(clip(c))) == [-1.0, 2.0]


def test_nan_is_missing(spark):
    assert column(spark, [float("nan"), 1.0, None], "double", numeric.nan_to_null) == [None, 1.0, None]


def test_quantity_and_margin(spark):
    rows = spark.createDataFrame(
        [(2.99, 1.0), (-2.999, 1.0), (5.0, 0.0), (5.0, None), (0.0, 2.0)], "total double, price double")
    got = rows.select(numeric.item_quantity(F.col("total"), F.col("price"))).collect()
    assert [r[0] for r in got] == [2, -2, 1, 1, 0]
    margins = rows.select(numeric.profit_margin(F.lit(1.0), F.col("total"))).collect()
    assert [r[0] for r in margins] == [0.33, 0.0, 0.2, 0.2, 0.0]


def test_failure_modes(spark):
    rows = spark.createDataFrame([(308.0, 300.0, 1370, 60.0, 200, "L"), (310.0, 300.0, 1500, 40.0, 10, "M")],
                                 "p double, a double, rpm int, t double, w int, k string")
    got = rows.select(
        machine.heat_dissipation_failure(F.col("p"), F.col("a"), F.col("rpm")),
        machine.power_failure(F.col("t"), F.col("rpm")),
        machine.overstrain_failure(F.col("w"), F.col("t"), F.col("k"))).collect()
    assert [tuple(r) for r in got] == [(1, 0, 1), (0, 0, 0)]


@pytest.mark.parametrize("t, freedom, p", [
    (2.228138852, 10, 0.05), (12.7062047, 1, 0.05), (1, 2, 0.4226497), (0, 5, 1.0), (1.959964, 1e12, 0.05),
    (3.8895, 2634, 0.0001029)])
def test_student_tail(t, freedom, p):
    assert two_sided_p(t, freedom) == pytest.approx(p, rel=1e-3)
    assert two_sided_p(-t, freedom) == two_sided_p(t, freedom)
    assert math.isnan(two_sided_p(math.nan, freedom))
