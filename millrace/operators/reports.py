"""Rollups and rankings over the star and over telemetry."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.operators.codes import totals_before


def state_rollup(rows: DataFrame) -> DataFrame:
    """Orders, average delay in days and hours, and profit by state, largest first."""
    # The report's column names, here and in variance_extremes.
    delay = F.col("delivery_variance_days")
    return (
        rows.groupBy("customer_state").agg(
            F.count("order_id").alias("total_orders"),
            F.avg(delay).alias("avg_delay_days"),
            F.avg(delay * 24).alias("avg_delay_hours"),
            F.sum("order_profit_capped").alias("total_profit"),
        ).orderBy(F.desc("total_orders"), F.asc("customer_state"))
    )


def variance_extremes(rows: DataFrame) -> DataFrame:
    """Earliest, latest and mean delivery variance with its population deviation."""
    delay = F.col("delivery_variance_days")
    return rows.agg(
        F.min(delay).alias("max_early_arrival_days"), F.max(delay).alias("max_late_delay_days"),
        F.avg(delay).alias("mean_variance"), F.stddev_pop(delay).alias("standard_deviation"))


def delay_by_mode(rows: DataFrame) -> DataFrame:
    return rows.groupBy("shipping_mode").agg(
        F.count("*").alias("orders"), F.avg("delivery_variance_days").alias("avg_delay_days"))


def delay_calendar(rows: DataFrame) -> DataFrame:
    """Average delay by month and weekday."""
    return rows.groupBy("order_month", "order_day_of_week").agg(
        F.count("*").alias("orders"), F.avg("delivery_variance_days").alias("avg_delay_days"))


def risk_matrix(rows: DataFrame) -> DataFrame:
    """Profit of late orders by state and segment (our reading of a described report)."""
    late = F.col("delivery_variance_days") > 0
    return rows.groupBy("customer_state", "customer_segment").agg(
        F.count("*").alias("orders"), F.count_if(late).alias("late_orders"),
        F.coalesce(F.sum(F.when(late, F.col("order_profit_capped"))), F.lit(0.0)).alias("profit_at_risk"))


def danger_zones(readings: DataFrame, speed_step: int = 200, torque_step: int = 5) -> DataFrame:
    """Failure share by speed and torque cell."""
    speed = (F.floor(F.col("rotational_speed_rpm") / speed_step) * speed_step).cast("int")
    torque = (F.floor(F.col("torque_nm") / torque_step) * torque_step).cast("int")
    return readings.groupBy(speed.alias("speed_from"), torque.alias("torque_from")).agg(
        F.count("*").alias("readings"), F.sum("machine_failure").alias("failures"),
        F.avg("machine_failure").alias("failure_share"))


def dispatch_queue(flagged: DataFrame) -> DataFrame:
    """Flagged machines with their rank by failure probability, highest first.

    Ranks are worked out on the counts of distinct probabilities, range by range, and joined back;
    ranking the rows themselves would put all of them into one task. Equal probabilities share a rank;
    machines without a probability come last.
    """
    counts = flagged.groupBy("failure_probability").agg(F.count("*").alias("_rows"))
    ahead = totals_before(counts, [F.desc_nulls_last("failure_probability")], "_rows", "_ahead")
    ranks = ahead.select(F.col("failure_probability").alias("_probability"), (F.col("_ahead") + 1).alias("queue_rank"))
    others = [c for c in flagged.columns if c != "failure_probability"]
    return (flagged.join(ranks, F.col("failure_probability").eqNullSafe(F.col("_probability")))
            .select("failure_probability", *others, "queue_rank")
            .orderBy(F.asc("queue_rank"), F.asc("machine_id")))
