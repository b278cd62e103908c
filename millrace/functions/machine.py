"""Expressions over machine telemetry."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Documented failure-mode limits.
HEAT_GAP_K = 8.6
HEAT_SPEED_RPM = 1380
POWER_RANGE_W = (3500, 9000)
OVERSTRAIN_LIMIT = {"L": 11000, "M": 12000, "H": 13000}

# Status labels and marker symbols.
FAILURE = "Failure"
NORMAL = "Normal operation"
FAILURE_MARK = "\U0001f6a8"
NORMAL_MARK = "✅"


def temperature_difference(process: Column, air: Column) -> Column:
    return process - air


def power_watts(torque: Column, rpm: Column) -> Column:
    """Torque times angular speed."""
    return torque * rpm * 2 * F.pi() / 60


def heat_dissipation_failure(process: Column, air: Column, rpm: Column) -> Column:
    return F.when((process - air < HEAT_GAP_K) & (rpm < HEAT_SPEED_RPM), 1).otherwise(0)


def power_failure(torque: Column, rpm: Column) -> Column:
    low, high = POWER_RANGE_W
    watts = power_watts(torque, rpm)
    return F.when((watts < low) | (watts > high), 1).otherwise(0)


def overstrain_failure(wear: Column, torque: Column, machine_type: Column) -> Column:
    limit = F.coalesce(*[F.when(machine_type == k, F.lit(v)) for k, v in OVERSTRAIN_LIMIT.items()])
    return F.when(wear * torque > limit, 1).otherwise(0)


def status_label(flag: Column) -> Column:
    return F.when(flag == 1, FAILURE).otherwise(NORMAL)


def status_mark(flag: Column) -> Column:
    return F.when(flag == 1, FAILURE_MARK).otherwise(NORMAL_MARK)
