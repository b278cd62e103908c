"""Date expressions on zone-less timestamps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SLASHED_FORMAT = "M/d/yyyy H:mm"


def parse_timestamp(text: Column, pattern: str = SLASHED_FORMAT) -> Column:
    """Zone-less timestamp, null where the text does not fit the pattern.

    The try_ variant only yields zoned values, which would move wall-clock times inside a
    daylight-saving gap; it serves as the validity test alone.
    """
    valid = F.try_to_timestamp(text, F.lit(pattern)).isNotNull()
    return F.when(valid, F.to_timestamp_ntz(text, F.lit(pattern)))


def monday_based_weekday(day: Column) -> Column:
    """0 for Monday to 6 for Sunday."""
    return F.weekday(day)


def weekend_flag(weekday: Column) -> Column:
    """1 on Saturday and Sunday, else 0; a missing day counts as 0."""
    return F.when(weekday >= 5, 1).otherwise(0)


def delivery_variance(real_days: Column, scheduled_days: Column) -> Column:
    """Days late; negative when early."""
    return (real_days - scheduled_days).cast("int")
