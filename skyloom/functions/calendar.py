"""Calendar features. Every function maps a timestamp column to named columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_PI = 2 * math.pi


def fractional_hour(t: Column | str) -> Column:
    t = F.col(t) if isinstance(t, str) else t
    return F.hour(t) + F.minute(t) / F.lit(60.0)


def _wave(name: str, phase: Column) -> list[Column]:
    return [F.sin(phase).alias(f"{name}_sin"), F.cos(phase).alias(f"{name}_cos")]


def _day_and_year(t: Column) -> list[Column]:
    hour = _wave("hour", F.lit(TWO_PI) * fractional_hour(t) / F.lit(24.0))
    year = _wave("doy", F.lit(TWO_PI) * F.dayofyear(t) / F.lit(365.25))
    return hour + year


def _week(t: Column) -> list[Column]:
    return _wave("dow", F.lit(TWO_PI) * F.weekday(t) / F.lit(7.0))


def cyclic(time: str = "time") -> list[Column]:
    """hour, day-of-week and day-of-year waves plus the weekend flag."""
    t = F.col(time)
    weekend = (F.weekday(t) >= 5).cast("int").alias("is_weekend")
    return _day_and_year(t) + _week(t) + [weekend]


def cyclic_hourly(time: str = "time") -> list[Column]:
    """As :func:`cyclic`, with the closed 06:00-18:00 daytime flag instead of the weekend."""
    t = F.col(time)
    daytime = fractional_hour(t).between(6, 18).cast("int").alias("is_daytime")
    return _day_and_year(t) + _week(t) + [daytime]


def plain(time: str = "time") -> list[Column]:
    """month, weekday and the half-open 6 <= hour < 18 daytime flag on whole hours."""
    t = F.col(time)
    daytime = ((F.hour(t) >= 6) & (F.hour(t) < 18)).cast("int")
    return [
        F.month(t).alias("month"),
        daytime.alias("is_daytime"),
        F.weekday(t).alias("weekday"),
    ]


def station(time: str = "time") -> list[Column]:
    return _day_and_year(F.col(time)) + plain(time)


def legacy(time: str = "time") -> list[Column]:
    """month and ISO-week waves, minute of hour and 15-minute step of day."""
    t = F.col(time)
    return [
        *_wave("month", F.lit(TWO_PI) * F.month(t) / F.lit(12.0)),
        *_wave("week", F.lit(TWO_PI) * F.weekofyear(t) / F.lit(52.0)),
        F.minute(t).alias("minute_of_hour"),
        (F.hour(t) * 4 + F.floor(F.minute(t) / 15)).cast("int").alias("step_of_day"),
    ]


def horizon_waves(h: Column | str, max_horizon: int) -> list[Column]:
    h = F.col(h) if isinstance(h, str) else h
    phase = F.lit(TWO_PI) * h / F.lit(24.0)
    return [
        (h / F.lit(float(max_horizon))).alias("forecast_horizon"),
        F.sin(phase).alias("forecast_horizon_sin"),
        F.cos(phase).alias("forecast_horizon_cos"),
    ]
