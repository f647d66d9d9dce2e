"""Calendar parts and trading buckets of a UTC stamp."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from hourloom.config import FIXED_HOLIDAYS
from hourloom.functions.clock import _col


def hour(ts: Column | str) -> Column:
    return F.hour(_col(ts))


def day_of_week(ts: Column | str) -> Column:
    """Monday is 0."""
    return F.weekday(_col(ts))


def month(ts: Column | str) -> Column:
    return F.month(_col(ts))


def is_weekend(ts: Column | str) -> Column:
    return (F.weekday(_col(ts)) >= 5).cast("int")


def season(ts: Column | str) -> Column:
    """1 winter (Dec-Feb), 2 spring, 3 summer, 4 autumn."""
    return F.floor((F.month(_col(ts)) % 12) / 3).cast("int") + 1


def is_holiday(ts: Column | str, days: tuple[str, ...] = FIXED_HOLIDAYS) -> Column:
    return F.date_format(_col(ts), "MM-dd").isin(*days).cast("int")


CALENDAR = {
    "hour": hour,
    "day_of_week": day_of_week,
    "month": month,
    "is_weekend": is_weekend,
    "is_holiday": is_holiday,
    "season": season,
}


def cycle(part: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a part that repeats every ``period``."""
    angle = part * (2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def exclusive_bucket(ts: Column | str) -> Column:
    """One label per stamp; the weekend wins over every hour rule."""
    h = hour(ts)
    return (
        F.when(day_of_week(ts) >= 5, "weekend")
        .when(h < 6, "off_peak_night")
        .when(h >= 22, "off_peak_late")
        .when((h >= 8) & (h < 20), "peak")
        .otherwise("shoulder")
    )


def trading_buckets(ts: Column | str) -> dict[str, Column]:
    """Overlapping predicates used for scoring; weekend daytime also counts as shoulder."""
    h, d = hour(ts), day_of_week(ts)
    night, late, peak = h < 6, h >= 22, (h >= 8) & (h < 20) & (d < 5)
    return {
        "off_peak_night": night,
        "off_peak_late": late,
        "peak": peak,
        "shoulder": ~(night | late | peak),
        "weekend": d >= 5,
        "weekday": d < 5,
    }


def hour_buckets(ts: Column | str) -> dict[str, Column]:
    return {f"hour_{n:02d}": hour(ts) == n for n in range(24)}
