"""Arithmetic on TIMESTAMP_NTZ columns that never looks at the session time zone.

``date_trunc`` and ``timestampdiff`` cast NTZ to a zoned timestamp first, so a
session in a zone with daylight saving would shift results; these do not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR_MICROS = 3_600_000_000
DAY_MICROS = 24 * HOUR_MICROS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def day_number(ts: Column | str) -> Column:
    """Days since 1970-01-01."""
    return F.unix_date(F.to_date(_col(ts))).cast("bigint")


def hour_number(ts: Column | str) -> Column:
    """Hours since 1970-01-01 00:00."""
    return day_number(ts) * 24 + F.hour(_col(ts)).cast("bigint")


def micros(ts: Column | str) -> Column:
    """Microseconds since 1970-01-01 00:00."""
    ts = _col(ts)
    seconds = F.extract(F.lit("second"), ts)
    return hour_number(ts) * HOUR_MICROS + F.minute(ts).cast("bigint") * 60_000_000 + (seconds * 1_000_000).cast("bigint")


def from_micros(n: Column) -> Column:
    return F.timestamp_add("MICROSECOND", n, epoch())


def from_hours(n: Column) -> Column:
    return F.timestamp_add("HOUR", n, epoch())


def hour_start(ts: Column | str) -> Column:
    return from_hours(hour_number(ts))


def day_start(ts: Column | str) -> Column:
    return F.to_date(_col(ts)).cast("timestamp_ntz")


def slot_number(ts: Column | str, step: str) -> Column:
    """Position of a stamp on the regular grid of its series."""
    if step == "hour":
        return hour_number(ts)
    if step == "day":
        return day_number(ts)
    raise ValueError(f"step must be 'hour' or 'day', not {step!r}")


def plus_hours(ts: Column | str, n: int) -> Column:
    return F.timestamp_add("HOUR", F.lit(n), _col(ts))


def plus_days(ts: Column | str, n: Column | int) -> Column:
    return F.timestamp_add("DAY", F.lit(n) if isinstance(n, int) else n, _col(ts))


def day_text(ts: Column | str) -> Column:
    return F.to_date(_col(ts)).cast("string")
