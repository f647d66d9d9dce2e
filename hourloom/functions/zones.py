"""Local clock to UTC and back, with the two daylight-saving corrections."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hourloom.functions.clock import _col, day_start, hour_start, micros, plus_days, plus_hours


def to_zone(ts: Column | str, zone: str) -> Column:
    """UTC stamp to the wall clock of ``zone``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(ts))


def from_zone(local: Column | str, zone: str) -> Column:
    """Wall clock to UTC as Spark sees it: the earlier instant of a repeated hour."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), _col(local))


def local_to_utc(local: Column | str, zone: str) -> Column:
    """Wall clock to UTC; a stamp inside the skipped hour moves forward to the change itself."""
    local = _col(local)
    utc = from_zone(local, zone)
    return F.when(to_zone(utc, zone) == local, utc).otherwise(hour_start(utc))


def is_repeated(local: Column | str, zone: str) -> Column:
    """True when the wall clock shows this stamp twice."""
    local = _col(local)
    utc = from_zone(local, zone)
    return (to_zone(utc, zone) == local) & (to_zone(plus_hours(utc, 1), zone) == local)


def utc_offset_hours(ts: Column | str, zone: str) -> Column:
    ts = _col(ts)
    return (micros(to_zone(ts, zone)) - micros(ts)) / 3_600_000_000


def is_dst(ts: Column | str, zone: str) -> Column:
    """Offset differs from the one on 1 January of the same year (northern zones)."""
    ts = _col(ts)
    january = F.trunc(F.to_date(ts), "year").cast("timestamp_ntz")
    return (utc_offset_hours(ts, zone) != utc_offset_hours(january, zone)).cast("int")


def offset_changes_on(day: Column | str, zone: str) -> Column:
    """The UTC offset at the start of the local day differs from the next local day's."""
    start = day_start(day)
    nxt = plus_days(start, 1)

    def offset(local: Column) -> Column:
        return micros(local) - micros(from_zone(local, zone))

    return offset(start) != offset(nxt)
