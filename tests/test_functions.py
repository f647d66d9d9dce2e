"""Column functions on literals."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hourloom.config import KEY, TS
from hourloom.functions import calendar, clock, numbers, scores, zones
from hourloom.operators.evaluation import regression_metrics, residual_histogram
from hourloom.operators.regularize import localize_to_utc
from tests.helpers import at, column, series

BERLIN = "Europe/Berlin"


def _values(spark, values, make, kind="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["o"] for r in df.select("i", make(F.col("v")).alias("o")).orderBy("i").collect()]


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "v double")
    assert df.select(F.avg(numbers.nan_to_null(F.col("v")))).first()[0] == 2.0


def test_clip_keeps_null(spark):
    assert _values(spark, [None, -1.0, 2.0], numbers.clip_at_zero) == [None, 0.0, 2.0]


def test_coerce(spark):
    assert _values(spark, [" 1.5 ", "n/a", None, "NaN", "-2"], numbers.coerce_number, "string") == [1.5, None, None, None, -2.0]


def test_histogram_edges(spark):
    edges = [-100.0, -96.1, -96.0, 0.0, 100.0, 100.1, -100.1]
    got = _values(spark, edges, lambda c: numbers.equal_width_bin(c, F.lit(-100.0), F.lit(100.0), 50))
    assert got == [1, 1, 2, 26, 50, None, None]


def test_seasons(spark):
    months = [datetime(2024, m, 1) for m in (12, 1, 2, 3, 5, 6, 8, 9, 11)]
    assert _values(spark, months, calendar.season, "timestamp_ntz") == [1, 1, 1, 2, 2, 3, 3, 4, 4]


def test_calendar_of_a_week(spark):
    stamps = [datetime(2024, 1, 1, 5), datetime(2024, 1, 6, 23), datetime(2024, 1, 7)]
    assert _values(spark, stamps, calendar.day_of_week, "timestamp_ntz") == [0, 5, 6]
    assert _values(spark, stamps, calendar.is_weekend, "timestamp_ntz") == [0, 1, 1]
    assert _values(spark, stamps, calendar.hour, "timestamp_ntz") == [5, 23, 0]


def test_holidays_are_fixed_days(spark):
    days = [datetime(2024, 12, 25, 7), datetime(2024, 10, 3), datetime(2024, 4, 1)]
    assert _values(spark, days, calendar.is_holiday, "timestamp_ntz") == [1, 1, 0]


def test_exclusive_buckets(spark):
    stamps = [datetime(2024, 1, 6, 3), datetime(2024, 1, 5, 23), datetime(2024, 1, 8, 9), datetime(2024, 1, 8, 21), datetime(2024, 1, 8, 0)]
    got = _values(spark, stamps, calendar.exclusive_bucket, "timestamp_ntz")
    assert got == ["weekend", "off_peak_late", "peak", "shoulder", "off_peak_night"]


def test_overlapping_buckets(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 6, 12),)], f"{TS} timestamp_ntz")
    row = df.select(*[c.alias(n) for n, c in calendar.trading_buckets(TS).items()]).first().asDict()
    assert {n for n, hit in row.items() if hit} == {"shoulder", "weekend"}
    hours = df.select(*[c.alias(n) for n, c in calendar.hour_buckets(TS).items()]).first().asDict()
    assert len(hours) == 24 and [n for n, hit in hours.items() if hit] == ["hour_12"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", BERLIN])
def test_clock_ignores_the_session_zone(spark, zone):
    stamp = datetime(2024, 3, 31, 2, 30, 15, 250)
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        df = spark.createDataFrame([(stamp,)], f"{TS} timestamp_ntz")
        row = df.select(
            clock.from_micros(clock.micros(TS)).alias("back"), clock.hour_start(TS).alias("hour"), clock.hour_number(TS).alias("n"), clock.day_start(TS).alias("day")
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert row["back"] == stamp and row["hour"] == datetime(2024, 3, 31, 2) and row["day"] == datetime(2024, 3, 31)
    assert row["n"] == 19813 * 24 + 2


def test_spring_gap_moves_to_the_change(spark):
    local = [datetime(2024, 3, 31, 2), datetime(2024, 3, 31, 2, 30), datetime(2024, 3, 31, 3), datetime(2024, 3, 31, 1, 59)]
    got = _values(spark, local, lambda c: zones.local_to_utc(c, BERLIN), "timestamp_ntz")
    assert got == [datetime(2024, 3, 31, 1), datetime(2024, 3, 31, 1), datetime(2024, 3, 31, 1), datetime(2024, 3, 31, 0, 59)]


def test_autumn_hour_is_told_apart_by_arrival(spark):
    stamps = [datetime(2024, 10, 27, 1), datetime(2024, 10, 27, 2), datetime(2024, 10, 27, 2), datetime(2024, 10, 27, 3)]
    df = series(spark, [(s, i) for i, s in enumerate(stamps)], ["nr int"])
    got = [r[TS] for r in localize_to_utc(df, BERLIN, "nr").orderBy("nr").collect()]
    assert got == [datetime(2024, 10, 26, 23), datetime(2024, 10, 27, 0), datetime(2024, 10, 27, 1), datetime(2024, 10, 27, 2)]


def test_dst_flag(spark):
    stamps = [datetime(2024, 1, 1), datetime(2024, 3, 31, 0, 59), datetime(2024, 3, 31, 1), datetime(2024, 10, 27, 0, 59), datetime(2024, 10, 27, 1)]
    assert _values(spark, stamps, lambda c: zones.is_dst(c, BERLIN), "timestamp_ntz") == [0, 0, 1, 1, 0]


def _scores(spark, pairs):
    df = series(spark, [(i, a, p) for i, (a, p) in enumerate(pairs)], ["actual", "predicted"])
    return regression_metrics(df).first()


def test_r_squared_of_constant_outcomes(spark):
    assert _scores(spark, [(5.0, 5.0), (5.0, 5.0)])["r2"] == 1.0
    assert _scores(spark, [(5.0, 5.0), (5.0, 4.0)])["r2"] == 0.0
    assert _scores(spark, [(5.0, 4.0)])["r2"] is None


def test_r_squared_can_be_negative(spark):
    got = _scores(spark, [(1.0, 10.0), (2.0, -7.0), (3.0, 3.0)])
    assert got["r2"] == pytest.approx(1 - (81 + 81) / 2)
    assert got["mae"] == pytest.approx(6.0) and got["rmse"] == pytest.approx((162 / 3) ** 0.5)


def test_smape_of_zeros(spark):
    assert _scores(spark, [(0.0, 0.0), (1.0, -1.0)])["smape"] == pytest.approx(100.0)
    assert _values(spark, [0.0, 2.0], lambda c: scores.smape_term(c, c)) == [0.0, 0.0]


def test_constant_residuals_still_have_a_histogram(spark):
    df = series(spark, [(i, 5.0, 3.0) for i in range(4)], ["actual", "predicted"])
    row = residual_histogram(df).first()
    assert (row["low"], row["high"], row["n"], row["bin"]) == (1.5, 2.5, 4, 26)


def test_column_helper(spark):
    assert column(series(spark, [(1, 2.0), (0, 1.0)], ["x"]), "x") == [1.0, 2.0]
    assert at(1).hour == 1 and KEY == "series_key"
