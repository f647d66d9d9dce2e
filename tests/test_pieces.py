"""Work in pieces equals work on whole series, however small the pieces are."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from bindings import base
from hourloom.config import KEY, TS
from hourloom.operators import features, pieces, regularize, signals
from hourloom.operators.baseline import split_ratio
from tests.helpers import at, same


@pytest.fixture
def tiny_pieces(monkeypatch):
    monkeypatch.setattr(pieces, "PIECE_SLOTS", 37)


@pytest.fixture(scope="module")
def gappy(spark):
    """Two long series, one of them holding most rows, with missing hours and missing values."""
    rng = random.Random(7)
    rows = []
    for key, hours in (("big", 1500), ("small", 90)):
        for h in range(hours):
            if rng.random() < 0.15:
                continue
            price = None if rng.random() < 0.3 else rng.uniform(-50, 150)
            rows.append((key, at(h), price, rng.uniform(1000, 2000)))
    return spark.createDataFrame(rows, f"{KEY} string, {TS} timestamp_ntz, price double, load double").cache()


W = lambda: Window.partitionBy(KEY).orderBy(TS)


def test_number_rows(spark, gappy, tiny_pieces):
    got = pieces.number_rows(gappy.select(KEY, TS), total="n").select(KEY, TS, F.col(pieces.SLOT).alias("i"), "n")
    want = gappy.select(KEY, TS, (F.row_number().over(W()) - 1).cast("bigint").alias("i"), F.count("*").over(Window.partitionBy(KEY)).alias("n"))
    same(got, want)


@pytest.mark.parametrize("mode", ["rows", "time"])
def test_lags_and_rolling(spark, gappy, tiny_pieces, mode):
    got = features.window_features(
        gappy, ["price"], [24, 48], ["price", "load"], [24, 50], ("mean", "std", "min", "max"), min_periods=5, mode=mode
    )
    hour = F.unix_timestamp(F.col(TS).cast("timestamp")) / 3600
    order = W() if mode == "rows" else Window.partitionBy(KEY).orderBy(hour.cast("bigint"))

    def frame(a, b):
        return order.rowsBetween(-a, -b) if mode == "rows" else order.rangeBetween(-a, -b)

    want = {f"lag_{n}h_price": F.max("price").over(frame(n, n)) for n in (24, 48)}
    aggregates = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    for c in ("price", "load"):
        for w in (24, 50):
            f = frame(23 + w, 24)
            for name, agg in aggregates.items():
                want[f"roll_{w}h_{name}_{c}"] = F.when(F.count(c).over(f) >= 5, agg(c).over(f))
    same(got, gappy.withColumns(want))


def test_unshifted_window_includes_the_row(spark, gappy, tiny_pieces):
    got = features.rolling_features(gappy, ["price"], [10], ["mean"], min_periods=1, shift=0, mode="rows")
    want = gappy.withColumn("roll_10h_mean_price", F.avg("price").over(W().rowsBetween(-9, 0)))
    same(got, want)


@pytest.mark.parametrize("limit", [1, 2, 40])
def test_fill_forward(spark, gappy, tiny_pieces, limit):
    got = regularize.fill_forward(gappy, ["price"], limit)
    numbered = gappy.withColumn("i", F.row_number().over(W()))
    known = F.when(F.col("price").isNotNull(), F.col("i"))
    past = W().rowsBetween(Window.unboundedPreceding, 0)
    last = F.last("price", True).over(past)
    want = numbered.withColumn("p", F.when(F.col("i") - F.max(known).over(past) <= limit, last)).select(KEY, TS, F.col("p").alias("price"), "load")
    same(got, want)


def test_interpolation_across_pieces(spark, tiny_pieces):
    rows = [("a", at(h), float(h) if h % 120 == 0 else None) for h in range(0, 361)]
    df = spark.createDataFrame(rows, f"{KEY} string, {TS} timestamp_ntz, x double")
    got = {r[TS]: r["x"] for r in regularize.interpolate(df, ["x"], limit=200).collect()}
    assert all(abs(got[at(h)] - h) < 1e-9 for h in range(361))


@pytest.fixture
def ragged(spark, gappy):
    """With repeated stamps of equal rows, a row off the grid, a one-row series and rows without a key."""
    more = [("big", at(3), 1.0, 2.0), ("big", at(3), 1.0, 2.0), ("small", at(5.5), 9.0, 9.0), ("one", at(7), None, 4.0), (None, at(0), 1.0, 1.0), (None, at(80), 2.0, 2.0)]
    return gappy.filter(~((F.col(KEY) == "big") & (F.col(TS) == F.lit(at(3))))).unionByName(spark.createDataFrame(more, gappy.schema))


def test_hours_between_rows_equal_a_joined_grid(ragged, monkeypatch):
    monkeypatch.setattr(regularize, "GRID_BLOCK", 37)
    at_micros = regularize.micros(TS)
    grid = regularize.hour_grid(ragged.groupBy(KEY).agg(F.min(at_micros).alias("_first"), F.max(at_micros).alias("_last")))
    same(regularize.complete_hours(ragged), regularize.reindex(ragged, grid))


@pytest.mark.parametrize("strict", [False, True])
def test_fills_without_a_grid_equal_fills_of_the_grid(ragged, monkeypatch, strict):
    monkeypatch.setattr(regularize, "GRID_BLOCK", 37)
    grid = regularize.complete_hours(ragged)
    same(regularize.interpolate_hours(ragged, ["price", "load"], 2, strict), regularize.interpolate(grid, ["price", "load"], 2, strict))
    same(regularize.fill_forward_hours(ragged, ["price"], 2), regularize.fill_forward(grid, ["price"], 2, mode="time"))


@pytest.mark.parametrize("name", ["interpolate_linear", "ffill_limit", "hourly_grid"])
def test_hours_are_made_after_all_shuffles_and_sorts(spark, name):
    plan = base.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    made = plan.index("Generate explode(")
    assert all(plan.index(x) > made for x in ("Exchange", "Sort", "Window"))


def test_streak_spans_pieces(spark, tiny_pieces):
    rows = [("a", at(h), -1.0 if 20 <= h < 220 else 1.0) for h in range(400)]
    df = spark.createDataFrame(rows, f"{KEY} string, {TS} timestamp_ntz, clean_spark_spread double")
    assert signals.negative_streak(df).first()["max_negative_streak"] == 200


def test_split_ratio(spark, gappy, tiny_pieces):
    got = split_ratio(gappy.select(KEY, TS), 0.8)
    n = F.count("*").over(Window.partitionBy(KEY))
    label = F.when(F.row_number().over(W()) <= F.floor(n * 0.8), "train").otherwise("validation")
    same(got, gappy.select(KEY, TS, label.alias("split")))


def test_rows_without_key_are_kept(spark):
    df = spark.createDataFrame([(None, at(h), float(h)) for h in range(30)], f"{KEY} string, {TS} timestamp_ntz, x double")
    assert features.lag_features(df, ["x"], [24]).count() == 30


def test_a_copy_of_one_row_spreads_over_salts(spark):
    """Identical rows on different map partitions do not share one bucket."""
    df = spark.range(0, 8000, 1, 16).select(F.lit("a").alias(KEY), F.lit(1.0).alias("x"))
    content = F.xxhash64(*df.columns, F.spark_partition_id())
    assert df.select(F.pmod(content, F.lit(64)).alias("s")).distinct().count() > 4
