"""Operators on small literal series."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from hourloom.config import DRIVERS, KEY, TARGET, TS, Economics, FeatureSpec, FoldSpec
from hourloom.operators import baseline, evaluation, features, quality, regularize, signals, tables, transformers
from tests.helpers import START, at, column, series

VALUES = (TARGET, *DRIVERS)


# --- fills and grids -----------------------------------------------------------


def _filled(spark, values, **options):
    df = series(spark, list(enumerate(values)), ["x"])
    return column(regularize.interpolate(df, ["x"], **options), "x")


def test_interpolation_fills_the_first_cells_of_a_long_gap(spark):
    got = _filled(spark, [1.0, *[None] * 8, 10.0])
    assert got == [1, 2, 3, 4, 5, 6, 7, None, None, 10]
    assert _filled(spark, [1.0, *[None] * 8, 10.0], strict=True) == [1.0, *[None] * 8, 10.0]


def test_interpolation_at_the_ends(spark):
    assert _filled(spark, [None, 1.0, None]) == [None, 1.0, 1.0]
    assert _filled(spark, [None, 1.0, None], strict=True) == [None, 1.0, None]
    assert _filled(spark, [None, None]) == [None, None]


def test_forward_fill_limit(spark):
    df = series(spark, list(enumerate([1.0, None, None, None, 5.0])), ["x"])
    assert column(regularize.fill_forward(df, ["x"], 2), "x") == [1, 1, 1, None, 5]


def test_forward_fill_by_rows_or_hours(spark):
    df = series(spark, [(0, 1.0), (10, None), (11, None)], ["x"])
    assert column(regularize.fill_forward(df, ["x"], 1), "x") == [1, 1, None]
    assert column(regularize.fill_forward(df, ["x"], 1, mode="time"), "x") == [1, None, None]


def test_grid_is_anchored_at_the_first_stamp(spark):
    half = timedelta(minutes=30)
    df = series(spark, [(START + half, 1.0), (at(2), 2.0), (at(3) + half, 3.0)], ["x"])
    got = [(r[TS], r["x"]) for r in regularize.complete_hours(df).orderBy(TS).collect()]
    assert got == [(START + half, 1.0), (at(1) + half, None), (at(2) + half, None), (at(3) + half, 3.0)]


def test_first_value_of_an_hour_skips_nulls(spark):
    quarter = timedelta(minutes=15)
    df = series(spark, [(START, None, 1.0), (START + quarter, 7.0, 2.0), (START + 2 * quarter, 8.0, None)], ["x", "y"])
    assert regularize.resample_first(df, ["x", "y"]).collect()[0].asDict() == {KEY: "a", TS: START, "x": 7.0, "y": 1.0}


def test_repeat_policies(spark):
    df = series(spark, [(0, 1.0, 1), (0, 3.0, 0), (1, 5.0, 2)], ["x", "nr int"])
    assert column(regularize.handle_repeats(df, ["x"], "average"), "x") == [2.0, 5.0]
    assert column(regularize.handle_repeats(df, ["x"], "first", "nr"), "x") == [3.0, 5.0]
    assert column(regularize.dedupe_none(df), "x") == [5.0]
    with pytest.raises(ValueError, match="arrival"):
        regularize.handle_repeats(df, ["x"], "first")


def test_equal_values_at_other_stamps_survive(spark):
    part = series(spark, [(0, 4.0), (1, 4.0)], ["x"])
    assert tables.union_chunks([part, part]).count() == 2


def test_trim_applies_columns_in_order(spark):
    rows = [(0, None, 1.0), (1, 1.0, None), (2, 1.0, 1.0), (3, 1.0, 1.0), (4, None, 1.0)]
    df = series(spark, rows, ["p", "q"])
    assert [r[TS] for r in regularize.trim_to_valid(df, ["p", "q"]).orderBy(TS).collect()] == [at(2), at(3)]
    empty = df.withColumn("z", F.lit(None).cast("double"))
    assert regularize.trim_to_valid(empty, ["z"]).count() == 5


def test_one_source_passes_through_and_two_count_missing_as_zero(spark):
    df = series(spark, [(0, 1.0, None), (1, None, None)], ["on", "off"])
    assert column(regularize.sum_sources(df, ["on", "off"], "wind"), "wind") == [1.0, 0.0]
    assert column(regularize.sum_sources(df.drop("off"), ["on", "off"], "wind"), "wind") == [1.0, None]


# --- features ------------------------------------------------------------------


def test_lag_modes_differ_after_a_missing_hour(spark):
    df = series(spark, [(h, float(h)) for h in range(30) if h != 3], ["x"])
    by_time = column(features.lag_features(df, ["x"], [24]), "lag_24h_x")
    by_rows = column(features.lag_features(df, ["x"], [24], mode="rows"), "lag_24h_x")
    assert by_time[-3:] == [None, 4.0, 5.0] and by_rows[-3:] == [2.0, 4.0, 5.0]
    assert by_rows[-4] == 1.0


def test_rolling_mean_of_a_ramp(spark):
    df = series(spark, [(h, float(h)) for h in range(60)], ["x"])
    got = column(features.rolling_features(df, ["x"], [24]), "roll_24h_mean_x")
    assert got[34] is None and got[35] == pytest.approx(5.5) and got[48] == pytest.approx(12.5)


def test_rolling_needs_min_periods(spark):
    df = series(spark, [(h, float(h)) for h in range(60)], ["x"])
    quarter = column(features.rolling_features(df, ["x"], [24], min_periods=features.quarter_window), "roll_24h_mean_x")
    assert quarter[28] is None and quarter[29] == pytest.approx(2.5)
    full = column(features.rolling_features(df, ["x"], [24], min_periods=features.full_window, shift=0), "roll_24h_mean_x")
    assert full[22] is None and full[23] == pytest.approx(11.5)


def test_rolling_of_a_constant_has_no_spread(spark):
    df = series(spark, [(h, 0.1) for h in range(80)], ["x"])
    got = column(features.rolling_features(df, ["x"], [24]), "roll_24h_std_x")
    assert got[-1] == pytest.approx(0.0, abs=1e-9)


def test_rolling_ignores_infinities(spark):
    df = series(spark, [(h, float("inf") if h == 2 else 1.0) for h in range(60)], ["x"])
    assert column(features.rolling_features(df, ["x"], [24]), "roll_24h_mean_x")[-1] == pytest.approx(1.0)


def test_features_never_look_at_the_last_day(spark):
    """Changing a row may change features only 24 hours later or more."""
    rows = [(h, float(h % 17), 1000.0 + h, 100.0 + h % 5, 50.0 + h % 3) for h in range(260)]
    changed = [r if r[0] < 230 else (r[0], 999.0, *r[2:]) for r in rows]
    built = [features.build_features(series(spark, data, VALUES)).filter(F.col(TS) < at(254)) for data in (rows, changed)]
    names = [c for c in built[0].columns if c.startswith(("lag_", "roll_"))]
    assert len(names) == 24
    a, b = ([tuple(r) for r in df.select(TS, *names).orderBy(TS).collect()] for df in built)
    assert a == b


def test_derived_and_products(spark):
    df = series(spark, [(0, 1.0, 50000.0, 10000.0, 5000.0), (1, 1.0, 0.0, 1.0, 1.0)], VALUES)
    out = features.derived_features(df, DRIVERS)
    assert column(out, "forecast_residual_load") == [35000.0, -2.0]
    assert column(out, "forecast_renewable_share") == [pytest.approx(0.3), None]
    assert features.derived_features(df.drop(DRIVERS[0]), DRIVERS).columns == df.drop(DRIVERS[0]).columns
    assert "interact_forecast_load_forecast_wind" in features.interaction_features(df, [DRIVERS[:2]]).columns


def test_toggles_and_feature_list(spark):
    df = series(spark, [(h, 1.0, 2.0, 3.0, 4.0) for h in range(5)], VALUES)
    spec = FeatureSpec(enable_calendar=False, enable_derived=False, enable_lags=False, enable_rolling=False, enable_interactions=False)
    assert features.build_features(df, spec).columns == df.columns
    listed = features.feature_columns(features.build_features(df))
    assert TARGET not in listed and "forecast_load" not in listed and "lag_24h_forecast_load" in listed


def test_leakage_names():
    columns = ["lag_6h_day_ahead_price", "lag_24h_day_ahead_price", "roll_24h_mean_day_ahead_price", "lead_price"]
    assert features.short_lag_columns(columns) == ["lag_6h_day_ahead_price"]
    assert features.suspicious_columns(columns, VALUES) == ["lead_price"]
    assert features.lags_are_safe(columns) and not features.lags_are_safe(columns, FeatureSpec(lags=(12, 24)))


def test_raw_features_need_all_columns(spark):
    with pytest.raises(ValueError, match="forecast_solar"):
        features.raw_file_features(series(spark, [(0, 1.0, 2.0, 3.0)], VALUES[:3]))


def test_stages_persist(spark, tmp_path):
    stages = [transformers.CalendarParts(parts=["hour"]), transformers.Lags(columns=["x"], lags=[2]), transformers.RollingWindows(columns=["x"], windows=[2], aggregations=["mean"])]
    df = series(spark, [(h, float(h)) for h in range(5)], ["x"])
    path = str(tmp_path / "stages")
    Pipeline(stages=stages).fit(df).write().overwrite().save(path)
    out = PipelineModel.load(path).transform(df)
    assert column(out, "lag_2h_x") == [None, None, 0, 1, 2] and column(out, "rolling_2h_mean_x") == [None, 0.5, 1.5, 2.5, 3.5]


# --- models --------------------------------------------------------------------


def test_naive_forecast_falls_back_to_the_mean(spark):
    df = series(spark, [(h, float(h)) for h in range(170)], [TARGET])
    lagged = features.lag_features(df, [TARGET], [168])
    got = column(baseline.naive_seasonal(lagged), "predicted")
    assert got[:2] == [0.5, 0.5] and got[168:] == [0.0, 1.0]
    with pytest.raises(ValueError, match="lag_168h"):
        baseline.naive_seasonal(df)


def test_evaluation_keeps_rows_without_outcome(spark):
    df = series(spark, [(h, float(h) if h < 169 else None) for h in range(171)], [TARGET])
    assert baseline.train_baseline(df).count() == 1
    assert baseline.evaluate_baseline(df).count() == 3


def test_last_days_split(spark):
    df = series(spark, [(h, 1.0) for h in range(100)], ["x"])
    got = column(baseline.split_last_days(df, 2), "split")
    assert got.count("validation") == 49 and got[50] == "train" and got[51] == "validation"


def _daily(spark, days):
    return series(spark, [(24 * d, float(d)) for d in range(days)], [TARGET])


def test_folds_of_a_short_history(spark):
    folds = baseline.cv_folds(_daily(spark, 100), FoldSpec()).orderBy("split").collect()
    assert [f["split"] for f in folds] == list(range(len(folds)))
    assert (folds[0]["train_end"] - folds[0]["train_start"]).days == 49
    assert {(b["train_start"] - a["train_start"]).days for a, b in zip(folds, folds[1:], strict=False)} == {7}
    assert all(f["test_end"] <= at(24 * 99) for f in folds) and len(folds) == 7


def test_folds_fall_back_to_one_row_split(spark):
    folds = baseline.cv_folds(_daily(spark, 10), FoldSpec()).collect()
    assert len(folds) == 1 and (folds[0]["train_rows"], folds[0]["test_rows"]) == (8, 2)


def test_fold_sizes_equal_counted_rows(spark):
    """Many series, odd first stamps, missing days, a short series beside long ones."""
    rng = random.Random(4)
    rows = [(key, datetime(2024, 1, 1, begin, 30) + timedelta(hours=h), 1.0) for key, begin, hours in (("a", 5, 2400), ("b", 23, 900), ("short", 2, 60)) for h in range(0, hours, 3) if rng.random() < 0.6]
    df = spark.createDataFrame(rows, f"{KEY} string, {TS} timestamp_ntz, x double")
    folds = baseline.cv_folds(df, FoldSpec(train_days=20, test_days=3, gap_days=2, n_splits=6)).collect()
    assert {f[KEY] for f in folds} == {"a", "b", "short"}
    for f in folds:
        mine = [t for k, t, _ in rows if k == f[KEY]]
        assert f["train_rows"] == sum(f["train_start"] <= t < f["train_end"] for t in mine)
        assert f["test_rows"] == sum(f["test_start"] <= t < f["test_end"] for t in mine)


def test_fold_gap_and_empty_folds(spark):
    sparse = series(spark, [(24 * d, float(d)) for d in range(200) if not 120 <= d < 160], [TARGET])
    folds = baseline.cv_folds(sparse, FoldSpec(train_days=30, test_days=7, gap_days=2, n_splits=10)).orderBy("split").collect()
    assert all((f["test_start"] - f["train_end"]).days == 2 and f["train_rows"] > 0 and f["test_rows"] > 0 for f in folds)
    assert [f["split"] for f in folds] == list(range(len(folds))) and len(folds) < 10


# --- regimes and signals ---------------------------------------------------------


def test_one_row_day_is_in_no_volatility_class(spark):
    rows = [(h, float(h), 0.0) for h in range(24)] + [(24, 5.0, 0.0)]
    df = series(spark, rows, ["actual", "predicted"])
    got = evaluation.volatility_regimes(df, 1.0).collect()
    assert [(r["regime"], r["n_samples"], r["n_days"]) for r in got] == [("high_volatility", 24, 1)]


def test_volatility_metrics_match_a_direct_computation(spark):
    rows = [(h, float((h * 37) % 50) + 100, float((h * 11) % 40) + 100) for h in range(24 * 6)]
    df = series(spark, rows, ["actual", "predicted"])
    got = evaluation.volatility_regimes(df, -1.0).first()
    want = evaluation.regression_metrics(df).first()
    for name in ("mae", "rmse", "smape", "r2", "n_samples"):
        assert got[name] == pytest.approx(want[name])


def test_constant_outcomes_are_both_extremes(spark):
    df = series(spark, [(h, 5.0, 4.0) for h in range(6)], ["actual", "predicted"])
    got = {r["regime"]: r["n_samples"] for r in evaluation.extreme_price_regimes(df).collect()}
    assert got == {"low_prices": 6, "high_prices": 6}


def test_empty_metrics(spark):
    row = evaluation.safe_metrics(series(spark, [(0, None, 1.0)], ["actual", "predicted"])).first()
    assert row["mae"] is None and row["r2"] is None and row["n_samples"] == 0


COSTS = Economics(threshold=5.0)


def test_hourly_signals(spark):
    df = series(spark, [(0, 90.0), (1, 110.0), (2, 70.0), (3, None), (4, 95.0)], ["predicted_price"])
    out = signals.hourly_signals(df, COSTS)
    assert column(out, "clean_spark_spread") == [0.0, 20.0, -20.0, None, 5.0]
    assert column(out, "market_price") == pytest.approx([90, 100, 90, 90, 91.25])
    assert column(out, "signal") == ["HOLD", "BUY", "SELL", "HOLD", "HOLD"]
    assert column(out, "margin_signal") == ["OFF", "DISPATCH", "OFF", "OFF", "DISPATCH"]
    assert column(out, "dispatch_pnl") == [0.0, 20.0, 0.0, None, 5.0]


def test_market_prices_and_mask(spark):
    df = series(spark, [(0, 90.0, 10.0), (1, 2000.0, 10.0), (2, 90.0, 31.0), (3, None, None)], ["predicted_price", "sigma"])
    market = series(spark, [(0, 80.0)], ["price"])
    mask = signals.validity(df, COSTS, "sigma")
    assert column(mask, "valid") == [True, False, False, True]
    out = signals.hourly_signals(df, COSTS, market, mask)
    assert column(out, "signal") == ["BUY", "INVALID", "INVALID", "HOLD"]
    assert column(out, "dispatch_pnl") == [0.0, 0.0, 0.0, None]


def test_streak_breaks_on_null(spark):
    values = [-1.0, -1.0, 1.0, -1.0, -1.0, -1.0, None, -1.0]
    df = series(spark, list(enumerate(values)), ["clean_spark_spread"])
    assert signals.negative_streak(df).first()["max_negative_streak"] == 3
    none = series(spark, [(0, 1.0)], ["clean_spark_spread"])
    assert signals.negative_streak(none).first()["max_negative_streak"] == 0


def test_bucket_ties_go_to_the_first_name(spark):
    rows = [("a", "peak", 5.0), ("a", "shoulder", 5.0), ("a", "off_peak_late", -1.0), ("a", "weekend", -1.0), ("a", "off_peak_night", None)]
    df = spark.createDataFrame(rows, f"{KEY} string, bucket string, clean_spark_spread double")
    row = signals.best_worst_bucket(df).first()
    assert (row["best_bucket"], row["worst_bucket"], row["best_css"], row["worst_css"]) == ("peak", "off_peak_late", 5.0, -1.0)


def _week(spark, level):
    df = series(spark, [(h, level + (h % 24), level + (h % 20)) for h in range(168)], ["predicted_price", "actual_price"])
    hourly = signals.hourly_signals(df, COSTS)
    return hourly, signals.bucket_signals(signals.prompt_buckets(hourly), COSTS)


def test_context_and_strategy(spark):
    hourly, buckets = _week(spark, 100.0)
    row = signals.rule_strategy(signals.trading_context(hourly, buckets)).first()
    assert row["hours_analyzed"] == 168 and row["profitable_hours"] == 168 and row["profitable_pct"] == 100.0
    assert row["avg_css_eur"] == 21.5 and row["price_range"] == "€100 - €123" and row["marginal_cost"] == 90.0
    assert sum(row["signal_distribution"].values()) == 168
    assert [b["bucket"] for b in row["bucket_summary"]] == ["off_peak_late", "off_peak_night", "peak", "shoulder", "weekend"]
    assert row["best_bucket"]["name"] == "off_peak_late" and row["risk_indicators"]["max_negative_streak"] == 0
    lines = row["strategy"].split("\n")
    assert len(lines) == 3 and lines[0].startswith("1. **POSITION**: BUY off_peak_late at full size") and "21.5 EUR/MWh" in lines[0]
    assert "**RATIONALE**: 100.0%" in lines[1] and "**RISK**: drop the signal" in lines[2]


def test_strategy_levels(spark):
    texts = [signals.rule_strategy(signals.trading_context(*_week(spark, level))).first()["strategy"] for level in (85.0, 50.0)]
    assert "BUY off_peak_late at half size" in texts[0] and "**POSITION**: HOLD" in texts[1] and "few hours pay" in texts[1]


def test_summaries(spark):
    hourly, _ = _week(spark, 80.0)
    row = signals.risk_level(signals.margin_summary(hourly)).first()
    assert row["hours"] == 168 and row["profitable_hours"] == 7 * 13 and row["risk"] == "MEDIUM" and row["margin"] == "marginal"
    hits = signals.dispatch_backtest(hourly, COSTS).first()
    assert hits["correct"] + hits["wrong"] == row["profitable_hours"]
    dist = {r["signal"]: r["pct"] for r in signals.signal_distribution(hourly).collect()}
    assert sum(dist.values()) == pytest.approx(100)


def test_forecast_window_falls_back_per_series(spark):
    one = series(spark, [(h, "test" if h >= 8 else "train") for h in range(10)], ["split string"], "marked")
    two = series(spark, [(h, "train") for h in range(300)], ["split string"], "plain")
    got = {r[KEY]: r["count"] for r in tables.forecast_window(one.unionByName(two)).groupBy(KEY).count().collect()}
    assert got == {"marked": 2, "plain": 168}


def test_last_rows_limits_before_the_shuffle(spark):
    df = series(spark, [(h, 1.0) for h in range(300)], ["x"])
    plan = tables.last_rows(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_select_and_rename(spark):
    df = series(spark, [(0, 1.0, -2.0)], ["spot_price", "forecast_load"])
    assert TARGET in tables.rename_price(df).columns
    assert column(tables.select_expected(df, ["forecast_wind"]), "forecast_wind") == [None]
    assert column(tables.clamp_invalid(df), "forecast_load") == [None]
    assert tables.select_driver(df, "absent").columns == df.columns


def test_time_range_is_half_open_and_local(spark):
    df = series(spark, [(h, 1.0) for h in range(72)], ["x"])
    assert tables.time_range(df, "2024-01-02", "2024-01-02").count() == 24
    first = tables.time_range(df, "2024-01-02", "2024-01-02", "Europe/Berlin").agg(F.min(TS)).first()[0]
    assert first == datetime(2024, 1, 1, 23)


def test_quality_names():
    assert len(quality.CHECKS) == 7


def test_a_past_spike_leaves_no_trace(spark):
    """The total a window subtracts may hold a spike; a flat window after it is still flat."""
    rows = [(h, 1_000_000.0 if h == 3 else 0.1) for h in range(120)]
    out = features.rolling_features(series(spark, rows, ["x"]), ["x"], [24])
    assert column(out, "roll_24h_mean_x")[-1] == pytest.approx(0.1, abs=1e-9)
    assert column(out, "roll_24h_std_x")[-1] == pytest.approx(0.0, abs=1e-6)
