"""End-to-end jobs. Each step that later steps reuse is written as a table, which also cuts lineage."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.config import DRIVERS, KEY, TARGET, TS, JobSpec
from hourloom.operators import quality, signals
from hourloom.operators.features import build_features, feature_columns, lags_are_safe, raw_file_features
from hourloom.operators.regularize import (
    complete_hours,
    dedupe_mean,
    fill_forward,
    interpolate_hours,
    localize_to_utc,
    resample_first,
    trim_to_valid,
    valid_bounds,
)
from hourloom.operators.tables import (
    clamp_invalid,
    drop_null_target,
    forecast_window,
    outer_join_sources,
    rename_predictions,
    rename_price,
    select_expected,
)
from hourloom.sources.files import read_raw_folder
from hourloom.sources.sinks import gate_report, write_csv, write_json, write_series
from hourloom.sources.workspace import settle

log = logging.getLogger(__name__)


# --- normalisation -----------------------------------------------------------


def normalize_prices(df: DataFrame, zone: str | None = None, arrival: str | None = None, target: str = TARGET) -> DataFrame:
    """Price rows to UTC, one per hour, gaps as NULL rows. ``zone=None``: stamps are UTC already."""
    out = localize_to_utc(df, zone, arrival) if zone else df
    out = rename_price(out, target)
    return complete_hours(dedupe_mean(out, [target]))


def normalize_drivers(df: DataFrame, zone: str | None = None, arrival: str | None = None, drivers: tuple[str, ...] = DRIVERS) -> DataFrame:
    """Driver rows to UTC hours; absent drivers become NULL columns, negative load is missing."""
    out = localize_to_utc(df, zone, arrival) if zone else df
    present = [c for c in drivers if c in out.columns]
    out = select_expected(complete_hours(dedupe_mean(out, present)), drivers)
    return clamp_invalid(out, drivers[0])


def clean_dataset(df: DataFrame, columns: list[str], target: str = TARGET, max_gap: int = 2, mode: str = "rows") -> DataFrame:
    """Short gaps repeat the last value, rows still without a target go."""
    return drop_null_target(fill_forward(df, columns, max_gap, mode), target)


def regular_raw(df: DataFrame, columns: list[str], max_gap: int = 6, tie: str | None = None) -> DataFrame:
    """Raw-file path: first value per hour on a full grid, short gaps interpolated.

    ``tie`` orders rows of one stamp; without it the smallest value of a column comes first, so reruns agree.
    """
    if tie:
        return interpolate_hours(resample_first(df, columns, fill_grid=False, tie=tie), columns, max_gap)
    unique = df.groupBy(KEY, TS).agg(*[F.min(c).alias(c) for c in columns])
    return interpolate_hours(resample_first(unique, columns, fill_grid=False), columns, max_gap)


def local_features(spark: SparkSession, folder: str, spec: JobSpec = JobSpec()) -> DataFrame:
    """Raw CSV folder to a trimmed feature table.

    The regular grid is written once; the trim bounds come from it, as features
    change neither stamps nor gaps.
    """
    f = spec.features
    raw = settle(regular_raw(read_raw_folder(spark, folder, spec.market), [f.target, *f.drivers]), "regular")
    bounds = valid_bounds(drop_null_target(raw, f.target), list(f.drivers))
    return trim_to_valid(drop_null_target(raw_file_features(raw, f), f.target), list(f.drivers), bounds)


# --- ingest and prepare ------------------------------------------------------


@dataclass
class Prepared:
    """Tables and checks of one preparation run."""

    raw: DataFrame
    checks: DataFrame | None
    clean: DataFrame
    features: DataFrame
    passed: bool
    feature_names: list[str]


def ingest(prices: DataFrame, drivers: DataFrame, spec: JobSpec = JobSpec(), zone: str | None = None, arrival: str | None = None) -> DataFrame:
    """Normalise both sources and join them on every stamp either one has."""
    return outer_join_sources([normalize_prices(prices, zone, arrival), normalize_drivers(drivers, zone, arrival, spec.features.drivers)])


def run_gate(df: DataFrame, spec: JobSpec = JobSpec(), fail_fast: bool = True, arrival: str | None = None) -> tuple[DataFrame, bool]:
    """Run all checks, with an ``arrival`` column also the one on time order; a failure raises unless ``fail_fast`` is off."""
    results = settle(quality.run_checks(df, spec.contract, spec.limits, spec.features.target, spec.features.drivers, arrival), "checks")
    if fail_fast:
        return results, quality.evaluate_gate(results)
    return results, not quality.failed_checks(results)


def prepare(
    raw: DataFrame,
    spec: JobSpec = JobSpec(),
    folder: str | None = None,
    run_id: str = "run",
    skip_gate: bool = False,
    fail_fast: bool = True,
    arrival: str | None = None,
) -> Prepared:
    """Gate, clean, features and leakage check; with a ``folder`` every stage is written and read back.

    ``arrival`` numbers the rows as they came; the gate checks their order, later stages do not need it.
    """
    spark, f = raw.sparkSession, spec.features
    raw = _stage(spark, raw, folder, "raw", run_id)
    columns = [f.target, *f.drivers]
    checks, passed = (None, True) if skip_gate else run_gate(raw, spec, fail_fast, arrival)
    raw = raw.drop(arrival) if arrival else raw
    if checks is not None and folder:
        write_json(gate_report(checks, run_id), f"{folder}/checks/run_id={run_id}")
    clean = raw if skip_gate else clean_dataset(raw, columns, f.target, spec.limits.max_gap_hours)
    clean = _stage(spark, clean, folder, "clean", run_id)
    features = _stage(spark, build_features(clean, f), folder, "features", run_id)
    if not lags_are_safe(features.columns, f):
        log.error("feature table fails the leakage check")
    return Prepared(raw, checks, clean, features, passed, feature_columns(features, f))


def _stage(spark: SparkSession, df: DataFrame, folder: str | None, name: str, run_id: str) -> DataFrame:
    if folder is None:
        return df
    path = f"{folder}/{name}"
    write_series(df, path, run_id)
    return spark.read.parquet(path).filter(F.col("run_id") == run_id).select(*df.columns)


# --- signals -----------------------------------------------------------------


@dataclass
class SignalTables:
    hourly: DataFrame
    buckets: DataFrame
    distribution: DataFrame
    margins: DataFrame
    percentiles: DataFrame
    sides: DataFrame
    backtest: DataFrame | None


def run_signals(predictions: DataFrame, spec: JobSpec = JobSpec(), folder: str | None = None) -> SignalTables:
    """Predictions to hourly signals, bucket view and the tables of the signal report.

    The hourly signals feed every other table, so they are computed once.
    """
    costs = spec.economics
    window = forecast_window(rename_predictions(predictions))
    hourly = settle(signals.hourly_signals(window, costs), "signals")
    if folder:
        write_csv(hourly, f"{folder}/hourly_signals")
    view = signals.bucket_signals(signals.prompt_buckets(hourly), costs)
    if folder:
        write_csv(view, f"{folder}/prompt_view")
    return SignalTables(
        hourly,
        view,
        signals.signal_distribution(hourly),
        signals.risk_level(signals.margin_summary(hourly)),
        signals.css_percentiles(hourly),
        signals.side_summary(hourly),
        signals.dispatch_backtest(hourly, costs) if "actual_price" in hourly.columns else None,
    )


def morning_signal(predictions: DataFrame, spec: JobSpec = JobSpec(), folder: str | None = None) -> DataFrame:
    """One record per series: market, period, strategy text and the numbers behind it."""
    tables = run_signals(predictions, spec)
    context = signals.trading_context(tables.hourly, tables.buckets)
    inside = [c for c in context.columns if c != KEY]
    period = tables.hourly.groupBy(KEY).agg(
        F.concat(F.min(TS).cast("string"), F.lit(" to "), F.max(TS).cast("string")).alias("period")
    )
    record = (
        signals.rule_strategy(context)
        .join(period, KEY)
        .select(
            KEY,
            F.lit(spec.market).alias("market"),
            "period",
            "strategy",
            F.struct(*inside).alias("context"),
            F.struct(F.lit("rules").alias("provider")).alias("metadata"),
        )
    )
    if folder:
        write_json(record.withColumn("timestamp", F.current_timestamp().cast("string")), f"{folder}/morning_signal")
    return record
