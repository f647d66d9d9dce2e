"""Score prediction tables: overall, by bucket, by regime, and side by side."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.config import KEY, TS, WEEK_HOURS
from hourloom.functions.calendar import is_weekend, trading_buckets
from hourloom.functions.clock import day_number
from hourloom.functions.numbers import equal_width_bin, improvement_pct
from hourloom.functions.scores import r_squared, score_columns, smape_term
from hourloom.functions.numbers import nan_to_null
from hourloom.operators.pieces import attach_summary
from hourloom.operators.quantiles import percentile_columns
from hourloom.operators.tables import inner_join_models, last_rows



def scored(df: DataFrame) -> DataFrame:
    """Rows that have both an outcome and a forecast."""
    return df.filter(nan_to_null(F.col("actual")).isNotNull() & nan_to_null(F.col("predicted")).isNotNull())


def regression_metrics(df: DataFrame, by: Sequence[str] = (KEY,)) -> DataFrame:
    """mae, rmse, smape, r2, n_samples per group, combined before the shuffle."""
    return scored(df).groupBy(*by).agg(*score_columns(F.col("actual"), F.col("predicted")))


def safe_metrics(df: DataFrame) -> DataFrame:
    """One row even for an empty table: metrics are NULL and the count 0."""
    return scored(df).agg(*score_columns(F.col("actual"), F.col("predicted")))


def bucket_metrics(df: DataFrame, buckets: Callable[[str], dict[str, Column]] = trading_buckets, by: Sequence[str] = (KEY,)) -> DataFrame:
    """Metrics per named predicate; a row counts in every bucket it satisfies.

    The copies exist only in front of the map-side aggregation. Empty buckets
    have no row.
    """
    labels = F.filter(F.array(*[F.when(p, n) for n, p in buckets(TS).items()]), lambda x: x.isNotNull())
    return scored(df).withColumn("bucket", F.explode(labels)).groupBy(*by, "bucket").agg(*score_columns(F.col("actual"), F.col("predicted")))


def hour_metrics(df: DataFrame) -> DataFrame:
    """24 disjoint buckets need no copies: group by the hour itself."""
    name = F.format_string("hour_%02d", F.hour(TS)).alias("bucket")
    return scored(df).groupBy(KEY, name).agg(*score_columns(F.col("actual"), F.col("predicted")))


def baseline_improvement(base: DataFrame, model: DataFrame) -> DataFrame:
    """Relative reduction of each error metric, from two one-row-per-series tables."""
    names = ("mae", "rmse", "smape")
    a = base.select(KEY, *[F.col(n).alias(f"_b_{n}") for n in names])
    joined = a.join(model.select(KEY, *names), KEY)
    return joined.select(KEY, *[improvement_pct(F.col(f"_b_{n}"), F.col(n)).alias(f"{n}_improvement_pct") for n in names])


# --- regimes -----------------------------------------------------------------


def weekday_weekend(df: DataFrame) -> DataFrame:
    regime = F.when(is_weekend(TS) == 1, "weekend").otherwise("weekday").alias("regime")
    return scored(df).groupBy(KEY, regime).agg(*score_columns(F.col("actual"), F.col("predicted")))


def _daily(df: DataFrame) -> DataFrame:
    """Per series and day: what the metrics of any set of days can be rebuilt from."""
    error = F.col("actual") - F.col("predicted")
    return scored(df).groupBy(KEY, day_number(TS).alias("day")).agg(
        F.count("*").alias("n"),
        F.sum(F.abs(error)).alias("abs_error"),
        F.sum(error * error).alias("sq_error"),
        F.sum(smape_term(F.col("actual"), F.col("predicted"))).alias("smape_sum"),
        F.avg(F.col("actual")).alias("mean"),
        (F.var_pop(F.col("actual")) * F.count("*")).alias("moment"),
        F.stddev_samp(F.col("actual")).alias("daily_std"),
    )


def daily_volatility(df: DataFrame) -> DataFrame:
    """Standard deviation of the outcome per series and day; one-row days have none."""
    return scored(df).groupBy(KEY, F.to_date(TS).alias("day")).agg(F.stddev_samp(F.col("actual")).alias("daily_std"))


def volatility_threshold(df: DataFrame, p: float = 0.75) -> DataFrame:
    """A high percentile of the daily deviations; a series has one value per calendar day."""
    return daily_volatility(df).groupBy(KEY).agg(F.percentile("daily_std", F.lit(p)).alias("threshold"))


def volatility_regimes(df: DataFrame, threshold: float | None = 50.0) -> DataFrame:
    """Metrics of volatile and calm days; ``None`` uses each series' own 75th percentile.

    Days are classified and merged from per-day sums, so rows shuffle once. The
    spread of the outcome is the within-day moment plus the spread of day means.
    """
    days = _daily(df)
    if threshold is None:
        own = days.groupBy(KEY).agg(F.percentile("daily_std", F.lit(0.75)).alias("_limit"))
        days = days.join(own, KEY)
        limit = F.col("_limit")
    else:
        limit = F.lit(threshold)
    regime = F.when(F.col("daily_std") > limit, "high_volatility").when(F.col("daily_std") <= limit, "low_volatility")
    n, total = F.col("n"), F.sum("n")
    # Means are taken relative to one day of the group to keep the squares small.
    classed = days.withColumn("regime", regime).filter("regime is not null")
    centre = classed.groupBy(KEY, "regime").agg((F.sum(n * F.col("mean")) / total).alias("_centre"))
    offset = F.col("mean") - F.col("_centre")
    sst = F.sum(F.col("moment") + n * offset * offset)
    return classed.join(centre, [KEY, "regime"]).groupBy(KEY, "regime").agg(
        (F.sum("abs_error") / total).alias("mae"),
        F.sqrt(F.sum("sq_error") / total).alias("rmse"),
        (F.sum("smape_sum") / total).alias("smape"),
        r_squared(F.sum("sq_error"), sst, total).alias("r2"),
        total.alias("n_samples"),
        F.count("*").alias("n_days"),
    )


def extreme_price_regimes(df: DataFrame, low: float = 0.10, high: float = 0.90) -> DataFrame:
    """Metrics of the cheapest, middle and dearest outcomes, with the two thresholds."""
    rows = scored(df)
    limits = percentile_columns(rows, "actual", {"low_threshold": low, "high_threshold": high}, [KEY])
    regime = (
        F.when(F.col("actual") <= F.col("low_threshold"), "low_prices")
        .when(F.col("actual") >= F.col("high_threshold"), "high_prices")
        .otherwise("mid_prices")
    )
    # A value on both thresholds (a constant series) belongs to both extremes, as each is closed.
    both = (F.col("actual") <= F.col("low_threshold")) & (F.col("actual") >= F.col("high_threshold"))
    labels = F.when(both, F.array(F.lit("low_prices"), F.lit("high_prices"))).otherwise(F.array(regime))
    return (
        attach_summary(rows.select(KEY, TS, "actual", "predicted"), limits)
        .withColumn("regime", F.explode(labels))
        .groupBy(KEY, "regime")
        .agg(
            *score_columns(F.col("actual"), F.col("predicted")),
            F.first("low_threshold").alias("low_threshold"),
            F.first("high_threshold").alias("high_threshold"),
        )
    )


# --- error distributions -----------------------------------------------------


def residual_stats(df: DataFrame) -> DataFrame:
    """Mean, standard deviation and range of ``actual - predicted`` per series."""
    r = F.col("actual") - F.col("predicted")
    return scored(df).groupBy(KEY).agg(
        F.avg(r).alias("mean"), F.stddev_pop(r).alias("std"), F.min(r).alias("low"), F.max(r).alias("high")
    )


def residual_histogram(df: DataFrame, bins: int = 50) -> DataFrame:
    """Equal-width bins over each series' own residual range; a constant gets a unit-wide range."""
    stats = residual_stats(df)
    flat = F.col("low") == F.col("high")
    bounds = stats.select(
        KEY, "mean", "std", F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"), F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")).alias("high")
    )
    rows = attach_summary(scored(df).select(KEY, TS, (F.col("actual") - F.col("predicted")).alias("residual")), bounds)
    binned = rows.withColumn("bin", equal_width_bin(F.col("residual"), F.col("low"), F.col("high"), bins))
    return binned.groupBy(KEY, "bin").agg(
        F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("mean", "std", "low", "high")]
    )


def error_histogram(models: dict[str, DataFrame], low: float = -100.0, high: float = 100.0, bins: int = 50) -> DataFrame:
    """Counts per model and fixed bin; errors outside the range are not shown."""
    parts = [scored(df).select(KEY, F.lit(name).alias("model"), (F.col("actual") - F.col("predicted")).alias("e")) for name, df in models.items()]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    binned = rows.withColumn("bin", equal_width_bin(F.col("e"), F.lit(low), F.lit(high), bins)).filter("bin is not null")
    return binned.groupBy(KEY, "model", "bin").agg(F.count("*").alias("n"))


def prediction_comparison(baseline: DataFrame, model: DataFrame, n: int = WEEK_HOURS) -> DataFrame:
    """The last ``n`` rows of both models on their common stamps, with both errors."""
    joined = inner_join_models(last_rows(baseline, n), last_rows(model, n))
    return joined.withColumns(
        {"baseline_error": F.col("actual") - F.col("baseline_predicted"), "model_error": F.col("actual") - F.col("model_predicted")}
    )
