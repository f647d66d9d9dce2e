"""Registry, series built from the test tables, and SQL building blocks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourloom.config import DRIVERS, KEY, TARGET, TS, ColumnRule, Economics, QualityLimits
from hourloom.functions.clock import day_start, hour_start
from hourloom.operators.baseline import train_baseline

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

VALUES = (TARGET, *DRIVERS)
COLUMNS = ", ".join(VALUES)
DIGITS = 6
# Sums differ between engines in their last bits. Exact halves at the last printed digit (means over 2, 4, 8 ...
# rows) would then round either way; this nudge, far below that digit, moves them off the edge on both sides.
NUDGE = "3.14159e-8"


def query(name: str, sql: str | None = None):
    def register(make: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(make(spark, sf_dir))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return make

    return register


def rounded(df: DataFrame) -> DataFrame:
    """Scale, round, scale back: the arithmetic of ``round(x, 6)`` on the SQL side."""
    scale = 10.0**DIGITS
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.round((F.col(c) + float(NUDGE)) * scale) / scale + F.lit(0.0) for c in doubles}) if doubles else df


def r(*columns: str) -> str:
    """SQL list that rounds like ``rounded``; ``name=expression`` or plain names."""
    parts = []
    for c in columns:
        name, _, expression = c.partition("=")
        parts.append(f"round(({expression or name}) + {NUDGE}, {DIGITS}) + 0.0 AS {name}")
    return ", ".join(parts)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- series ------------------------------------------------------------------


def _mean_of(kind: str, scale: float = 1.0):
    mean = F.avg(F.when(F.col("event_type") == kind, F.col("value")))
    return mean if scale == 1.0 else F.lit(scale) * mean


def market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One hourly series; each event type feeds one column, so gaps are natural."""
    e = table(spark, sf_dir, "events")
    return e.groupBy(hour_start(TS).alias(TS)).agg(
        _mean_of("purchase").alias(VALUES[0]),
        _mean_of("view", 100.0).alias(VALUES[1]),
        _mean_of("click", 20.0).alias(VALUES[2]),
        _mean_of("signup", 10.0).alias(VALUES[3]),
    ).select(F.lit("all").alias(KEY), TS, *VALUES)


H = """h AS (
  SELECT 'all' AS series_key, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts,
         avg(value) FILTER (WHERE event_type = 'purchase') AS day_ahead_price,
         100.0 * avg(value) FILTER (WHERE event_type = 'view') AS forecast_load,
         20.0 * avg(value) FILTER (WHERE event_type = 'click') AS forecast_wind,
         10.0 * avg(value) FILTER (WHERE event_type = 'signup') AS forecast_solar
  FROM events GROUP BY 2)"""


def markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same columns for every user: many series with many gaps."""
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.col("user_id").cast("string").alias(KEY), hour_start(TS).alias(TS)).agg(
        _mean_of("purchase").alias(VALUES[0]),
        _mean_of("view", 100.0).alias(VALUES[1]),
        _mean_of("click", 20.0).alias(VALUES[2]),
        _mean_of("signup", 10.0).alias(VALUES[3]),
    )


MARKETS = H.replace("'all' AS series_key", "CAST(user_id AS VARCHAR) AS series_key").replace("GROUP BY 2", "GROUP BY 1, 2")


def _spread(df: DataFrame) -> DataFrame:
    v = F.col("value")
    return df.groupBy(KEY, hour_start(TS).alias(TS)).agg(
        F.avg(v).alias(VALUES[0]), (F.lit(100.0) * F.max(v)).alias(VALUES[1]), (F.lit(20.0) * F.min(v)).alias(VALUES[2]), (F.lit(10.0) * F.count("*")).alias(VALUES[3])
    )


_SPREAD = """avg(value) AS day_ahead_price, 100.0 * max(value) AS forecast_load,
         20.0 * min(value) AS forecast_wind, CAST(10 * count(*) AS DOUBLE) AS forecast_solar"""


def by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five hourly series, one per event type."""
    return _spread(table(spark, sf_dir, "events").withColumn(KEY, F.col("event_type")))


TYPES = f"""t AS (
  SELECT event_type AS series_key, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts, {_SPREAD}
  FROM events GROUP BY 1, 2)"""


def by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many sparse hourly series, one per user."""
    return _spread(table(spark, sf_dir, "events").withColumn(KEY, F.col("user_id").cast("string")))


USERS = f"""u AS (
  SELECT CAST(user_id AS VARCHAR) AS series_key, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts, {_SPREAD}
  FROM events GROUP BY 1, 2)"""


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six daily series over many years."""
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(F.concat("l_returnflag", "l_linestatus").alias(KEY), day_start("l_shipdate").alias(TS)).agg(
        F.avg("l_extendedprice").alias(VALUES[0]), F.avg("l_quantity").alias(VALUES[1]), F.avg("l_discount").alias(VALUES[2]), F.avg("l_tax").alias(VALUES[3])
    )


D = """d AS (
  SELECT l_returnflag || l_linestatus AS series_key, CAST(date_trunc('day', l_shipdate) AS TIMESTAMP) AS ts,
         avg(l_extendedprice) AS day_ahead_price, avg(l_quantity) AS forecast_load,
         avg(l_discount) AS forecast_wind, avg(l_tax) AS forecast_solar
  FROM lineitem GROUP BY 1, 2)"""


def predictions(spark: SparkSession, sf_dir: str, lag: int = 168) -> DataFrame:
    """Naive forecasts of the five event-type series."""
    return train_baseline(by_type(spark, sf_dir), lag=lag)


def predictions_sql(name: str = "p", lag: int = 168) -> str:
    return f"""{name} AS (
  SELECT a.series_key, a.ts, a.day_ahead_price AS actual, b.day_ahead_price AS predicted,
         a.day_ahead_price - b.day_ahead_price AS residual
  FROM t a JOIN t b ON a.series_key = b.series_key AND b.ts = a.ts - INTERVAL {lag} HOUR)"""


P = f"{TYPES}, {predictions_sql()}"
MODEL_LAG = 24
PM = f"{P}, {predictions_sql('m', MODEL_LAG)}"

SCORES = """avg(abs(actual - predicted)) AS mae, sqrt(avg((actual - predicted) * (actual - predicted))) AS rmse,
  avg(CASE WHEN abs(actual) + abs(predicted) = 0 THEN 0
           ELSE 200.0 * abs(actual - predicted) / (abs(actual) + abs(predicted)) END) AS smape,
  CASE WHEN count(*) < 2 THEN NULL
       WHEN max(actual) = min(actual) THEN CASE WHEN max(abs(actual - predicted)) = 0 THEN 1.0 ELSE 0.0 END
       ELSE 1 - sum((actual - predicted) * (actual - predicted)) / (var_pop(actual) * count(*)) END AS r2,
  count(*) AS n_samples"""
ROUNDED_SCORES = r("mae", "rmse", "smape", "r2") + ", n_samples"

# --- parameters that make both branches of every rule fire on this data --------

COSTS = Economics(gas_price=15.0, carbon_price=20.0, heat_rate=2.0, carbon_intensity=0.4, threshold=10.0, max_uncertainty=30.0, floor_price=5.0, cap_price=120.0)
MARGINAL = COSTS.marginal_cost

RULES = (
    ColumnRule(TS, "timestamp_ntz", required=True),
    ColumnRule(VALUES[0], "double", 1.0, 150.0, True),
    ColumnRule(VALUES[1], "double", 50.0, 30000.0, True),
    ColumnRule(VALUES[2], "double", 0.0, 4000.0, True),
    ColumnRule(VALUES[3], "double", 0.0, 2000.0, False),
)
LIMITS = QualityLimits(price_zscore=3.0, driver_zscore=2.5, max_gap_hours=2)
