"""Calendar, derived, lag, rolling and interaction features, and leakage checks."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from bindings.base import D, H, KEY, MARKETS, TARGET, TS, TYPES, USERS, VALUES, by_type, by_user, daily, market, markets, query, r
from bindings.regularize import grid_sql, interpolation_sql
from bindings.sources import land_raw_folder
from bindings.tables import trim_sql
from hourloom.config import RESIDUAL, SHARE, FeatureSpec, JobSpec

from hourloom.operators import features, transformers
from hourloom.operators.quality import arrival_order
from hourloom.plans.jobs import local_features

DOW = "(isodow(ts) - 1)"
CALENDAR_SQL = f"""CAST(hour(ts) AS INTEGER) AS hour, CAST({DOW} AS INTEGER) AS day_of_week, CAST(month(ts) AS INTEGER) AS month,
  CAST({DOW} >= 5 AS INTEGER) AS is_weekend"""
HOLIDAY_SQL = "CAST(strftime(ts, '%m-%d') IN ('01-01', '05-01', '10-03', '12-25', '12-26') AS INTEGER) AS is_holiday"
SEASON_SQL = "CAST((month(ts) % 12 + 3) // 3 AS INTEGER) AS season"
CYCLE = {
    "hour_sin": "sin(2 * pi() * hour(ts) / 24)",
    "hour_cos": "cos(2 * pi() * hour(ts) / 24)",
    "dow_sin": f"sin(2 * pi() * {DOW} / 7)",
    "dow_cos": f"cos(2 * pi() * {DOW} / 7)",
}
RESIDUAL_SQL = "forecast_load - forecast_wind - forecast_solar"
SHARE_SQL = "(forecast_wind + forecast_solar) / nullif(forecast_load, 0)"


@query("calendar_features", f"WITH {TYPES} SELECT series_key, ts, {CALENDAR_SQL} FROM t")
def calendar_features(spark, sf_dir):
    return features.calendar_features(by_type(spark, sf_dir).select(KEY, TS), ("hour", "day_of_week", "month", "is_weekend"))


@query("season", f"WITH {D} SELECT series_key, ts, {SEASON_SQL} FROM d")
def season(spark, sf_dir):
    return features.calendar_features(daily(spark, sf_dir).select(KEY, TS), ("season",))


@query("is_holiday", f"WITH {D} SELECT series_key, ts, {HOLIDAY_SQL} FROM d")
def is_holiday(spark, sf_dir):
    return features.calendar_features(daily(spark, sf_dir).select(KEY, TS), ("is_holiday",))


@query("cyclic_encoding", f"WITH {TYPES} SELECT series_key, ts, {r(*[f'{k}={v}' for k, v in CYCLE.items()])} FROM t")
def cyclic_encoding(spark, sf_dir):
    return features.cyclic_features(by_type(spark, sf_dir).select(KEY, TS))


@query("residual_load", f"WITH {H} SELECT series_key, ts, {r(f'{RESIDUAL}={RESIDUAL_SQL}')} FROM h")
def residual_load(spark, sf_dir):
    return features.derived_features(market(spark, sf_dir), VALUES[1:], (RESIDUAL,)).select(KEY, TS, RESIDUAL)


@query("renewable_share", f"WITH {H}, z AS (SELECT * REPLACE (CASE WHEN hour(ts) = 5 THEN 0.0 ELSE forecast_load END AS forecast_load) FROM h) SELECT series_key, ts, {r(f'{SHARE}={SHARE_SQL}')} FROM z")
def renewable_share(spark, sf_dir):
    zeroed = market(spark, sf_dir).withColumn(VALUES[1], F.when(F.hour(TS) == 5, 0.0).otherwise(F.col(VALUES[1])))
    return features.derived_features(zeroed, VALUES[1:], (SHARE,)).select(KEY, TS, SHARE)


# --- lags and rolling statistics ----------------------------------------------


def lag_rows_sql(columns, lags):
    return [f"lag_{n}h_{c}=lag({c}, {n}) OVER (PARTITION BY series_key ORDER BY ts)" for c in columns for n in lags]


def lag_time_sql(columns, lags):
    """Range frames that hold exactly the row ``n`` hours earlier."""
    return [
        f"lag_{n}h_{c}=max({c}) OVER (PARTITION BY series_key ORDER BY ts RANGE BETWEEN INTERVAL {n} HOUR PRECEDING AND INTERVAL {n} HOUR PRECEDING)"
        for c in columns
        for n in lags
    ]


_SQL_AGG = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}


def rolling_sql(columns, windows, aggregations, min_periods, shift=24, mode="time", prefix="roll"):
    out = []
    for c in columns:
        for w in windows:
            a, b = shift + w - 1, shift
            if mode == "time":
                frame = f"RANGE BETWEEN INTERVAL {a} HOUR PRECEDING AND INTERVAL {b} HOUR PRECEDING"
            else:
                frame = f"ROWS BETWEEN {a} PRECEDING AND {b} PRECEDING"
            over = f"OVER (PARTITION BY series_key ORDER BY ts {frame})"
            for g in aggregations:
                out.append(f"{prefix}_{w}h_{g}_{c}=CASE WHEN count({c}) {over} >= {min_periods(w)} THEN {_SQL_AGG[g]}({c}) {over} END")
    return out


@query("lag_features", f"WITH {USERS} SELECT series_key, ts, {r(*lag_rows_sql(VALUES[:2], (24, 48, 168)))} FROM u")
def lag_features(spark, sf_dir):
    out = features.lag_features(by_user(spark, sf_dir), VALUES[:2], mode="rows")
    return out.drop(*VALUES)


@query("lag_features_time", f"WITH {USERS} SELECT series_key, ts, {r(*lag_time_sql(VALUES[:2], (24, 48, 168)))} FROM u")
def lag_features_time(spark, sf_dir):
    return features.lag_features(by_user(spark, sf_dir), VALUES[:2]).drop(*VALUES)


_ALL = ("mean", "std", "min", "max")


@query("rolling_roll_then_shift", f"WITH {TYPES} SELECT series_key, ts, {r(*rolling_sql(VALUES[:2], (24, 168), _ALL, lambda w: 12))} FROM t")
def rolling_roll_then_shift(spark, sf_dir):
    return features.rolling_features(by_type(spark, sf_dir), VALUES[:2], aggregations=_ALL).drop(*VALUES)


@query(
    "rolling_shift_then_roll",
    f"WITH {TYPES} SELECT series_key, ts, {r(*rolling_sql(VALUES[:1], (24, 168), ('mean', 'std'), features.quarter_window, mode='rows'))} FROM t",
)
def rolling_shift_then_roll(spark, sf_dir):
    out = features.rolling_features(by_type(spark, sf_dir), VALUES[:1], min_periods=features.quarter_window, mode="rows")
    return out.drop(*VALUES)


@query(
    "rolling_unshifted",
    f"WITH {TYPES} SELECT series_key, ts, {r(*rolling_sql(VALUES[:1], (24, 168), _ALL, lambda w: w, 0, 'rows', 'rolling'))} FROM t",
)
def rolling_unshifted(spark, sf_dir):
    out = features.rolling_features(
        by_type(spark, sf_dir), VALUES[:1], aggregations=_ALL, min_periods=features.full_window, shift=0, mode="rows", prefix="rolling"
    )
    return out.drop(*VALUES)


@query(
    "interaction_features",
    f"""WITH {H} SELECT series_key, ts, {r(f'interact_hour_day_of_week=CAST(hour(ts) * {DOW} AS DOUBLE)', 'interact_forecast_wind_forecast_solar=forecast_wind * forecast_solar')} FROM h""",
)
def interaction_features(spark, sf_dir):
    parts = features.calendar_features(market(spark, sf_dir), ("hour", "day_of_week"))
    pairs = [("hour", "day_of_week"), ("forecast_wind", "forecast_solar"), ("hour", "absent"), ("hour",)]
    out = features.interaction_features(parts, pairs).withColumn("interact_hour_day_of_week", F.col("interact_hour_day_of_week").cast("double"))
    return out.drop("hour", "day_of_week", *VALUES)


# --- feature tables ----------------------------------------------------------

SPEC = FeatureSpec()


def features_sql(source: str, mode: str = "time", name: str = "f") -> str:
    """The default feature table over a CTE of the four value columns."""
    lags = lag_time_sql if mode == "time" else lag_rows_sql
    cells = [*lags(SPEC.lag_columns, SPEC.lags), *rolling_sql(SPEC.rolling_columns, SPEC.windows, SPEC.aggregations, lambda w: SPEC.min_periods, mode=mode)]
    windowed = ", ".join(f"{c.partition('=')[2]} AS {c.partition('=')[0]}" for c in cells)
    return f"""{name}_0 AS (SELECT *, {CALENDAR_SQL}, {HOLIDAY_SQL}, {SEASON_SQL}, {RESIDUAL_SQL} AS {RESIDUAL}, {SHARE_SQL} AS {SHARE} FROM {source}),
{name}_1 AS (SELECT *, {windowed}, hour * day_of_week AS interact_hour_day_of_week, {RESIDUAL} * hour AS interact_{RESIDUAL}_hour FROM {name}_0),
{name} AS (SELECT * FROM {name}_1 WHERE day_ahead_price IS NOT NULL)"""


INTS = ["hour", "day_of_week", "month", "is_weekend", "is_holiday", "season", "interact_hour_day_of_week"]
DOUBLES = [
    *VALUES, RESIDUAL, SHARE, f"interact_{RESIDUAL}_hour",
    *[f"lag_{n}h_{c}" for c in SPEC.lag_columns for n in SPEC.lags],
    *[f"roll_{w}h_{a}_{c}" for c in SPEC.rolling_columns for w in SPEC.windows for a in SPEC.aggregations],
]


@query("build_features", f"WITH {MARKETS}, {features_sql('h')} SELECT series_key, ts, {', '.join(INTS)}, {r(*DOUBLES)} FROM f")
def build_features(spark, sf_dir):
    return features.build_features(markets(spark, sf_dir), SPEC)


@query("feature_toggles", f"WITH {MARKETS}, c AS (SELECT *, {CALENDAR_SQL} FROM h) SELECT series_key, ts, hour, day_of_week, month, is_weekend, {r(*VALUES, *lag_time_sql((TARGET,), (24, 168)))} FROM c QUALIFY day_ahead_price IS NOT NULL")
def feature_toggles(spark, sf_dir):
    spec = FeatureSpec(
        calendar=("hour", "day_of_week", "month", "is_weekend"), lag_columns=(TARGET,), lags=(24, 168), enable_derived=False, enable_rolling=False, enable_interactions=False
    )
    return features.build_features(markets(spark, sf_dir), spec)


_RAW_CELLS = [
    *lag_rows_sql((TARGET, VALUES[1]), SPEC.lags),
    *rolling_sql((TARGET,), SPEC.windows, ("mean", "std"), features.quarter_window, mode="rows"),
]
_RAW_WINDOWS = ", ".join(f"{c.partition('=')[2]} AS {c.partition('=')[0]}" for c in _RAW_CELLS)
_RAW_DOUBLES = [*VALUES, RESIDUAL, *CYCLE, "wind_x_solar", *[c.partition("=")[0] for c in _RAW_CELLS]]


@query(
    "load_local_features",
    f"""WITH {H}, {grid_sql('h')}, {interpolation_sql('g', VALUES)},
f0 AS (SELECT *, {CALENDAR_SQL}, {", ".join(f"{v} AS {k}" for k, v in CYCLE.items())}, {RESIDUAL_SQL} AS {RESIDUAL},
  forecast_wind * forecast_solar / 1e6 AS wind_x_solar, {_RAW_WINDOWS} FROM filled),
f1 AS (SELECT *, hour * day_of_week AS hour_x_dow FROM f0 WHERE day_ahead_price IS NOT NULL), {trim_sql('f1')}
SELECT series_key, ts, hour, day_of_week, month, is_weekend, hour_x_dow, {r(*_RAW_DOUBLES)} FROM c2""",
)
def load_local_features(spark, sf_dir):
    folder = land_raw_folder(spark, market(spark, sf_dir))
    return local_features(spark, folder, JobSpec(market="all"))


# --- metadata, measured on the data -------------------------------------------

_HIDDEN = {KEY, TS, *VALUES, RESIDUAL}
_SHOWN = [c for c in [*INTS, *DOUBLES] if c not in _HIDDEN]


@query(
    "feature_columns",
    f"WITH {MARKETS}, {features_sql('h')} " + " UNION ALL ".join(f"SELECT '{c}' AS feature, count({c}) AS known FROM f" for c in _SHOWN),
)
def feature_columns(spark, sf_dir):
    table = features.build_features(markets(spark, sf_dir), SPEC)
    names = features.feature_columns(table, SPEC)
    counts = table.agg(*[F.count(c).alias(c) for c in names])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("known")) for c in names])))


@query(
    "leakage_lag_check",
    f"""WITH {MARKETS}, f(severity, finding) AS (VALUES ('error', 'lag 6h is shorter than 24h'), ('warning', 'no lag 48h column'))
SELECT severity, finding, count(day_ahead_price) AS n_rows FROM h CROSS JOIN f GROUP BY ALL""",
)
def leakage_lag_check(spark, sf_dir):
    spec = FeatureSpec(lags=(6, 24), lag_columns=(TARGET,), enable_rolling=False)
    built = features.build_features(markets(spark, sf_dir), spec)
    found = features.lag_findings(built.columns, (6, 24, 48))
    literal = F.array(*[F.struct(F.lit(s).alias("severity"), F.lit(t).alias("finding")) for s, t in found])
    return built.agg(F.count(TARGET).alias("n_rows")).select("n_rows", F.inline(literal))


@query(
    "leakage_name_check",
    f"""WITH {TYPES}, x AS (SELECT event_type AS series_key, ts < lag(ts) OVER (PARTITION BY event_type ORDER BY user_id * 1000000 + event_id) AS back
  FROM events), o AS (SELECT series_key, NOT coalesce(bool_or(back), false) AS ordered FROM x GROUP BY 1),
f(column_name, finding) AS (VALUES ('lag_6h_day_ahead_price', 'short lag'), ('future_load', 'suspicious name'))
SELECT o.series_key, o.ordered, f.column_name, f.finding FROM o CROSS JOIN f""",
)
def leakage_name_check(spark, sf_dir):
    built = features.lag_features(by_type(spark, sf_dir), [TARGET], [6, 24]).withColumn("future_load", F.col(VALUES[1]))
    short = features.short_lag_columns(built.columns)
    odd = features.suspicious_columns(built.columns, VALUES)
    found = [(c, "short lag") for c in short] + [(c, "suspicious name") for c in odd]
    literal = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("finding")) for c, t in found])
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    arrival = (F.col("user_id") * 1_000_000 + F.col("event_id")).alias("arrival")
    order = arrival_order(events.select(F.col("event_type").alias(KEY), TS, arrival), "arrival")
    return order.select(KEY, F.col("monotone").alias("ordered"), F.inline(literal))


@query(
    "ml_transformers",
    f"""WITH {TYPES} SELECT series_key, ts, {CALENDAR_SQL}, {r(*VALUES, f'residual_load={RESIDUAL_SQL}', *lag_time_sql((TARGET,), (24, 168)),
    *rolling_sql((VALUES[1],), (24,), ('mean', 'max'), lambda w: w, 0, 'time', 'rolling'))} FROM t""",
)
def ml_transformers(spark, sf_dir):
    stages = [
        transformers.ResidualLoad(load=VALUES[1], wind=VALUES[2], solar=VALUES[3]),
        transformers.CalendarParts(),
        transformers.Lags(columns=[TARGET], lags=[24, 168]),
        transformers.RollingWindows(columns=[VALUES[1]], windows=[24], aggregations=["mean", "max"]),
    ]
    rows = by_type(spark, sf_dir)
    return Pipeline(stages=stages).fit(rows).transform(rows)


