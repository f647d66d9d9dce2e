"""Scores of the naive forecasts of five series."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.base import KEY, MODEL_LAG, P, PM, ROUNDED_SCORES, SCORES, TYPES, predictions, query, r
from bindings.features import DOUBLES, INTS, features_sql
from bindings.models import BOOST, COMPLETE, JOB, stored_features
from hourloom.config import DRIVERS
from hourloom.operators import evaluation as ev
from hourloom.operators.baseline import split_ratio
from hourloom.plans.boosting import fit_boosted, missing_driver_stress, model_inputs
from hourloom.plans.validation import run_validation as validate

DOW = "(isodow(ts) - 1)"


def scored_sql(extra: str, group: str, source: str = "p", where: str = "true", ctes: str = P) -> str:
    return f"WITH {ctes}, s AS (SELECT {extra}, {SCORES} FROM {source} WHERE {where} GROUP BY {group})"


@query("regression_metrics", f"{scored_sql('series_key', '1')} SELECT series_key, {ROUNDED_SCORES} FROM s")
def regression_metrics(spark, sf_dir):
    return ev.regression_metrics(predictions(spark, sf_dir))


@query("safe_metrics", f"WITH {P}, s AS (SELECT {SCORES} FROM p WHERE actual < 0) SELECT {ROUNDED_SCORES} FROM s")
def safe_metrics(spark, sf_dir):
    return ev.safe_metrics(predictions(spark, sf_dir).filter("actual < 0"))


_NIGHT, _LATE, _PEAK = "hour(ts) < 6", "hour(ts) >= 22", f"(hour(ts) >= 8 AND hour(ts) < 20 AND {DOW} < 5)"
_BUCKETS = {
    "off_peak_night": _NIGHT,
    "off_peak_late": _LATE,
    "peak": _PEAK,
    "shoulder": f"NOT ({_NIGHT}) AND NOT ({_LATE}) AND NOT {_PEAK}",
    "weekend": f"{DOW} >= 5",
    "weekday": f"{DOW} < 5",
}


def _bucket_sql(where: str = "true") -> str:
    parts = [f"SELECT series_key, '{n}' AS bucket, {SCORES} FROM p WHERE {w} AND {where} GROUP BY 1" for n, w in _BUCKETS.items()]
    return f"WITH {P}, s AS (" + " UNION ALL ".join(parts) + ")"



@query("bucket_metrics", f"{_bucket_sql()} SELECT series_key, bucket, {ROUNDED_SCORES} FROM s")
def bucket_metrics(spark, sf_dir):
    return ev.bucket_metrics(predictions(spark, sf_dir))


@query("trading_buckets", _bucket_sql() + " SELECT series_key, bucket, n_samples FROM s")
def trading_buckets(spark, sf_dir):
    return ev.bucket_metrics(predictions(spark, sf_dir)).select(KEY, "bucket", "n_samples")


@query("hour_buckets", f"""{scored_sql("series_key, 'hour_' || lpad(CAST(hour(ts) AS VARCHAR), 2, '0') AS bucket", '1, 2')} SELECT series_key, bucket, {ROUNDED_SCORES} FROM s""")
def hour_buckets(spark, sf_dir):
    return ev.hour_metrics(predictions(spark, sf_dir))


@query(
    "baseline_improvement",
    f"""WITH {PM}, a AS (SELECT series_key, {SCORES} FROM p GROUP BY 1), b AS (SELECT series_key, {SCORES} FROM m GROUP BY 1)
SELECT series_key, {r(*[f'{n}_improvement_pct=100 * (a.{n} - b.{n}) / a.{n}' for n in ('mae', 'rmse', 'smape')])} FROM a JOIN b USING (series_key)""",
)
def baseline_improvement(spark, sf_dir):
    return ev.baseline_improvement(ev.regression_metrics(predictions(spark, sf_dir)), ev.regression_metrics(predictions(spark, sf_dir, MODEL_LAG)))


@query("stress_weekday_weekend", f"{scored_sql(f'''series_key, CASE WHEN {DOW} >= 5 THEN 'weekend' ELSE 'weekday' END AS regime''', '1, 2')} SELECT series_key, regime, {ROUNDED_SCORES} FROM s")
def stress_weekday_weekend(spark, sf_dir):
    return ev.weekday_weekend(predictions(spark, sf_dir))


_DAYS = "days AS (SELECT series_key, CAST(ts AS DATE) AS day, stddev_samp(actual) AS sd FROM p GROUP BY 1, 2)"
_LIMIT = "k AS (SELECT series_key, quantile_cont(sd, 0.75) AS threshold FROM days GROUP BY 1)"


@query(
    "stress_volatility",
    f"""WITH {P}, {_DAYS}, {_LIMIT}, c AS (SELECT p.*, d.day, CASE WHEN d.sd > k.threshold THEN 'high_volatility' ELSE 'low_volatility' END AS regime
  FROM p JOIN days d ON p.series_key = d.series_key AND CAST(p.ts AS DATE) = d.day JOIN k ON k.series_key = p.series_key WHERE d.sd IS NOT NULL),
s AS (SELECT series_key, regime, {SCORES}, count(DISTINCT day) AS n_days FROM c GROUP BY 1, 2)
SELECT series_key, regime, {ROUNDED_SCORES}, n_days FROM s""",
)
def stress_volatility(spark, sf_dir):
    return ev.volatility_regimes(predictions(spark, sf_dir), None)


@query("volatility_threshold", f"WITH {P}, {_DAYS}, {_LIMIT} SELECT series_key, {r('threshold')} FROM k")
def volatility_threshold(spark, sf_dir):
    return ev.volatility_threshold(predictions(spark, sf_dir))


@query(
    "stress_extreme_prices",
    f"""WITH {P}, k AS (SELECT series_key, quantile_cont(actual, 0.1) AS low_threshold, quantile_cont(actual, 0.9) AS high_threshold FROM p GROUP BY 1),
c AS (SELECT p.*, k.low_threshold, k.high_threshold, CASE WHEN actual <= low_threshold THEN 'low_prices' WHEN actual >= high_threshold THEN 'high_prices' ELSE 'mid_prices' END AS regime
  FROM p JOIN k USING (series_key)),
s AS (SELECT series_key, regime, {SCORES}, any_value(low_threshold) AS low_threshold, any_value(high_threshold) AS high_threshold FROM c GROUP BY 1, 2)
SELECT series_key, regime, {ROUNDED_SCORES}, {r('low_threshold', 'high_threshold')} FROM s""",
)
def stress_extreme_prices(spark, sf_dir):
    return ev.extreme_price_regimes(predictions(spark, sf_dir))


@query(
    "residual_stats",
    f"""WITH {P}, k AS (SELECT series_key, avg(residual) AS mean, stddev_pop(residual) AS std, min(residual) AS low, max(residual) AS high FROM p GROUP BY 1)
SELECT series_key, CAST(least(floor((residual - low) / (high - low) * 50) + 1, 50) AS INTEGER) AS bin, count(*) AS n,
  {r('mean=any_value(mean)', 'std=any_value(std)', 'low=any_value(low)', 'high=any_value(high)')} FROM p JOIN k USING (series_key) GROUP BY 1, 2""",
)
def residual_stats(spark, sf_dir):
    return ev.residual_histogram(predictions(spark, sf_dir))


@query(
    "error_histogram",
    f"""WITH {PM}, e AS (SELECT series_key, 'baseline' AS model, residual AS e FROM p UNION ALL SELECT series_key, 'improved', residual FROM m)
SELECT series_key, model, CAST(least(floor((e + 100.0) / 200.0 * 50) + 1, 50) AS INTEGER) AS bin, count(*) AS n FROM e WHERE e >= -100 AND e <= 100 GROUP BY 1, 2, 3""",
)
def error_histogram(spark, sf_dir):
    return ev.error_histogram({"baseline": predictions(spark, sf_dir), "improved": predictions(spark, sf_dir, MODEL_LAG)})


_LAST = "row_number() OVER (PARTITION BY series_key ORDER BY ts DESC) <= 168"


@query(
    "prediction_comparison",
    f"""WITH {PM}, a AS (SELECT * FROM p QUALIFY {_LAST}), b AS (SELECT * FROM m QUALIFY {_LAST})
SELECT a.series_key, a.ts, {r('actual=a.actual', 'baseline_predicted=a.predicted', 'model_predicted=b.predicted', 'baseline_error=a.actual - a.predicted', 'model_error=a.actual - b.predicted')}
FROM a JOIN b ON a.series_key = b.series_key AND a.ts = b.ts""",
)
def prediction_comparison(spark, sf_dir):
    return ev.prediction_comparison(predictions(spark, sf_dir), predictions(spark, sf_dir, MODEL_LAG))


# --- the boosted model under stress ------------------------------------------------
# SQL cannot repeat the fit: it states the scored rows, regimes, scenarios, medians and all numbers of the naive model.

_SCENARIOS = {"baseline": "NULL", **{f"missing_{d}": f"quantile_cont({d}, 0.5)" for d in DRIVERS}}


def _scenario_sql(source: str, columns: str) -> str:
    """One row per series and scenario with the median that stands in for the driver."""
    parts = [f"SELECT series_key, '{name}' AS scenario, count(*) AS n, CAST({median} AS DOUBLE) AS replaced_by FROM {source} GROUP BY 1" for name, median in _SCENARIOS.items()]
    return f"SELECT series_key, {columns} FROM ({' UNION ALL '.join(parts)})"


@query(
    "stress_missing_driver",
    f"""WITH {COMPLETE}, v AS (SELECT * FROM c WHERE split = 'validation')
{_scenario_sql('v', f"scenario, n AS n_samples, {r('replaced_by')}, true AS ordered, CAST(CASE WHEN scenario = 'baseline' THEN 0.0 END AS DOUBLE) AS degradation_of_baseline")}""",
)
def stress_missing_driver(spark, sf_dir):
    rows = stored_features(spark, sf_dir)
    inputs = model_inputs(rows)
    parted = split_ratio(rows.na.drop("any"))
    model = fit_boosted(parted.filter("split = 'train'"), inputs=inputs, spec=BOOST)
    out = missing_driver_stress(model, parted.filter("split = 'validation'").drop("split"))
    own = F.when(F.col("scenario") == "baseline", F.col("mae_degradation_pct")).alias("degradation_of_baseline")
    return out.select(KEY, "scenario", "n_samples", "replaced_by", (F.col("rmse") >= F.col("mae")).alias("ordered"), own)


_NUMBERS = ("mae", "rmse", "smape", "r2")


def _long(section: str, name: str, values: dict[str, str], source: str) -> str:
    """Rows of the report: one per metric; what depends on the trees has no value in SQL."""
    return " UNION ALL ".join(f"SELECT series_key, '{section}' AS section, {name} AS name, '{m}' AS metric, CAST({v} AS DOUBLE) AS value FROM {source}" for m, v in values.items())


_KNOWN = {m: m for m in (*_NUMBERS, "n_samples")}
_TREES = {**dict.fromkeys(_NUMBERS, "NULL"), "n_samples": "n_samples"}
_DEGRADED = {**_TREES, "replaced_by": "replaced_by", "mae_degradation_pct": "NULL"}
_HOUR = "'hour_' || lpad(CAST(hour(ts) AS VARCHAR), 2, '0')"
_REPORT = [
    _long("overall", "'baseline'", _KNOWN, "s"),
    _long("overall", "'improved'", _TREES, "s"),
    _long("improvement", "'all'", {f"{n}_improvement_pct": "NULL" for n in ("mae", "rmse", "smape")}, "s"),
    _long("hour_baseline", "bucket", _KNOWN, "hours"),
    _long("hour_improved", "bucket", _TREES, "hours"),
    _long("weekday_weekend", "regime", _TREES, "ends"),
    _long("volatility", "regime", {**_TREES, "n_days": "n_days"}, "calm"),
    _long("missing_driver", "scenario", _DEGRADED, "stress"),
    _long("leakage", "'all'", {"issues": "0"}, "s"),
]


@query(
    "run_validation",
    f"""WITH {TYPES}, {features_sql('t')}, ready AS (SELECT * FROM f WHERE day_ahead_price IS NOT NULL),
borders AS (SELECT series_key, max(ts) - INTERVAL {JOB.validation_days} DAY AS border FROM ready GROUP BY 1),
v AS (SELECT ready.*, day_ahead_price AS actual, lag_168h_day_ahead_price AS predicted FROM ready JOIN borders USING (series_key)
  WHERE ts >= border AND {' AND '.join(f'{c} IS NOT NULL' for c in (*INTS, *DOUBLES))}),
s AS (SELECT series_key, {SCORES} FROM v GROUP BY 1),
hours AS (SELECT series_key, {_HOUR} AS bucket, {SCORES} FROM v GROUP BY 1, 2),
ends AS (SELECT series_key, CASE WHEN {DOW} >= 5 THEN 'weekend' ELSE 'weekday' END AS regime, count(*) AS n_samples FROM v GROUP BY 1, 2),
days AS (SELECT series_key, CAST(ts AS DATE) AS day, count(*) AS n, stddev_samp(actual) AS std FROM v GROUP BY 1, 2),
limits AS (SELECT series_key, quantile_cont(std, 0.75) AS top FROM days GROUP BY 1),
calm AS (SELECT series_key, CASE WHEN std > top THEN 'high_volatility' ELSE 'low_volatility' END AS regime, sum(n) AS n_samples, count(*) AS n_days
  FROM days JOIN limits USING (series_key) WHERE std IS NOT NULL GROUP BY 1, 2),
stress AS ({_scenario_sql('v', 'scenario, n AS n_samples, replaced_by')}),
rows AS ({" UNION ALL ".join(_REPORT)})
SELECT series_key, section, name, metric, {r('value')} FROM rows""",
)
def run_validation(spark, sf_dir):
    out = validate(stored_features(spark, sf_dir), JOB)
    of_trees = (F.col("section").isin("hour_improved", "weekday_weekend", "volatility", "missing_driver") | ((F.col("section") == "overall") & (F.col("name") == "improved"))) & F.col("metric").isin(*_NUMBERS, "mae_degradation_pct")
    hidden = of_trees | (F.col("section") == "improvement")
    return out.withColumn("value", F.when(~hidden, F.col("value")))
