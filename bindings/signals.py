"""Signals, bucket views and briefings from the naive forecasts of five series."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.base import COSTS, KEY, MARGINAL, P, PM, TS, predictions, query, r
from hourloom.operators import signals as sg
from hourloom.operators.tables import forecast_window, rename_predictions, union_splits

DOW = "(isodow(ts) - 1)"


def forecasts(spark, sf_dir):
    return rename_predictions(predictions(spark, sf_dir)).drop("residual")


def hourly(spark, sf_dir):
    return sg.hourly_signals(forecasts(spark, sf_dir), COSTS)


def side_sql(spread: str) -> str:
    return f"CASE WHEN {spread} > {COSTS.threshold} THEN 'BUY' WHEN {spread} < -{COSTS.threshold} THEN 'SELL' ELSE 'HOLD' END"


# The forecast itself can come out a hair beside the trailing mean; no spread sits near the threshold.
S = f"""{P}, f AS (SELECT series_key, ts, actual AS actual_price, predicted AS predicted_price FROM p),
s0 AS (SELECT *, predicted_price - {MARGINAL} AS clean_spark_spread, CAST({MARGINAL} AS DOUBLE) AS marginal_cost,
  avg(predicted_price) OVER (PARTITION BY series_key ORDER BY ts ROWS BETWEEN 167 PRECEDING AND CURRENT ROW) AS market_price FROM f),
s AS (SELECT *, predicted_price - market_price AS price_spread, {side_sql('(predicted_price - market_price)')} AS signal,
  CASE WHEN clean_spark_spread > 0 THEN 'DISPATCH' ELSE 'OFF' END AS margin_signal, greatest(clean_spark_spread, 0.0) AS dispatch_pnl FROM s0)"""


@query("clean_spark_spread", f"WITH {P} SELECT series_key, ts, {r(f'css=predicted - {MARGINAL}')} FROM p")
def clean_spark_spread(spark, sf_dir):
    f = forecasts(spark, sf_dir)
    return f.select(KEY, TS, sg.clean_spark_spread(F.col("predicted_price"), COSTS).alias("css"))


@query(
    "hourly_signals",
    f"""WITH {S} SELECT series_key, ts, {r('actual_price', 'predicted_price', 'clean_spark_spread', 'marginal_cost', 'market_price', 'price_spread')},
  signal, margin_signal, {r('dispatch_pnl')} FROM s""",
)
def hourly_signals(spark, sf_dir):
    return hourly(spark, sf_dir)


_SURE = f"""u0 AS (SELECT series_key, ts, abs(actual - predicted) AS uncertainty, predicted FROM p),
v AS (SELECT series_key, ts, NOT (uncertainty > {COSTS.max_uncertainty} OR predicted < {COSTS.floor_price} OR predicted > {COSTS.cap_price}) AS valid FROM u0)"""


def _mask(spark, sf_dir):
    f = forecasts(spark, sf_dir).withColumn("uncertainty", F.abs(F.col("actual_price") - F.col("predicted_price")))
    return sg.validity(f, COSTS, "uncertainty")


@query("signal_invalidation", f"WITH {P}, {_SURE} SELECT * FROM v")
def signal_invalidation(spark, sf_dir):
    return _mask(spark, sf_dir)


@query(
    "signals_masked",
    f"""WITH {S}, {_SURE} SELECT series_key, ts, CASE WHEN valid THEN signal ELSE 'INVALID' END AS signal,
  CASE WHEN valid THEN margin_signal ELSE 'INVALID' END AS margin_signal, {r('dispatch_pnl=CASE WHEN valid THEN dispatch_pnl ELSE 0.0 END')}
FROM s JOIN v USING (series_key, ts)""",
)
def signals_masked(spark, sf_dir):
    out = sg.hourly_signals(forecasts(spark, sf_dir), COSTS, mask=_mask(spark, sf_dir))
    return out.select(KEY, TS, "signal", "margin_signal", "dispatch_pnl")


BUCKET = f"""CASE WHEN {DOW} >= 5 THEN 'weekend' WHEN hour(ts) < 6 THEN 'off_peak_night' WHEN hour(ts) >= 22 THEN 'off_peak_late'
  WHEN hour(ts) >= 8 AND hour(ts) < 20 THEN 'peak' ELSE 'shoulder' END"""


@query("assign_bucket", f"WITH {P} SELECT series_key, ts, {BUCKET} AS bucket FROM p")
def assign_bucket(spark, sf_dir):
    return sg.assign_bucket(forecasts(spark, sf_dir).select(KEY, TS))


VIEW = f"""b0 AS (SELECT series_key, {BUCKET} AS bucket, avg(predicted_price) AS predicted_price, avg(actual_price) AS actual_price FROM f GROUP BY 1, 2),
b1 AS (SELECT *, predicted_price - {MARGINAL} AS clean_spark_spread, CAST({MARGINAL} AS DOUBLE) AS marginal_cost,
  predicted_price - avg(predicted_price) OVER (PARTITION BY series_key) AS price_vs_avg FROM b0),
b AS (SELECT *, CASE WHEN clean_spark_spread > 0 THEN 'DISPATCH' ELSE 'OFF' END AS margin_signal, {side_sql('price_vs_avg').replace(str(COSTS.threshold), '2.0')} AS signal FROM b1)"""


def view(spark, sf_dir):
    from dataclasses import replace

    return sg.bucket_signals(sg.prompt_buckets(forecasts(spark, sf_dir)), replace(COSTS, threshold=2.0))


@query("prompt_buckets", f"WITH {S}, {VIEW} SELECT series_key, bucket, {r('predicted_price', 'actual_price')} FROM b0")
def prompt_buckets(spark, sf_dir):
    return sg.prompt_buckets(forecasts(spark, sf_dir))


@query(
    "bucket_signals",
    f"WITH {S}, {VIEW} SELECT series_key, bucket, {r('predicted_price', 'actual_price', 'clean_spark_spread', 'marginal_cost', 'price_vs_avg')}, margin_signal, signal FROM b",
)
def bucket_signals(spark, sf_dir):
    return view(spark, sf_dir)


@query(
    "forecast_window",
    f"""WITH {PM}, j AS (SELECT *, CASE WHEN series_key IN ('click', 'view') AND ts >= TIMESTAMP '2024-01-28' THEN 'test' ELSE 'train' END AS split FROM m),
k AS (SELECT *, count(*) FILTER (WHERE split = 'test') OVER (PARTITION BY series_key) AS tests, row_number() OVER (PARTITION BY series_key ORDER BY ts DESC) AS back FROM j)
SELECT series_key, ts, {r('actual', 'predicted')}, split FROM k WHERE (tests > 0 AND split = 'test') OR (tests = 0 AND back <= 168)""",
)
def forecast_window_query(spark, sf_dir):
    m = predictions(spark, sf_dir, 24).drop("residual")
    test = F.col(KEY).isin("click", "view") & (F.col(TS) >= "2024-01-28")
    return forecast_window(union_splits({"test": m.filter(test), "train": m.filter(~test)}))


@query(
    "signal_distribution",
    f"WITH {S}, c AS (SELECT series_key, signal, count(*) AS n FROM s GROUP BY 1, 2) SELECT series_key, signal, n, {r('pct=100.0 * n / sum(n) OVER (PARTITION BY series_key)')} FROM c",
)
def signal_distribution(spark, sf_dir):
    return sg.signal_distribution(hourly(spark, sf_dir))


MARGINS = """g AS (SELECT series_key, count(*) AS hours, avg(clean_spark_spread) AS avg_css, count(*) FILTER (WHERE clean_spark_spread > 0) AS profitable_hours,
  sum(dispatch_pnl) AS total_pnl FROM s GROUP BY 1)"""
MARGIN_COLUMNS = "series_key, hours, profitable_hours, " + r(
    "avg_css", "profitable_pct=100.0 * profitable_hours / hours", "total_pnl", "pnl_per_dispatch_hour=total_pnl / greatest(profitable_hours, 1)"
)


@query("margin_summary", f"WITH {S}, {MARGINS} SELECT {MARGIN_COLUMNS} FROM g")
def margin_summary(spark, sf_dir):
    return sg.margin_summary(hourly(spark, sf_dir))


@query(
    "css_percentiles",
    f"WITH {S} " + " UNION ALL ".join(f"SELECT series_key, {p} AS percentile, {r(f'css=quantile_cont(clean_spark_spread, {p / 100})')} FROM s GROUP BY 1" for p in (10, 25, 50, 75, 90)),
)
def css_percentiles(spark, sf_dir):
    return sg.css_percentiles(hourly(spark, sf_dir))


@query(
    "side_summary",
    f"WITH {S} SELECT series_key, signal, count(*) AS n, {r('avg_price_spread=avg(price_spread)', 'avg_css=avg(clean_spark_spread)')} FROM s WHERE signal IN ('BUY', 'SELL') GROUP BY 1, 2",
)
def side_summary(spark, sf_dir):
    return sg.side_summary(hourly(spark, sf_dir))


BACKTEST = f"""t0 AS (SELECT series_key, count(*) AS n, count(*) FILTER (WHERE actual_price - {MARGINAL} > 0) AS actual_profitable,
  count(*) FILTER (WHERE clean_spark_spread > 0 AND actual_price - {MARGINAL} > 0) AS correct,
  count(*) FILTER (WHERE clean_spark_spread > 0 AND actual_price - {MARGINAL} <= 0) AS wrong,
  count(*) FILTER (WHERE clean_spark_spread <= 0 AND actual_price - {MARGINAL} > 0) AS missed FROM s GROUP BY 1)"""
BACKTEST_COLUMNS = "series_key, actual_profitable, correct, wrong, missed, " + r(
    "actual_profitable_pct=100.0 * actual_profitable / n", "accuracy_pct=100.0 * correct / nullif(correct + wrong, 0)"
)


@query("dispatch_backtest", f"WITH {S}, {BACKTEST} SELECT {BACKTEST_COLUMNS} FROM t0")
def dispatch_backtest(spark, sf_dir):
    return sg.dispatch_backtest(hourly(spark, sf_dir), COSTS)


STREAK = """n0 AS (SELECT series_key, ts, clean_spark_spread < 0 AS neg, row_number() OVER (PARTITION BY series_key ORDER BY ts)
    - row_number() OVER (PARTITION BY series_key, clean_spark_spread < 0 ORDER BY ts) AS island FROM s),
n1 AS (SELECT series_key, island, count(*) AS len FROM n0 WHERE neg GROUP BY 1, 2),
streak AS (SELECT series_key, max(len) AS max_negative_streak FROM n1 GROUP BY 1)"""


@query("negative_streak", f"WITH {S}, {STREAK} SELECT series_key, max_negative_streak FROM streak")
def negative_streak(spark, sf_dir):
    return sg.negative_streak(hourly(spark, sf_dir))


ENDS = """ends AS (SELECT series_key, arg_max(bucket, clean_spark_spread) AS best_bucket, max(clean_spark_spread) AS best_css,
  arg_min(bucket, clean_spark_spread) AS worst_bucket, min(clean_spark_spread) AS worst_css FROM (SELECT * FROM b ORDER BY series_key, bucket) GROUP BY 1)"""


@query("best_worst_bucket", f"WITH {S}, {VIEW}, {ENDS} SELECT series_key, best_bucket, worst_bucket, {r('best_css', 'worst_css')} FROM ends")
def best_worst_bucket(spark, sf_dir):
    return sg.best_worst_bucket(view(spark, sf_dir))


def _two(expression: str, digits: int = 2) -> str:
    return f"round({expression}, {digits})"


CONTEXT = f"""main AS (SELECT series_key, strftime(max(ts), '%Y-%m-%d') AS forecast_date, count(*) AS hours_analyzed, {_two('avg(clean_spark_spread)')} AS avg_css_eur,
  count(*) FILTER (WHERE clean_spark_spread > 0) AS profitable_hours, {_two('100.0 * count(*) FILTER (WHERE clean_spark_spread > 0) / count(*)', 1)} AS profitable_pct,
  100.0 * count(*) FILTER (WHERE clean_spark_spread > 0) / count(*) < 60 AS low_confidence,
  {_two('sum(dispatch_pnl)')} AS total_dispatch_pnl_eur, {_two('avg(predicted_price)')} AS avg_price_eur,
  '€' || CAST(CAST(round(min(predicted_price)) AS BIGINT) AS VARCHAR) || ' - €' || CAST(CAST(round(max(predicted_price)) AS BIGINT) AS VARCHAR) AS price_range,
  {_two('stddev_samp(predicted_price)')} AS price_volatility FROM s GROUP BY 1),
dist AS (SELECT series_key, string_agg(signal || '=' || CAST(n AS VARCHAR), ',' ORDER BY signal) AS signals FROM (SELECT series_key, signal, count(*) AS n FROM s GROUP BY 1, 2) GROUP BY 1),
names AS (SELECT series_key, string_agg(bucket || ':' || margin_signal, ',' ORDER BY bucket) AS buckets FROM b GROUP BY 1),
ctx AS (SELECT * FROM main JOIN dist USING (series_key) JOIN names USING (series_key) JOIN ends USING (series_key) JOIN streak USING (series_key))"""


def context(spark, sf_dir):
    return sg.trading_context(hourly(spark, sf_dir), view(spark, sf_dir))


@query(
    "trading_context",
    f"""WITH {S}, {VIEW}, {ENDS}, {STREAK}, {CONTEXT} SELECT series_key, forecast_date, hours_analyzed, profitable_hours, price_range, low_confidence, signals, buckets,
  best_bucket, worst_bucket, max_negative_streak, {r('avg_css_eur', 'profitable_pct', 'total_dispatch_pnl_eur', 'avg_price_eur', 'price_volatility', f'marginal_cost={MARGINAL}::DOUBLE')} FROM ctx""",
)
def trading_context(spark, sf_dir):
    pairs = F.transform(F.map_entries("signal_distribution"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    names = F.transform("bucket_summary", lambda b: F.concat(b["bucket"], F.lit(":"), b["signal"]))
    return context(spark, sf_dir).select(
        KEY, "forecast_date", "hours_analyzed", "profitable_hours", "price_range", F.col("risk_indicators")["low_confidence"].alias("low_confidence"),
        F.array_join(pairs, ",").alias("signals"), F.array_join(names, ",").alias("buckets"),
        F.col("best_bucket")["name"].alias("best_bucket"), F.col("worst_bucket")["name"].alias("worst_bucket"),
        F.col("risk_indicators")["max_negative_streak"].alias("max_negative_streak"),
        "avg_css_eur", "profitable_pct", "total_dispatch_pnl_eur", "avg_price_eur", "price_volatility", "marginal_cost",
    )


STRATEGY = f"""CASE WHEN avg_css_eur > 20 THEN '1. **POSITION**: BUY ' || best_bucket || ' at full size: the plant earns ' || avg_css_eur || ' EUR/MWh on average.'
  WHEN avg_css_eur > 0 THEN '1. **POSITION**: BUY ' || best_bucket || ' at half size: the average hour earns little.'
  ELSE '1. **POSITION**: HOLD, running costs more than it earns (' || avg_css_eur || ' EUR/MWh on average).' END
  || chr(10) || '2. **RATIONALE**: ' || profitable_pct || '% of the hours pay; ' || best_bucket || ' pays most (' || {_two('best_css')} || ' EUR/MWh), '
  || worst_bucket || ' least (' || {_two('worst_css')} || ' EUR/MWh).' || chr(10)
  || CASE WHEN low_confidence THEN '3. **RISK**: few hours pay (' || profitable_pct || '%); halve the position when spot leaves the forecast by 15 EUR/MWh.'
     ELSE '3. **RISK**: drop the signal when wind and solar miss their forecast by 2 GW.' END"""


@query("rule_strategy", f"WITH {S}, {VIEW}, {ENDS}, {STREAK}, {CONTEXT} SELECT series_key, {STRATEGY} AS strategy FROM ctx")
def rule_strategy(spark, sf_dir):
    return sg.rule_strategy(context(spark, sf_dir)).select(KEY, "strategy")


RISK = """CASE WHEN avg_css > 0 THEN 'PROFITABLE' ELSE 'UNECONOMIC' END AS baseload,
  CASE WHEN avg_css > 20 THEN 'healthy' WHEN avg_css > 0 THEN 'marginal' ELSE 'negative' END AS margin,
  CASE WHEN 1.0 * profitable_hours / hours > 0.8 THEN 'LOW' WHEN 1.0 * profitable_hours / hours > 0.5 THEN 'MEDIUM' ELSE 'HIGH' END AS risk"""


@query("risk_level", f"WITH {S}, {MARGINS} SELECT series_key, {RISK} FROM g")
def risk_level(spark, sf_dir):
    return sg.risk_level(sg.margin_summary(hourly(spark, sf_dir))).select(KEY, "baseload", "margin", "risk")
