"""Margins, trading signals, bucket views and the briefing built from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.config import KEY, TS, WEEK_HOURS, Economics
from hourloom.functions.calendar import exclusive_bucket
from hourloom.functions.clock import day_text
from hourloom.functions.numbers import clip_at_zero, percent
from hourloom.operators.features import rolling_features, rolling_name
from hourloom.operators.pieces import FAR, carry, in_piece, with_slot
from hourloom.operators.quantiles import exact_percentiles
from hourloom.operators.tables import apply_mask, left_join_market_price



# --- hourly ------------------------------------------------------------------


def clean_spark_spread(price: Column, costs: Economics = Economics()) -> Column:
    """Power price minus fuel and carbon cost of one MWh."""
    return price - costs.gas_price * costs.heat_rate - costs.carbon_price * costs.carbon_intensity


def side(spread: Column, threshold: float) -> Column:
    return F.when(spread > threshold, "BUY").when(spread < -threshold, "SELL").otherwise("HOLD")


def margin_side(css: Column) -> Column:
    return F.when(css > 0, "DISPATCH").otherwise("OFF")


def validity(df: DataFrame, costs: Economics = Economics(), uncertainty: str | None = None) -> DataFrame:
    """``series_key, ts, valid``: false for uncertain or absurd prices; unknown values stay valid."""
    bad = (F.col("predicted_price") < costs.floor_price) | (F.col("predicted_price") > costs.cap_price)
    if uncertainty:
        bad = F.coalesce(bad, F.lit(False)) | (F.col(uncertainty) > costs.max_uncertainty)
    return df.select(KEY, TS, (~F.coalesce(bad, F.lit(False))).alias("valid"))


def mask_signals(signals: DataFrame, mask: DataFrame) -> DataFrame:
    """Invalid rows say so and earn nothing."""
    joined = apply_mask(signals, mask)
    bad = ~F.col("valid")
    return joined.withColumns(
        {
            "signal": F.when(bad, "INVALID").otherwise(F.col("signal")),
            "margin_signal": F.when(bad, "INVALID").otherwise(F.col("margin_signal")),
            "dispatch_pnl": F.when(bad, 0.0).otherwise(F.col("dispatch_pnl")),
        }
    ).drop("valid")


def hourly_signals(
    forecasts: DataFrame,
    costs: Economics = Economics(),
    market: DataFrame | None = None,
    mask: DataFrame | None = None,
    mode: str = "rows",
) -> DataFrame:
    """Margin, benchmark price and both signals per hour.

    Without market prices the benchmark is the mean forecast of the trailing 168
    rows, the current one included.
    """
    if market is not None:
        priced = left_join_market_price(forecasts, market)
    else:
        name = rolling_name(WEEK_HOURS, "mean", "predicted_price")
        rolled = rolling_features(forecasts, ["predicted_price"], [WEEK_HOURS], ["mean"], min_periods=1, shift=0, mode=mode)
        priced = rolled.withColumnRenamed(name, "market_price")
    out = priced.withColumns(
        {
            "clean_spark_spread": clean_spark_spread(F.col("predicted_price"), costs),
            "marginal_cost": F.lit(costs.marginal_cost),
            "price_spread": F.col("predicted_price") - F.col("market_price"),
        }
    )
    out = out.withColumns(
        {
            "signal": side(F.col("price_spread"), costs.threshold),
            "margin_signal": margin_side(F.col("clean_spark_spread")),
            "dispatch_pnl": clip_at_zero(F.col("clean_spark_spread")),
        }
    )
    return mask_signals(out, mask) if mask is not None else out


# --- buckets -----------------------------------------------------------------


def assign_bucket(df: DataFrame) -> DataFrame:
    return df.withColumn("bucket", exclusive_bucket(TS))


def prompt_buckets(forecasts: DataFrame) -> DataFrame:
    """Mean forecast, and outcome when present, per series and bucket."""
    prices = [c for c in ("predicted_price", "actual_price") if c in forecasts.columns]
    return assign_bucket(forecasts).groupBy(KEY, "bucket").agg(*[F.avg(c).alias(c) for c in prices])


def bucket_signals(buckets: DataFrame, costs: Economics = Economics()) -> DataFrame:
    """Signals per bucket against the plain mean over buckets (at most five rows per series)."""
    mean = F.avg("predicted_price").over(Window.partitionBy(KEY))
    out = buckets.withColumns(
        {
            "clean_spark_spread": clean_spark_spread(F.col("predicted_price"), costs),
            "marginal_cost": F.lit(costs.marginal_cost),
            "price_vs_avg": F.col("predicted_price") - mean,
        }
    )
    return out.withColumns({"margin_signal": margin_side(F.col("clean_spark_spread")), "signal": side(F.col("price_vs_avg"), costs.threshold)})


# --- summaries ---------------------------------------------------------------


def signal_distribution(signals: DataFrame) -> DataFrame:
    """Rows and share per signal; the total is a window over a handful of rows."""
    counts = signals.groupBy(KEY, "signal").agg(F.count("*").alias("n"))
    return counts.withColumn("pct", percent(F.col("n"), F.sum("n").over(Window.partitionBy(KEY))))


def margin_summary(signals: DataFrame) -> DataFrame:
    good = F.count(F.when(F.col("clean_spark_spread") > 0, 1))
    pnl = F.sum("dispatch_pnl")
    return signals.groupBy(KEY).agg(
        F.count("*").alias("hours"),
        F.avg(F.col("clean_spark_spread")).alias("avg_css"),
        good.alias("profitable_hours"),
        percent(good, F.count("*")).alias("profitable_pct"),
        pnl.alias("total_pnl"),
        (pnl / F.greatest(good, F.lit(1))).alias("pnl_per_dispatch_hour"),
    )


def css_percentiles(signals: DataFrame, points: tuple[int, ...] = (10, 25, 50, 75, 90)) -> DataFrame:
    long = exact_percentiles(signals, "clean_spark_spread", [p / 100 for p in points], [KEY])
    return long.select(KEY, F.round(F.col("p") * 100).cast("int").alias("percentile"), F.col("value").alias("css"))


def side_summary(signals: DataFrame) -> DataFrame:
    return (
        signals.filter(F.col("signal").isin("BUY", "SELL"))
        .groupBy(KEY, "signal")
        .agg(F.count("*").alias("n"), F.avg("price_spread").alias("avg_price_spread"), F.avg(F.col("clean_spark_spread")).alias("avg_css"))
    )


def dispatch_backtest(signals: DataFrame, costs: Economics = Economics()) -> DataFrame:
    """What the dispatch decision would have met, judged by actual prices."""
    actual = F.col("actual_price") - costs.marginal_cost

    def hits(c: Column) -> Column:
        return F.count(F.when(c, 1))

    correct, wrong = hits((F.col("clean_spark_spread") > 0) & (actual > 0)), hits((F.col("clean_spark_spread") > 0) & (actual <= 0))
    return signals.groupBy(KEY).agg(
        hits(actual > 0).alias("actual_profitable"),
        percent(hits(actual > 0), F.count("*")).alias("actual_profitable_pct"),
        correct.alias("correct"),
        wrong.alias("wrong"),
        hits((F.col("clean_spark_spread") <= 0) & (actual > 0)).alias("missed"),
        percent(correct, correct + wrong).alias("accuracy_pct"),
    )


def negative_streak(df: DataFrame, column: str = "clean_spark_spread", step: str = "hour") -> DataFrame:
    """Longest run of consecutive rows below zero per series; NULL ends a run.

    A run is the rows that share the number of non-negative rows before them.
    That count is carried across pieces, so a run may span any number of them.
    """
    negative = F.coalesce(F.col(column) < 0, F.lit(False))
    ends = F.when(negative, 0).otherwise(1)
    cut = carry(with_slot(df.select(KEY, TS, column), step), running={"_ends_before": F.sum(ends)})
    run = F.col("_ends_before") + F.sum(ends).over(in_piece(TS).rowsBetween(FAR, 0))
    runs = cut.withColumn("_run", run).groupBy(KEY, "_run").agg(F.count(F.when(negative, 1)).alias("_length"))
    return runs.groupBy(KEY).agg(F.max("_length").alias("max_negative_streak"))


def best_worst_bucket(buckets: DataFrame) -> DataFrame:
    """Buckets with the highest and lowest margin; ties go to the first by name."""
    best, worst = F.min(F.struct((-F.col("clean_spark_spread")).alias("k"), "bucket")), F.min(F.struct(F.col("clean_spark_spread").alias("k"), "bucket"))
    known = buckets.filter(F.col("clean_spark_spread").isNotNull()).groupBy(KEY).agg(best.alias("b"), worst.alias("w"))
    return known.select(
        KEY,
        F.col("b")["bucket"].alias("best_bucket"),
        (-F.col("b")["k"]).alias("best_css"),
        F.col("w")["bucket"].alias("worst_bucket"),
        F.col("w")["k"].alias("worst_css"),
    )


# --- briefing ----------------------------------------------------------------

LOW_CONFIDENCE_PCT = 60


def trading_context(signals: DataFrame, buckets: DataFrame) -> DataFrame:
    """All numbers of a briefing in one nested row per series."""
    good = F.count(F.when(F.col("clean_spark_spread") > 0, 1))
    pct = percent(good, F.count("*"))
    volatility = F.round(F.stddev_samp(F.col("predicted_price")), 2)
    euro = F.lit("€")
    main = signals.groupBy(KEY).agg(
        day_text(F.max(TS)).alias("forecast_date"),
        F.count("*").alias("hours_analyzed"),
        F.round(F.avg(F.col("clean_spark_spread")), 2).alias("avg_css_eur"),
        good.alias("profitable_hours"),
        F.round(pct, 1).alias("profitable_pct"),
        F.round(F.sum("dispatch_pnl"), 2).alias("total_dispatch_pnl_eur"),
        F.round(F.avg(F.col("predicted_price")), 2).alias("avg_price_eur"),
        F.concat(
            euro, F.round(F.min(F.col("predicted_price"))).cast("bigint").cast("string"), F.lit(" - "),
            euro, F.round(F.max(F.col("predicted_price"))).cast("bigint").cast("string"),
        ).alias("price_range"),
        volatility.alias("price_volatility"),
        (pct < LOW_CONFIDENCE_PCT).alias("low_confidence"),
        F.round(F.min_by("marginal_cost", TS), 2).alias("marginal_cost"),
    )
    counts = signals.groupBy(KEY, "signal").agg(F.count("*").alias("n"))
    spread = counts.groupBy(KEY).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("signal", "n")))).alias("signal_distribution")
    )
    view = buckets.groupBy(KEY).agg(
        F.sort_array(
            F.collect_list(
                F.struct("bucket", F.col("predicted_price").alias("price"), F.col("clean_spark_spread").alias("css"), F.col("margin_signal").alias("signal"))
            )
        ).alias("bucket_summary")
    )
    ends = best_worst_bucket(buckets).select(
        KEY,
        F.struct(F.col("best_bucket").alias("name"), F.round("best_css", 2).alias("css")).alias("best_bucket"),
        F.struct(F.col("worst_bucket").alias("name"), F.round("worst_css", 2).alias("css")).alias("worst_bucket"),
    )
    joined = main.join(spread, KEY).join(view, KEY).join(ends, KEY).join(negative_streak(signals), KEY)
    risk = F.struct(
        "max_negative_streak", F.col("price_volatility").alias("volatility_eur"), F.col("low_confidence")
    ).alias("risk_indicators")
    return joined.withColumn("risk_indicators", risk).drop("max_negative_streak", "low_confidence")


def rule_strategy(context: DataFrame) -> DataFrame:
    """Three-line strategy text per series."""
    css, pct = F.col("avg_css_eur"), F.col("profitable_pct")
    best, worst = F.col("best_bucket"), F.col("worst_bucket")

    def text(*parts) -> Column:
        return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])

    # The thresholds and the labels POSITION, RATIONALE and RISK.
    position = (
        F.when(css > 20, text("**POSITION**: BUY ", best["name"], " at full size: the plant earns ", css, " EUR/MWh on average."))
        .when(css > 0, text("**POSITION**: BUY ", best["name"], " at half size: the average hour earns little."))
        .otherwise(text("**POSITION**: HOLD, running costs more than it earns (", css, " EUR/MWh on average)."))
    )
    rationale = text(
        "**RATIONALE**: ", pct, "% of the hours pay; ", best["name"], " pays most (", best["css"],
        " EUR/MWh), ", worst["name"], " least (", worst["css"], " EUR/MWh).",
    )
    risk = F.when(
        F.col("risk_indicators")["low_confidence"],
        text("**RISK**: few hours pay (", pct, "%); halve the position when spot leaves the forecast by 15 EUR/MWh."),
    ).otherwise("**RISK**: drop the signal when wind and solar miss their forecast by 2 GW.")
    strategy = F.concat(F.lit("1. "), position, F.lit("\n2. "), rationale, F.lit("\n3. "), risk)
    return context.withColumn("strategy", strategy)


def risk_level(summary: DataFrame) -> DataFrame:
    """Verdicts on a ``margin_summary``: baseload, margin and risk."""
    share = F.col("profitable_hours") / F.col("hours")
    return summary.withColumns(
        {
            "baseload": F.when(F.col("avg_css") > 0, "PROFITABLE").otherwise("UNECONOMIC"),
            "margin": F.when(F.col("avg_css") > 20, "healthy").when(F.col("avg_css") > 0, "marginal").otherwise("negative"),
            "risk": F.when(share > 0.8, "LOW").when(share > 0.5, "MEDIUM").otherwise("HIGH"),
        }
    )
