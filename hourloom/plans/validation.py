"""Hold-out validation with buckets, stress tests and leakage checks as one metrics table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.config import KEY, TARGET, TS, JobSpec
from hourloom.operators.baseline import ensure_lag, naive_seasonal, split_last_days
from hourloom.operators.evaluation import baseline_improvement, hour_metrics, regression_metrics, volatility_regimes, weekday_weekend
from hourloom.operators.features import lag_findings, short_lag_columns, suspicious_columns
from hourloom.operators.tables import drop_null_any, drop_null_target, union_all
from hourloom.operators.quality import arrival_order
from hourloom.plans.boosting import fit_boosted, missing_driver_stress, model_inputs, predict
from hourloom.sources.sinks import write_json
from hourloom.sources.workspace import settle


def long_metrics(df: DataFrame, section: str, name: str | None = None, label: str = "all") -> DataFrame:
    """Wide metric columns to ``series_key, section, name, metric, value`` rows."""
    keys = {KEY, name} if name else {KEY}
    columns = [c for c in df.columns if c not in keys]
    tag = F.col(name) if name else F.lit(label)
    entries = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(KEY, F.lit(section).alias("section"), tag.alias("name"), F.inline(entries))


def leakage_findings(columns: Sequence[str], spec: JobSpec = JobSpec(), ordered: bool = True) -> list[str]:
    """Reasons to distrust a feature table; an empty list means none."""
    f = spec.features
    issues = [] if ordered else ["timestamps are not increasing"]
    short = short_lag_columns(columns)
    if short:
        issues.append(f"lag columns shorter than 24h: {short}")
    odd = suspicious_columns(columns, [f.target, *f.drivers])
    if odd:
        issues.append(f"suspicious names: {odd}")
    return issues + [text for severity, text in lag_findings(columns, f.lags) if severity == "error"]


def run_validation(
    features: DataFrame, spec: JobSpec = JobSpec(), target: str = TARGET, step: str = "hour", arrival: str | None = None, folder: str | None = None, run_id: str = "run"
) -> DataFrame:
    """Train before the last ``validation_days``, score both models on the same later rows.

    ``arrival`` numbers the rows as they came and lets the leakage check see their order. With a ``folder`` each series'
    numbers are written as one JSON record.
    """
    ordered = True
    if arrival:
        ordered = arrival_order(features, arrival).filter("not monotone").isEmpty()
        features = features.drop(arrival)
    ready = drop_null_target(ensure_lag(features, target, spec.baseline_lag, step=step), target)
    parted = settle(drop_null_any(split_last_days(ready, spec.validation_days)), "validation", ("split",))
    train, test = parted.filter("split = 'train'").drop("split"), parted.filter("split = 'validation'").drop("split")
    inputs = model_inputs(ready, target)
    model = fit_boosted(train, target, inputs, spec.boost, step=step)
    improved = settle(predict(model, test, target), "improved")
    naive = naive_seasonal(test, target, spec.baseline_lag).select(KEY, TS, F.col(target).alias("actual"), "predicted")
    base_scores, model_scores = regression_metrics(naive), regression_metrics(improved)
    parts = [
        long_metrics(base_scores, "overall", label="baseline"),
        long_metrics(model_scores, "overall", label="improved"),
        long_metrics(baseline_improvement(base_scores, model_scores), "improvement"),
        long_metrics(hour_metrics(naive), "hour_baseline", "bucket"),
        long_metrics(hour_metrics(improved), "hour_improved", "bucket"),
        long_metrics(weekday_weekend(improved), "weekday_weekend", "regime"),
        long_metrics(volatility_regimes(improved, None), "volatility", "regime"),
        long_metrics(missing_driver_stress(model, test, target, spec.features.drivers), "missing_driver", "scenario"),
    ]
    issues = leakage_findings(ready.columns, spec, ordered)
    leakage = base_scores.select(KEY).withColumn("issues", F.lit(float(len(issues))))
    out = union_all([*parts, long_metrics(leakage, "leakage")])
    if folder:
        out = settle(out, "validation_rows")
        lists = out.groupBy(KEY).agg(F.sort_array(F.collect_list(F.struct("section", "name", "metric", "value"))).alias("metrics"))  # some dozens a series
        verdict = F.lit("; ".join(issues) or "none").alias("leakage")
        write_json(lists.select(KEY, F.lit(run_id).alias("run_id"), verdict, "metrics"), f"{folder}/validation/run_id={run_id}")
    return out
