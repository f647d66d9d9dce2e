"""Writers for run outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.config import KEY, TS
from hourloom.functions.clock import day_text


MONTH = "ts_month"


def write_series(df: DataFrame, path: str, run_id: str | None = None) -> None:
    """Parquet by run and month, rows sorted by series inside files.

    Partitioning by month keeps the folder count independent of the number of
    series; sorted files let row-group statistics skip other series and dates.
    The rebalance hint lets adaptive execution cut a large month into files of
    the advisory size and merge small ones, so no task owns a series or a month. Writing a run
    again replaces all of it; without a run only the months that are written.
    """
    out = df.withColumn(MONTH, F.substring(day_text(TS), 1, 7))
    out = out.hint("rebalance", F.col(MONTH)).sortWithinPartitions(MONTH, KEY, TS)
    if run_id is None:
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)
    else:
        out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(MONTH).parquet(f"{path}/run_id={run_id}")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def metrics_record(metrics: DataFrame, model: str, run_id: str, written_at: Column | None = None) -> DataFrame:
    """``series_key, model, run_id, timestamp, metrics{...}``: the JSON layout of a metrics file."""
    names = [c for c in metrics.columns if c != KEY]
    stamp = F.current_timestamp().cast("string") if written_at is None else written_at
    return metrics.select(
        KEY, F.lit(model).alias("model"), F.lit(run_id).alias("run_id"), stamp.alias("timestamp"), F.struct(*names).alias("metrics")
    )


def write_metrics(metrics: DataFrame, model: str, run_id: str, path: str) -> None:
    """Metrics hold one row per series, so they end up in few files whatever the input size."""
    write_json(metrics_record(metrics, model, run_id), path)


def gate_report(results: DataFrame, run_id: str) -> DataFrame:
    """Per series: overall verdict, totals and the check rows as one nested JSON record."""
    check = F.struct("name", "passed", "errors", "warnings", "metrics")
    return results.groupBy(KEY).agg(
        F.lit(run_id).alias("run_id"),
        F.bool_and("passed").alias("overall_pass"),
        F.struct(
            F.count("*").alias("total_checks"),
            F.count(F.when(F.col("passed"), 1)).alias("passed"),
            F.count(F.when(~F.col("passed"), 1)).alias("failed"),
            F.sum(F.size("errors")).alias("total_errors"),
            F.sum(F.size("warnings")).alias("total_warnings"),
        ).alias("summary"),
        F.collect_list(check).alias("checks"),
    )


def report_lines(results: DataFrame, shown: int = 3) -> DataFrame:
    """Log lines per series: one per check, the first few errors, and the overall verdict."""
    head = F.format_string("  [%s] %s", F.when(F.col("passed"), "PASS").otherwise("FAIL"), F.col("name"))
    errors = F.transform(F.slice("errors", 1, shown), lambda e: F.concat(F.lit("         "), e))
    more = F.when(F.size("errors") > shown, F.array(F.format_string("         ... and %d more errors", F.size("errors") - shown)))
    lines = F.concat(F.array(head), errors, F.coalesce(more, F.array().cast("array<string>")))
    return results.select(KEY, "name", F.array_join(lines, "\n").alias("text"))
