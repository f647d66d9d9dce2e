"""Ingest as a job: ranked sources per table, a date range, tables that count once their run is published."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.config import JobSpec
from hourloom.operators.tables import outer_join_sources, time_range
from hourloom.plans.jobs import normalize_drivers, normalize_prices
from hourloom.sources.files import SourceMissing, first_acceptable, read_cached
from hourloom.sources.sinks import write_json, write_series
from hourloom.sources.workspace import work_scope

log = logging.getLogger(__name__)

TABLES = ("prices", "drivers", "combined")


@dataclass(frozen=True)
class Source:
    """A place a table may come from, in the order of trust.

    ``read`` raises ``SourceMissing`` where there is nothing. ``raw`` rows are normalised first; ``stale`` ones, the
    last resort, are taken as they are, whatever their range.
    """

    name: str
    read: Callable[[], DataFrame]
    raw: bool = False
    stale: bool = False


@dataclass(frozen=True)
class Span:
    """Local days ``start`` to ``end``, both included."""

    start: str
    end: str
    zone: str | None = None


# --- published runs ---------------------------------------------------------------


def publish(spark: SparkSession, folder: str, run_id: str, span: Span, tables: Sequence[str]) -> None:
    """Write the manifest of a run whose tables are all in place. Without it the run does not count, so a run that failed is never read."""
    about = spark.range(1).select(
        F.array(*[F.lit(t) for t in tables]).alias("tables"), F.lit(span.start).alias("start"), F.lit(span.end).alias("end"), F.unix_micros(F.current_timestamp()).alias("published_at")
    )
    write_json(about, f"{folder}/runs/run_id={run_id}")


def published_runs(spark: SparkSession, folder: str) -> DataFrame:
    """``run_id, tables, start, end, published_at`` of the runs that have a manifest: one small row a run."""
    schema = "tables array<string>, start string, end string, published_at long, run_id string"
    try:
        return spark.read.schema(schema).json(f"{folder}/runs")
    except AnalysisException as problem:
        raise SourceMissing(f"no runs under {folder}") from problem


def newest_run(spark: SparkSession, folder: str, table: str, span: Span | None = None) -> str:
    """The run published last that has ``table`` and, with a ``span``, covers its days."""
    runs = published_runs(spark, folder).filter(F.array_contains("tables", table))
    if span:
        runs = runs.filter((F.col("start") <= span.start) & (F.col("end") >= span.end))
    found = runs.orderBy(F.desc("published_at"), F.desc("run_id")).first()
    if found is None:
        raise SourceMissing(f"no published run under {folder} has {table}" + (f" for {span.start} to {span.end}" if span else ""))
    return found["run_id"]


def published_table(spark: SparkSession, folder: str, table: str, run_id: str | None = None, span: Span | None = None) -> DataFrame:
    """A table of one run, the newest by default, cut to a span: months outside it are not listed."""
    path = f"{folder}/{table}/run_id={run_id or newest_run(spark, folder, table, span)}"
    if span:
        return read_cached(spark, path, span.start, span.end, span.zone).drop("ts_month", "run_id")
    return spark.read.parquet(path).drop("ts_month", "run_id")


def cached(spark: SparkSession, folder: str, table: str, span: Span) -> Source:
    """The newest published run that covers the span."""
    return Source("cache", lambda: published_table(spark, folder, table, span=span))


def stale(spark: SparkSession, folder: str, table: str) -> Source:
    """The newest published run of any range."""
    return Source("stale", lambda: published_table(spark, folder, table), stale=True)


# --- choice -------------------------------------------------------------------------


def resolve(sources: Sequence[Source], normalize: Callable[[DataFrame], DataFrame], span: Span, critical: str, max_missing_pct: float = 1.0) -> DataFrame:
    """Per series the rows of the first source whose ``critical`` column is complete enough in the span; ``source`` names it.

    Sources without files are passed over; the others are read only for series that no better one serves. A series no
    source can serve is absent; ``SourceMissing`` is raised where that is all of them.
    """
    ready, problems = [], []
    for source in sources:
        try:
            rows = source.read()
        except (SourceMissing, AnalysisException) as problem:
            log.info("source %s unavailable: %s", source.name, problem)
            problems.append(f"{source.name}: {problem}")
            continue
        rows = normalize(rows) if source.raw else rows
        ready.append((source.name, rows if source.stale else time_range(rows, span.start, span.end, span.zone)))
    if not ready:
        raise SourceMissing("no source available - " + "; ".join(problems))
    chosen = first_acceptable(ready, critical, max_missing_pct)
    if chosen.isEmpty():
        raise SourceMissing(f"no source has at most {max_missing_pct} % of {critical} missing: " + ", ".join(name for name, _ in ready))
    return chosen


# --- the job ------------------------------------------------------------------------


@dataclass(frozen=True)
class Ingested:
    """The three tables of a run as read back, each with its rows' source but the combined one."""

    run_id: str
    prices: DataFrame
    drivers: DataFrame
    combined: DataFrame


def run_ingest(
    spark: SparkSession,
    folder: str,
    prices: Sequence[Source],
    drivers: Sequence[Source],
    span: Span,
    run_id: str,
    spec: JobSpec = JobSpec(),
    refresh: bool = False,
) -> Ingested:
    """Choose a source for both tables, join them on every stamp either has, write all three and publish the run.

    Sources are tried in the order given, after the published runs of ``folder`` that cover the span (unless ``refresh``)
    and before its newest run of any range. Raw rows are normalised to UTC hours first. Tables are read back from what was written;
    no work table outlives the job.
    """
    limit, names = spec.limits.critical_missing_pct, spec.features.drivers
    ahead = (lambda t: []) if refresh else (lambda t: [cached(spark, folder, t, span)])

    def chosen(table: str, given: Sequence[Source], normalize, critical: str) -> DataFrame:
        return resolve([*ahead(table), *given, stale(spark, folder, table)], normalize, span, critical, limit)

    given = {
        "prices": (prices, lambda df: normalize_prices(df, target=spec.features.target), spec.features.target),
        "drivers": (drivers, lambda df: normalize_drivers(df, drivers=names), names[0]),
    }
    written = {}
    with work_scope():
        for table, parts in given.items():
            written[table] = _stored(spark, chosen(table, *parts), folder, table, run_id)
        joined = outer_join_sources([written[t].drop("source") for t in ("prices", "drivers")])
        written["combined"] = _stored(spark, joined, folder, "combined", run_id)
        publish(spark, folder, run_id, span, TABLES)
    return Ingested(run_id, **written)


def _stored(spark: SparkSession, rows: DataFrame, folder: str, table: str, run_id: str) -> DataFrame:
    write_series(rows, f"{folder}/{table}", run_id)
    return published_table(spark, folder, table, run_id)
