"""Scans of landed files: series CSV, legacy exports, JSON payloads, Parquet caches."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.config import CONTRACT, DRIVERS, KEY, MARKET_CODE, TARGET, TS, ColumnRule
from hourloom.functions.clock import from_micros
from hourloom.functions.numbers import coerce_number
from hourloom.operators.pieces import attach_summary
from hourloom.operators.tables import outer_join_sources, time_range
from hourloom.sources.schema import enforce_schema, validate_schema
from hourloom.sources.sinks import MONTH
from hourloom.sources.workspace import settle

log = logging.getLogger(__name__)


class SourceMissing(FileNotFoundError):
    """A required file or every candidate source is absent."""


def path_exists(spark: SparkSession, path: str) -> bool:
    """Ask the file system behind the path, so it works for any Hadoop store and globs."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(target)
    return found is not None and len(found) > 0


# --- series CSV --------------------------------------------------------------


def _utc_text(c: Column) -> Column:
    """ISO text with an optional offset to a UTC stamp, whatever the session zone.

    The offset is split off and subtracted by arithmetic.
    """
    text = F.regexp_replace(F.trim(c), "T", " ")
    plain = F.regexp_extract(text, r"^(\d{4}-\d{2}-\d{2}(?: \d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?)?)", 1)
    sign = F.when(F.regexp_extract(text, r"([+-])\d{2}:?\d{2}$", 1) == "-", -1).otherwise(1)
    offset_hours = F.regexp_extract(text, r"\s?[+-](\d{2}):?\d{2}$", 1).try_cast("int")
    offset_minutes = F.regexp_extract(text, r"\s?[+-]\d{2}:?(\d{2})$", 1).try_cast("int")
    timed = F.length(plain) > 10
    shift = F.when(timed, sign * (F.coalesce(offset_hours, F.lit(0)) * 60 + F.coalesce(offset_minutes, F.lit(0)))).otherwise(0)
    return F.timestamp_add("MINUTE", -shift, plain.try_cast("timestamp_ntz"))


def read_series_csv(spark: SparkSession, path: str, columns: Sequence[str], series: str | None = MARKET_CODE) -> DataFrame:
    """``timestamp,<columns>`` files with a header; ``series=None`` reads the key from the file too."""
    if not path_exists(spark, path):
        raise SourceMissing(path)
    raw = spark.read.option("header", True).csv(path)
    absent = [c for c in ("timestamp", *columns) if c not in raw.columns]
    if absent:
        raise SourceMissing(f"{path} lacks columns {absent}")
    key = F.col(KEY) if series is None else F.lit(series).alias(KEY)
    return raw.select(key, _utc_text(F.col("timestamp")).alias(TS), *[coerce_number(F.col(c)).alias(c) for c in columns])


def read_raw_folder(spark: SparkSession, folder: str, market: str = MARKET_CODE) -> DataFrame:
    """Prices, load and generation of one market, joined on the stamp; all three files must exist."""
    parts = {"prices": (TARGET,), "load": (DRIVERS[0],), "gen_forecast": DRIVERS[1:]}
    paths = {name: f"{folder}/{name}_{market}.csv" for name in parts}
    absent = [p for p in paths.values() if not path_exists(spark, p)]
    if absent:
        raise SourceMissing(f"missing raw files: {absent}")
    return outer_join_sources([read_series_csv(spark, paths[n], columns, market) for n, columns in parts.items()])


# --- legacy exports ----------------------------------------------------------

# Header words that mark the price and the time column.
PRICE_WORDS = ("price", "eur/mwh")
TIME_WORDS = ("time", "mtu", "date")
TITLE = "Day-ahead Prices"
SEPARATORS = (",", ";", "\t", "|")


def _clean_name(name: str) -> str:
    return name.strip().replace('"', "").strip()


def _last_with(names: Sequence[str], words: Sequence[str]) -> str | None:
    hits = [n for n in names if any(w in n.lower() for w in words)]
    return hits[-1] if hits else None


def read_legacy_csv(spark: SparkSession, path: str, series: str = MARKET_CODE) -> DataFrame:
    """Exports with unknown separator, an optional title row and loosely named columns.

    Only the first two lines are looked at on the driver. Time cells may be ranges (the start counts), day first
    with dots, slashes or dashes, or ISO; an ISO offset is applied, other stamps stay in local time. Rows
    whose price is not a number are dropped; a priced row with an unreadable stamp is an error when it is read.
    """
    if not path_exists(spark, path):
        raise SourceMissing(path)
    lines = spark.read.text(path)
    top = [r["value"] for r in lines.limit(2).collect()]
    titled = bool(top) and TITLE in top[0]
    header = top[1] if titled and len(top) > 1 else (top[0] if top else "")
    sep = max(SEPARATORS, key=header.count)
    names = [_clean_name(n) for n in header.split(sep)]
    price, time = _last_with(names, PRICE_WORDS), _last_with(names, TIME_WORDS)
    if price is None:
        raise SourceMissing(f"{path}: no price column among {names}")
    cells = F.from_csv(F.col("value"), F.lit(", ".join(f"c{i} string" for i in range(len(names)))), {"sep": sep})
    rows = lines.filter(~F.col("value").isin(*top[: 2 if titled else 1])).select(cells.alias("r"))
    cell = F.trim(F.col("r")[f"c{names.index(time) if time else 0}"])
    start = F.trim(F.split(cell, " - ")[0])
    stamp = F.coalesce(_day_first(start), _utc_text(start))
    checked = F.when(stamp.isNull(), F.raise_error(F.concat(F.lit(f"{path}: unreadable stamp "), F.coalesce(start, F.lit("(none)")))).cast("timestamp_ntz")).otherwise(stamp)
    number = coerce_number(F.col("r")[f"c{names.index(price)}"])
    return rows.filter(number.isNotNull()).select(F.lit(series).alias(KEY), checked.alias(TS), number.alias(TARGET))


DAY_FIRST = r"^(\d{1,2})[./-](\d{1,2})[./-](\d{4})(?:[ T]+(\d{1,2}):(\d{2})(?::(\d{2}))?)?$"
YEAR_FIRST = r"^(\d{4})[./](\d{1,2})[./](\d{1,2})(?:[ T]+(\d{1,2}):(\d{2})(?::(\d{2}))?)?$"


def _day_first(text: Column) -> Column:
    """NTZ stamp of a day-first text (or a year-first one with dots or slashes), NULL when the shape differs.

    The text is rearranged to ISO and cast, which no session zone can shift.
    """

    def arranged(shape: str, order: tuple[int, int, int]) -> Column:
        part = [F.regexp_extract(text, shape, n) for n in (*order, 4, 5, 6)]
        two = [F.lpad(F.when(p == "", "0").otherwise(p), 2, "0") for p in part[1:]]
        whole = F.concat(part[0], F.lit("-"), two[0], F.lit("-"), two[1], F.lit(" "), two[2], F.lit(":"), two[3], F.lit(":"), two[4])
        return F.when(text.rlike(shape), whole.try_cast("timestamp_ntz"))

    return F.coalesce(arranged(DAY_FIRST, (3, 2, 1)), arranged(YEAR_FIRST, (1, 2, 3)))


# --- JSON payloads -----------------------------------------------------------

ARRAY_SCHEMA = f"{KEY} string, unix_seconds array<bigint>, price array<double>"
PAIR_SCHEMA = f"{KEY} string, series array<array<double>>"
MIX_SCHEMA = f"{KEY} string, unix_seconds array<bigint>, production_types array<struct<name:string,data:array<double>>>"

# Production type names that mean the load itself.
LOAD_NAMES = ("load", "last", "residual load", "verbrauch")


def read_price_arrays(spark: SparkSession, path: str) -> DataFrame:
    """Payloads with parallel ``unix_seconds`` and ``price`` arrays, one row per element."""
    payload = spark.read.schema(ARRAY_SCHEMA).json(path)
    return payload.select(KEY, F.inline(F.arrays_zip("unix_seconds", "price"))).select(
        KEY, from_micros(F.col("unix_seconds") * 1_000_000).alias(TS), F.col("price").alias(TARGET)
    )


def read_pairs(spark: SparkSession, path: str, column: str = TARGET) -> DataFrame:
    """Payloads of ``[milliseconds, value]`` pairs; pairs without a value are skipped."""
    payload = spark.read.schema(PAIR_SCHEMA).json(path)
    pair = payload.select(KEY, F.explode("series").alias("p")).filter(F.col("p")[1].isNotNull())
    return pair.select(KEY, from_micros((F.col("p")[0] * 1000).cast("bigint")).alias(TS), F.col("p")[1].alias(column))


def read_mix(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MIX_SCHEMA).json(path)


def _element_sum(kinds: Column) -> Column:
    """Element-wise sum over the ``data`` arrays of the given types; absent and NULL count as zero."""
    zeros = F.transform("unix_seconds", lambda _: F.lit(0.0))

    def add(total: Column, kind: Column) -> Column:
        return F.zip_with(total, kind["data"], lambda a, b: a + F.coalesce(b, F.lit(0.0)))

    return F.aggregate(F.filter(kinds, lambda k: k["data"].isNotNull()), zeros, add)


def _per_stamp(payload: DataFrame, columns: dict[str, Column]) -> DataFrame:
    arrays = payload.select(KEY, "unix_seconds", *[c.alias(n) for n, c in columns.items()])
    return arrays.select(KEY, F.inline(F.arrays_zip("unix_seconds", *columns))).select(
        KEY, from_micros(F.col("unix_seconds") * 1_000_000).alias(TS), *columns
    )


def production_mix(payload: DataFrame) -> DataFrame:
    """Wind and solar totals per stamp, added up inside each payload: no shuffle."""
    kinds = F.col("production_types")

    def named(*words: str):
        return lambda k: F.lower(k["name"]).rlike("|".join(words))

    wind = F.filter(kinds, named("wind"))
    solar = F.filter(kinds, lambda k: named("solar", "photovoltaic")(k) & ~named("wind")(k))
    return _per_stamp(payload, {DRIVERS[1]: _element_sum(wind), DRIVERS[2]: _element_sum(solar)})


def load_from_mix(payload: DataFrame) -> DataFrame:
    """The first production type that is the load, else the sum of all types."""
    kinds = F.col("production_types")
    direct = F.filter(kinds, lambda k: F.lower(k["name"]).isin(*LOAD_NAMES))
    load = F.when(F.size(direct) > 0, F.get(direct, F.lit(0))["data"]).otherwise(_element_sum(kinds))
    return _per_stamp(payload, {DRIVERS[0]: load})


# --- Parquet -----------------------------------------------------------------


def read_cached(spark: SparkSession, path: str, start: str, end: str, zone: str | None = None) -> DataFrame:
    """A cached series table cut to local days ``start``..``end``.

    The stamp filter is pushed to the scan; in tables laid out by month the
    folders outside the range (a day wider, for the zone) are not even listed.
    """
    table = spark.read.parquet(path)
    if MONTH in table.columns:
        low, high = (F.date_format(F.date_add(F.lit(day).cast("date"), n), "yyyy-MM") for day, n in ((start, -1), (end, 2)))
        table = table.filter(F.col(MONTH).between(low, high))
    return time_range(table, start, end, zone)


# --- choosing a source -------------------------------------------------------


def first_acceptable(sources: Sequence[tuple[str, DataFrame]], target: str = TARGET, max_missing_pct: float = 1.0) -> DataFrame:
    """Per series, the rows of the highest-ranked source whose target is complete enough.

    Sources are listed best first and read in that order: the rows a source serves are those of series that no
    better source has served, and reading stops when the remaining sources have none. Series
    no source can serve are absent.
    """
    served, out = None, None
    for name, df in sources:
        if served is not None:
            df = df.join(served, KEY, "left_anti")
        missing = F.avg(F.col(target).isNull().cast("double")) * 100
        good = settle(df.groupBy(KEY).agg(missing.alias("_pct")).filter(F.col("_pct") <= max_missing_pct).select(KEY), "served")
        if good.isEmpty():
            continue
        part = attach_summary(df, good).withColumn("source", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
        served = good if served is None else served.unionByName(good)
    if out is None:
        return sources[0][1].limit(0).withColumn("source", F.lit(""))
    return out


def first_available(readers: Sequence[tuple[str, Callable[[], DataFrame]]]) -> tuple[str, DataFrame]:
    """The first reader that finds its files, for whole tables: (name, rows)."""
    problems = []
    for name, read in readers:
        try:
            return name, read()
        except (SourceMissing, AnalysisException) as problem:
            log.info("source %s unavailable: %s", name, problem)
            problems.append(f"{name}: {problem}")
    raise SourceMissing("no source available - " + "; ".join(problems))


def run_folders(spark: SparkSession, path: str, run: str = "run_id") -> list[str]:
    """Names of the runs under ``path``, oldest first: the folders are listed, no file is opened."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)
    names = [x.getPath().getName() for x in found if x.isDirectory()]
    return sorted(n.partition("=")[2] for n in names if n.startswith(f"{run}="))


def latest_run(spark: SparkSession, path: str, run: str = "run_id") -> DataFrame:
    """Rows of the newest run of a table laid out by run; only its folder is read."""
    if not path_exists(spark, path) or not (runs := run_folders(spark, path, run)):
        raise SourceMissing(f"no runs under {path}")
    return spark.read.parquet(f"{path}/{run}={runs[-1]}").withColumn(run, F.lit(unquote(runs[-1])))


def load_features(spark: SparkSession, local: Callable[[], DataFrame] | None, cache: str, target: str = TARGET) -> tuple[str, DataFrame]:
    """The feature table to train on: the local one if its files are there, else the newest cached run, else an error."""
    readers = [("cache", lambda: latest_run(spark, cache))]
    if local is not None:
        readers.insert(0, ("local", local))
    name, table = first_available(readers)
    if target not in table.columns:
        raise SourceMissing(f"the {name} feature table has no column {target}")
    return name, table


# --- typed files -------------------------------------------------------------


def _kind(path: str) -> str:
    for suffix in ("parquet", "csv"):
        if path.rstrip("/").endswith(f".{suffix}"):
            return suffix
    raise ValueError(f"unsupported file type: {path}")


def read_typed(spark: SparkSession, path: str, contract: Sequence[ColumnRule] | None = CONTRACT) -> DataFrame:
    """Read by suffix and cast to the contract."""
    df = spark.read.parquet(path) if _kind(path) == "parquet" else spark.read.option("header", True).csv(path)
    return enforce_schema(df, contract) if contract else df


def write_typed(df: DataFrame, path: str, contract: Sequence[ColumnRule] | None = CONTRACT) -> list[tuple]:
    """Check against the contract, write by suffix, return the warnings."""
    warnings = validate_schema(df, contract) if contract else []
    writer = df.write.mode("overwrite")
    if _kind(path) == "parquet":
        writer.parquet(path)
    else:
        writer.option("header", True).csv(path)
    return warnings

