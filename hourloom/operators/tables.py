"""Projections, filters, joins and set operations on series tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.config import DRIVERS, KEY, TARGET, TS, WEEK_HOURS
from hourloom.functions import zones
from hourloom.functions.numbers import coerce_number, drop_negative

KEYS = (KEY, TS)

# --- projections -------------------------------------------------------------


def select_expected(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys plus the listed columns; absent ones appear as NULL doubles."""
    return df.select(*KEYS, *[F.col(c) if c in df.columns else F.lit(None).cast("double").alias(c) for c in columns])


def select_driver(df: DataFrame, column: str) -> DataFrame:
    return df.select(*KEYS, column) if column in df.columns else df


def rename_predictions(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"predicted": "predicted_price", "actual": "actual_price"})


def rename_price(df: DataFrame, target: str = TARGET) -> DataFrame:
    """The first column whose name contains ``price`` becomes the target, unless it exists."""
    found = [c for c in df.columns if "price" in c.lower()]
    return df if target in df.columns or not found else df.withColumnRenamed(found[0], target)


def to_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: coerce_number(F.col(c).cast("string")) for c in columns})


def clamp_invalid(df: DataFrame, column: str = DRIVERS[0]) -> DataFrame:
    return df.withColumn(column, drop_negative(F.col(column)))


# --- filters -----------------------------------------------------------------


def time_range(df: DataFrame, start: str, end: str, zone: str | None = None) -> DataFrame:
    """Rows from ``start`` up to and including the day ``end``; both are local days of ``zone``.

    The bounds are constants, so the filter reaches the Parquet scan.
    """
    low, high = F.lit(start).cast("timestamp_ntz"), F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz")
    if zone:
        low, high = zones.from_zone(low, zone), zones.from_zone(high, zone)
    return df.filter((F.col(TS) >= low) & (F.col(TS) < high))


def drop_null_target(df: DataFrame, target: str = TARGET) -> DataFrame:
    return df.na.drop(subset=[target])


def drop_null_any(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def last_rows(df: DataFrame, n: int = WEEK_HOURS) -> DataFrame:
    """The latest ``n`` rows of each series.

    Spark limits each map task to ``n`` rows per series before the shuffle, so a
    dominant series does not flood one task.
    """
    w = Window.partitionBy(KEY).orderBy(F.desc(TS))
    return df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r")


def forecast_window(df: DataFrame, n: int = WEEK_HOURS, split: str = "test") -> DataFrame:
    """Rows marked ``split``; series without any (or tables without marks) use their last ``n`` rows."""
    if "split" not in df.columns:
        return last_rows(df, n)
    marked = df.filter(F.col("split") == split)
    without = last_rows(df, n).join(marked.select(KEY).distinct(), KEY, "left_anti")
    return marked.unionByName(without)


# --- joins -------------------------------------------------------------------


def outer_join_sources(sources: Sequence[DataFrame], keys: Sequence[str] = KEYS) -> DataFrame:
    """Full outer join on (series, stamp); every source shuffles once on the same keys."""
    return reduce(lambda a, b: a.join(b, list(keys), "full"), sources)


def left_join_market_price(df: DataFrame, market: DataFrame, price: str = "price") -> DataFrame:
    return df.join(market.select(*KEYS, F.col(price).alias("market_price")), list(KEYS), "left")


def inner_join_models(first: DataFrame, second: DataFrame) -> DataFrame:
    """Two prediction tables on their common stamps."""
    a = first.select(*KEYS, "actual", F.col("predicted").alias("baseline_predicted"))
    b = second.select(*KEYS, F.col("predicted").alias("model_predicted"))
    return a.join(b, list(KEYS))


def semi_join_days(df: DataFrame, days: DataFrame) -> DataFrame:
    """Rows whose UTC date is among ``days`` (``series_key, day``)."""
    return df.withColumn("day", F.to_date(TS)).join(days.select(KEY, "day"), [KEY, "day"], "left_semi").drop("day")


def apply_mask(signals: DataFrame, mask: DataFrame) -> DataFrame:
    """Join a ``series_key, ts, valid`` mask; rows without an entry stay valid."""
    joined = signals.join(mask.select(*KEYS, "valid"), list(KEYS), "left")
    return joined.withColumn("valid", F.coalesce("valid", F.lit(True)))


# --- sorts, sets -------------------------------------------------------------


def sort_series(df: DataFrame) -> DataFrame:
    """Global order, a range-partitioned sort: for sinks only."""
    return df.orderBy(*KEYS)


def union_all(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def union_splits(splits: Mapping[str, DataFrame]) -> DataFrame:
    return union_all(df.withColumn("split", F.lit(name)) for name, df in splits.items())


def union_chunks(parts: Iterable[DataFrame]) -> DataFrame:
    """Chunked reads together; a stamp read twice counts once, as the first chunk has it."""
    tagged = union_all(df.withColumn("_chunk", F.lit(i)) for i, df in enumerate(parts))
    values = [c for c in tagged.columns if c not in (*KEYS, "_chunk")]
    first = tagged.groupBy(*KEYS).agg(F.min_by(F.struct(*values), "_chunk").alias("_row"))
    return first.select(*KEYS, *[F.col("_row")[c].alias(c) for c in values])


def distinct_rows(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return df.dropDuplicates(list(keys))


def common_stamps(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.select(*KEYS).intersect(second.select(*KEYS))


def head_rows(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    return df.orderBy(*order).limit(n)
