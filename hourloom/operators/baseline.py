"""Seasonal-naive forecasts, time splits and rolling-origin folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourloom.config import KEY, TARGET, TS, FoldSpec
from hourloom.functions.clock import DAY_MICROS, micros, plus_days
from hourloom.functions.scores import score_columns
from hourloom.operators.features import lag_features, lag_name
from hourloom.operators.pieces import PIECE, SLOT, attach_summary, number_rows
from hourloom.operators.tables import drop_null_any
from hourloom.sources.workspace import settle_counted

METRICS = ("mae", "rmse", "smape", "r2")
FOLD_BOUNDS = ("train_start", "train_end", "test_start", "test_end")


# --- naive forecast ----------------------------------------------------------


def ensure_lag(df: DataFrame, target: str = TARGET, lag: int = 168, mode: str = "time", step: str = "hour") -> DataFrame:
    if lag_name(lag, target) in df.columns:
        return df
    return lag_features(df, [target], [lag], mode, step)


def naive_seasonal(df: DataFrame, target: str = TARGET, lag: int = 168) -> DataFrame:
    """Add ``predicted``: last week's value, or the series' mean of those where it is unknown."""
    name = lag_name(lag, target)
    if name not in df.columns:
        raise ValueError(f"lag column '{name}' not found; available: {df.columns[:10]}")
    means = df.groupBy(KEY).agg(F.avg(name).alias("_mean"))
    return attach_summary(df, means).withColumn("predicted", F.coalesce(name, "_mean")).drop("_mean")


def train_baseline(df: DataFrame, target: str = TARGET, lag: int = 168, mode: str = "time", step: str = "hour") -> DataFrame:
    """``series_key, ts, actual, predicted, residual`` where both target and lag are known."""
    name = lag_name(lag, target)
    known = ensure_lag(df, target, lag, mode, step).na.drop(subset=[target, name])
    return known.select(
        KEY, TS, F.col(target).alias("actual"), F.col(name).alias("predicted"), (F.col(target) - F.col(name)).alias("residual")
    )


def evaluate_baseline(df: DataFrame, target: str = TARGET, lag: int = 168, mode: str = "time", step: str = "hour") -> DataFrame:
    """As ``train_baseline``, but future rows without an outcome stay."""
    name = lag_name(lag, target)
    known = ensure_lag(df, target, lag, mode, step).na.drop(subset=[name])
    return known.select(KEY, TS, F.col(target).alias("actual"), F.col(name).alias("baseline_pred"))


# --- splits ------------------------------------------------------------------


def split_ratio(df: DataFrame, ratio: float = 0.8, step: str = "hour", names: tuple[str, str] = ("train", "validation")) -> DataFrame:
    """Label the first ``ratio`` of each series' rows ``train`` and the rest ``validation``."""
    numbered = number_rows(df, step, total="_rows")
    first = F.col(SLOT) < F.floor(F.col("_rows") * ratio)
    return numbered.withColumn("split", F.when(first, names[0]).otherwise(names[1])).drop(SLOT, PIECE, "_rows")


def split_last_days(df: DataFrame, days: int = 30) -> DataFrame:
    """Label rows at or after ``last stamp - days`` of the series ``validation``."""
    cutoffs = df.groupBy(KEY).agg(plus_days(F.max(TS), -days).alias("_cutoff"))
    labelled = attach_summary(df, cutoffs)
    return labelled.withColumn("split", F.when(F.col(TS) < F.col("_cutoff"), "train").otherwise("validation")).drop("_cutoff")


# --- folds -------------------------------------------------------------------


def planned_folds(df: DataFrame, spec: FoldSpec = FoldSpec()) -> DataFrame:
    """Fold bounds per series from its first and last stamp; short series get one 80/20 row split."""
    return _planned(df, *_bounds(df, spec), spec)


def _bounds(df: DataFrame, spec: FoldSpec) -> tuple[DataFrame, int]:
    """First and last stamp of every series with the days to train on and those left over; and how many series are short."""
    bounds = df.groupBy(KEY).agg(F.min(TS).alias("first"), F.max(TS).alias("last"))
    total = F.floor((micros("last") - micros("first")) / DAY_MICROS)
    sized = bounds.withColumn("total", total).withColumn("train", F.least(F.lit(spec.train_days), F.floor(F.col("total") / 2)))
    return settle_counted(sized.withColumn("free", F.col("total") - F.col("train") - spec.test_days), "bounds", F.col("free") <= 0)


def _planned(df: DataFrame, sized: DataFrame, n_short: int, spec: FoldSpec) -> DataFrame:
    step = F.col("free")
    if spec.n_splits > 1:
        step = F.greatest(F.floor(F.col("free") / (spec.n_splits - 1)), F.lit(spec.test_days))
    long = sized.filter("free > 0").select("*", F.explode(F.sequence(F.lit(0), F.lit(spec.n_splits - 1))).alias("plan"))
    begin = plus_days(F.col("first"), F.col("plan") * step)
    rolled = (
        long.withColumn("train_start", begin)
        .withColumn("train_end", plus_days(F.col("train_start"), F.col("train")))
        .withColumn("test_start", plus_days(F.col("train_end"), spec.gap_days))
        .withColumn("test_end", plus_days(F.col("test_start"), spec.test_days))
        .filter("test_end <= last")
    )
    columns = [KEY, "plan", *FOLD_BOUNDS]
    if not n_short:
        return rolled.select(columns)
    return rolled.select(columns).unionByName(_row_split(df, sized.filter("free <= 0")).select(columns))


def _row_split(df: DataFrame, short: DataFrame) -> DataFrame:
    """Series of at most a few weeks: train on the first 80 % of rows, test on the rest."""
    rows = attach_summary(df.select(KEY, TS), short.select(KEY, "first", "last"))
    labelled = split_ratio(rows, 0.8)
    border = labelled.groupBy(KEY).agg(
        F.min("first").alias("train_start"),
        F.min(F.when(F.col("split") == "validation", F.col(TS))).alias("border"),
        F.timestamp_add("MICROSECOND", F.lit(1), F.max("last")).alias("test_end"),
    )
    return border.select(
        KEY, F.lit(0).alias("plan"), "train_start", F.col("border").alias("train_end"), F.col("border").alias("test_start"), "test_end"
    )


def assign_folds(df: DataFrame, folds: DataFrame, label: str = "split") -> DataFrame:
    """One copy of a row per fold and role (``train``/``test``) whose dates contain it.

    A series has at most ``n_splits`` folds, so they travel as one short array
    per series; rows find their folds without a range join.
    """
    lists = folds.groupBy(KEY).agg(
        F.collect_list(F.struct(label, "train_start", "train_end", "test_start", "test_end")).alias("_folds")
    )
    ts = F.col(TS)

    def role(name: str):
        inside = F.filter("_folds", lambda f: (ts >= f[f"{name}_start"]) & (ts < f[f"{name}_end"]))
        return F.transform(inside, lambda f: F.struct(f[label].alias(label), F.lit(name).alias("role")))

    return attach_summary(df, lists).select(
        *df.columns, F.inline(F.concat(role("train"), role("test")))
    )


def _fold_sizes(df: DataFrame, sized: DataFrame, planned: DataFrame) -> DataFrame:
    """``series_key, plan, train_rows, test_rows`` from running totals, without a row being copied into its folds.

    Folds begin and end whole days after the first stamp, so rows are counted by such days once, and a fold's size is the
    difference of two totals. Bounds off those days (of a short series' row split) are counted at their own instant.
    """
    first = sized.select(KEY, F.col("first").alias("_first"))
    since = lambda c: micros(c) - micros("_first")
    edges = planned.select(KEY, "plan", F.inline(F.array(*[F.struct(F.lit(c).alias("bound"), F.col(c).alias("at")) for c in FOLD_BOUNDS])))
    edges = attach_summary(edges, first).select(KEY, "plan", "bound", since("at").alias("since"))
    odd = edges.filter(F.col("since") % DAY_MICROS != 0).groupBy(KEY).agg(F.array_sort(F.collect_set("since")).alias("_odd"))  # of short series
    rows = attach_summary(df.select(KEY, TS), first).join(odd, KEY, "left").select(KEY, since(TS).alias("since"), "_odd")
    day = F.floor(F.col("since") / DAY_MICROS) * DAY_MICROS
    cut = F.array_max(F.filter("_odd", lambda o: (o <= F.col("since")) & (o > day)))
    counts = rows.groupBy(KEY, F.coalesce(cut, day).cast("long").alias("since")).agg(F.count("*").alias("n"))
    # a series' days and bounds in one short list; a bound comes before the rows of its instant
    both = counts.select(KEY, "since", "n", F.lit(None).cast("int").alias("plan"), F.lit(None).cast("string").alias("bound")).unionByName(
        edges.select(KEY, F.col("since").cast("long"), F.lit(0).cast("long").alias("n"), F.col("plan").cast("int"), "bound")
    )
    order = Window.partitionBy(KEY).orderBy("since", F.col("plan").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    totals = both.withColumn("total", F.sum("n").over(order)).filter("plan is not null").groupBy(KEY, "plan")
    at = lambda name: F.max(F.when(F.col("bound") == name, F.col("total")))
    return totals.agg((at("train_end") - at("train_start")).alias("train_rows"), (at("test_end") - at("test_start")).alias("test_rows"))


def cv_folds(df: DataFrame, spec: FoldSpec = FoldSpec()) -> DataFrame:
    """Folds that have both train and test rows, numbered from 0, with their row counts."""
    sized, n_short = _bounds(df, spec)
    planned = _planned(df, sized, n_short, spec)
    sizes = _fold_sizes(df, sized, planned)
    full = planned.join(sizes.filter("train_rows > 0 and test_rows > 0"), [KEY, "plan"])
    number = F.row_number().over(Window.partitionBy(KEY).orderBy("plan")) - 1
    folds, n = settle_counted(full.select(KEY, number.alias("split"), *FOLD_BOUNDS, "train_rows", "test_rows"), "folds")
    if not n:
        raise ValueError("no fold has both train and test rows")
    return folds


def cv_baseline_predictions(df: DataFrame, folds: DataFrame, target: str = TARGET, lag: int = 168) -> DataFrame:
    """The naive forecast of every complete row in the test part of a fold."""
    rows = assign_folds(drop_null_any(df).select(KEY, TS, target, lag_name(lag, target)), folds).filter("role = 'test'")
    return rows.select(KEY, TS, "split", F.col(target).alias("actual"), F.col(lag_name(lag, target)).alias("predicted"), (F.col(target) - F.col(lag_name(lag, target))).alias("residual"))


def cv_baseline(df: DataFrame, folds: DataFrame, target: str = TARGET, lag: int = 168) -> DataFrame:
    """Metrics of the naive forecast per fold; folds left without train or test rows are skipped."""
    rows = assign_folds(drop_null_any(df).select(KEY, TS, target, lag_name(lag, target)), folds)
    test = F.col("role") == "test"
    scores = rows.groupBy(KEY, "split").agg(
        F.count(F.when(F.col("role") == "train", 1)).alias("train_rows"),
        *score_columns(F.col(target), F.col(lag_name(lag, target)), where=test),
    )
    return scores.filter("train_rows > 0 and n_samples > 0").drop("train_rows")


def cv_mean_metrics(fold_metrics: DataFrame, by: Sequence[str] = (KEY,)) -> DataFrame:
    return fold_metrics.groupBy(*by).agg(*[F.avg(m).alias(m) for m in METRICS], F.count("*").alias("n_folds"))
