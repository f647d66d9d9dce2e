"""Exact percentiles of groups that may be too large for one task.

The built-in ``percentile`` gathers every distinct value of a group in one
buffer. Here each wanted rank has a bracket of values that is narrowed by
counting: a mergeable sketch offers cut points, the values between them are
counted exactly, and the interval that holds the rank is the next bracket. Only
a bracket of at most ``ORDERED`` values is put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.functions.numbers import nan_to_null
from hourloom.operators.pieces import FAR, attach_summary
from hourloom.operators.tables import union_all
from hourloom.sources.workspace import settle

#: Values of one group and rank that are put in order.
ORDERED = 10_000
#: Intervals that a counting pass cuts a bracket into. The sketch is far finer, so an interval holds few more values than its share.
CUTS = 64
SKETCH_ACCURACY = 40 * CUTS


def exact_percentiles(df: DataFrame, value: str, probabilities: list[float], by: list[str]) -> DataFrame:
    """Linear-interpolation percentiles, one row per group and probability: ``by, p, value``; NULL and NaN do not count.

    Every counting pass divides the values in question by about ``CUTS``, so a group of a billion takes three. Counts
    are exact and brackets hold their rank by construction; a value that fills an interval alone ends the search.
    """
    rows = df.select(*by, nan_to_null(F.col(value).cast("double")).alias("_v")).filter("_v is not null")
    groups = rows.groupBy(*by).agg(F.count("*").alias("inside"), F.min("_v").alias("low"), F.max("_v").alias("high"))
    wanted = groups.withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
    state = wanted.withColumns({"rank": (F.col("inside") - 1) * F.col("p"), "below": F.lit(0).cast("long")})
    one = F.col("low") == F.col("high")
    unknown = F.lit(None).cast("double")
    columns = [*by, "p", "rank", "low", "high", "inside", "below", "at_floor", "at_ceil"]
    state = settle(state.withColumns({"at_floor": F.when(one, F.col("low")).otherwise(unknown), "at_ceil": F.when(one, F.col("low")).otherwise(unknown)}).select(columns), "brackets")
    done, stored = [], False
    while True:
        done.append(state.filter("at_floor is not null").select(*by, "p", _between(F.col("at_floor"), F.col("at_ceil")).alias("value")))
        state = state.filter("at_floor is null")
        done.append(_ordered(rows, state.filter(F.col("inside") <= ORDERED), by))
        state = state.filter(F.col("inside") > ORDERED)
        if state.isEmpty():
            return union_all(done)
        if not stored:
            rows, stored = settle(rows, "values"), True
        state = settle(_narrowed(rows, state, by).select(columns), "brackets")


def _between(low: Column, high: Column) -> Column:
    return low + (high - low) * (F.col("rank") - F.floor("rank"))


def _inside(rows: DataFrame, state: DataFrame, by: list[str]) -> DataFrame:
    """The values of each bracket, once for every rank whose bracket has them."""
    return attach_summary(rows, state, by).filter(F.col("_v").between(F.col("low"), F.col("high")))


def _position(upto: Column, count: Column, rank: Column) -> Column:
    """Whether the entries that end at ``upto`` hold a rank."""
    return (upto - count <= rank) & (rank < upto)


def _narrowed(rows: DataFrame, state: DataFrame, by: list[str]) -> DataFrame:
    """One counting pass: the interval of each bracket that holds the rank, or both neighbours where it lies between intervals."""
    keys = [*by, "p"]
    near = _inside(rows, state.select(*keys, "rank", "low", "high", "below"), by)
    cuts = near.groupBy(*keys).agg(F.array_distinct(F.percentile_approx("_v", [i / CUTS for i in range(CUTS + 1)], SKETCH_ACCURACY)).alias("_cuts"))
    cut = _inside(rows, state.join(cuts, keys), by)
    # even intervals lie between two cut points, odd ones are a cut point
    interval = 2 * F.size(F.filter("_cuts", lambda c: c < F.col("_v"))) + F.array_contains("_cuts", F.col("_v")).cast("int")
    counted = cut.groupBy(*keys, "rank", "below", interval.alias("_i")).agg(F.count("*").alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    order = Window.partitionBy(*keys).orderBy("_i").rowsBetween(FAR, 0)  # at most 2 * CUTS + 1 rows
    upto, c = F.col("_upto"), F.col("_c")
    ends = counted.withColumn("_upto", F.col("below") + F.sum("_c").over(order))
    at_floor, at_ceil = (_position(upto, c, f("rank")) for f in (F.floor, F.ceil))
    pick = lambda where, x: F.max(F.when(where, x))
    found = ends.groupBy(*keys, "rank").agg(
        pick(at_floor, F.col("_i")).alias("_f"), pick(at_ceil, F.col("_i")).alias("_g"),
        pick(at_floor, F.col("_lo")).alias("low"), pick(at_floor, F.col("_hi")).alias("high"), pick(at_ceil, F.col("_lo")).alias("_next"),
        pick(at_floor, c).alias("inside"), pick(at_floor, upto - c).alias("below"),
    )
    # a rank between two intervals has the greatest value of the one and the least of the other for neighbours
    known = (F.col("_f") != F.col("_g")) | (F.col("low") == F.col("high"))
    after = F.when(F.col("_f") != F.col("_g"), F.col("_next")).otherwise(F.col("high"))
    return found.withColumns({"at_floor": F.when(known, F.col("high")), "at_ceil": F.when(known, after)})


def _ordered(rows: DataFrame, state: DataFrame, by: list[str]) -> DataFrame:
    """Percentiles of brackets with few values, put in order."""
    keys = [*by, "p"]
    counted = _inside(rows, state.select(*keys, "rank", "low", "high", "below"), by).groupBy(*keys, "rank", "below", "_v").agg(F.count("*").alias("_c"))
    order = Window.partitionBy(*keys).orderBy("_v").rowsBetween(FAR, 0)  # at most ORDERED rows
    ends = counted.withColumn("_upto", F.col("below") + F.sum("_c").over(order))
    at = lambda f: F.max(F.when(_position(F.col("_upto"), F.col("_c"), f("rank")), F.col("_v")))
    picked = ends.groupBy(*keys, "rank").agg(at(F.floor).alias("_lo"), at(F.ceil).alias("_hi"))
    return picked.select(*keys, _between(F.col("_lo"), F.col("_hi")).alias("value"))


def percentile_columns(df: DataFrame, value: str, names: dict[str, float], by: list[str]) -> DataFrame:
    """The same percentiles as columns: one row per group."""
    long = exact_percentiles(df, value, sorted(set(names.values())), by)
    return long.groupBy(*by).agg(
        *[F.max(F.when(F.col("p") == F.lit(float(p)), F.col("value"))).alias(n) for n, p in names.items()]
    )
