"""Bring raw rows onto a complete, unique UTC grid and fill short gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from hourloom.config import KEY, TS
from hourloom.functions import zones
from hourloom.functions.clock import (
    HOUR_MICROS,
    from_micros,
    hour_start,
    micros,
    plus_hours,
)
from hourloom.operators.pieces import FAR, PIECE, PIECE_SLOTS, SLOT, attach_summary, carry, in_piece, placed, with_slot

GRID_BLOCK = PIECE_SLOTS
ROW, AT = "_row", "_at"


# --- duplicates --------------------------------------------------------------


def dedupe_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Repeated stamps become one row with the mean of each column."""
    return df.groupBy(KEY, TS).agg(*[F.avg(c).alias(c) for c in columns])


def dedupe_first(df: DataFrame, arrival: str) -> DataFrame:
    """Repeated stamps keep the row with the lowest ``arrival`` (unique); combined before the shuffle.

    One aggregate per column rather than one per row keeps the hash aggregation:
    a row as a struct would force a sort of the whole table first.
    """
    rest = [c for c in df.columns if c not in (KEY, TS)]
    return df.groupBy(KEY, TS).agg(*[F.min_by(c, arrival).alias(c) for c in rest])


def dedupe_none(df: DataFrame) -> DataFrame:
    """Every row of a repeated stamp is dropped."""
    rest = [c for c in df.columns if c not in (KEY, TS)]
    kept = df.groupBy(KEY, TS).agg(F.count("*").alias("_n"), *[F.any_value(c).alias(c) for c in rest])
    return kept.filter("_n = 1").drop("_n")


def handle_repeats(df: DataFrame, columns: Sequence[str], policy: str, arrival: str | None = None) -> DataFrame:
    """The fall-back policy of a market: ``average`` or, for anything else, keep the first."""
    if policy == "average":
        return dedupe_mean(df, columns)
    if arrival is None:
        raise ValueError("keeping the first row needs an arrival column")
    return dedupe_first(df, arrival)


# --- grids -------------------------------------------------------------------


def hour_grid(bounds: DataFrame) -> DataFrame:
    """``series_key, ts`` for every hour from ``_first`` to ``_last`` (micros), anchored at the first.

    Blocks are exploded before hours, so the longest array is one block long.
    """
    hours = F.floor((F.col("_last") - F.col("_first")) / HOUR_MICROS).cast("bigint")
    blocks = bounds.select(
        KEY, "_first", hours.alias("_hours"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(hours / GRID_BLOCK))).alias("_b")
    )
    start = F.col("_b") * GRID_BLOCK
    steps = F.explode(F.sequence(start, F.least(F.col("_hours"), start + GRID_BLOCK - 1)))
    return blocks.select(KEY, "_first", steps.alias("_step")).select(
        KEY, from_micros(F.col("_first") + F.col("_step") * HOUR_MICROS).alias(TS)
    )


def _with_gaps(df: DataFrame, no_key: Column | None = None) -> DataFrame:
    """Rows on the hourly grid of their series (anchored at its first stamp), and a marker without values at the start of every block.

    Adds the step on the grid, the block as the piece, whether it is a row, and ``_until``, the step of what comes next.
    What lies between two of them follows from their steps, so hours without a row are neither shuffled nor sorted.
    Rows without a key are on no grid: their series has markers only, in blocks of its own.
    """
    at = micros(TS)
    bounds = df.groupBy(KEY).agg(F.min(at).alias("_first"), F.max(at).alias("_last"))
    rest = [c for c in df.columns if c not in (KEY, TS)]
    hours = F.floor((F.col("_last") - F.col("_first")) / HOUR_MICROS).cast("bigint")
    blocks = bounds.select(KEY, "_first", hours.alias("_hours"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(hours / GRID_BLOCK))).alias("_block"))
    markers = blocks.withColumn(SLOT, F.col("_block") * GRID_BLOCK)
    past = at - F.col("_first")
    rows = attach_summary(df, bounds).filter(past % HOUR_MICROS == 0).withColumns({SLOT: F.floor(past / HOUR_MICROS).cast("bigint"), "_hours": hours})
    rows = rows.withColumn("_block", F.floor(F.col(SLOT) / GRID_BLOCK).cast("bigint"))
    place = [KEY, "_first", "_hours", "_block", SLOT]
    both = rows.select(*place, F.lit(True).alias(ROW), *rest).unionByName(markers.select(*place, F.lit(False).alias(ROW)), allowMissingColumns=True)
    end = F.least((F.col("_block") + 1) * GRID_BLOCK, F.col("_hours") + 1)
    piece = F.when(F.col(KEY).isNull(), -1 - F.col("_block")).otherwise(F.col("_block"))
    both = both.withColumns({"_end": end, PIECE: piece, KEY: F.col(KEY) if no_key is None else F.coalesce(KEY, no_key)})
    ahead = F.lead(SLOT).over(Window.partitionBy(KEY, PIECE).orderBy(SLOT, ROW))
    return both.withColumn("_until", F.coalesce(ahead, "_end")).drop("_hours", "_block", "_end")


def _filled_hours(gaps: DataFrame, names: Sequence[str], cells: dict[str, Column]) -> DataFrame:
    """``names`` for every step up to the next row: a row's own values at its step, NULL after it; ``cells`` instead where given."""
    stands = F.col(ROW) | (F.col("_until") > F.col(SLOT))
    steps = F.when(stands, F.sequence(SLOT, F.greatest(F.col("_until") - 1, F.col(SLOT))))
    hours = gaps.withColumn(AT, F.explode(steps))
    own = {c: F.when(F.col(ROW) & (F.col(AT) == F.col(SLOT)), F.col(c)) for c in names if c not in (KEY, TS)}
    hours = hours.withColumns({TS: from_micros(F.col("_first") + F.col(AT) * HOUR_MICROS), **own})
    return hours.withColumns(cells).select(KEY, TS, *own)


def complete_hours(df: DataFrame) -> DataFrame:
    """Every hour between the first and last stamp of a series; gaps are NULL rows.

    The grid is anchored at the first stamp, so rows off that grid vanish. Each row emits the hours up to the next one:
    the work before that grows with the rows given, not with the hours.
    """
    return _filled_hours(_with_gaps(df), df.columns, {})


def reindex(df: DataFrame, grid: DataFrame) -> DataFrame:
    """Align rows to a grid of ``series_key, ts``; grid stamps without a row are NULL rows."""
    return grid.join(df, [KEY, TS], "left")


def resample_mean(df: DataFrame, columns: Sequence[str], fill_grid: bool = True) -> DataFrame:
    """Hourly mean of finer rows; empty hours inside the range are NULL rows."""
    hourly = df.groupBy(KEY, hour_start(TS).alias(TS)).agg(*[F.avg(c).alias(c) for c in columns])
    return complete_hours(hourly) if fill_grid else hourly


def resample_first(df: DataFrame, columns: Sequence[str], fill_grid: bool = True, tie: str | None = None) -> DataFrame:
    """First non-null value per hour and column; ``tie`` orders rows with equal stamps."""

    def earliest(c: str) -> Column:
        order = F.struct(TS, tie) if tie else F.col(TS)
        return F.min_by(c, F.when(F.col(c).isNotNull(), order)).alias(c)

    hourly = df.groupBy(KEY, hour_start(TS).alias("_hour")).agg(*[earliest(c) for c in columns])
    hourly = hourly.withColumnRenamed("_hour", TS)
    return complete_hours(hourly) if fill_grid else hourly


# --- fills -------------------------------------------------------------------


def _known_at(c: str, at: str = SLOT) -> Column:
    """Slot of a non-null cell, NULL otherwise."""
    return F.when(F.col(c).isNotNull(), F.col(at))


def fill_forward(df: DataFrame, columns: Sequence[str], limit: int, mode: str = "rows", step: str = "hour") -> DataFrame:
    """Repeat the last known value over at most ``limit`` rows (or hours, with ``mode='time'``).

    Values and positions cross pieces in one summary, so even row distances need
    neither a numbering pass nor a second shuffle.
    """
    cut = with_slot(df, step)
    if mode == "rows":
        cut = cut.withColumn(SLOT, F.row_number().over(in_piece(TS)).cast("bigint"))
    elif mode != "time":
        raise ValueError(f"mode must be 'time' or 'rows', not {mode!r}")
    values = {f"_bv_{c}": F.max_by(c, _known_at(c)) for c in columns}
    slots = {f"_bs_{c}": F.max(_known_at(c)) for c in columns}
    out = carry(cut, before=values, place=slots) if mode == "rows" else carry(cut, before={**values, **slots})
    offset = F.col("_offset") if mode == "rows" else F.lit(0)
    w = in_piece(TS).rowsBetween(FAR, 0)

    def near(c: str) -> Column:
        last_value = F.coalesce(F.last(c, ignorenulls=True).over(w), F.col(f"_bv_{c}"))
        last_slot = F.coalesce(F.last(_known_at(c), ignorenulls=True).over(w) + offset, F.col(f"_bs_{c}"))
        return F.when(F.col(SLOT) + offset - last_slot <= limit, last_value)

    return out.withColumns({c: near(c) for c in columns}).select(*df.columns)


def interpolate(
    df: DataFrame,
    columns: Sequence[str],
    limit: int = 6,
    strict: bool = False,
    mode: str = "time",
    step: str = "hour",
) -> DataFrame:
    """Straight line between the known neighbours of a gap.

    By default the first ``limit`` cells of any gap are filled, and cells after
    the last known value repeat it up to the same limit; leading cells stay NULL.
    ``strict`` leaves gaps longer than ``limit``, and open ends, untouched.
    """
    out = _neighbours(placed(df, mode, step), columns, SLOT)
    return out.withColumns({c: _line(c, F.col(SLOT), limit, strict) for c in columns}).select(*df.columns)


def _neighbours(df: DataFrame, columns: Sequence[str], *order: str) -> DataFrame:
    """Value and slot of the last known cell up to each row (``_pv_``, ``_ps_``) and of the first one after it (``_nv_``, ``_ns_``).

    All windows are over one order and come before the join with the summaries, so a piece is sorted once.
    """
    back = Window.partitionBy(KEY, PIECE).orderBy(*order).rowsBetween(FAR, 0)
    ahead = f"IGNORE NULLS OVER (PARTITION BY {KEY}, {PIECE} ORDER BY {', '.join(order)})"
    inside = {}
    for c in columns:
        inside[f"_pv_{c}"] = F.last(c, ignorenulls=True).over(back)
        inside[f"_ps_{c}"] = F.last(_known_at(c), ignorenulls=True).over(back)
        inside[f"_nv_{c}"] = F.expr(f"lead(`{c}`) {ahead}")
        inside[f"_ns_{c}"] = F.expr(f"lead(CASE WHEN `{c}` IS NOT NULL THEN {SLOT} END) {ahead}")
    before = {f"_bv_{c}": F.max_by(c, _known_at(c)) for c in columns} | {f"_bs_{c}": F.max(_known_at(c)) for c in columns}
    after = {f"_av_{c}": F.min_by(c, _known_at(c)) for c in columns} | {f"_as_{c}": F.min(_known_at(c)) for c in columns}
    out = carry(df.withColumns(inside), before=before, after=after)
    sides = [(near + kind, far + kind) for near, far in (("_p", "_b"), ("_n", "_a")) for kind in "vs"]
    return out.withColumns({f"{x}_{c}": F.coalesce(f"{x}_{c}", f"{y}_{c}") for c in columns for x, y in sides})


def _line(c: str, at: Column, limit: int, strict: bool) -> Column:
    pv, ps, nv, ns = (F.col(f"_{n}_{c}") for n in ("pv", "ps", "nv", "ns"))
    gone = at - ps
    between = pv + (nv - pv) * gone / (ns - ps)
    fill = F.when(ns - ps - 1 <= limit, between) if strict else F.when(gone <= limit, F.coalesce(between, pv))
    return F.when(F.col(c).isNotNull(), F.col(c)).otherwise(fill)


def interpolate_hours(df: DataFrame, columns: Sequence[str], limit: int = 6, strict: bool = False) -> DataFrame:
    """``interpolate`` of ``complete_hours``, without a grid before the result: neighbours are sought among the rows given.

    Rows without a key form a series named '', whose cells are NULL.
    """
    known = _neighbours(_with_gaps(df, F.lit("")), columns, SLOT, ROW)
    return _filled_hours(known, df.columns, {c: _line(c, F.col(AT), limit, strict) for c in columns})


def fill_forward_hours(df: DataFrame, columns: Sequence[str], limit: int) -> DataFrame:
    """``fill_forward`` of ``complete_hours`` over at most ``limit`` hours, sought among the rows given like ``interpolate_hours``."""
    known = _neighbours(_with_gaps(df, F.lit("")), columns, SLOT, ROW)
    return _filled_hours(known, df.columns, {c: F.when(F.col(AT) - F.col(f"_ps_{c}") <= limit, F.col(f"_pv_{c}")) for c in columns})


# --- time zones --------------------------------------------------------------


def localize_to_utc(df: DataFrame, zone: str, arrival: str, ts: str = TS) -> DataFrame:
    """Naive wall-clock stamps to UTC.

    A stamp in the skipped hour moves forward to the change; of a repeated stamp
    the first arrival is the earlier instant and the others the later one. Only
    the rare repeated stamps are grouped; all other rows stay where they are.
    """
    utc = zones.local_to_utc(ts, zone)
    again = zones.is_repeated(ts, zone)
    firsts = df.filter(again).groupBy(KEY, ts).agg(F.min(arrival).alias("_first_arrival"))
    plain = df.filter(~F.coalesce(again, F.lit(False))).withColumn(ts, utc)
    twice = attach_summary(df.filter(again), firsts, [KEY, ts])
    second = F.col(arrival) > F.col("_first_arrival")
    shifted = twice.withColumn(ts, F.when(second, plus_hours(utc, 1)).otherwise(utc)).drop("_first_arrival")
    return plain.unionByName(shifted)


def zone_column(df: DataFrame, zone: str, name: str = "local_ts") -> DataFrame:
    """Add the wall clock of ``zone`` for every UTC stamp."""
    return df.withColumn(name, zones.to_zone(TS, zone))


def zone_hours(ranges: DataFrame, zone: str) -> DataFrame:
    """Every hour between two wall-clock instants (``start``, ``end``), in UTC and local time."""
    bounds = ranges.select(
        KEY,
        micros(zones.local_to_utc("start", zone)).alias("_first"),
        micros(zones.local_to_utc("end", zone)).alias("_last"),
    )
    return zone_column(hour_grid(bounds.filter("_last >= _first")), zone)


def dst_change_days(years: DataFrame, zone: str) -> DataFrame:
    """Local days of each ``year`` on which the UTC offset changes."""
    first = F.make_date("year", F.lit(1), F.lit(1))
    last = F.make_date("year", F.lit(12), F.lit(31))
    days = years.select("year", F.explode(F.sequence(first, last)).alias("day"))
    return days.filter(zones.offset_changes_on("day", zone))


def sum_sources(df: DataFrame, parts: Sequence[str], name: str) -> DataFrame:
    """Add sources of one quantity; with several, a missing one counts as zero."""
    present = [c for c in parts if c in df.columns]
    if not present:
        return df
    if len(present) == 1:
        total = F.col(present[0])
    else:
        total = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in present[1:]), F.coalesce(F.col(present[0]), F.lit(0.0)))
    return df.withColumn(name, total).drop(*[c for c in present if c != name])


# --- ranges ------------------------------------------------------------------


def valid_bounds(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """First and last stamp per series after cutting, column by column, to each column's known range.

    A column that is entirely missing cuts nothing. The columns are applied in
    order, because a cut can remove the rows that bound a later column.
    """
    rows, bounds = df.select(KEY, TS, *columns), None
    for c in columns:
        inside = rows if bounds is None else _between(rows, bounds)
        known = F.when(F.col(c).isNotNull(), F.col(TS))
        bounds = inside.groupBy(KEY).agg(
            F.coalesce(F.min(known), F.min(TS)).alias("_from"), F.coalesce(F.max(known), F.max(TS)).alias("_to")
        )
    return bounds


def _between(df: DataFrame, bounds: DataFrame) -> DataFrame:
    return attach_summary(df, bounds).filter(F.col(TS).between(F.col("_from"), F.col("_to"))).drop("_from", "_to")


def trim_to_valid(df: DataFrame, columns: Sequence[str], bounds: DataFrame | None = None) -> DataFrame:
    """Cut each series to the range in which every listed column has data at both ends.

    ``bounds`` may come from a cheaper table with the same stamps and gaps.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    return _between(df, valid_bounds(df, present) if bounds is None else bounds)
