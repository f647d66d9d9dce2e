"""Ordered work on one series without putting the series into one task.

A series is cut into *pieces* of ``PIECE_SLOTS`` grid positions. A grid position
holds at most one row, so a piece is bounded whatever the series' length or its
share of the table. Three tools cover every ordered operator here:

``over_pieces``  frames that reach back a known number of positions: each row is
                 also copied into the next piece(s) that can see it;
``carry``        state that crosses any number of pieces: one summary row per
                 piece is combined along the series and joined back;
``number_rows``  position of a row in its series, from per-piece counts.

The summaries hold one row per piece (a century of hours is 652 of them), so the
window that combines them per series is small by construction.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from hourloom.config import KEY, TS
from hourloom.functions.clock import slot_number

PIECE_SLOTS = 1344

SLOT = "_slot"
PIECE = "_piece"
HOME = "_home"

FAR = Window.unboundedPreceding


def with_slot(df: DataFrame, step: str = "hour") -> DataFrame:
    """Add the grid position and the piece of every row.

    Rows without a key form a series named ''. Besides keeping them, this tells
    Spark the key is never NULL, so no filter keeps it from reusing shuffles.
    """
    slot = slot_number(TS, step)
    return df.withColumn(KEY, F.coalesce(KEY, F.lit(""))).withColumn(SLOT, slot).withColumn(PIECE, piece_of(F.col(SLOT)))


def piece_of(slot: Column) -> Column:
    return F.floor(slot / PIECE_SLOTS).cast("bigint")


def in_piece(order: str = SLOT) -> WindowSpec:
    return Window.partitionBy(KEY, PIECE).orderBy(order)


def carry(
    df: DataFrame,
    before: dict[str, Column] | None = None,
    after: dict[str, Column] | None = None,
    running: dict[str, Column] | None = None,
    total: dict[str, Column] | None = None,
    place: dict[str, Column] | None = None,
) -> DataFrame:
    """Join per-piece summaries from the rest of the series onto every row.

    ``before``/``after``: latest non-null summary of the earlier pieces / first
    one of the later pieces. ``running``: sum over earlier pieces. ``total``: sum
    over all pieces. ``place``: like ``before``, for a row position inside a
    piece; it becomes a position in the series, and ``_offset`` (rows in earlier
    pieces) is added. ``df`` must carry the piece column. Rows and summaries are
    hashed alike, so the join adds no shuffle of the rows. Every piece has its
    summary; the join is a left one because an inner join would put a filter
    under the rows' shuffle and so keep both sides from sharing it.
    """
    before, after, running, total, place = (d or {} for d in (before, after, running, total, place))
    if place:
        running = {**running, "_offset": F.count("*")}
    summary = df.groupBy(KEY, PIECE).agg(
        *[c.alias(n) for part in (before, after, running, total, place) for n, c in part.items()]
    )
    forward = Window.partitionBy(KEY).orderBy(PIECE).rowsBetween(FAR, -1)
    backward = Window.partitionBy(KEY).orderBy(F.desc(PIECE)).rowsBetween(FAR, -1)
    if running:
        summary = summary.withColumns({n: F.coalesce(F.sum(n).over(forward), F.lit(0)) for n in running})
    combined = summary.select(
        KEY,
        PIECE,
        *running,
        *[F.last(n, ignorenulls=True).over(forward).alias(n) for n in before],
        *[F.last(F.col("_offset") + F.col(n), ignorenulls=True).over(forward).alias(n) for n in place],
        *[F.last(n, ignorenulls=True).over(backward).alias(n) for n in after],
        *[F.sum(n).over(Window.partitionBy(KEY)).alias(n) for n in total],
    )
    return df.join(combined, [KEY, PIECE], "left")


def number_rows(df: DataFrame, step: str = "hour", total: str | None = None) -> DataFrame:
    """0-based position of a row in its series as the slot; optionally the series' row count.

    Time pieces are counted, the counts are summed along the series, and the
    offset is added to the position inside the piece. Equal stamps are numbered
    in an unspecified order, so de-duplicate first.
    """
    cut = with_slot(df, step)
    numbered = carry(
        cut,
        running={"_before": F.count("*")},
        total={total: F.count("*")} if total else {},
    )
    position = F.col("_before") + F.row_number().over(in_piece(TS)) - 1
    return (
        numbered.withColumn("_position", position)
        .withColumn(SLOT, F.col("_position"))
        .withColumn(PIECE, piece_of(F.col(SLOT)))
        .drop("_before", "_position")
    )


def placed(df: DataFrame, mode: str = "time", step: str = "hour") -> DataFrame:
    """Slots by wall clock (``time``) or by row position (``rows``)."""
    if mode == "time":
        return with_slot(df, step)
    if mode == "rows":
        return number_rows(df, step)
    raise ValueError(f"mode must be 'time' or 'rows', not {mode!r}")


def over_pieces(
    df: DataFrame,
    build: Callable[[WindowSpec], dict[str, Column]],
    reach: int,
    mode: str = "time",
    step: str = "hour",
    prepare: Callable[[WindowSpec], dict[str, Column]] | None = None,
) -> DataFrame:
    """Window columns whose frames look back at most ``reach`` slots.

    One shuffle on (series, piece); the copied share is ``reach / PIECE_SLOTS``.
    ``prepare`` may add helper columns that ``build`` uses; its frames must only
    serve as helpers because they see one piece plus its copies.
    """
    slotted = placed(df, mode, step)
    spread = slotted.withColumn(HOME, F.col(PIECE)).withColumn(
        PIECE, F.explode(F.sequence(F.col(HOME), piece_of(F.col(SLOT) + reach)))
    )
    w = in_piece()
    helpers = prepare(w) if prepare else {}
    wide = spread.withColumns(helpers) if helpers else spread
    wide = wide.withColumns(build(w))
    return wide.filter(F.col(PIECE) == F.col(HOME)).drop(SLOT, PIECE, HOME, *helpers)


def attach_summary(df: DataFrame, summary: DataFrame, keys: Sequence[str] | str = KEY) -> DataFrame:
    """Inner-join a one-row-per-key summary to a table whose keys may be badly skewed.

    Adaptive execution knows the summary's size when it has been computed: it broadcasts a small one and
    splits the hot keys of the table beside a large one.
    """
    return df.join(summary, [keys] if isinstance(keys, str) else list(keys))
