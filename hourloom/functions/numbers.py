"""Scalar helpers with pandas-like missing-value rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(c: Column) -> Column:
    """NaN means missing in the source files; Spark only skips NULL."""
    return F.when(~F.isnan(c), c)


def finite_or_null(c: Column) -> Column:
    """NaN and both infinities to NULL, the rule of rolling statistics."""
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def coerce_number(c: Column) -> Column:
    """Text to double; what does not parse becomes NULL."""
    return nan_to_null(F.trim(c).try_cast("double"))


def clip_at_zero(c: Column) -> Column:
    """Lower clip that keeps NULL (``greatest`` would turn it into 0)."""
    return F.when(c.isNotNull(), F.greatest(c, F.lit(0.0)))


def drop_negative(c: Column) -> Column:
    """Negative values are physically impossible: treat them as missing."""
    return F.when(c >= 0, c)


def percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100``, NULL when the whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100


def improvement_pct(base: Column, model: Column) -> Column:
    return F.try_divide(base - model, base) * 100


def equal_width_bin(c: Column, low: Column, high: Column, bins: int) -> Column:
    """1-based bin of ``[low, high]``; the upper edge belongs to the last bin, outside is NULL."""
    raw = F.floor((c - low) / (high - low) * bins).cast("int") + 1
    return F.when((c >= low) & (c <= high), F.least(raw, F.lit(bins)))
