"""Leakage-safe features: calendar, derived drivers, lags, rolling statistics, products."""

from __future__ import annotations

import logging
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from hourloom.config import KEY, RESIDUAL, SHARE, TS, FeatureSpec
from hourloom.functions.calendar import CALENDAR, cycle
from hourloom.functions.numbers import finite_or_null
from hourloom.operators.pieces import FAR, over_pieces

log = logging.getLogger(__name__)

DAY_SLOTS = 24


# --- row-wise ----------------------------------------------------------------


def calendar_features(df: DataFrame, names: Sequence[str] = tuple(CALENDAR)) -> DataFrame:
    return df.withColumns({n: CALENDAR[n](TS) for n in names if n in CALENDAR})


def cyclic_features(df: DataFrame) -> DataFrame:
    """Hour of day and day of week as points on a circle."""
    hour_sin, hour_cos = cycle(CALENDAR["hour"](TS), 24)
    dow_sin, dow_cos = cycle(CALENDAR["day_of_week"](TS), 7)
    return df.withColumns({"hour_sin": hour_sin, "hour_cos": hour_cos, "dow_sin": dow_sin, "dow_cos": dow_cos})


def residual_load(load: str, wind: str, solar: str) -> Column:
    return F.col(load) - F.col(wind) - F.col(solar)


def renewable_share(load: str, wind: str, solar: str) -> Column:
    return (F.col(wind) + F.col(solar)) / F.nullif(F.col(load), F.lit(0.0))


def derived_features(df: DataFrame, drivers: Sequence[str], names: Sequence[str] = (RESIDUAL, SHARE)) -> DataFrame:
    """Residual load and renewable share; nothing is added unless all three drivers exist."""
    if not set(drivers) <= set(df.columns):
        return df
    formulas = {RESIDUAL: residual_load(*drivers), SHARE: renewable_share(*drivers)}
    return df.withColumns({n: formulas[n] for n in names if n in formulas})


def interaction_features(df: DataFrame, pairs: Sequence[Sequence[str]]) -> DataFrame:
    """Products of column pairs; a malformed pair or an absent column is skipped."""
    usable = [p for p in pairs if len(p) == 2 and set(p) <= set(df.columns)]
    for p in pairs:
        if p not in usable:
            log.warning("interaction %s skipped", list(p))
    products = {f"interact_{a}_{b}": F.col(a) * F.col(b) for a, b in usable}
    return df.withColumns(products) if products else df


# --- window features ---------------------------------------------------------


def lag_name(n: int, column: str) -> str:
    return f"lag_{n}h_{column}"


def rolling_name(window: int, aggregation: str, column: str, prefix: str = "roll") -> str:
    return f"{prefix}_{window}h_{aggregation}_{column}"


def _lag(w: WindowSpec, column: str, n: int) -> Column:
    """Value exactly ``n`` slots earlier; the frame holds at most that one row."""
    return F.max(F.col(column)).over(w.rangeBetween(-n, -n))


# Values are added up in two parts: multiples of a power of two, whose sums are exact, and the small rest.
VALUE_GRID = 2.0**-10
SQUARE_GRID = 1.0


class _Rolling:
    """Statistics over slots ``[-(shift+window-1), -shift]``.

    Mean and standard deviation are differences of two running totals, so the
    cost per row does not depend on the window length. Values are taken relative
    to the first known one of the piece, and the large part of every total is
    exact (for distances up to about two million), so what has left the window
    leaves no trace; nothing later than the row takes part in any way. Minimum
    and maximum have no such inverse and use the frame itself.
    """

    def __init__(self, columns, windows, aggregations, min_periods, shift, prefix):
        self.columns, self.windows, self.aggregations = columns, windows, aggregations
        self.min_periods, self.shift, self.prefix = min_periods, shift, prefix

    @property
    def reach(self) -> int:
        return self.shift + max(self.windows) - 1 if self.columns and self.windows else 0

    def helpers(self, w: WindowSpec) -> dict[str, Column]:
        past = w.rowsBetween(FAR, 0)
        return {f"_c_{c}": F.first(finite_or_null(F.col(c)), ignorenulls=True).over(past) for c in self.columns}

    def _total(self, w: WindowSpec, c: Column, window: int) -> Column:
        upto = F.coalesce(F.sum(c).over(w.rangeBetween(FAR, -self.shift)), F.lit(0))
        gone = F.coalesce(F.sum(c).over(w.rangeBetween(FAR, -self.shift - window)), F.lit(0))
        return upto - gone

    def _split_total(self, w: WindowSpec, c: Column, grid: float, window: int) -> Column:
        coarse = F.rint(c / grid) * grid
        return self._total(w, coarse, window) + self._total(w, c - coarse, window)

    def columns_of(self, w: WindowSpec) -> dict[str, Column]:
        out = {}
        for c in self.columns:
            value = finite_or_null(F.col(c))
            away = value - F.col(f"_c_{c}")
            known = F.when(value.isNotNull(), 1).otherwise(0).cast("bigint")
            # The centre of a row equals that of every earlier known row; before the first there is nothing to add.
            centre = F.col(f"_c_{c}")
            for window in self.windows:
                n = self._total(w, known, window)
                s = self._split_total(w, away, VALUE_GRID, window)
                frame = w.rangeBetween(-self.shift - window + 1, -self.shift)
                needed = self.min_periods(window)
                for aggregation in self.aggregations:
                    if aggregation == "mean":
                        stat = F.when(n >= max(needed, 1), centre + s / F.nullif(n, F.lit(0)))
                    elif aggregation == "std":
                        q = self._split_total(w, away * away, SQUARE_GRID, window)
                        spread = F.greatest(q - s * s / F.nullif(n, F.lit(0)), F.lit(0.0))
                        stat = F.when(n >= max(needed, 2), F.sqrt(spread / F.nullif(n - 1, F.lit(0))))
                    elif aggregation == "min":
                        stat = F.when(n >= max(needed, 1), F.min(value).over(frame))
                    elif aggregation == "max":
                        stat = F.when(n >= max(needed, 1), F.max(value).over(frame))
                    else:
                        log.warning("unknown rolling aggregation %s skipped", aggregation)
                        continue
                    out[rolling_name(window, aggregation, c, self.prefix)] = stat
        return out


def window_features(
    df: DataFrame,
    lag_columns: Sequence[str] = (),
    lags: Sequence[int] = (),
    rolling_columns: Sequence[str] = (),
    windows: Sequence[int] = (),
    aggregations: Sequence[str] = ("mean", "std"),
    min_periods=12,
    shift: int = DAY_SLOTS,
    mode: str = "time",
    step: str = "hour",
    prefix: str = "roll",
) -> DataFrame:
    """All lag and rolling columns in one shuffle and one sort.

    ``mode='time'`` measures distances by the clock, so missing rows do not
    stretch them; ``mode='rows'`` counts rows. ``min_periods`` is a number or a
    function of the window.
    """
    lag_columns = [c for c in lag_columns if c in df.columns]
    rolling_columns = [c for c in rolling_columns if c in df.columns]
    needed = min_periods if callable(min_periods) else (lambda _w: min_periods)
    rolling = _Rolling(rolling_columns, windows, aggregations, needed, shift, prefix)

    def build(w: WindowSpec) -> dict[str, Column]:
        lagged = {lag_name(n, c): _lag(w, c, n) for c in lag_columns for n in lags}
        return {**lagged, **rolling.columns_of(w)}

    reach = max([rolling.reach, *(lags if lag_columns else [])], default=0)
    if not (lag_columns and lags) and not (rolling_columns and windows):
        return df
    return over_pieces(df, build, reach, mode, step, prepare=rolling.helpers if rolling_columns else None)


def lag_features(df: DataFrame, columns: Sequence[str], lags: Sequence[int] = (24, 48, 168), mode: str = "time", step: str = "hour") -> DataFrame:
    if step == "hour" and lags and min(lags) < DAY_SLOTS:
        log.warning("a lag of %s hours can leak the day being predicted", min(lags))
    return window_features(df, lag_columns=columns, lags=lags, mode=mode, step=step)


def rolling_features(
    df: DataFrame,
    columns: Sequence[str],
    windows: Sequence[int] = (24, 168),
    aggregations: Sequence[str] = ("mean", "std"),
    min_periods=12,
    shift: int = DAY_SLOTS,
    mode: str = "time",
    step: str = "hour",
    prefix: str = "roll",
) -> DataFrame:
    """Backward statistics that end ``shift`` slots before the row.

    Rolling first and shifting the result, or shifting first and rolling, is the
    same frame; only ``min_periods`` differs between callers.
    """
    return window_features(
        df,
        rolling_columns=columns,
        windows=windows,
        aggregations=aggregations,
        min_periods=min_periods,
        shift=shift,
        mode=mode,
        step=step,
        prefix=prefix,
    )


def quarter_window(window: int) -> int:
    """Minimum rows of the raw-file path: a quarter of the window."""
    return max(1, window // 4)


def full_window(window: int) -> int:
    return window


# --- feature tables ----------------------------------------------------------


def build_features(df: DataFrame, spec: FeatureSpec = FeatureSpec()) -> DataFrame:
    """The full feature table; rows without a target are dropped at the end."""
    out = df
    if spec.enable_calendar:
        out = calendar_features(out, spec.calendar)
    if spec.enable_derived:
        out = derived_features(out, spec.drivers, spec.derived)
    out = window_features(
        out,
        lag_columns=spec.lag_columns if spec.enable_lags else (),
        lags=spec.lags if spec.enable_lags else (),
        rolling_columns=spec.rolling_columns if spec.enable_rolling else (),
        windows=spec.windows if spec.enable_rolling else (),
        aggregations=spec.aggregations,
        min_periods=spec.min_periods,
        shift=spec.shift,
        mode=spec.mode,
        step=spec.step,
    )
    if spec.enable_interactions:
        out = interaction_features(out, spec.interactions)
    return out.na.drop(subset=[spec.target]) if spec.target in out.columns else out


def raw_file_features(df: DataFrame, spec: FeatureSpec = FeatureSpec()) -> DataFrame:
    """Feature set of the raw-file path: cyclic parts, two lagged columns, price statistics."""
    load, wind, solar = spec.drivers
    missing = [c for c in (spec.target, *spec.drivers) if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    out = df.withColumn(RESIDUAL, residual_load(load, wind, solar))
    out = cyclic_features(calendar_features(out, ("hour", "day_of_week", "month", "is_weekend")))
    out = window_features(
        out,
        lag_columns=(spec.target, load),
        lags=spec.lags,
        rolling_columns=(spec.target,),
        windows=spec.windows,
        min_periods=quarter_window,
        shift=spec.shift,
        mode=spec.mode,
        step=spec.step,
    )
    return out.withColumns(
        {"hour_x_dow": F.col("hour") * F.col("day_of_week"), "wind_x_solar": F.col(wind) * F.col(solar) / 1e6}
    )


def feature_columns(df: DataFrame, spec: FeatureSpec = FeatureSpec()) -> list[str]:
    """Model inputs: everything but keys, target and the raw drivers."""
    hidden = {KEY, TS, "timestamp", spec.target, *spec.drivers, RESIDUAL}
    return [c for c in df.columns if c not in hidden]


# --- leakage -----------------------------------------------------------------

_LAG = re.compile(r"lag_(\d+)h_")
# Name parts that would point to the future.
FUTURE_WORDS = ("lead", "future", "t+", "shift_-", "ahead_")


def short_lag_columns(columns: Sequence[str], minimum: int = DAY_SLOTS) -> list[str]:
    found = [(c, _LAG.match(c)) for c in columns]
    return [c for c, m in found if m and int(m.group(1)) < minimum]


def suspicious_columns(columns: Sequence[str], allowed: Sequence[str]) -> list[str]:
    """Names that speak of the future, judged without the known column names they embed.

    ``day_ahead_price`` contains ``ahead_``; removing known names first keeps it
    and everything derived from it from being flagged.
    """

    def stripped(c: str) -> str:
        for name in allowed:
            c = c.replace(name, "")
        return c.lower()

    return [c for c in columns if any(word in stripped(c) for word in FUTURE_WORDS)]


def lag_findings(columns: Sequence[str], lags: Sequence[int], minimum: int = DAY_SLOTS) -> list[tuple[str, str]]:
    """(severity, message) pairs: configured lags that are too short, expected lag columns that are absent."""
    out = [("error", f"lag {n}h is shorter than {minimum}h") for n in lags if n < minimum]
    out += [("warning", f"no lag {n}h column") for n in lags if not any(f"lag_{n}h_" in c for c in columns)]
    return out


def lags_are_safe(columns: Sequence[str], spec: FeatureSpec = FeatureSpec()) -> bool:
    return not any(severity == "error" for severity, _ in lag_findings(columns, spec.lags))
