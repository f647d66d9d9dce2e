"""Names, fixed values and tunable parameters."""

from __future__ import annotations

from dataclasses import dataclass, field

KEY = "series_key"
TS = "ts"

# Market layout.
MARKET_CODE = "DE_LU"
MARKET_ZONE = "Europe/Berlin"
TARGET = "day_ahead_price"
DRIVERS = ("forecast_load", "forecast_wind", "forecast_solar")
VALUES = (TARGET, *DRIVERS)
RESIDUAL = "forecast_residual_load"
SHARE = "forecast_renewable_share"

# Month-day pairs that count as holidays.
FIXED_HOLIDAYS = ("01-01", "05-01", "10-03", "12-25", "12-26")

# Hours in the trailing window every signal view looks at.
WEEK_HOURS = 168


@dataclass(frozen=True)
class ColumnRule:
    """One contract column: type, allowed range and whether it must exist."""

    name: str
    dtype: str = "double"
    low: float | None = None
    high: float | None = None
    required: bool = False


# The schema contract (EUR/MWh for the price, MW for the rest).
CONTRACT = (
    ColumnRule(TS, "timestamp_ntz", required=True),
    ColumnRule("day_ahead_price", "double", -500.0, 3000.0, True),
    ColumnRule("forecast_load", "double", 0.0, 90000.0, True),
    ColumnRule("forecast_wind", "double", 0.0, 75000.0, True),
    ColumnRule("forecast_solar", "double", 0.0, 55000.0, True),
    ColumnRule("actual_load", "double", 0.0, 90000.0, False),
    ColumnRule("actual_wind", "double", 0.0, 75000.0, False),
    ColumnRule("actual_solar", "double", 0.0, 55000.0, False),
)


@dataclass(frozen=True)
class QualityLimits:
    """Thresholds of the quality gate."""

    critical_missing_pct: float = 1.0
    optional_missing_pct: float = 10.0
    max_duplicates: int = 0
    fail_on_range: bool = True
    range_pct: float = 0.1
    max_gap_hours: int = 2
    irregular_share: float = 0.01
    bad_day_share: float = 0.05
    misaligned_pct: float = 5.0
    aligned_pct: float = 90.0
    price_zscore: float = 10.0
    driver_zscore: float = 5.0
    driver_outlier_share: float = 0.01
    outlier_min_rows: int = 10


@dataclass(frozen=True)
class FeatureSpec:
    """Which feature families to build, and their parameters."""

    target: str = TARGET
    drivers: tuple[str, str, str] = DRIVERS
    calendar: tuple[str, ...] = ("hour", "day_of_week", "month", "is_weekend", "is_holiday", "season")
    lag_columns: tuple[str, ...] = VALUES
    lags: tuple[int, ...] = (24, 48, 168)
    rolling_columns: tuple[str, ...] = (TARGET, "forecast_load", RESIDUAL)
    windows: tuple[int, ...] = (24, 168)
    aggregations: tuple[str, ...] = ("mean", "std")
    min_periods: int = 12
    shift: int = 24
    derived: tuple[str, ...] = (RESIDUAL, SHARE)
    interactions: tuple[tuple[str, ...], ...] = (("hour", "day_of_week"), (RESIDUAL, "hour"))
    enable_calendar: bool = True
    enable_derived: bool = True
    enable_lags: bool = True
    enable_rolling: bool = True
    enable_interactions: bool = True
    mode: str = "time"
    step: str = "hour"


@dataclass(frozen=True)
class FoldSpec:
    """Rolling-origin cross-validation windows, in days."""

    train_days: int = 365
    test_days: int = 7
    gap_days: int = 0
    n_splits: int = 10


@dataclass(frozen=True)
class BoostSpec:
    """Hyper-parameters of the gradient-boosted trees."""

    n_trees: int = 500
    learning_rate: float = 0.05
    max_depth: int = 8
    min_child_rows: int = 20
    subsample: float = 0.8
    column_share: float = 0.8
    seed: int = 42
    # Fraction of the training rows, the latest ones, that only decide when to stop.
    stop_share: float = 0.1
    # Rounds without a lower mean absolute error of those rows after which no later round is looked at.
    patience: int = 50


@dataclass(frozen=True)
class Economics:
    """Cost assumptions of a gas-fired unit, and the signal thresholds."""

    gas_price: float = 35.0
    carbon_price: float = 50.0
    heat_rate: float = 2.0
    carbon_intensity: float = 0.4
    threshold: float = 5.0
    max_uncertainty: float = 30.0
    floor_price: float = -100.0
    cap_price: float = 1000.0

    @property
    def marginal_cost(self) -> float:
        return self.gas_price * self.heat_rate + self.carbon_price * self.carbon_intensity


@dataclass(frozen=True)
class JobSpec:
    """Everything one end-to-end run needs."""

    market: str = MARKET_CODE
    zone: str = MARKET_ZONE
    contract: tuple[ColumnRule, ...] = CONTRACT
    limits: QualityLimits = field(default_factory=QualityLimits)
    features: FeatureSpec = field(default_factory=FeatureSpec)
    folds: FoldSpec = field(default_factory=FoldSpec)
    boost: BoostSpec = field(default_factory=BoostSpec)
    economics: Economics = field(default_factory=lambda: Economics(threshold=10.0))
    baseline_lag: int = 168
    validation_days: int = 30
