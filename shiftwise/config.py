"""Planning parameters.

Every constant the pipeline uses lives here, grouped by stage, so a caller
can change an assumption without touching operator code.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (must stay equal to the published pipeline for equal results)
# ---------------------------------------------------------------------------
# Lags (weeks, as row offsets): 1, 2, 4, 13, 52
# Rolling means of past sales: 4 and 13 rows, minimum 1 row
# Holdout: last 13 weekly dates, i.e. max(date) - 12 weeks inclusive
# Volume tier cut-offs: 0.33 and 0.66 quantiles of department medians
# Tiers and targets (sales per labor hour):
#   High Volume 1250.00, Medium Volume 950.00, Low Volume 700.00
# Weekly hours per associate: 32
# Coverage factor by store type: A 0.98, B 0.95, C 0.92, other 0.95
# Hourly wage by store type: A 18.50, B 17.50, C 16.75, other 17.50
# Holiday schedule factor: 1.06 on holiday weeks, else 1.00
# Callout rate: 0.075 on holiday weeks, else 0.045
# Flex pool: 5 % of scheduled hours
# Overtime premium: 1.5
# Readiness: coverage 40 pts, accuracy 25 pts, productivity 25 pts,
#   holiday 5 pts (holiday week) or 10 pts; ratios capped at 1.10
# Readiness status: >= 85 Ready, >= 70 Watch, else At Risk
# Recommendation on labor gap hours:
#   >= 24   'Add associates or approve overtime'
#   >= 8    'Use flex pool / monitor schedule'
#   <= -24  'Potential overstaffing - review schedule'
#   else    'Staffing balanced'
# Ridge alpha 1.0; boosting depth 6, min child weight 5, subsample 0.8,
#   column sample 0.8, seed 42

LAGS = (1, 2, 4, 13, 52)
ROLLING_WINDOWS = (4, 13)
MARKDOWN_COLS = ("markdown1", "markdown2", "markdown3", "markdown4", "markdown5")
EXTERNAL_COLS = ("temperature", "fuel_price", "cpi", "unemployment")
REQUIRED_MODEL_COLS = (
    "lag_1", "lag_2", "lag_4", "lag_13", "lag_52", "rolling_4_mean", "rolling_13_mean",
)
NUMERIC_FEATURES = (
    "size", "temperature", "fuel_price", "cpi", "unemployment",
    "markdown1", "markdown2", "markdown3", "markdown4", "markdown5",
    "year", "month", "weekofyear", "quarter", "is_december",
    "lag_1", "lag_2", "lag_4", "lag_13", "lag_52", "rolling_4_mean", "rolling_13_mean",
)
CATEGORICAL_FEATURES = ("store", "dept", "type", "is_holiday")


@dataclass(frozen=True)
class ForecastConfig:
    lags: tuple = LAGS
    rolling_windows: tuple = ROLLING_WINDOWS
    holdout_weeks: int = 13
    ridge_alpha: float = 1.0
    gbt_rounds: int = 2000
    gbt_step: float = 0.01
    gbt_depth: int = 6
    gbt_min_instances: int = 5
    gbt_subsample: float = 0.8
    gbt_column_share: float = 0.8
    gbt_l2: float = 1.0
    gbt_bins: int = 256
    fit_partitions: int = 16
    seed: int = 42


@dataclass(frozen=True)
class LaborConfig:
    low_quantile: float = 0.33
    high_quantile: float = 0.66
    tier_targets: tuple = (
        ("High Volume", 1250.00),
        ("Medium Volume", 950.00),
        ("Low Volume", 700.00),
    )
    weekly_hours_per_associate: int = 32
    coverage_by_type: dict = field(default_factory=lambda: {"A": 0.98, "B": 0.95, "C": 0.92})
    coverage_default: float = 0.95
    wage_by_type: dict = field(default_factory=lambda: {"A": 18.50, "B": 17.50, "C": 16.75})
    wage_default: float = 17.50
    holiday_factor: float = 1.06
    regular_factor: float = 1.00
    holiday_callout: float = 0.075
    regular_callout: float = 0.045
    flex_share: float = 0.05


@dataclass(frozen=True)
class MartConfig:
    overtime_premium: float = 1.5
    ratio_cap: float = 1.10
    coverage_points: float = 40.0
    accuracy_points: float = 25.0
    productivity_points: float = 25.0
    holiday_points: int = 5
    regular_points: int = 10
    ready_at: float = 85.0
    watch_at: float = 70.0
    add_staff_gap: float = 24.0
    flex_gap: float = 8.0
    overstaff_gap: float = -24.0
    add_staff_text: str = "Add associates or approve overtime"
    flex_text: str = "Use flex pool / monitor schedule"
    overstaff_text: str = "Potential overstaffing - review schedule"
    balanced_text: str = "Staffing balanced"
