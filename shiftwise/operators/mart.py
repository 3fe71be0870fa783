"""Row-level workforce mart: forecast + standards + schedule -> 41 columns.

Four stages (base, labor, gap, scored) are chained projections that Catalyst
collapses into one codegen stage after the two joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftwise.config import MartConfig
from shiftwise.functions.columns import bool_to_int, greatest_or_null, safe_div

BASE_FORECAST = (
    "store", "dept", "week_date", "store_type", "store_size", "is_holiday",
    "actual_weekly_sales", "forecast_weekly_sales", "forecast_error", "abs_forecast_error",
    "forecast_variance_pct", "temperature", "fuel_price", "cpi", "unemployment",
    "markdown1", "markdown2", "markdown3", "markdown4", "markdown5",
)
BASE_STANDARDS = ("volume_tier", "target_sales_per_labor_hour")
BASE_SCHEDULE = (
    "scheduled_labor_hours", "scheduled_associates", "callout_rate", "flex_pool_hours",
    "avg_hourly_rate", "avg_weekly_hours_per_associate",
)
MART_COLUMNS = (
    "store", "dept", "week_date", "store_type", "store_size", "is_holiday",
    "actual_weekly_sales", "forecast_weekly_sales", "forecast_error", "abs_forecast_error",
    "forecast_variance_pct", "temperature", "fuel_price", "cpi", "unemployment",
    "markdown1", "markdown2", "markdown3", "markdown4", "markdown5",
    "volume_tier", "target_sales_per_labor_hour", "required_labor_hours", "required_associates",
    "scheduled_labor_hours", "scheduled_associates", "callout_rate", "available_labor_hours",
    "flex_pool_hours", "labor_gap_hours", "labor_gap_associates", "coverage_pct",
    "overtime_risk_hours", "overtime_risk_flag", "avg_hourly_rate", "estimated_overtime_cost",
    "productivity_sales_per_labor_hour", "productivity_to_target_pct", "site_readiness_score",
    "site_readiness_status", "recommendation",
)


def mart_base(forecast: DataFrame, standards: DataFrame, schedule: DataFrame) -> DataFrame:
    """forecast LEFT JOIN schedule ON (store, dept, date) LEFT JOIN standards ON dept.

    The schedule comes first, so that tables bucketed on its keys meet without a
    shuffle. The holiday flag is normalized to 1/0 as when the tables were loaded.
    """
    f = forecast.select(
        *[F.col(c) for c in ("store", "dept")],
        F.to_date("date").alias("week_date"),
        "store_type", "store_size", bool_to_int("is_holiday").alias("is_holiday"),
        *BASE_FORECAST[6:])
    ls = standards.select("dept", *BASE_STANDARDS)
    sch = schedule.select("store", "dept", F.to_date("date").alias("week_date"), *BASE_SCHEDULE)
    return (f.join(sch, ["store", "dept", "week_date"], "left")
            .join(ls, "dept", "left")
            .select(*BASE_FORECAST, *BASE_STANDARDS, *BASE_SCHEDULE))


def mart_labor(base: DataFrame) -> DataFrame:
    req = safe_div("forecast_weekly_sales", "target_sales_per_labor_hour")
    return base.withColumns({
        "required_labor_hours": req,
        "required_associates": F.ceil(safe_div(req, "avg_weekly_hours_per_associate")),
        "available_labor_hours": F.col("scheduled_labor_hours") * (F.lit(1) - F.col("callout_rate")),
    })


def mart_gap(labor: DataFrame, cfg: MartConfig = MartConfig()) -> DataFrame:
    gap = F.col("required_labor_hours") - F.col("available_labor_hours")
    overtime = greatest_or_null(gap - F.col("flex_pool_hours"), 0.0)
    productivity = safe_div("actual_weekly_sales", "available_labor_hours")
    return labor.withColumns({
        "labor_gap_hours": gap,
        "labor_gap_associates": F.ceil(safe_div(gap, "avg_weekly_hours_per_associate")),
        "coverage_pct": safe_div("available_labor_hours", "required_labor_hours"),
        "overtime_risk_hours": overtime,
        "estimated_overtime_cost": overtime * F.col("avg_hourly_rate") * F.lit(cfg.overtime_premium),
        "productivity_sales_per_labor_hour": productivity,
        "productivity_to_target_pct": safe_div(productivity, "target_sales_per_labor_hour"),
    })


def mart_scored(gap: DataFrame, cfg: MartConfig = MartConfig()) -> DataFrame:
    cap = F.lit(cfg.ratio_cap)
    err_share = F.coalesce(safe_div("abs_forecast_error", "actual_weekly_sales"), F.lit(1.0))
    return gap.withColumns({
        "coverage_score": F.least(F.coalesce("coverage_pct", F.lit(0.0)), cap) / cap
                          * F.lit(cfg.coverage_points),
        "forecast_accuracy_score": F.greatest(F.lit(0.0), F.lit(1.0) - F.least(err_share, F.lit(1.0)))
                                   * F.lit(cfg.accuracy_points),
        "productivity_score": F.least(F.coalesce("productivity_to_target_pct", F.lit(0.0)), cap) / cap
                              * F.lit(cfg.productivity_points),
        "holiday_risk_score": F.when(F.col("is_holiday") == 1, F.lit(cfg.holiday_points))
                              .otherwise(F.lit(cfg.regular_points)),
    })


def mart_final(scored: DataFrame, cfg: MartConfig = MartConfig()) -> DataFrame:
    total = (F.col("coverage_score") + F.col("forecast_accuracy_score")
             + F.col("productivity_score") + F.col("holiday_risk_score"))
    raw = F.least(F.lit(100.0), F.greatest(F.lit(0.0), total))
    gap = F.col("labor_gap_hours")
    df = scored.withColumn("__raw_score", raw).withColumns({
        "overtime_risk_flag": F.when(F.col("overtime_risk_hours") > 0, F.lit("At Risk"))
                              .otherwise(F.lit("Covered")),
        "site_readiness_score": F.round(F.col("__raw_score"), 1),
        # status from the unrounded score: 84.96 shows as 85.0 but is 'Watch'
        "site_readiness_status": F.when(F.col("__raw_score") >= cfg.ready_at, F.lit("Ready"))
                                 .when(F.col("__raw_score") >= cfg.watch_at, F.lit("Watch"))
                                 .otherwise(F.lit("At Risk")),
        "recommendation": F.when(gap >= cfg.add_staff_gap, F.lit(cfg.add_staff_text))
                          .when(gap >= cfg.flex_gap, F.lit(cfg.flex_text))
                          .when(gap <= cfg.overstaff_gap, F.lit(cfg.overstaff_text))
                          .otherwise(F.lit(cfg.balanced_text)),
    })
    return df.select(*MART_COLUMNS)


def workforce_mart(forecast: DataFrame, standards: DataFrame, schedule: DataFrame,
                   cfg: MartConfig = MartConfig()) -> DataFrame:
    base = mart_base(forecast, standards, schedule)
    return mart_final(mart_scored(mart_gap(mart_labor(base), cfg), cfg), cfg)
