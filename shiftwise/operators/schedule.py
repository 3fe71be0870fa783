"""Rule-based weekly labor schedule per store x dept x week."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftwise.config import LaborConfig
from shiftwise.functions.columns import cap_at_zero, is_truthy, map_with_default, safe_div

SCHEDULE_COLUMNS = (
    "store", "dept", "date", "scheduled_labor_hours", "scheduled_associates", "callout_rate",
    "flex_pool_hours", "avg_hourly_rate", "avg_weekly_hours_per_associate",
)


def plan_schedule(forecast: DataFrame, standards: DataFrame,
                  cfg: LaborConfig = LaborConfig(), keep_all: bool = False) -> DataFrame:
    """forecast LEFT JOIN standards ON dept, then the planning rules.

    The standards side has one row per department; the planner broadcasts it
    once AQE has measured it, otherwise both sides shuffle on dept.
    """
    df = forecast.join(standards, "dept", "left")
    holiday = is_truthy("is_holiday")
    df = df.withColumns({
        "planning_coverage_factor": map_with_default("store_type", cfg.coverage_by_type,
                                                     cfg.coverage_default),
        "holiday_schedule_factor": F.when(holiday, F.lit(cfg.holiday_factor))
                                    .otherwise(F.lit(cfg.regular_factor)),
        "schedule_baseline_sales": F.coalesce("rolling_4_mean", "forecast_weekly_sales"),
    })
    hours = (safe_div("schedule_baseline_sales", "target_sales_per_labor_hour")
             * F.col("planning_coverage_factor") * F.col("holiday_schedule_factor"))
    df = df.withColumn("scheduled_labor_hours", cap_at_zero(hours))
    df = df.withColumns({
        "scheduled_associates": F.ceil(F.col("scheduled_labor_hours")
                                       / F.lit(cfg.weekly_hours_per_associate)),
        "callout_rate": F.when(holiday, F.lit(cfg.holiday_callout))
                         .otherwise(F.lit(cfg.regular_callout)),
        "flex_pool_hours": F.col("scheduled_labor_hours") * F.lit(cfg.flex_share),
        "avg_hourly_rate": map_with_default("store_type", cfg.wage_by_type, cfg.wage_default),
        "avg_weekly_hours_per_associate": F.lit(cfg.weekly_hours_per_associate),
    })
    return df if keep_all else df.select(*SCHEDULE_COLUMNS)
