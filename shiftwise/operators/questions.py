"""Business questions answered from the mart.

Top-k questions sort by the measure and then by their key columns, so ties
resolve the same way on every run; ``orderBy(...).limit(k)`` plans as a
TakeOrderedAndProject (per-partition top-k, then a k-row merge).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftwise.functions.columns import safe_div
from shiftwise.operators.rollups import AT_RISK_COLUMNS


def top_overtime_stores(mart: DataFrame, k: int = 10) -> DataFrame:
    return (mart.groupBy("store", "store_type")
            .agg(F.sum("overtime_risk_hours").alias("total_overtime_risk_hours"),
                 F.sum("estimated_overtime_cost").alias("total_estimated_overtime_cost"),
                 F.avg("site_readiness_score").alias("avg_site_readiness_score"))
            .orderBy(F.col("total_estimated_overtime_cost").desc_nulls_last(), "store", "store_type")
            .limit(k))


def top_at_risk_weeks(mart: DataFrame, k: int = 20) -> DataFrame:
    return (mart.where(F.col("overtime_risk_hours") > 0).select(*AT_RISK_COLUMNS)
            .orderBy(F.col("estimated_overtime_cost").desc_nulls_last(), "store", "dept", "week_date")
            .limit(k))


def dept_accuracy(forecast: DataFrame, k: int = 15, actual: str = "actual_weekly_sales") -> DataFrame:
    """Hardest departments to forecast. Reads only forecast columns, so it runs
    on the forecast table directly (the mart adds no rows: see validate_fanout)."""
    return (forecast.groupBy("dept")
            .agg(F.sum(actual).alias("actual_weekly_sales"),
                 F.sum("forecast_weekly_sales").alias("forecast_weekly_sales"),
                 F.sum("abs_forecast_error").alias("abs_forecast_error"),
                 safe_div(F.sum("abs_forecast_error"), F.sum(actual)).alias("wape"))
            .orderBy(F.col("wape").desc_nulls_last(), "dept")
            .limit(k))


WEEKLY_SUMS = ("required_labor_hours", "available_labor_hours", "labor_gap_hours",
               "overtime_risk_hours", "estimated_overtime_cost")


def weekly_trend(mart: DataFrame) -> DataFrame:
    return (mart.groupBy("week_date").agg(*[F.sum(c).alias(c) for c in WEEKLY_SUMS])
            .orderBy("week_date"))
