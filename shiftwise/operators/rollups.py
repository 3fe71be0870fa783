"""Mart rollups: store-week summary, forecast accuracy, at-risk rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftwise.functions.columns import safe_div

AT_RISK_COLUMNS = (
    "week_date", "store", "dept", "store_type", "forecast_weekly_sales", "required_labor_hours",
    "available_labor_hours", "labor_gap_hours", "overtime_risk_hours", "estimated_overtime_cost",
    "site_readiness_score", "recommendation",
)


STORE_WEEK_SUMS = ("actual_weekly_sales", "forecast_weekly_sales", "required_labor_hours",
                   "scheduled_labor_hours", "available_labor_hours", "labor_gap_hours",
                   "overtime_risk_hours", "estimated_overtime_cost")


def store_week_summary(mart: DataFrame) -> DataFrame:
    return mart.groupBy("week_date", "store", "store_type").agg(
        *[F.sum(c).alias(c) for c in STORE_WEEK_SUMS],
        F.avg("coverage_pct").alias("avg_coverage_pct"),
        F.avg("site_readiness_score").alias("avg_site_readiness_score"),
        F.sum(F.when(F.col("overtime_risk_flag") == "At Risk", F.lit(1)).otherwise(F.lit(0)))
        .alias("at_risk_dept_count"))


def forecast_accuracy_summary(mart: DataFrame) -> DataFrame:
    return mart.groupBy("store", "dept", "store_type").agg(
        F.sum("actual_weekly_sales").alias("actual_weekly_sales"),
        F.sum("forecast_weekly_sales").alias("forecast_weekly_sales"),
        F.sum("abs_forecast_error").alias("abs_forecast_error"),
        safe_div(F.sum("abs_forecast_error"), F.sum("actual_weekly_sales")).alias("wape"),
        safe_div(F.sum("forecast_error"), F.sum("actual_weekly_sales")).alias("forecast_bias_pct"))


def top_at_risk(mart: DataFrame, k: int | None = None) -> DataFrame:
    """Rows with overtime risk by estimated cost, highest first (keys break ties)."""
    df = (mart.where(F.col("overtime_risk_hours") > 0).select(*AT_RISK_COLUMNS)
          .orderBy(F.desc("estimated_overtime_cost"), "store", "dept", "week_date"))
    return df.limit(k) if k else df
