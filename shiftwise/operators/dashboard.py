"""Datasets behind the workforce dashboard (KPI row, trends, heatmap, drill-down)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftwise.functions.columns import safe_div


def _kpis():
    return [
        F.count(F.lit(1)).alias("row_count"),
        F.sum("actual_weekly_sales").alias("actual_weekly_sales"),
        F.sum("forecast_weekly_sales").alias("forecast_weekly_sales"),
        safe_div(F.sum("abs_forecast_error"), F.sum("actual_weekly_sales")).alias("wape"),
        F.sum("required_labor_hours").alias("required_labor_hours"),
        F.sum("available_labor_hours").alias("available_labor_hours"),
        F.sum("labor_gap_hours").alias("labor_gap_hours"),
        F.sum("overtime_risk_hours").alias("overtime_risk_hours"),
        F.sum("estimated_overtime_cost").alias("estimated_overtime_cost"),
        F.avg("site_readiness_score").alias("avg_site_readiness_score"),
    ]


def kpi_overview(mart: DataFrame) -> DataFrame:
    """Executive KPI row: one global aggregate (partial per task, one final row)."""
    return mart.agg(*_kpis())


def _meets(filters: dict) -> Column:
    cond = F.lit(True)
    for name, value in filters.items():
        values = list(value) if isinstance(value, (list, tuple, set, frozenset)) else [value]
        cond = cond & F.col(name).isin(*values)
    return cond


def drilldown(mart: DataFrame, **filters) -> DataFrame:
    """Keep rows whose column values are in the given lists (or equal a scalar).

    ``drilldown(mart, store_type=["A"], site_readiness_status=["Watch", "At Risk"])``
    """
    return mart.where(_meets(filters))


def kpi_drilldown(mart: DataFrame, **filters) -> DataFrame:
    return kpi_overview(drilldown(mart, **filters))


def drilldown_report(mart: DataFrame, selections: dict[str, dict]) -> DataFrame:
    """The KPI row of each named selection of filters, all in one pass over the mart.

    A row counts in every selection that it meets; a selection that no row meets has no row.
    """
    names = [F.when(_meets(filters), F.lit(name)) for name, filters in selections.items()]
    met = mart.withColumn("selection", F.explode(F.array_compact(F.array(*names))))
    return met.groupBy("selection").agg(*_kpis())


def sales_trend(mart: DataFrame) -> DataFrame:
    return (mart.groupBy("week_date").agg(
        F.sum("actual_weekly_sales").alias("actual_weekly_sales"),
        F.sum("forecast_weekly_sales").alias("forecast_weekly_sales"),
        F.sum("forecast_error").alias("forecast_error"),
        safe_div(F.sum("abs_forecast_error"), F.sum("actual_weekly_sales")).alias("wape"),
        safe_div(F.sum("forecast_error"), F.sum("forecast_weekly_sales")).alias("variance_pct"))
        .orderBy("week_date"))


def labor_gap_heatmap(mart: DataFrame) -> DataFrame:
    """Long form: one cell per (store, dept)."""
    return mart.groupBy("store", "dept").agg(
        F.sum("labor_gap_hours").alias("labor_gap_hours"),
        F.sum("overtime_risk_hours").alias("overtime_risk_hours"))


def labor_gap_heatmap_wide(mart: DataFrame, depts: list | None = None) -> DataFrame:
    """Wide form: one row per store, one column per department.

    Pass ``depts`` to skip the extra job Spark runs to find the pivot values.
    """
    g = mart.groupBy("store")
    g = g.pivot("dept", depts) if depts is not None else g.pivot("dept")
    return g.agg(F.sum("labor_gap_hours"))


def labor_plan_by_recommendation(mart: DataFrame) -> DataFrame:
    return mart.groupBy("recommendation").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("required_labor_hours").alias("required_labor_hours"),
        F.sum("available_labor_hours").alias("available_labor_hours"),
        F.sum("labor_gap_hours").alias("labor_gap_hours"),
        F.sum("overtime_risk_hours").alias("overtime_risk_hours"),
        F.sum("estimated_overtime_cost").alias("estimated_overtime_cost"))


def holiday_effect(mart: DataFrame) -> DataFrame:
    at_risk = F.when(F.col("overtime_risk_flag") == "At Risk", F.lit(1)).otherwise(F.lit(0))
    return mart.groupBy("is_holiday").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.avg("forecast_weekly_sales").alias("avg_forecast_weekly_sales"),
        F.avg("required_labor_hours").alias("avg_required_labor_hours"),
        F.avg("labor_gap_hours").alias("avg_labor_gap_hours"),
        F.sum("overtime_risk_hours").alias("overtime_risk_hours"),
        F.sum(at_risk).alias("at_risk_rows"),
        F.avg("site_readiness_score").alias("avg_site_readiness_score"))


def lowest_readiness(mart: DataFrame, k: int = 10) -> DataFrame:
    return (mart.groupBy("store", "store_type")
            .agg(F.avg("site_readiness_score").alias("avg_site_readiness_score"),
                 F.count(F.lit(1)).alias("row_count"))
            .orderBy(F.col("avg_site_readiness_score").asc_nulls_last(), "store")
            .limit(k))


def largest_gaps(mart: DataFrame, k: int = 20) -> DataFrame:
    return (mart.select("week_date", "store", "dept", "store_type", "required_labor_hours",
                        "available_labor_hours", "labor_gap_hours", "recommendation")
            .orderBy(F.col("labor_gap_hours").desc_nulls_last(), "store", "dept", "week_date")
            .limit(k))


def readiness_mix(mart: DataFrame) -> DataFrame:
    return mart.groupBy("site_readiness_status").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.avg("site_readiness_score").alias("avg_site_readiness_score"))
