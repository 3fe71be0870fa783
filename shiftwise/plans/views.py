"""The four published views, as persistent views of a schema over its loaded tables.

``CREATE OR REPLACE VIEW`` texts, resolved by name in any session that sees the
catalog. The mart's terms are named once, in the order they build on each
other; a term uses the names of those before it.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from shiftwise.config import MartConfig
from shiftwise.operators.mart import BASE_FORECAST, BASE_SCHEDULE, BASE_STANDARDS, MART_COLUMNS
from shiftwise.operators.rollups import AT_RISK_COLUMNS, STORE_WEEK_SUMS


def _over(x: str, y: str) -> str:
    return f"{x} / NULLIF({y}, 0)"


def mart_terms(cfg: MartConfig = MartConfig()) -> dict[str, str]:
    """Term -> Spark SQL. A missing input stays missing up to the scores, where it counts as none."""
    cap = f"{cfg.ratio_cap}D"
    # the gap is missing wherever an input is: GREATEST would skip it
    return {
        "required_labor_hours": _over("forecast_weekly_sales", "target_sales_per_labor_hour"),
        "required_associates": f"CEIL({_over('required_labor_hours', 'avg_weekly_hours_per_associate')})",
        "available_labor_hours": "scheduled_labor_hours * (1 - callout_rate)",
        "labor_gap_hours": "required_labor_hours - available_labor_hours",
        "labor_gap_associates": f"CEIL({_over('labor_gap_hours', 'avg_weekly_hours_per_associate')})",
        "coverage_pct": _over("available_labor_hours", "required_labor_hours"),
        "overtime_risk_hours": "IF(labor_gap_hours - flex_pool_hours IS NOT NULL, GREATEST(labor_gap_hours - flex_pool_hours, 0D), NULL)",
        "overtime_risk_flag": "IF(overtime_risk_hours > 0, 'At Risk', 'Covered')",
        "estimated_overtime_cost": f"overtime_risk_hours * avg_hourly_rate * {cfg.overtime_premium}D",
        "productivity_sales_per_labor_hour": _over("actual_weekly_sales", "available_labor_hours"),
        "productivity_to_target_pct": _over("productivity_sales_per_labor_hour", "target_sales_per_labor_hour"),
        "coverage_score": f"LEAST(COALESCE(coverage_pct, 0D), {cap}) / {cap} * {cfg.coverage_points}D",
        "miss": f"COALESCE({_over('abs_forecast_error', 'actual_weekly_sales')}, 1D)",
        "forecast_accuracy_score": f"GREATEST(0D, 1D - LEAST(miss, 1D)) * {cfg.accuracy_points}D",
        "productivity_score": f"LEAST(COALESCE(productivity_to_target_pct, 0D), {cap}) / {cap} * {cfg.productivity_points}D",
        "holiday_risk_score": f"IF(is_holiday = 1, {cfg.holiday_points}, {cfg.regular_points})",
        "points": "LEAST(100D, GREATEST(0D, coverage_score + forecast_accuracy_score + productivity_score + holiday_risk_score))",
        "site_readiness_score": "ROUND(points, 1)",
        "site_readiness_status": f"CASE WHEN points >= {cfg.ready_at} THEN 'Ready' WHEN points >= {cfg.watch_at} THEN 'Watch' ELSE 'At Risk' END",
        "recommendation": f"CASE WHEN labor_gap_hours >= {cfg.add_staff_gap} THEN '{cfg.add_staff_text}' "
                          f"WHEN labor_gap_hours >= {cfg.flex_gap} THEN '{cfg.flex_text}' "
                          f"WHEN labor_gap_hours <= {cfg.overstaff_gap} THEN '{cfg.overstaff_text}' ELSE '{cfg.balanced_text}' END",
    }


def view_texts(database: str, cfg: MartConfig = MartConfig()) -> dict[str, str]:
    """View name -> SELECT, in the order they have to be created."""
    at = f"`{database}`"
    forecast = ", ".join("CAST(f.date AS DATE) AS week_date" if c == "week_date" else f"f.{c}" for c in BASE_FORECAST)
    brought = ", ".join([*(f"s.{c}" for c in BASE_STANDARDS), *(f"h.{c}" for c in BASE_SCHEDULE)])
    terms = ", ".join(f"{expr} AS {name}" for name, expr in mart_terms(cfg).items())
    mart = f"{at}.`mart_workforce_dashboard`"
    base = (f"SELECT {forecast}, {brought} FROM {at}.analytics_forecast_output f "
            f"LEFT JOIN {at}.analytics_labor_standards s ON f.dept = s.dept "
            f"LEFT JOIN {at}.analytics_simulated_schedule h ON f.store = h.store AND f.dept = h.dept "
            "AND CAST(f.date AS DATE) = CAST(h.date AS DATE)")
    sums = ", ".join(f"SUM({c}) AS {c}" for c in STORE_WEEK_SUMS)
    return {
        "mart_workforce_dashboard": f"SELECT {', '.join(MART_COLUMNS)} FROM (SELECT *, {terms} FROM ({base}))",
        "mart_store_week_summary":
            f"SELECT week_date, store, store_type, {sums}, AVG(coverage_pct) AS avg_coverage_pct, "
            "AVG(site_readiness_score) AS avg_site_readiness_score, "
            f"COUNT_IF(overtime_risk_flag = 'At Risk') AS at_risk_dept_count FROM {mart} GROUP BY week_date, store, store_type",
        "mart_forecast_accuracy_summary":
            "SELECT store, dept, store_type, SUM(actual_weekly_sales) AS actual_weekly_sales, "
            "SUM(forecast_weekly_sales) AS forecast_weekly_sales, SUM(abs_forecast_error) AS abs_forecast_error, "
            f"{_over('SUM(abs_forecast_error)', 'SUM(actual_weekly_sales)')} AS wape, "
            f"{_over('SUM(forecast_error)', 'SUM(actual_weekly_sales)')} AS forecast_bias_pct "
            f"FROM {mart} GROUP BY store, dept, store_type",
        "mart_top_at_risk_store_depts":
            f"SELECT {', '.join(AT_RISK_COLUMNS)} FROM {mart} WHERE overtime_risk_hours > 0 "
            "ORDER BY estimated_overtime_cost DESC, store, dept, week_date",
    }


def create_views(spark: SparkSession, database: str, cfg: MartConfig = MartConfig()) -> list[str]:
    texts = view_texts(database, cfg)
    for name, text in texts.items():
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS {text}")
    return list(texts)


def drop_views(spark: SparkSession, database: str) -> None:
    """The dependent views first."""
    for name in reversed(list(view_texts(database))):
        spark.sql(f"DROP VIEW IF EXISTS `{database}`.`{name}`")
