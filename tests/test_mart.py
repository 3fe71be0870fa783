import datetime as dt

import pytest

from shiftwise.operators import mart as m
from shiftwise.operators.validate import fanout_check, unmatched_rows

D = dt.date(2001, 1, 1)
FCOLS = ("store int, dept int, date date, store_type string, store_size int, is_holiday boolean, "
         "actual_weekly_sales double, forecast_weekly_sales double, forecast_error double, "
         "abs_forecast_error double, forecast_variance_pct double, temperature double, fuel_price double, "
         "cpi double, unemployment double, markdown1 double, markdown2 double, markdown3 double, "
         "markdown4 double, markdown5 double")


def _f(store, dept, actual, forecast, hol=False):
    err = actual - forecast
    return (store, dept, D, "A", 1, hol, actual, forecast, err, abs(err), None,
            1.0, 1.0, 1.0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0)


def _schedule(spark, rows):
    return spark.createDataFrame(rows, "store int, dept int, date date, scheduled_labor_hours double, "
                                       "scheduled_associates bigint, callout_rate double, flex_pool_hours double, "
                                       "avg_hourly_rate double, avg_weekly_hours_per_associate int")


def test_mart_null_paths_and_divisions(spark):
    f = spark.createDataFrame([
        _f(1, 1, 1000.0, 1000.0),      # regular row
        _f(2, 9, 1000.0, 1000.0),      # dept without standard
        _f(3, 1, 1000.0, 1000.0),      # row without schedule
        _f(4, 2, 1000.0, 1000.0),      # target 0
        _f(5, 1, 0.0, 1000.0),         # actual 0
        _f(6, 1, 1000.0, 0.0, True),   # forecast 0, holiday
    ], FCOLS)
    std = spark.createDataFrame([(1, "High Volume", 100.0), (2, "Low Volume", 0.0)],
                                "dept int, volume_tier string, target_sales_per_labor_hour double")
    sch = _schedule(spark, [(s, d, D, 10.0, 1, 0.0, 0.5, 20.0, 32) for s, d in [(1, 1), (2, 9), (4, 2), (5, 1), (6, 1)]])
    out = {r.store: r for r in m.workforce_mart(f, std, sch).collect()}
    assert len(m.MART_COLUMNS) == 41 and len(out[1]) == 41
    r = out[1]
    assert r.required_labor_hours == 10.0 and r.available_labor_hours == 10.0 and r.labor_gap_hours == 0.0
    assert r.overtime_risk_hours == 0.0 and r.overtime_risk_flag == "Covered"
    assert r.recommendation == "Staffing balanced"
    # missing standard: NULL requirement, ELSE branches, coverage scored 0
    r = out[2]
    assert r.required_labor_hours is None and r.overtime_risk_hours is None
    assert r.overtime_risk_flag == "Covered" and r.recommendation == "Staffing balanced"
    # missing schedule: NULL available hours, NULL overtime (not 0)
    r = out[3]
    assert r.available_labor_hours is None and r.overtime_risk_hours is None and r.estimated_overtime_cost is None
    # target 0 -> NULL instead of an error
    assert out[4].required_labor_hours is None and out[4].productivity_to_target_pct is None
    # actual 0 -> accuracy share defaults to 1 -> 0 points
    assert out[5].productivity_sales_per_labor_hour == 0.0
    # forecast 0 on a holiday week
    r = out[6]
    assert r.required_labor_hours == 0.0 and r.coverage_pct is None and r.is_holiday == 1


def _scored(spark, rows):
    cols = ", ".join(f"{c} double" for c in ("coverage_score", "forecast_accuracy_score", "productivity_score"))
    base = spark.createDataFrame(rows, f"k int, {cols}, holiday_risk_score int, labor_gap_hours double, "
                                       "overtime_risk_hours double")
    fill = {c: None for c in m.MART_COLUMNS if c not in base.columns}
    from pyspark.sql import functions as F
    return base.withColumns({c: F.lit(v) for c, v in fill.items()}).withColumn("store", F.col("k"))


def test_status_from_unrounded_score_and_gap_thresholds(spark):
    rows = [
        (1, 40.0, 19.96, 0.0, 10, 24.0, 1.0),    # raw 69.96 -> 70.0 shown, At Risk
        (2, 40.0, 20.0, 0.0, 10, 8.0, 0.0),      # raw 70 -> Watch
        (3, 40.0, 25.0, 9.96, 10, -24.0, 0.0),   # raw 84.96 -> 85.0 shown, Watch
        (4, 40.0, 25.0, 10.0, 10, 7.99, 0.0),    # raw 85 -> Ready
        (5, 40.0, 25.0, 25.0, 10, 23.99, None),  # raw 100 clamp
    ]
    out = {r.store: r for r in m.mart_final(_scored(spark, rows)).collect()}
    assert (out[1].site_readiness_score, out[1].site_readiness_status) == (70.0, "At Risk")
    assert out[2].site_readiness_status == "Watch"
    assert (out[3].site_readiness_score, out[3].site_readiness_status) == (85.0, "Watch")
    assert out[4].site_readiness_status == "Ready"
    assert out[5].site_readiness_score == 100.0
    assert out[1].recommendation == "Add associates or approve overtime"
    assert out[2].recommendation == "Use flex pool / monitor schedule"
    assert out[3].recommendation == "Potential overstaffing - review schedule"
    assert out[4].recommendation == "Staffing balanced"
    assert out[5].recommendation == "Use flex pool / monitor schedule"
    assert out[1].overtime_risk_flag == "At Risk" and out[5].overtime_risk_flag == "Covered"


def test_fanout_check_finds_duplicate_standard(spark):
    f = spark.createDataFrame([_f(1, 1, 10.0, 10.0)], FCOLS)
    std = spark.createDataFrame([(1, "High Volume", 100.0), (1, "Low Volume", 50.0)],
                                "dept int, volume_tier string, target_sales_per_labor_hour double")
    sch = _schedule(spark, [(1, 1, D, 10.0, 1, 0.0, 0.5, 20.0, 32)])
    mart = m.workforce_mart(f, std, sch)
    checks = {r.check_name: r.value for r in fanout_check(f, std, sch, mart).collect()}
    assert checks["standards_duplicate_depts"] == 1
    assert checks["forecast_rows"] == 1 and checks["mart_rows"] == 2  # the fan-out is visible
    u = unmatched_rows(mart).first()
    assert u.mart_rows == 2 and u.rows_without_standard == 0
