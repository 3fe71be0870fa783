import datetime as dt

import numpy as np
import pytest

from shiftwise.operators.schedule import plan_schedule
from shiftwise.operators.standards import dept_stats, labor_standards, volume_cutoffs


def _sales_with_medians(spark, medians):
    rows = []
    for dept, m in enumerate(medians, start=1):
        for v in (m - 1.0, m, m + 1.0):  # median of three is m
            rows.append((1, dept, dt.date(2001, 1, 1), float(v)))
    return spark.createDataFrame(rows, "store int, dept int, date date, weekly_sales double")


def test_interpolated_cutoffs_and_tier_ties(spark):
    sales = _sales_with_medians(spark, list(range(1, 11)))
    cut = volume_cutoffs(dept_stats(sales)).first()
    assert cut.low_cutoff == pytest.approx(np.quantile(np.arange(1, 11), 0.33))  # 3.97
    assert cut.high_cutoff == pytest.approx(np.quantile(np.arange(1, 11), 0.66))  # 6.94
    got = {r.dept: (r.volume_tier, r.target_sales_per_labor_hour) for r in labor_standards(sales).collect()}
    assert got[3] == ("Low Volume", 700.0) and got[4] == ("Medium Volume", 950.0)
    assert got[6] == ("Medium Volume", 950.0) and got[7] == ("High Volume", 1250.0)
    assert sum(t == "High Volume" for t, _ in got.values()) == 4


def test_tier_tie_uses_greater_or_equal(spark):
    # medians [1,1,1,5,5,5]: q33 = 1.0 and q66 = 5.0 are hit exactly
    sales = _sales_with_medians(spark, [1, 1, 1, 5, 5, 5])
    got = {r.dept: r.volume_tier for r in labor_standards(sales).collect()}
    assert got[1] == "Medium Volume"  # equal to the low cut-off
    assert got[6] == "High Volume"  # equal to the high cut-off


def test_negative_sales_capped_before_median(spark):
    rows = [(1, 1, dt.date(2001, 1, 1), -100.0), (1, 1, dt.date(2001, 1, 8), 10.0)]
    sales = spark.createDataFrame(rows, "store int, dept int, date date, weekly_sales double")
    r = dept_stats(sales).first()
    assert (r.median_weekly_sales, r.avg_weekly_sales) == (5.0, 5.0)


def _forecast(spark, rows):
    return spark.createDataFrame(rows, "store int, dept int, date date, store_type string, "
                                       "is_holiday string, rolling_4_mean double, forecast_weekly_sales double")


def test_schedule_factor_maps_and_defaults(spark):
    d = dt.date(2001, 1, 1)
    f = _forecast(spark, [
        (1, 1, d, "A", "true", 1250.0, 0.0), (2, 1, d, "B", "false", 1250.0, 0.0),
        (3, 1, d, "C", "TRUE", 1250.0, 0.0), (4, 1, d, None, "1", 1250.0, 0.0),
        (5, 1, d, "Z", "x", None, 2500.0), (6, 2, d, "A", None, 1000.0, 0.0),
    ])
    std = spark.createDataFrame([(1, "High Volume", 1250.0)], "dept int, volume_tier string, target_sales_per_labor_hour double")
    out = {r.store: r for r in plan_schedule(f, std).collect()}
    assert out[1].scheduled_labor_hours == pytest.approx(0.98 * 1.06)
    assert out[1].callout_rate == 0.075 and out[1].avg_hourly_rate == 18.5
    assert out[2].scheduled_labor_hours == pytest.approx(0.95) and out[2].callout_rate == 0.045
    assert out[3].avg_hourly_rate == 16.75 and out[3].callout_rate == 0.075
    assert out[4].avg_hourly_rate == 17.5 and out[4].scheduled_labor_hours == pytest.approx(0.95 * 1.06)
    # rolling mean missing -> the forecast is the baseline; unknown type -> defaults
    assert out[5].scheduled_labor_hours == pytest.approx(2.0 * 0.95)
    assert out[5].scheduled_associates == 1 and out[5].flex_pool_hours == pytest.approx(0.095)
    # department without a standard -> NULL hours and associates, the row stays
    assert out[6].scheduled_labor_hours is None and out[6].scheduled_associates is None
    assert out[6].avg_weekly_hours_per_associate == 32
