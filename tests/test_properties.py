"""Cross-table identities on the derived data."""

import pytest
from pyspark.sql import functions as F

from shiftwise.operators import dashboard, questions, rollups
from shiftwise.plans.pipeline import Workspace

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ws(spark):
    return Workspace(spark, SF, persist=True)


def _sum(df, c):
    return df.agg(F.sum(c)).first()[0] or 0.0


def test_mart_rows_equal_forecast_rows(ws):
    assert ws.mart.count() == ws.mart_forecast.count()


def test_rollups_preserve_totals(ws):
    mart = ws.mart
    sw = rollups.store_week_summary(mart)
    acc = rollups.forecast_accuracy_summary(mart)
    trend = questions.weekly_trend(mart)
    for c in ("required_labor_hours", "labor_gap_hours", "estimated_overtime_cost"):
        assert _sum(sw, c) == pytest.approx(_sum(mart, c), rel=1e-9)
        assert _sum(trend, c) == pytest.approx(_sum(sw, c), rel=1e-9)
    assert _sum(acc, "abs_forecast_error") == pytest.approx(_sum(mart, "abs_forecast_error"), rel=1e-9)
    kpi = dashboard.kpi_overview(mart).first()
    assert kpi.row_count == mart.count()
    assert kpi.overtime_risk_hours == pytest.approx(_sum(mart, "overtime_risk_hours"), rel=1e-9)


def test_wape_identity(ws):
    # mae * rows / wape = total actual sales, the same for every model
    totals = {r.model_name: r.mae * r.holdout_rows / r.wape for r in ws.naive_metrics.collect()}
    actual = _sum(ws.mart_forecast, "actual_weekly_sales")
    for v in totals.values():
        assert v == pytest.approx(actual, rel=1e-9)


def test_readiness_mix_covers_all_rows(ws):
    mix = dashboard.readiness_mix(ws.mart).collect()
    assert sum(r.row_count for r in mix) == ws.mart.count()
    assert {r.site_readiness_status for r in mix} <= {"Ready", "Watch", "At Risk"}
