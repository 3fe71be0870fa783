import pytest

from shiftwise.config import ForecastConfig
from shiftwise.operators import models
from shiftwise.plans.forecasting import NAIVE, run_forecast
from shiftwise.plans.pipeline import Workspace

SF = "/root/testdata/sf0.01"
CFG = ForecastConfig(gbt_rounds=3, gbt_step=0.3, gbt_depth=3)


def rows(run):
    return sorted((r["model_name"], r["store"], r["dept"], r["date"], r["forecast_weekly_sales"]) for r in run.forecasts.collect())


def test_saved_models_are_loaded_and_forecast_the_same(spark, tmp_path):
    store = str(tmp_path / "models")
    first = run_forecast(Workspace(spark, SF, CFG), store=store)
    assert first.fitted == (models.RIDGE, models.GBT)
    second = run_forecast(Workspace(spark, SF, CFG), store=store)
    assert second.fitted == ()
    assert rows(first) == rows(second)
    assert {r["model_name"] for r in first.metrics.collect()} == {*NAIVE, models.RIDGE, models.GBT}
    best = min(first.metrics.collect(), key=lambda r: (r["wape"], r["model_name"]))["model_name"]
    assert {r["model_name"] for r in first.best.select("model_name").distinct().collect()} == {best}

    ws = Workspace(spark, SF, CFG)
    ws.plan_on(first.best)
    assert ws.mart.count() == first.best.count()


def test_only_the_named_models(spark):
    run = run_forecast(Workspace(spark, SF, CFG), ("Rolling Mean",))
    assert [r["model_name"] for r in run.metrics.collect()] == ["Rolling Mean"] and run.fitted == ()
    with pytest.raises(ValueError, match="unknown"):
        run_forecast(Workspace(spark, SF, CFG), ("Oracle",))
    with pytest.raises(ValueError, match="no model"):
        run_forecast(Workspace(spark, SF, CFG), ())
