import os
import tempfile

from shiftwise.plans.export import export
from shiftwise.plans.pipeline import Workspace
from shiftwise.sources import files, schemas

SF = "/root/testdata/sf0.001"


def test_export_writes_every_output(spark):
    out = tempfile.mkdtemp(prefix="shiftwise-export-")
    ws = Workspace(spark, SF, persist=True)
    paths = export(ws, out)
    slugs = sorted(os.listdir(paths["forecast_by_model"]))
    assert [s for s in slugs if s.startswith("model_slug=")] == ["model_slug=rolling_mean",
                                                                 "model_slug=seasonal_naive"]
    mart = spark.read.parquet(paths["mart_workforce_dashboard"])
    assert len(mart.columns) == 41
    assert mart.count() == ws.mart_forecast.count()
    std = files.read_csv(spark, paths["labor_standards"], schemas.LABOR_STANDARDS)
    assert std.count() == ws.labor_standards.count()
    sch = files.read_csv(spark, paths["simulated_schedule"], schemas.SCHEDULE)
    assert sch.count() == mart.count()
    cmp_ = files.read_csv(spark, paths["model_comparison"], schemas.MODEL_COMPARISON).collect()
    assert len(cmp_) == 2 and cmp_[0].wape <= cmp_[1].wape
    doc = spark.read.json(paths["model_metrics_json"]).first()
    assert doc.best_model == cmp_[0].model_name
