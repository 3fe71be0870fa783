"""Run the whole pipeline and write every output table.

    python -m shiftwise.plans.export --input /root/testdata/sf0.1 --output <folder> [--models naive|all]

Writes, under the output folder (Parquet unless noted):
  forecast_by_model/model_slug=<slug>/  one folder per model (CSV)
  forecast_all_models/, forecast_best/, model_comparison/ (CSV), model_metrics/ (CSV),
  model_metrics_json/ (JSON), labor_standards/ (CSV), simulated_schedule/ (CSV),
  mart_workforce_dashboard/, mart_store_week_summary/, mart_forecast_accuracy_summary/,
  mart_top_at_risk_store_depts/
Each write is one distributed job; nothing passes through the driver.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from shiftwise.operators import evaluate, rollups
from shiftwise.operators.mart import workforce_mart
from shiftwise.operators.schedule import plan_schedule
from shiftwise.plans.pipeline import Workspace
from shiftwise.sources import files


def export(ws: Workspace, out: str, models: str = "naive") -> dict[str, str]:
    """Write all outputs of ``ws``. The labor plan (schedule, mart, rollups) is
    built on the forecast of the model with the lowest holdout WAPE;
    ``models='all'`` adds the MLlib models to the candidates."""
    if models == "all":
        forecasts = ws.naive_forecasts.unionByName(ws.model_forecasts)
    else:
        forecasts = ws.naive_forecasts
    p = {name: os.path.join(out, name) for name in (
        "forecast_by_model", "forecast_all_models", "forecast_best", "model_comparison",
        "model_metrics", "model_metrics_json", "labor_standards", "simulated_schedule",
        "mart_workforce_dashboard", "mart_store_week_summary", "mart_forecast_accuracy_summary",
        "mart_top_at_risk_store_depts")}
    spark = ws.spark
    files.write_table(forecasts, p["forecast_all_models"])
    forecasts = spark.read.parquet(p["forecast_all_models"])  # computed once, read by all below
    metrics = evaluate.model_metrics(forecasts, ws.split.start)
    best = evaluate.forecast_best(forecasts, metrics)
    files.write_per_model(forecasts, p["forecast_by_model"], fmt="csv")
    files.write_table(best, p["forecast_best"])
    best = spark.read.parquet(p["forecast_best"])  # later writes start from the written table
    files.write_csv(evaluate.model_comparison(metrics).coalesce(1), p["model_comparison"])
    files.write_csv(evaluate.model_comparison(metrics).coalesce(1), p["model_metrics"])
    files.write_json(evaluate.metrics_struct(metrics).coalesce(1), p["model_metrics_json"])
    schedule = plan_schedule(best, ws.labor_standards, ws.lcfg)
    mart = workforce_mart(best, ws.labor_standards, schedule, ws.mcfg)
    files.write_csv(ws.labor_standards, p["labor_standards"])
    files.write_csv(schedule, p["simulated_schedule"])
    files.write_table(mart, p["mart_workforce_dashboard"])
    mart = spark.read.parquet(p["mart_workforce_dashboard"])
    files.write_table(rollups.store_week_summary(mart), p["mart_store_week_summary"])
    files.write_table(rollups.forecast_accuracy_summary(mart), p["mart_forecast_accuracy_summary"])
    files.write_table(rollups.top_at_risk(mart), p["mart_top_at_risk_store_depts"])
    return p


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--input", required=True)
    ap.add_argument("--output", required=True)
    ap.add_argument("--models", choices=("naive", "all"), default="naive")
    args = ap.parse_args(argv)
    from shiftwise.session import get_session

    spark = SparkSession.getActiveSession() or get_session()
    ws = Workspace(spark, args.input, persist=True)
    for name, path in export(ws, args.output, args.models).items():
        print(f"{name}: {path}")
    ws.release()


if __name__ == "__main__":
    main()
