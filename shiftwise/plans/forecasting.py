"""The forecast driver: a list of models, fitted or loaded, scored on one holdout.

With a ``store`` (a folder that all executors share) every fitted model is
saved there together with what it needs on new rows, the medians and the
category dictionary, and marked when complete; a later run loads what is
complete and fits only the rest, so a lost run does not fit again.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftwise.config import NUMERIC_FEATURES
from shiftwise.functions.columns import slug_text
from shiftwise.operators import boosting, evaluate, forecast, models
from shiftwise.plans.pipeline import Workspace

NAIVE = (forecast.SEASONAL_NAIVE, forecast.ROLLING_MEAN)
FITTED = (models.RIDGE, models.GBT)


@dataclass(frozen=True)
class ForecastRun:
    forecasts: DataFrame  # all models' rows, written
    metrics: DataFrame
    best: DataFrame  # the rows of the model with the lowest WAPE
    fitted: tuple  # models fitted in this run; the others were loaded or need no fit


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _mark(spark: SparkSession, path: str) -> None:
    spark.range(1).write.mode("overwrite").parquet(f"{path}.complete")


def _complete(spark: SparkSession, path: str) -> bool:
    return _exists(spark, f"{path}.complete/_SUCCESS")


class ModelStore:
    """Saved models of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{slug_text(name)}"

    def has(self, name: str) -> bool:
        return _complete(self.spark, self.path(name))

    def save(self, name: str, model, medians: dict, dictionary: DataFrame) -> None:
        path = self.path(name)
        if name == models.GBT:
            boosting.save_model(self.spark, model, f"{path}/trees")
        else:
            model.write().overwrite().save(f"{path}/pipeline")
        schema = ", ".join(f"{c} double" for c in medians)
        self.spark.createDataFrame([tuple(medians.values())], schema).write.mode("overwrite").parquet(f"{path}/medians")
        dictionary.write.mode("overwrite").parquet(f"{path}/categories")
        _mark(self.spark, path)

    def load(self, name: str):
        """(model, medians, dictionary)"""
        path = self.path(name)
        model = boosting.load_model(self.spark, f"{path}/trees") if name == models.GBT else PipelineModel.load(f"{path}/pipeline")
        return model, self.spark.read.parquet(f"{path}/medians").first().asDict(), self.spark.read.parquet(f"{path}/categories")


def scored(name: str, model, holdout: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Forecast rows of a fitted model over imputed holdout rows."""
    if name == models.GBT:
        return forecast.score_model(boosting.with_prediction(model, holdout, dictionary), name, "prediction")
    return models.forecast_with(model, holdout, name)


def _fit(name: str, ws: Workspace):
    if name == models.GBT:
        return models.fit_gbt(ws.prepared, ws.fcfg)
    return models.fit(models.ridge_pipeline(ws.prepared.train, ws.fcfg), ws.prepared.train, ws.fcfg)


def run_forecast(ws: Workspace, names=(*NAIVE, *FITTED), store: str | None = None) -> ForecastRun:
    """Forecast the holdout with each named model, compare them, and take the best.

    Unknown names fail before anything runs.
    """
    unknown = [n for n in names if n not in (*NAIVE, *FITTED)]
    if unknown or not names:
        raise ValueError(f"unknown models {unknown}" if unknown else "no model named")
    kept = ModelStore(ws.spark, store) if store else None
    parts, fitted = [], []
    naive = [n for n in names if n in NAIVE]
    if naive:
        parts.append(ws.naive_forecasts.where(F.col("model_name").isin(*naive)))
    for name in (n for n in FITTED if n in names):
        if kept and kept.has(name):
            model, medians, dictionary = kept.load(name)
            holdout = models.prepared_rows(ws.split.holdout, medians, NUMERIC_FEATURES)
        else:
            model, dictionary, holdout = _fit(name, ws), ws.prepared.dictionary, ws.prepared.holdout
            fitted.append(name)
            if kept:
                kept.save(name, model, ws.prepared.medians, dictionary)
        parts.append(scored(name, model, holdout, dictionary))
    forecasts = ws.written(reduce(DataFrame.unionByName, parts), "forecasts")
    metrics = evaluate.model_metrics(forecasts, ws.split.start)
    return ForecastRun(forecasts, metrics, evaluate.forecast_best(forecasts, metrics), tuple(fitted))
