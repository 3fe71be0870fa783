"""Holdout metrics, model choice and the metrics document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftwise.functions.columns import safe_div

METRIC_COLUMNS = ("model_name", "holdout_start", "holdout_end", "holdout_rows", "mae", "wape")


def model_metrics(forecasts: DataFrame, holdout_start: Column,
                  actual: str = "actual_weekly_sales") -> DataFrame:
    """One row per model: MAE = mean |error|, WAPE = sum |error| / sum actual.

    A single grouped aggregate over all stacked forecasts (partial aggregation
    per partition), instead of one pass per model.
    """
    return (forecasts.groupBy("model_name")
            .agg(F.max("date").alias("holdout_end"),
                 F.count(F.lit(1)).alias("holdout_rows"),
                 F.avg("abs_forecast_error").alias("mae"),
                 safe_div(F.sum("abs_forecast_error"), F.sum(actual)).alias("wape"))
            .withColumn("holdout_start", holdout_start)
            .select(*METRIC_COLUMNS))


def _rank_key() -> Column:
    # lowest WAPE first, missing WAPE last, model name breaks ties
    return F.struct(F.col("wape").isNull(), F.col("wape"), F.col("model_name"))


def best_model(metrics: DataFrame) -> DataFrame:
    """Exactly one row: the model with the lowest WAPE."""
    return metrics.agg(F.min_by("model_name", _rank_key()).alias("best_model"))


def model_comparison(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy(F.col("wape").asc_nulls_last(), "model_name")


def forecast_best(forecasts: DataFrame, metrics: DataFrame) -> DataFrame:
    """Forecast rows of the winning model (semi join against a one-row table)."""
    best = best_model(metrics).select(F.col("best_model").alias("model_name"))
    return forecasts.join(F.broadcast(best), "model_name", "left_semi")


def metrics_struct(metrics: DataFrame) -> DataFrame:
    """One row ``(best_model, models: array<struct>)``, models by WAPE.

    The array holds one element per model (a handful), so the single row is
    bounded by the number of models, not by data size.
    """
    ordered = F.array_sort(F.collect_list(F.struct(
        F.col("wape").isNull().alias("_missing"), "wape", "model_name", "holdout_start",
        "holdout_end", "holdout_rows", "mae")))
    models = F.transform(ordered, lambda m: F.struct(
        m["model_name"].alias("model_name"),
        F.date_format(m["holdout_start"], "yyyy-MM-dd").alias("holdout_start"),
        F.date_format(m["holdout_end"], "yyyy-MM-dd").alias("holdout_end"),
        m["holdout_rows"].alias("holdout_rows"), m["mae"].alias("mae"), m["wape"].alias("wape")))
    return metrics.agg(F.min_by("model_name", _rank_key()).alias("best_model"),
                       models.alias("models"))


def metrics_document(metrics: DataFrame) -> DataFrame:
    """The same document as one JSON string."""
    doc = metrics_struct(metrics)
    return doc.select(F.to_json(F.struct("best_model", "models")).alias("metrics_json"))
