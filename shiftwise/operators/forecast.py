"""Forecast tables: naive baselines, error columns and the export projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftwise.functions.columns import cap_at_zero

SEASONAL_NAIVE = "Seasonal Naive"
ROLLING_MEAN = "Rolling Mean"

# Export projection: (source column, output column), in output order.
FORECAST_COLUMNS = (
    ("model_name", "model_name"),
    ("store", "store"),
    ("dept", "dept"),
    ("date", "date"),
    ("type", "store_type"),
    ("size", "store_size"),
    ("is_holiday", "is_holiday"),
    ("weekly_sales", "actual_weekly_sales"),
    ("forecast_weekly_sales", "forecast_weekly_sales"),
    ("forecast_error", "forecast_error"),
    ("abs_forecast_error", "abs_forecast_error"),
    ("forecast_variance_pct", "forecast_variance_pct"),
    ("temperature", "temperature"),
    ("fuel_price", "fuel_price"),
    ("cpi", "cpi"),
    ("unemployment", "unemployment"),
    ("markdown1", "markdown1"),
    ("markdown2", "markdown2"),
    ("markdown3", "markdown3"),
    ("markdown4", "markdown4"),
    ("markdown5", "markdown5"),
    ("rolling_4_mean", "rolling_4_mean"),
    ("rolling_13_mean", "rolling_13_mean"),
)


def with_forecast(holdout: DataFrame, model_name: str, prediction) -> DataFrame:
    """Attach a model's prediction, capped at zero (demand cannot be negative)."""
    pred = F.col(prediction) if isinstance(prediction, str) else prediction
    return holdout.withColumns({
        "model_name": F.lit(model_name),
        "forecast_weekly_sales": cap_at_zero(pred.cast("double")),
    })


def add_error_columns(df: DataFrame, actual: str = "weekly_sales",
                      forecast: str = "forecast_weekly_sales") -> DataFrame:
    err = F.col(actual) - F.col(forecast)
    return df.withColumn("forecast_error", err).withColumns({
        "abs_forecast_error": F.abs(F.col("forecast_error")),
        "forecast_variance_pct": F.when(F.col(forecast) > 0,
                                        F.col("forecast_error") / F.col(forecast)),
    })


def clean_forecast_output(df: DataFrame) -> DataFrame:
    """Project and rename to the 23-column forecast table."""
    return df.select(*[F.col(src).alias(dst) for src, dst in FORECAST_COLUMNS])


def score_model(holdout: DataFrame, model_name: str, prediction) -> DataFrame:
    return clean_forecast_output(add_error_columns(with_forecast(holdout, model_name, prediction)))


def naive_forecasts(holdout: DataFrame) -> DataFrame:
    """Two SQL-expressible baselines: one pass over the holdout, a row per model."""
    both = F.inline(F.array(
        F.struct(F.lit(SEASONAL_NAIVE).alias("_model"), F.col("lag_52").cast("double").alias("_raw")),
        F.struct(F.lit(ROLLING_MEAN).alias("_model"), F.col("rolling_4_mean").cast("double").alias("_raw"))))
    rows = holdout.select("*", both).withColumnsRenamed({"_model": "model_name"})
    rows = rows.withColumn("forecast_weekly_sales", cap_at_zero("_raw")).drop("_raw")
    return clean_forecast_output(add_error_columns(rows))
