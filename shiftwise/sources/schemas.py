"""Explicit schemas for the CSV inputs and the published tables.

CSV files are read with a declared schema (no inference pass over the data)
and ``NA`` as the missing-value marker.
"""

from pyspark.sql.types import (BooleanType, DateType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType)


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


SALES = _s(("Store", IntegerType()), ("Dept", IntegerType()), ("Date", DateType()),
           ("Weekly_Sales", DoubleType()), ("IsHoliday", BooleanType()))
FEATURES = _s(("Store", IntegerType()), ("Date", DateType()), ("Temperature", DoubleType()),
              ("Fuel_Price", DoubleType()), ("MarkDown1", DoubleType()), ("MarkDown2", DoubleType()),
              ("MarkDown3", DoubleType()), ("MarkDown4", DoubleType()), ("MarkDown5", DoubleType()),
              ("CPI", DoubleType()), ("Unemployment", DoubleType()), ("IsHoliday", BooleanType()))
STORES = _s(("Store", IntegerType()), ("Type", StringType()), ("Size", IntegerType()))
TEST = _s(("Store", IntegerType()), ("Dept", IntegerType()), ("Date", DateType()),
          ("IsHoliday", BooleanType()))
LABOR_STANDARDS = _s(("dept", IntegerType()), ("volume_tier", StringType()),
                     ("target_sales_per_labor_hour", DoubleType()))
SCHEDULE = _s(("store", IntegerType()), ("dept", IntegerType()), ("date", DateType()),
              ("scheduled_labor_hours", DoubleType()), ("scheduled_associates", LongType()),
              ("callout_rate", DoubleType()), ("flex_pool_hours", DoubleType()),
              ("avg_hourly_rate", DoubleType()), ("avg_weekly_hours_per_associate", IntegerType()))
MODEL_COMPARISON = _s(("model_name", StringType()), ("holdout_start", DateType()),
                      ("holdout_end", DateType()), ("holdout_rows", LongType()),
                      ("mae", DoubleType()), ("wape", DoubleType()))
FORECAST = _s(("model_name", StringType()), ("store", IntegerType()), ("dept", IntegerType()), ("date", DateType()),
              ("store_type", StringType()), ("store_size", IntegerType()), ("is_holiday", BooleanType()),
              ("actual_weekly_sales", DoubleType()), ("forecast_weekly_sales", DoubleType()),
              ("forecast_error", DoubleType()), ("abs_forecast_error", DoubleType()),
              ("forecast_variance_pct", DoubleType()), ("temperature", DoubleType()), ("fuel_price", DoubleType()),
              ("cpi", DoubleType()), ("unemployment", DoubleType()), ("markdown1", DoubleType()),
              ("markdown2", DoubleType()), ("markdown3", DoubleType()), ("markdown4", DoubleType()),
              ("markdown5", DoubleType()), ("rolling_4_mean", DoubleType()), ("rolling_13_mean", DoubleType()))
