"""Validation: row counts, sample rows, join fan-out and unmatched rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for every table; one aggregate per table, unioned
    into a single job."""
    parts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def sample_rows(mart: DataFrame, n: int = 20) -> DataFrame:
    """The first rows by key, so that reruns agree."""
    return mart.orderBy("store", "dept", "week_date").limit(n)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).count().where(F.col("count") > 1)


def fanout_check(forecast: DataFrame, standards: DataFrame, schedule: DataFrame,
                 mart: DataFrame) -> DataFrame:
    """Duplicate join keys on the lookup sides and the row balance of the mart."""
    dup_std = duplicate_keys(standards, ["dept"]).agg(F.count(F.lit(1)).alias("n"))
    dup_sch = duplicate_keys(schedule, ["store", "dept", "date"]).agg(F.count(F.lit(1)).alias("n"))
    return (dup_std.select(F.lit("standards_duplicate_depts").alias("check_name"), F.col("n").alias("value"))
            .unionByName(dup_sch.select(F.lit("schedule_duplicate_keys").alias("check_name"),
                                        F.col("n").alias("value")))
            .unionByName(forecast.agg(F.lit("forecast_rows").alias("check_name"),
                                      F.count(F.lit(1)).alias("value")))
            .unionByName(mart.agg(F.lit("mart_rows").alias("check_name"),
                                  F.count(F.lit(1)).alias("value"))))


def unmatched_rows(mart: DataFrame) -> DataFrame:
    """Rows the mart scores with missing labor inputs (they fall to ELSE branches)."""
    return mart.agg(
        F.count(F.lit(1)).alias("mart_rows"),
        F.count_if(F.col("volume_tier").isNull()).alias("rows_without_standard"),
        F.count_if(F.col("callout_rate").isNull()).alias("rows_without_schedule"),
        F.count_if(F.col("target_sales_per_labor_hour") == 0).alias("rows_with_zero_target"),
        F.count_if(F.col("actual_weekly_sales") == 0).alias("rows_with_zero_actual"),
        F.count_if(F.col("forecast_weekly_sales") == 0).alias("rows_with_zero_forecast"))
