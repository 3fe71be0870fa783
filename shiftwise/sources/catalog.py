"""Catalog: schema, tables and views under their published names.

Temp views stand in for the database views; ``save_tables`` writes managed
tables (overwrite = replace semantics). An external database would take the
same DataFrames through ``df.write.jdbc(url, table, mode="overwrite",
properties={"batchsize": "50000", ...})``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS = ("mart_top_at_risk_store_depts", "mart_forecast_accuracy_summary",
         "mart_store_week_summary", "mart_workforce_dashboard")
TABLES = ("raw_train_sales", "raw_features", "raw_stores", "raw_test_sales",
          "analytics_forecast_output", "analytics_model_comparison", "analytics_model_metrics",
          "analytics_labor_standards", "analytics_simulated_schedule")


def create_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")


def drop_existing(spark: SparkSession, database: str | None = None) -> None:
    """Views first, then tables, each only if present."""
    for v in VIEWS:
        spark.catalog.dropTempView(v)
    prefix = f"`{database}`." if database else ""
    for t in TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {prefix}`{t}`")


def register_views(tables: dict[str, DataFrame]) -> None:
    """``CREATE OR REPLACE VIEW`` for every DataFrame (no data is moved)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def save_tables(tables: dict[str, DataFrame], database: str | None = None) -> None:
    """Replace managed tables with the DataFrames' contents."""
    for name, df in tables.items():
        target = f"`{database}`.`{name}`" if database else f"`{name}`"
        df.write.mode("overwrite").saveAsTable(target)
