"""Load CSV files into named tables, each load replacing the table as a whole.

read (checked) -> clean column names -> booleans as 1/0 -> write a new version
of the table beside the old one -> point the name at it -> delete the old
version. A load that fails anywhere before the last two steps leaves the table
as it was: nothing is written over.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from shiftwise.functions.columns import normalize_bool_columns, standardize_columns
from shiftwise.session import remove_folder
from shiftwise.sources import schemas
from shiftwise.sources.csv_inputs import read_checked


@dataclass(frozen=True)
class TableSpec:
    """A table, the file it is loaded from, and the file's columns."""

    name: str
    file: str
    schema: StructType


TABLE_SPECS = (
    TableSpec("raw_train_sales", "train.csv", schemas.SALES),
    TableSpec("raw_features", "features.csv", schemas.FEATURES),
    TableSpec("raw_stores", "stores.csv", schemas.STORES),
    TableSpec("raw_test_sales", "test.csv", schemas.TEST),
    TableSpec("analytics_forecast_output", "forecast_output_best.csv", schemas.FORECAST),
    TableSpec("analytics_model_comparison", "model_comparison.csv", schemas.MODEL_COMPARISON),
    TableSpec("analytics_model_metrics", "model_metrics.csv", schemas.MODEL_COMPARISON),
    TableSpec("analytics_labor_standards", "labor_standards.csv", schemas.LABOR_STANDARDS),
    TableSpec("analytics_simulated_schedule", "simulated_schedule.csv", schemas.SCHEDULE),
)


def cleaned(df: DataFrame) -> DataFrame:
    return normalize_bool_columns(standardize_columns(df, slash=True))


def location(spark: SparkSession, table: str) -> str | None:
    """Folder of an existing table."""
    if not spark.catalog.tableExists(table):
        return None
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect():
        if r["col_name"] == "Location":
            return r["data_type"]
    return None


def replace_table(spark: SparkSession, df: DataFrame, database: str, name: str, base: str) -> None:
    """Write ``df`` as a new version under ``base`` and let the table name it; then delete the version before."""
    table, path = f"`{database}`.`{name}`", f"{base.rstrip('/')}/{name}/{uuid.uuid4().hex}"
    try:
        df.write.parquet(path)
    except Exception:
        remove_folder(spark, path)
        raise
    old = location(spark, table)
    if old is not None and spark.table(table).schema == spark.read.parquet(path).schema:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")  # one change of the catalog
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")  # other columns: the name has to be declared anew
        spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{path}'")
    spark.catalog.refreshTable(table)
    if old is not None and old.rstrip("/").split("/")[-2] == name:
        remove_folder(spark, old)


def load_csv(spark: SparkSession, spec: TableSpec, folder: str, database: str, base: str) -> None:
    """One file into its table; a bad record fails the load before anything is replaced."""
    path = f"{folder.rstrip('/')}/{spec.file}"
    rows = read_checked(spark, path, spec.schema, snake_case=False).strict(path)
    replace_table(spark, cleaned(rows), database, spec.name, base)


def load_all(spark: SparkSession, folder: str, database: str, base: str, specs=TABLE_SPECS) -> list[str]:
    """Every file of ``folder`` into its table; the names loaded."""
    for spec in specs:
        load_csv(spark, spec, folder, database, base)
    return [s.name for s in specs]
