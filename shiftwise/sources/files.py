"""File sources and sinks: CSV with schema, Parquet, per-model outputs, JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shiftwise.functions.columns import slug, standardize_columns


# Fields that stand for a missing value.
MISSING = ("", "NA", "N/A", "NaN", "nan", "NULL", "null", "None", "n/a", "#N/A", "<NA>")


def read_csv(spark: SparkSession, path: str, schema: StructType, snake_case: bool = True) -> DataFrame:
    """Header CSV read by column name, cast to a declared schema.

    A missing column fails, extra ones are ignored. Fields that mark a missing
    value (MISSING) and NaN are NULL; dates are yyyy-MM-dd; any other field
    that does not fit its type fails. Names are normalized to snake case.
    """
    raw = spark.read.option("header", True).option("mode", "FAILFAST").csv(path)
    lacking = [f.name for f in schema.fields if f.name not in raw.columns]
    if lacking:
        raise ValueError(f"{path}: no column {', '.join(lacking)}")
    cols = []
    for f in schema.fields:
        value = F.trim(F.col(f"`{f.name}`"))
        value = F.when(~value.isin(*MISSING), value).cast(f.dataType)
        cols.append(value.alias(f.name))
    df = raw.select(*cols)
    return standardize_columns(df) if snake_case else df


def write_csv(df: DataFrame, path: str) -> None:
    """Overwrite a folder of header CSV part files (written in parallel)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrite a Parquet folder, optionally partitioned by columns."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_per_model(forecasts: DataFrame, path: str, fmt: str = "parquet") -> None:
    """One output folder per model: ``model_slug=<lower_snake_name>/``.

    A single partitioned write instead of a driver loop over models. Only the
    folders of the models in ``forecasts`` are replaced; those of models from
    other runs stay.
    """
    out = forecasts.withColumn("model_slug", slug("model_name"))
    w = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("model_slug")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """Newline-delimited JSON (e.g. the one-row metrics document)."""
    df.write.mode("overwrite").json(path)
