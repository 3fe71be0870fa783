"""Forecast and schedule stored in the same buckets, so that the mart joins them without a shuffle.

Both tables are hashed once on (store, dept, date), when they are written, and
sorted inside each bucket; every later mart or rollup over them reads bucket
against bucket. A hot store or department spreads over the buckets by its
weeks. The tables lie under the run's folder of ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from shiftwise.operators import mart
from shiftwise.plans.pipeline import Workspace
from shiftwise.session import run_folder

KEYS = ("store", "dept", "date")


def bucketed(ws: Workspace, df: DataFrame, name: str, buckets: int, keys=KEYS) -> DataFrame:
    """``df`` as a table of ``buckets`` sorted files; the name is the run's own and is dropped by ``release``."""
    table = f"run_{ws.run_id}_{name}"
    # hashed as the buckets are, so that each bucket is one file
    (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet")
     .option("path", f"{run_folder(ws.spark, ws.run_id)}/bucketed_{name}")
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))
    return ws.spark.table(table)


def colocated_base(ws: Workspace, buckets: int | None = None) -> DataFrame:
    """``mart_base`` over bucketed tables; as many buckets as shuffle partitions unless told otherwise."""
    n = buckets or int(ws.spark.conf.get("spark.sql.shuffle.partitions"))
    forecast = bucketed(ws, ws.mart_forecast, "forecast", n)
    schedule = bucketed(ws, ws.schedule, "schedule", n)
    return mart.mart_base(forecast, ws.written(ws.labor_standards, "labor_standards"), schedule)


def release(ws: Workspace) -> None:
    """Drop the bucketed tables' names, and delete the run's folder."""
    for name in ("forecast", "schedule"):
        ws.spark.sql(f"DROP TABLE IF EXISTS run_{ws.run_id}_{name}")
    ws.release()
