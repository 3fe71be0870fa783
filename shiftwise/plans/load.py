"""Files of the load step, written from a run, and the schema that is loaded from them.

    python -m shiftwise.plans.load --input /root/testdata/sf0.1 --folder <files> --database planning --base <tables>
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from shiftwise.plans.pipeline import Workspace
from shiftwise.plans.views import create_views
from shiftwise.sources import catalog, files, loader
from shiftwise.sources.csv_inputs import write_inputs


def write_load_files(ws: Workspace, folder: str) -> None:
    """The nine CSV files of ``loader.TABLE_SPECS`` under ``folder``."""
    write_inputs(folder, ws.sales, ws.features, ws.stores, ws.test)
    for name, df in (("forecast_output_best", ws.mart_forecast), ("model_comparison", ws.naive_metrics),
                     ("model_metrics", ws.naive_metrics), ("labor_standards", ws.labor_standards),
                     ("simulated_schedule", ws.schedule)):
        files.write_csv(df, f"{folder.rstrip('/')}/{name}.csv")


def build_schema(spark: SparkSession, folder: str, database: str, base: str) -> list[str]:
    """Schema, nine tables and four views from the files; the names created."""
    catalog.create_schema(spark, database, location=f"{base.rstrip('/')}/schema")
    return [*loader.load_all(spark, folder, database, base), *create_views(spark, database)]


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    for name in ("input", "folder", "database", "base"):
        ap.add_argument(f"--{name}", required=True)
    args = ap.parse_args(argv)
    from shiftwise.session import get_session

    spark = SparkSession.getActiveSession() or get_session()
    ws = Workspace(spark, args.input)
    write_load_files(ws, args.folder)
    for name in build_schema(spark, args.folder, args.database, args.base):
        print(f"{args.database}.{name}")
    ws.release()


if __name__ == "__main__":
    main()
