"""The mart through Spark SQL: register the tables and views, then query them
by name with ``spark.sql`` exactly as an analyst would."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shiftwise.operators import rollups
from shiftwise.operators.questions import WEEKLY_SUMS
from shiftwise.plans.pipeline import Workspace
from shiftwise.sources.catalog import register_views

WEEKLY_TREND_SQL = (f"select week_date, {', '.join(f'sum({c}) as {c}' for c in WEEKLY_SUMS)} "
                    "from mart_workforce_dashboard group by week_date order by week_date")


def register_all(ws: Workspace) -> None:
    tables = ws.tables()
    tables["mart_store_week_summary"] = rollups.store_week_summary(ws.mart)
    tables["mart_forecast_accuracy_summary"] = rollups.forecast_accuracy_summary(ws.mart)
    tables["mart_top_at_risk_store_depts"] = rollups.top_at_risk(ws.mart)
    register_views(tables)


def sql(ws: Workspace, text: str) -> DataFrame:
    register_all(ws)
    return ws.spark.sql(text)
