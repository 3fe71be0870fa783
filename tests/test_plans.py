"""Plan assertions: the shapes the design relies on, read from explain()."""

import datetime as dt

from shiftwise.operators import questions
from shiftwise.operators.features import create_features
from shiftwise.plans.pipeline import Workspace
from shiftwise.sources import fixtures

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_mart_has_no_python_udf(spark):
    ws = Workspace(spark, SF, materialize_inputs=False)
    text = _plan(ws.mart)
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_lags_and_rolling_share_one_window(spark):
    rows = [(1, 1, dt.date(2001, 1, 1) + dt.timedelta(days=7 * i), float(i)) for i in range(20)]
    df = spark.createDataFrame(rows, "store int, dept int, date date, weekly_sales double").repartition(4)
    text = _plan(create_features(df))
    assert text.count("Window [") == 1
    assert text.count("Exchange hashpartitioning") == 1


def test_store_dimension_is_broadcast_and_scans_are_pruned(spark):
    ws = Workspace(spark, SF, materialize_inputs=False)
    plan = _plan(ws.modeling_table)
    assert "BroadcastHashJoin" in plan
    sales_plan = ws.sales._jdf.queryExecution().executedPlan().toString()
    # only the lineitem columns the derivation needs are read
    for unused in ("l_quantity", "l_tax", "l_linenumber", "l_orderkey"):
        assert unused not in sales_plan


def test_only_store_level_window_is_unpartitioned(spark):
    ws = Workspace(spark, SF, materialize_inputs=False)
    text = ws.feature_table._jdf.queryExecution().optimizedPlan().toString()
    # the one window without PARTITION BY runs over one row per store
    assert text.count("windowspecdefinition(store#") >= 1
    assert "specifiedwindowframe(RowFrame, currentrow$(), unboundedfollowing$())" in text


def test_top_k_is_take_ordered(spark):
    ws = Workspace(spark, SF, materialize_inputs=False)
    plan = _plan(questions.top_overtime_stores(ws.mart))
    assert "TakeOrderedAndProject" in plan


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["week_date", "required_labor_hours", "available_labor_hours",
                          "labor_gap_hours", "overtime_risk_hours", "estimated_overtime_cost"]
    assert len(rows) == 13


def test_fixture_table_sees_new_files(spark, tmp_path):
    """A table is listed anew each time: files added later count."""
    from shiftwise.sources import fixtures

    path = f"{tmp_path}/nation.parquet"
    spark.range(3).write.parquet(path)
    assert fixtures.table(spark, str(tmp_path), "nation").count() == 3
    spark.range(4).write.mode("append").parquet(path)
    assert fixtures.table(spark, str(tmp_path), "nation").count() == 7
