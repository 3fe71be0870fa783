from shiftwise.operators import dashboard, mart
from shiftwise.plans import colocated
from shiftwise.plans.pipeline import Workspace
from shiftwise.plans.registry import SELECTIONS

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_bucketed_forecast_and_schedule_meet_without_a_shuffle(spark):
    ws = Workspace(spark, SF)
    plain = _rows(mart.mart_base(ws.mart_forecast, ws.labor_standards, ws.schedule))
    base = colocated.colocated_base(ws, buckets=4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables too large to send around
    try:
        text = base._jdf.queryExecution().executedPlan().toString()
        joined = spark.table(f"run_{ws.run_id}_forecast").join(
            spark.table(f"run_{ws.run_id}_schedule"), list(colocated.KEYS), "left")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        shuffles = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
        assert len(shuffles) == 2 and all("hashpartitioning(dept#" in line for line in shuffles)  # the standards' join alone
        assert _rows(base) == plain and plain
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        colocated.release(ws)
    assert not spark.catalog.tableExists(f"run_{ws.run_id}_forecast")


def test_drilldown_report_equals_single_drilldowns(spark):
    ws = Workspace(spark, SF, persist=True)
    got = {r["selection"]: r for r in dashboard.drilldown_report(ws.mart, SELECTIONS).collect()}
    for name, filters in SELECTIONS.items():
        one = dashboard.kpi_drilldown(ws.mart, **filters).first()
        assert (name in got) == (one["row_count"] > 0)
        if name in got:
            assert got[name]["row_count"] == one["row_count"]
            assert abs(got[name]["labor_gap_hours"] - one["labor_gap_hours"]) < 1e-6
    assert set(got) >= {"store", "department", "store type"}
    ws.release()


def test_drilldown_report_of_no_rows(spark):
    ws = Workspace(spark, SF)
    assert dashboard.drilldown_report(ws.mart.limit(0), SELECTIONS).count() == 0
