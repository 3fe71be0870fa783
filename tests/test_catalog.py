import datetime as dt
import tempfile

from shiftwise.operators.dashboard import labor_gap_heatmap_wide
from shiftwise.sources import catalog


def test_schema_tables_views_and_drop(spark):
    loc = tempfile.mkdtemp(prefix="shiftwise-db-")
    catalog.create_schema(spark, "shiftwise_test", location=loc)
    df = spark.createDataFrame([(1, "High Volume", 1250.0)],
                               "dept int, volume_tier string, target_sales_per_labor_hour double")
    catalog.save_tables({"analytics_labor_standards": df}, database="shiftwise_test")
    catalog.save_tables({"analytics_labor_standards": df.union(df)}, database="shiftwise_test")  # replace
    assert spark.table("shiftwise_test.analytics_labor_standards").count() == 2
    catalog.register_views({"mart_workforce_dashboard": df})
    assert spark.sql("SELECT count(*) FROM mart_workforce_dashboard").first()[0] == 1
    catalog.drop_existing(spark, database="shiftwise_test")
    assert not spark.catalog.tableExists("analytics_labor_standards", "shiftwise_test")
    assert not spark.catalog.tableExists("mart_workforce_dashboard")


def test_wide_heatmap(spark):
    d = dt.date(2001, 1, 1)
    mart = spark.createDataFrame([(1, 1, d, 5.0), (1, 2, d, -3.0), (1, 2, d, 1.0), (2, 1, d, 7.0)],
                                 "store int, dept int, week_date date, labor_gap_hours double")
    out = {r.store: r for r in labor_gap_heatmap_wide(mart, depts=[1, 2]).collect()}
    assert (out[1]["1"], out[1]["2"]) == (5.0, -2.0)
    assert (out[2]["1"], out[2]["2"]) == (7.0, None)
