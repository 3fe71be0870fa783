import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from shiftwise.plans import load, views
from shiftwise.plans.pipeline import Workspace
from shiftwise.session import run_folder
from shiftwise.sources import catalog, files, loader, schemas
from shiftwise.sources.csv_inputs import CsvInputs, RejectedRows, read_checked, write_inputs

SF = "/root/testdata/sf0.001"


def written(tmp_path, text, name="train.csv"):
    p = tmp_path / name
    p.write_bytes(text.encode())
    return str(p)


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_shuffled_columns_and_every_line_end(spark, tmp_path, end):
    text = end.join(["Date,IsHoliday,extra,Dept,Weekly_Sales,Store", "2010-02-05,TRUE,x,1,24924.5,1", "2010-02-12,false,y,2,NA,1"]) + end
    got = read_checked(spark, written(tmp_path, text), schemas.SALES)
    assert got.rejected.count() == 0
    assert [tuple(r) for r in got.rows.orderBy("date").collect()] == [
        (1, 1, dt.date(2010, 2, 5), 24924.5, True), (1, 2, dt.date(2010, 2, 12), None, False)]


def test_bad_records_go_to_the_quarantine_with_their_cause(spark, tmp_path):
    text = ("Store,Dept,Date,Weekly_Sales,IsHoliday\n1,1,2010-02-05,1.5,TRUE\n1,1,2010-02-05\n1,2,05.02.2010,1.5,TRUE\n"
            "1,x,2010-02-05,much,TRUE\n,3,2010-02-05,2.5,FALSE\n1,4,2010-02-05,nan,FALSE\n1,1,2010-02-05,1,TRUE,7\n")
    path = written(tmp_path, text)
    got = read_checked(spark, path, schemas.SALES, required=("Store",))
    assert {r["cause"]: r["row_count"] for r in got.causes().collect()} == {
        "number of fields": 2, "Date: not date": 1, "Dept: not int": 1, "Store: missing": 1}
    assert [(r["dept"], r["weekly_sales"]) for r in got.rows.orderBy("dept").collect()] == [(1, 1.5), (4, None)]
    assert "1,2,05.02.2010,1.5,TRUE" in {r["record"] for r in got.rejected.collect()}
    with pytest.raises(RejectedRows, match="1 x Date: not date"):
        got.strict(path)
    with pytest.raises(ValueError, match="no column"):
        read_checked(spark, written(tmp_path, "Store,Dept\n1,2\n", "short.csv"), schemas.SALES)


def test_pipeline_from_csv_equals_the_pipeline(spark):
    ws = Workspace(spark, SF)
    folder = f"{run_folder(spark, ws.run_id)}/inputs"
    write_inputs(folder, ws.sales, ws.features, ws.stores, ws.test)
    other = Workspace(spark, "", inputs=CsvInputs(spark, folder, keys_required=False))
    assert other.sales.schema == ws.sales.schema and set(other.features.columns) == set(ws.features.columns)
    assert ws.test.exceptAll(other.test).count() == 0
    a, b = ws.mart, other.mart.select(*ws.mart.columns)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def schema_of(spark, tmp_path):
    name = f"load_{uuid.uuid4().hex}"
    catalog.create_schema(spark, name, location=str(tmp_path / "schema"))
    return name


def test_reload_replaces_and_a_failed_load_leaves_the_table(spark, tmp_path):
    db, spec, base = schema_of(spark, tmp_path), loader.TABLE_SPECS[2], str(tmp_path / "tables")
    for size in (10, 20):
        written(tmp_path, f"Store,Type,Size\n1,A,{size}\n2,B,{size}\n", "stores.csv")
        loader.load_csv(spark, spec, str(tmp_path), db, base)
        assert {r["size"] for r in spark.table(f"{db}.raw_stores").collect()} == {size}
    assert len(os.listdir(f"{base}/raw_stores")) == 1  # the version before is gone
    written(tmp_path, "Store,Type,Size\n1,A,large\n", "stores.csv")
    with pytest.raises(RejectedRows):
        loader.load_csv(spark, spec, str(tmp_path), db, base)

    breaks = spark.range(2).select(F.when(F.col("id") == 1, F.raise_error(F.lit("disk full"))).otherwise(F.lit(1)).cast("int").alias("store"))
    with pytest.raises(Exception, match="disk full"):
        loader.replace_table(spark, breaks, db, "raw_stores", base)
    assert {r["size"] for r in spark.table(f"{db}.raw_stores").collect()} == {20}
    assert len(os.listdir(f"{base}/raw_stores")) == 1
    loader.replace_table(spark, spark.range(3).withColumn("more", F.lit(True)), db, "raw_stores", base)  # other columns
    assert spark.table(f"{db}.raw_stores").count() == 3


def test_names_and_booleans_are_cleaned(spark):
    df = spark.createDataFrame([(1, True, "TRUE"), (2, None, "no")], "`Store/No` int, `Is-Open` boolean, Is_Holiday string")
    got = loader.cleaned(df)
    assert got.columns == ["store_no", "is_open", "is_holiday"]
    assert [tuple(r) for r in got.collect()] == [(1, 1, 1), (2, None, 0)]


def test_views_by_name_in_a_second_session(spark, tmp_path):
    ws = Workspace(spark, SF)
    load.write_load_files(ws, str(tmp_path / "files"))
    db = f"views_{uuid.uuid4().hex}"
    names = load.build_schema(spark, str(tmp_path / "files"), db, str(tmp_path / "tables"))
    assert len(names) == 13
    other = spark.newSession()
    mart = other.table(f"{db}.mart_workforce_dashboard")
    assert mart.columns == ws.mart.columns and mart.count() == ws.mart.count()
    own = {tuple(r) for r in ws.mart.collect()}
    assert {tuple(r) for r in mart.collect()} == own
    top = other.sql(f"SELECT * FROM {db}.mart_top_at_risk_store_depts").collect()
    assert [r["estimated_overtime_cost"] for r in top] == sorted((r["estimated_overtime_cost"] for r in top), reverse=True)
    views.drop_views(spark, db)
    assert not spark.catalog.tableExists(f"{db}.mart_workforce_dashboard")


def test_one_models_rerun_leaves_the_other_folders(spark, tmp_path):
    path = str(tmp_path / "by_model")
    df = spark.createDataFrame([("Naive One", 1), ("Naive One", 2), ("Other-Two", 3)], "model_name string, store int")
    files.write_per_model(df, path)
    files.write_per_model(df.where("store = 1"), path)
    got = {(r["model_slug"], r["store"]) for r in spark.read.parquet(path).collect()}
    assert got == {("naive_one", 1), ("other_two", 3)}
