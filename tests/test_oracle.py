"""Spark against the DuckDB reference SQL on the smallest fixture (the full
sweep at sf0.01 is tools/check_oracle.py)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem".split()
NAMES = ["input_sales", "fill_external", "feature_table", "model_metrics_naive", "labor_standards",
         "labor_schedule", "mart_workforce", "mart_store_week", "bq_weekly_trend", "kpi_overview",
         "validate_counts"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (2, v)
    return (3, str(v))


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_reference_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rel = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    order = sorted(dcols)
    srows = df.collect()
    a = sorted(tuple(_norm(r[c]) for c in order) for r in srows)
    b = sorted(tuple(_norm(r[dcols.index(c)]) for c in order) for r in drows)
    assert a == b
