import datetime as dt

import numpy as np
import pandas as pd

from shiftwise.operators.prepare import cap_sales, fill_externals, fill_markdowns, join_inputs

COLS = ["temperature", "fuel_price", "cpi", "unemployment"]


def _reference_fill(pdf):
    """Forward fill within store in (dept, date) order, then a plain backward fill."""
    pdf = pdf.sort_values(["store", "dept", "date"]).copy()
    for c in COLS:
        pdf[c] = pdf.groupby("store")[c].ffill().bfill()
    return pdf


def _frame(spark, pdf):
    return spark.createDataFrame(pdf, "store int, dept int, date date, temperature double, "
                                      "fuel_price double, cpi double, unemployment double")


def test_fill_three_stores(spark):
    d = [dt.date(2001, 1, 1) + dt.timedelta(days=7 * i) for i in range(3)]
    n = None
    rows = [
        # store 1: gap inside dept 1, leading gap in dept 2 (carried from dept 1)
        (1, 1, d[0], 1.0, 1.0, 1.0, 1.0), (1, 1, d[1], n, n, n, n), (1, 1, d[2], 3.0, 3.0, 3.0, 3.0),
        (1, 2, d[0], n, n, n, n), (1, 2, d[1], 5.0, 5.0, 5.0, 5.0), (1, 2, d[2], n, n, n, n),
        # store 2: leading gap at the start of the store
        (2, 1, d[0], n, n, n, n), (2, 1, d[1], n, n, n, n), (2, 1, d[2], 7.0, 7.0, 7.0, 7.0),
        # store 3: all missing -> backfilled from store 4
        (3, 1, d[0], n, n, n, n), (3, 1, d[1], n, n, n, n),
        (4, 1, d[0], n, n, n, n), (4, 1, d[1], 9.0, 9.0, 9.0, 9.0),
        # store 5: last store, all missing -> stays missing
        (5, 1, d[0], n, n, n, n),
    ]
    pdf = pd.DataFrame(rows, columns=["store", "dept", "date", *COLS])
    exp = _reference_fill(pdf).reset_index(drop=True)
    got = fill_externals(_frame(spark, pdf)).toPandas().sort_values(["store", "dept", "date"]).reset_index(drop=True)
    for c in COLS:
        np.testing.assert_array_equal(got[c].to_numpy(dtype=float), exp[c].to_numpy(dtype=float))
    assert np.isnan(got[got.store == 5]["cpi"].iloc[0])
    assert got[got.store == 3]["cpi"].tolist() == [9.0, 9.0]


def test_fill_random_against_pandas(spark):
    rng = np.random.default_rng(11)
    rows = []
    for store in range(1, 7):
        for dept in range(1, 4):
            for i in range(8):
                vals = [float(rng.integers(0, 100)) if rng.random() < (0.0 if store == 4 else 0.3) else None
                        for _ in COLS]
                rows.append((store, dept, dt.date(2001, 1, 1) + dt.timedelta(days=7 * i), *vals))
    pdf = pd.DataFrame(rows, columns=["store", "dept", "date", *COLS])
    exp = _reference_fill(pdf).reset_index(drop=True)
    got = fill_externals(_frame(spark, pdf)).toPandas().sort_values(["store", "dept", "date"]).reset_index(drop=True)
    for c in COLS:
        np.testing.assert_array_equal(got[c].to_numpy(dtype=float), exp[c].to_numpy(dtype=float))


def test_cap_and_markdowns(spark):
    df = spark.createDataFrame([(1, -5.0, None), (2, None, 3.0)], "k int, weekly_sales double, markdown1 double")
    out = fill_markdowns(cap_sales(df), cols=["markdown1"]).orderBy("k").collect()
    assert [(r.weekly_sales, r.weekly_sales_original, r.markdown1) for r in out] == [(0.0, -5.0, 0.0), (None, None, 3.0)]


def test_join_keeps_all_sales_rows(spark):
    d = dt.date(2001, 1, 1)
    sales = spark.createDataFrame([(1, 1, d, 5.0, True), (9, 1, d, 6.0, False)],
                                  "store int, dept int, date date, weekly_sales double, is_holiday boolean")
    stores = spark.createDataFrame([(1, "A", 100)], "store int, type string, size int")
    feats = spark.createDataFrame([(1, d, False, 20.0)], "store int, date date, is_holiday boolean, temperature double")
    out = {r.store: r for r in join_inputs(sales, stores, feats).collect()}
    assert out[1].type == "A" and out[1].temperature is None  # holiday flag disagrees -> no feature row
    assert out[9].type is None
