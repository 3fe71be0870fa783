import datetime as dt

import numpy as np
import pandas as pd

from shiftwise.operators.features import create_features


def _series(spark, weeks, values, store=1, dept=1):
    rows = [(store, dept, w, float(v)) for w, v in zip(weeks, values)]
    return spark.createDataFrame(rows, "store int, dept int, date date, weekly_sales double")


def _pandas_expected(pdf):
    pdf = pdf.sort_values(["store", "dept", "date"]).copy()
    g = pdf.groupby(["store", "dept"])["weekly_sales"]
    for n in (1, 2, 4, 13, 52):
        pdf[f"lag_{n}"] = g.shift(n)
    for n in (4, 13):
        pdf[f"rolling_{n}_mean"] = g.transform(lambda s: s.shift(1).rolling(n, min_periods=1).mean())
    return pdf


def test_lags_are_row_offsets_with_a_missing_week(spark):
    start = dt.date(2001, 1, 1)
    weeks = [start + dt.timedelta(days=7 * i) for i in (0, 1, 3)]  # week 2 missing
    out = create_features(_series(spark, weeks, [10, 20, 30])).orderBy("date").collect()
    assert [r.lag_1 for r in out] == [None, 10.0, 20.0]  # the row after the gap takes the previous row
    assert [r.rolling_4_mean for r in out] == [None, 10.0, 15.0]  # min_periods = 1


def test_against_pandas_on_sixty_rows(spark):
    rng = np.random.default_rng(7)
    start = dt.date(2000, 1, 3)
    rows = []
    for store, dept in [(1, 1), (1, 2), (2, 1)]:
        for i in range(60):
            rows.append((store, dept, start + dt.timedelta(days=7 * i), float(rng.integers(0, 1000))))
    pdf = pd.DataFrame(rows, columns=["store", "dept", "date", "weekly_sales"])
    exp = _pandas_expected(pdf)
    got = create_features(spark.createDataFrame(pdf)).toPandas()
    got = got.sort_values(["store", "dept", "date"]).reset_index(drop=True)
    exp = exp.reset_index(drop=True)
    for c in ["lag_1", "lag_2", "lag_4", "lag_13", "lag_52", "rolling_4_mean", "rolling_13_mean"]:
        np.testing.assert_allclose(got[c].astype(float), exp[c].astype(float), rtol=1e-12, equal_nan=True)
    assert got["lag_52"].notna().sum() == 3 * 8


def test_calendar_columns(spark):
    df = _series(spark, [dt.date(2012, 1, 1), dt.date(2011, 12, 26)], [1, 2])
    out = {r.date: r for r in create_features(df).collect()}
    r = out[dt.date(2012, 1, 1)]
    assert (r.year, r.month, r.weekofyear, r.quarter, r.is_december) == (2012, 1, 52, 1, 0)
    assert out[dt.date(2011, 12, 26)].is_december == 1
