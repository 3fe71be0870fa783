import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from shiftwise.config import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from shiftwise.operators import models


def test_ridge_penalty_matches_closed_form(spark):
    rng = np.random.default_rng(0)
    n, alpha = 400, 10.0
    X = rng.normal(size=(n, 3)) * [1, 5, 0.2] + [3, 0, 1]
    y = X @ [2, -1, 4] + 7 + rng.normal(size=n) * 3
    Xm, ym = X.mean(0), y.mean()
    w = np.linalg.solve((X - Xm).T @ (X - Xm) + alpha * np.eye(3), (X - Xm).T @ (y - ym))
    b = ym - Xm @ w
    df = spark.createDataFrame(pd.DataFrame({"a": X[:, 0], "b": X[:, 1], "c": X[:, 2], "y": y}))
    df = VectorAssembler(inputCols=["a", "b", "c"], outputCol="f").transform(df)
    reg = alpha * y.std(ddof=0) / n  # the scaling ridge_pipeline uses
    fit = LinearRegression(featuresCol="f", labelCol="y", regParam=reg, elasticNetParam=0.0,
                           standardization=False, solver="normal").fit(df)
    np.testing.assert_allclose(fit.coefficients.toArray(), w, rtol=1e-8)
    assert fit.intercept == pytest.approx(b, rel=1e-8)


def _frame(spark, stores, n_per=3, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for s in stores:
        for i in range(n_per):
            rec = {c: float(rng.normal()) for c in NUMERIC_FEATURES}
            rec.update(store=s, dept=1, type="A", is_holiday=False,
                       date=dt.date(2001, 1, 1) + dt.timedelta(days=7 * i),
                       weekly_sales=float(rng.normal() * 10 + 100))
            rows.append(rec)
    return spark.createDataFrame(pd.DataFrame(rows))


def test_unseen_category_gives_zero_block(spark):
    train = _frame(spark, ["a", "b", "c"])
    holdout = _frame(spark, ["a", "z"], n_per=1)
    p = models.prepare(train, holdout)
    out = {r.store: r.onehot for r in models.onehot_features(p).collect()}
    # store block has 3 slots (a, b, c); the unseen 'z' sets none of them
    assert out["a"][:3] == [1.0, 0.0, 0.0]
    assert out["z"][:3] == [0.0, 0.0, 0.0]


def test_exact_median_imputation(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,)], "size double")
    assert models.fit_medians(df, cols=["size"]).first().size == 1.5  # exact, not approximate (1.0)


def test_models_beat_the_mean_and_stay_non_negative(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(300):
        rec = {c: float(rng.normal()) for c in NUMERIC_FEATURES}
        rec.update(store=int(i % 3), dept=int(i % 2), type="A", is_holiday=bool(i % 5 == 0),
                   date=dt.date(2001, 1, 1), weekly_sales=float(max(0.0, 50 + 30 * rec["lag_1"] + rng.normal())))
        rows.append(rec)
    df = spark.createDataFrame(pd.DataFrame(rows))
    train, holdout = df.limit(250), df.exceptAll(df.limit(250))
    p = models.prepare(train, holdout)
    from shiftwise.config import ForecastConfig
    cfg = ForecastConfig(gbt_rounds=10)
    for fc in (models.ridge_forecast(p, cfg), models.gbt_forecast(p, cfg)):
        r = fc.agg(F.avg("abs_forecast_error").alias("mae"), F.min("forecast_weekly_sales").alias("lo"),
                   F.stddev_pop("actual_weekly_sales").alias("sd")).first()
        assert r.lo >= 0.0
        assert r.mae < r.sd  # better than predicting the mean
