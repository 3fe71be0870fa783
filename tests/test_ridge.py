import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shiftwise.config import CATEGORICAL_FEATURES, NUMERIC_FEATURES, ForecastConfig
from shiftwise.operators import models, ridge
from shiftwise.operators.categories import category_dictionary


def _data(n=600, wide=40, seed=0):
    rng = np.random.default_rng(seed)
    out = pd.DataFrame({
        "a": rng.normal(size=n) * 1000 + 5e4, "b": rng.normal(size=n), "flat": 7.0,
        "item": [f"i{k}" for k in rng.integers(0, wide, n)], "kind": [f"k{k}" for k in rng.integers(0, 3, n)]})
    out["y"] = 3 * out.a / 1000 - 2 * out.b + out.item.str[1:].astype(int) * 0.3 + rng.normal(size=n)
    return out


def _closed_form(pdf, alpha, cats):
    """Weights and intercept by dense normal equations over all columns."""
    columns = {c: pdf[c].to_numpy(float) for c in ("a", "b", "flat")}
    for c in cats:
        for v in sorted(pdf[c].dropna().unique()):
            columns[c, v] = (pdf[c] == v).to_numpy(float)
    x, y = np.stack(list(columns.values()), 1), pdf.y.to_numpy()
    xc = x - x.mean(0)
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ (y - y.mean()))
    return dict(zip(columns, w)), y.mean() - x.mean(0) @ w


def _fit(spark, pdf, cats=("item", "kind"), alpha=1.5):
    """The frame and the model; the dictionary knows both categories."""
    df = spark.createDataFrame(pdf).repartition(5)
    return df, ridge.fit_ridge(df, ["a", "b", "flat"], list(cats), category_dictionary(df, ["item", "kind"]), "y", alpha)


@pytest.mark.parametrize("cats", [("item", "kind"), ("kind",), ()])
def test_equals_closed_form(spark, cats):
    pdf = _data()
    want, base = _closed_form(pdf, 1.5, cats)
    df, model = _fit(spark, pdf, cats)
    got = {**model.numeric, **{(r["column"], r["value"]): r["coefficient"] for r in model.categories.collect()}}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], rel=1e-6, abs=1e-9), k
    plain = base + sum(pdf[c] * want[c] for c in ("a", "b", "flat")) + sum(
        pdf[c].map(lambda v, c=c: want[c, v]) for c in cats)
    fitted = ridge.with_prediction(model, df, cats).toPandas().sort_values(["a", "b"])
    np.testing.assert_allclose(fitted.prediction, plain.loc[pdf.sort_values(["a", "b"]).index], rtol=1e-9)


def test_more_values_than_a_dense_system_holds(spark):
    """6,000 values of one category: the normal equations hold for every column."""
    rng = np.random.default_rng(4)
    n = 30_000
    pdf = pd.DataFrame({"a": rng.normal(size=n), "b": rng.normal(size=n), "flat": 0.0,
                        "item": rng.permutation(np.arange(n) % 6_000).astype(str), "kind": rng.choice(["x", "y"], n)})
    pdf["y"] = pdf.a + pdf.item.astype(int) % 7 + rng.normal(size=n)
    df, model = _fit(spark, pdf)
    assert model.categories.where("column = 'item'").count() == 6_000
    gaps = ridge.residuals(model, df, ["item", "kind"], "y", 1.5)
    assert gaps.count() == 6_000 + 2 + 3
    assert gaps.agg(F.max("gap")).first()[0] < 1e-10


def test_a_hot_value_nulls_and_unseen_values(spark):
    pdf = _data(300, 10, 2)
    pdf.loc[:120, "item"] = "hot"
    pdf.loc[200:220, "item"] = None
    pdf.loc[230:233, "y"] = None
    want, base = _closed_form(pdf.dropna(subset=["y"]), 1.5, ("item", "kind"))
    df, model = _fit(spark, pdf)
    got = {r["value"]: r["coefficient"] for r in model.categories.where("column = 'item'").collect()}
    assert got == {v: pytest.approx(w, rel=1e-6) for (c, v), w in [(k, w) for k, w in want.items() if isinstance(k, tuple)]
                   if c == "item"}
    new = spark.createDataFrame([(5e4, 0.0, 7.0, "never", None)], "a double, b double, flat double, item string, kind string")
    value = ridge.with_prediction(model, new, ["item", "kind"]).first().prediction
    assert value == pytest.approx(base + 5e4 * want["a"] + 7.0 * want["flat"], rel=1e-9)


def test_gram_against_numpy(spark):
    pdf = _data(200, 4, 3)
    df = spark.createDataFrame(pdf).repartition(3)
    got = {(r.feature_a, r.feature_b): r.cosine for r in ridge.gram(
        df, ["a", "b"], ["item"], category_dictionary(df, ["item"]), "y").collect()}
    columns = {c: pdf[c] - pdf[c].mean() for c in ("a", "b", "y")}
    columns.update({f"item={v}": (pdf["item"] == v).astype(float) for v in pdf["item"].unique()})
    for (p, q), value in got.items():
        x, y = columns[p], columns[q]
        assert value == pytest.approx(x @ y / np.sqrt((x @ x) * (y @ y)), abs=1e-12)
    assert len(got) == 6 + 3 * 4 + 4  # pairs of two values of one category never meet


def test_empty_and_too_many_columns(spark):
    df = spark.createDataFrame([], "a double, item string, kind string, y double")
    words = category_dictionary(df, ["item", "kind"])
    with pytest.raises(ValueError, match="no training rows"):
        ridge.fit_ridge(df, ["a"], ["item", "kind"], words, "y", 1.0)
    n = ridge.LIMIT
    df = spark.range(2 * n).select(F.col("id").cast("double").alias("a"), F.col("id").cast("string").alias("item"),
                                   (F.col("id") % n).cast("string").alias("kind"), F.lit(1.0).alias("y"))
    with pytest.raises(ValueError, match="widest"):
        ridge.fit_ridge(df, ["a"], ["item", "kind"], category_dictionary(df, ["item", "kind"]), "y", 1.0)


def test_same_forecast_as_the_mllib_pipeline(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(240):
        rec = {c: float(rng.normal()) for c in NUMERIC_FEATURES}
        rec.update(store=i % 6, dept=i % 4, type="AB"[i % 2], is_holiday=bool(i % 5 == 0),
                   date=dt.date(2001, 1, 1) + dt.timedelta(days=7 * (i // 24)), weekly_sales=float(100 + 9 * rec["lag_1"] + i % 6))
        rows.append(rec)
    df = spark.createDataFrame(pd.DataFrame(rows))
    cut = dt.date(2001, 2, 26)
    p = models.prepare(df.where(F.col("date") < cut), df.where(F.col("date") >= cut))
    cfg, keys = ForecastConfig(), ["store", "dept", "date", "forecast_weekly_sales"]
    one = models.ridge_forecast(p, cfg).select(keys).toPandas().sort_values(keys)
    two = models.normal_ridge_forecast(p, cfg).select(keys).toPandas().sort_values(keys)
    assert len(one) == len(two) > 0
    np.testing.assert_allclose(two.forecast_weekly_sales, one.forecast_weekly_sales, rtol=1e-6)
    assert set(CATEGORICAL_FEATURES) == {r[0] for r in p.dictionary.select("column").distinct().collect()}
