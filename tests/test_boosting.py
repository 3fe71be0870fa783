import datetime as dt

import numpy as np
import pandas as pd
import pytest

from shiftwise.operators import boosting as b
from shiftwise.operators.categories import category_dictionary, dense, onehot, with_codes


def table(n=500, seed=0):
    rng = np.random.default_rng(seed)
    df = pd.DataFrame({
        "store": rng.integers(0, 12, n), "dept": rng.integers(0, 3, n),
        "date": [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(n)],
        "x": rng.normal(size=n).round(2), "z": rng.integers(0, 4, n).astype(float), "w": rng.normal(size=n)})
    df["y"] = (100 * (df["x"] > 0.3) + 30 * (df["store"] == 3) + 10 * df["z"] + rng.normal(size=n) * 5).round(3)
    return df


NUMERIC, CATEGORICAL, ORDER = ["x", "z", "w"], ["store", "dept"], ["store", "dept", "date"]


def plainly(df, cfg):
    """The same boosting with whole arrays and one split after another; predictions of the training rows.

    ``cfg.row_share`` below 1 needs one chunk: rows in the order of ORDER.
    """
    df = df.sort_values(ORDER)
    y, n = df["y"].to_numpy(), len(df)
    tests = []  # (feature, column order, rows that go right)
    feature = 0
    for c in NUMERIC:
        v = np.sort(df[c].to_numpy())
        for cut in sorted({v[k * (n - 1) // cfg.bins] for k in range(1, cfg.bins)}):
            tests.append((feature, c, df[c].to_numpy() > cut))
        feature += 1
    for c in CATEGORICAL:
        for value in sorted(df[c].astype(str).unique()):
            tests.append((feature, c, (df[c].astype(str) == value).to_numpy()))
            feature += 1
    unit = b.unit(n, float(np.abs(y).max()), cfg.chunk_rows)
    margin = np.full(n, float(y.mean()))
    for round_ in range(cfg.rounds):
        rows = b.drawn_rows(cfg, round_, 0, n) if cfg.row_share < 1 else np.ones(n, bool)
        allowed = b.drawn_features(cfg, round_, feature)
        g = np.rint((y - margin) / unit) * unit
        value = np.zeros(n)

        def grow(inside, depth):
            total, weight = g[inside & rows].sum(), (inside & rows).sum()
            value[inside] = cfg.step * total / (weight + cfg.l2)
            best, pick, column_best = 0.0, None, (None, 0.0, None)
            by_column = {}
            for f, c, right in tests:
                if not allowed[f]:
                    continue
                r = inside & rows & right
                gr, nr = g[r].sum(), r.sum()
                gl, nl = total - gr, weight - nr
                if nl >= cfg.min_weight and nr >= cfg.min_weight:
                    gain = gl ** 2 / (nl + cfg.l2) + gr ** 2 / (nr + cfg.l2) - total ** 2 / (weight + cfg.l2)
                    if c not in by_column or gain > by_column[c][0]:
                        by_column[c] = gain, right
            for c in NUMERIC + CATEGORICAL:
                if c in by_column and by_column[c][0] > best + 1e-9 * abs(best):
                    best, pick = by_column[c]
            if depth and pick is not None:
                grow(inside & ~pick, depth - 1)
                grow(inside & pick, depth - 1)

        grow(np.ones(n, bool), cfg.depth)
        margin = margin + value
    return pd.Series(margin, index=df.index)


def fitted(spark, df, cfg):
    train = spark.createDataFrame(df)
    dictionary = category_dictionary(train, CATEGORICAL)
    model = b.fit_boosting(train, NUMERIC, CATEGORICAL, dictionary, "y", ORDER, cfg)
    return model, train, dictionary


@pytest.mark.parametrize("cfg", [
    b.BoostConfig(rounds=8, step=0.3, depth=4, bins=16, row_share=0.8, column_share=0.8, keep_every=3),
    b.BoostConfig(rounds=5, step=0.5, depth=3, bins=256, row_share=1.0, column_share=0.6, chunk_rows=64),
])
def test_equals_plain_boosting(spark, cfg):
    df = table()
    model, train, dictionary = fitted(spark, df, cfg)
    got = b.with_prediction(model, train, dictionary).toPandas().sort_values(["date"])
    want = plainly(df, cfg).loc[df.sort_values("date").index]
    np.testing.assert_allclose(got["prediction"].to_numpy(), want.to_numpy(), rtol=1e-9)
    assert len(model.trees) == cfg.rounds


def test_same_trees_however_the_rows_are_dealt(spark, tmp_path):
    cfg = b.BoostConfig(rounds=4, step=0.3, depth=3, bins=32, chunk_rows=100)
    df = table(400, 3)
    df = pd.concat([df, df.iloc[:20]])  # repeated rows
    one, train, dictionary = fitted(spark, df, cfg)
    other, *_ = fitted(spark, df.sample(frac=1, random_state=1), cfg)
    shuffled = train.repartition(5, "w")
    third = b.fit_boosting(shuffled, NUMERIC, CATEGORICAL, dictionary, "y", ORDER, cfg)
    for model in (other, third):
        for a, c in zip(one.trees, model.trees, strict=True):
            assert a.column.tolist() == c.column.tolist() and a.cut.tolist() == c.cut.tolist()
            assert a.value.tolist() == c.value.tolist()
    b.save_model(spark, one, str(tmp_path / "m"))
    again = b.load_model(spark, str(tmp_path / "m"))
    p, q = (b.with_prediction(m, train, dictionary).select("date", "w", "prediction").toPandas().sort_values(["date", "w"])
            for m in (one, again))
    assert p["prediction"].tolist() == q["prediction"].tolist()


def test_unseen_categories_missing_values_and_no_rows(spark):
    cfg = b.BoostConfig(rounds=3, step=0.5, depth=2)
    model, train, dictionary = fitted(spark, table(100), cfg)
    odd = spark.createDataFrame([(99, None, None, 1.0, None)], "store int, dept int, x double, z double, w double")
    assert b.with_prediction(model, odd, dictionary).count() == 1
    empty = b.fit_boosting(train.limit(0), NUMERIC, CATEGORICAL, dictionary, "y", ORDER, cfg)
    assert empty.trees == [] and b.with_prediction(empty, odd, dictionary).first()["prediction"] == 0.0
    flat = b.fit_boosting(train.withColumn("y", train["y"] * 0 + 7), NUMERIC, CATEGORICAL, dictionary, "y", ORDER, cfg)
    assert b.with_prediction(flat, train, dictionary).select("prediction").distinct().collect()[0][0] == 7.0


def test_one_hot_is_sparse_and_dense(spark):
    train = spark.createDataFrame([("b", 10), ("a", 9), (None, 10)], "s string, n int")
    d = category_dictionary(train, ["s", "n"])
    rows = spark.createDataFrame([("b", 9, 1), ("z", None, 2)], "s string, n int, code int")
    got = onehot(rows, d, ["s", "n"]).withColumn("all", dense()).orderBy("code").collect()
    assert [(r["onehot_size"], r["onehot_indices"], r["all"]) for r in got] == [(4, [1, 3], [0, 1, 0, 1]), (4, [], [0, 0, 0, 0])]
    assert with_codes(rows, d, ["s"]).columns == ["s", "n", "code", "s_code"]
