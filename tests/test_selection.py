import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shiftwise.operators import selection


def frame(spark, rows):
    return spark.createDataFrame(rows, "g string, value double")


@pytest.mark.parametrize("share", [0.0, 0.33, 0.5, 1.0])
def test_quantiles_equal_the_plain_ones(spark, share):
    rng = random.Random(7)
    rows = [(rng.choice("ab"), float(rng.randrange(50))) for _ in range(500)]
    rows += [("one", 3.0), ("two", 1.0), ("two", 2.0), ("ties", 5.0), ("ties", 5.0), (None, -1.0), (None, 4.0), ("none", None)]
    rows += [("hot", 1.0)] * 2000 + [("hot", 2.0)] * 3
    got = {r["g"]: r["quantile"] for r in selection.quantiles(frame(spark, rows), ["g"], share).collect()}
    groups: dict = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert set(got) == set(groups)
    for g, v in groups.items():
        assert got[g] == pytest.approx(np.quantile(v, share), abs=1e-12)


def test_cuts_are_the_values_at_their_ranks(spark):
    rng = random.Random(8)
    rows = [("a", float(rng.randrange(1000))) for _ in range(700)] + [("b", float(i % 3)) for i in range(40)] + [("c", 1.0)]
    got: dict = {}
    for r in selection.cuts(frame(spark, rows), ["g"], 16).collect():
        got.setdefault(r["g"], []).append(r["value"])
    for g in "abc":
        v = sorted(x for k, x in rows if k == g)
        want = sorted({v[math.floor(k * (len(v) - 1) / 16)] for k in range(1, 16)}) if len(v) > 1 else []
        assert sorted(got.get(g, [])) == want


def test_no_percentile_and_no_single_task_over_the_values(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("y"))
    found = selection.column_medians(df, ["x", "y"])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan and "median" not in plan.replace("AS median", "").replace("median#", "")
    assert tuple(found.first()) == (499.5, 3.0)


def test_columns_without_values(spark):
    df = spark.createDataFrame([(None, 2.0), (None, None)], "x double, y double")
    assert tuple(selection.column_medians(df, ["x", "y"]).first()) == (None, 2.0)
    assert tuple(selection.column_medians(df.limit(0), ["x", "y"]).first()) == (None, None)
