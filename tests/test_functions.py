from pyspark.sql import functions as F

from shiftwise.functions.columns import (bool_to_int, cap_at_zero, greatest_or_null, is_truthy,
                                         map_with_default, normalize_bool_columns, normalize_name,
                                         safe_div, slug, slug_text, standardize_columns)


def test_cap_at_zero_keeps_null(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (0.0,), (5.0,)], "x double")
    got = [r[0] for r in df.select(cap_at_zero("x")).collect()]
    assert got == [None, 0.0, 0.0, 5.0]


def test_greatest_or_null_propagates_null(spark):
    df = spark.createDataFrame([(None,), (-3.0,), (2.0,)], "x double")
    got = [r[0] for r in df.select(greatest_or_null("x")).collect()]
    assert got == [None, 0.0, 2.0]
    # the plain built-in skips NULL, which is why the guard exists
    assert df.select(F.greatest("x", F.lit(0.0))).first()[0] == 0.0


def test_safe_div_returns_null_on_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(safe_div("a", "b")).collect()] == [None, None, 1.5]


def test_map_with_default(spark):
    df = spark.createDataFrame([("A",), ("B",), ("C",), (None,), ("Z",)], "t string")
    got = [r[0] for r in df.select(map_with_default("t", {"A": 0.98, "B": 0.95, "C": 0.92}, 0.95)).collect()]
    assert got == [0.98, 0.95, 0.92, 0.95, 0.95]


def test_truth_test_on_text_and_numbers(spark):
    df = spark.createDataFrame([("true",), ("false",), ("TRUE",), ("1",), ("0",), ("x",), (None,)], "h string")
    assert [r[0] for r in df.select(is_truthy("h")).collect()] == [True, False, True, True, False, False, False]
    assert [r[0] for r in df.select(bool_to_int("h")).collect()] == [1, 0, 1, 1, 0, 0, 0]
    b = spark.createDataFrame([(True,), (False,), (None,)], "h boolean")
    assert [r[0] for r in b.select(bool_to_int("h")).collect()] == [1, 0, 0]


def test_name_normalization():
    assert normalize_name(" Weekly Sales ") == "weekly_sales"
    assert normalize_name("Fuel-Price") == "fuel_price"
    assert normalize_name("IsHoliday") == "isholiday"  # lower-casing adds no underscore
    assert normalize_name("A/B", slash=True) == "a_b"
    assert normalize_name("A/B") == "a/b"


def test_standardize_and_bool_columns(spark):
    df = spark.createDataFrame([(1, True, "TRUE"), (2, False, "x")], "`Store Id` int, flag boolean, `is-holiday` string")
    df = standardize_columns(df)
    assert df.columns == ["store_id", "flag", "is_holiday"]
    out = normalize_bool_columns(df).collect()
    assert [(r.flag, r.is_holiday) for r in out] == [(1, 1), (0, 0)]


def test_slug(spark):
    df = spark.createDataFrame([("Ridge Regression",), ("Gradient-Boosted Trees",)], "m string")
    assert [r[0] for r in df.select(slug("m")).collect()] == ["ridge_regression", "gradient_boosted_trees"]
    assert slug_text("Seasonal Naive") == "seasonal_naive"
