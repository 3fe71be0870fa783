"""Category dictionary, codes and sparse one-hot vectors.

The dictionary is a table: (column, value, code), codes from 1 in the order of
the values' text. A value unseen in it, or null, has code 0 and sets nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def category_dictionary(df: DataFrame, cols) -> DataFrame:
    """(column, value, code) of the values that occur; one row per category."""
    seen = (df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "column", "value")
            .where("value is not null").distinct())
    return seen.withColumn("code", F.row_number().over(Window.partitionBy("column").orderBy("value")))


def with_codes(df: DataFrame, dictionary: DataFrame, cols) -> DataFrame:
    """Adds ``<col>_code`` (int); plain equality joins, whose side the planner sizes at run time."""
    for c in cols:
        side = dictionary.where(F.col("column") == c).select(F.col("value").alias("_value"), F.col("code").alias("_code"))
        df = (df.join(side, F.col(c).cast("string") == F.col("_value"), "left")
              .withColumn(f"{c}_code", F.coalesce("_code", F.lit(0))).drop("_value", "_code"))
    return df


def offsets(dictionary: DataFrame, cols) -> list[int]:
    """Where each column's block of the vector begins, and at last the vector's size; one number a column is collected."""
    sizes = {r["column"]: r["n"] for r in dictionary.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = [0]
    for c in cols:
        out.append(out[-1] + sizes.get(c, 0))
    return out


def onehot(df: DataFrame, dictionary: DataFrame, cols) -> DataFrame:
    """Adds ``onehot_size`` and ``onehot_indices``: the places (from 0, ascending) that are 1, one per seen category."""
    starts = offsets(dictionary, cols)
    coded = with_codes(df, dictionary, cols)
    places = F.array(*[F.when(F.col(f"{c}_code") > 0, F.col(f"{c}_code") - 1 + starts[i]) for i, c in enumerate(cols)])
    return (coded.withColumns({"onehot_size": F.lit(starts[-1]), "onehot_indices": F.array_compact(places)})
            .drop(*[f"{c}_code" for c in cols]))


def dense(size: str = "onehot_size", indices: str = "onehot_indices"):
    """The sparse vector as an array of 0.0 and 1.0."""
    return F.transform(F.sequence(F.lit(1), F.col(size)), lambda i: F.array_contains(F.col(indices), i - 1).cast("double"))
