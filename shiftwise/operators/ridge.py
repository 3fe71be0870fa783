"""Ridge regression by its normal equations, exact for categories of any number of values.

min ||y - Xw - b||^2 + alpha ||w||^2 over numeric columns and the one-hot columns
of some categories; the intercept carries no penalty. X'X and X'y are sums of
the rows' outer products, added up inside each task and then over the tasks.

One-hot columns of one category never meet in a row, so the block of the widest
category is diagonal. It is eliminated: with b_v the sums of the other columns
over the rows of value v (n_v of them) and r_v the sum of the label, the rest solves

    (A - sum_v b_v b_v' / (n_v + alpha)) w = r - sum_v b_v r_v / (n_v + alpha)

and w_v = (r_v - b_v'w) / (n_v + alpha). Only the system of the rest reaches the
driver (at most ``LIMIT`` columns); the b_v and w_v are tables.

Numeric columns and the label are centred on their means first, which leaves the
solution as it is and keeps the sums small. Rows with a null label take no part.
A category that is null or was not seen in training adds nothing. Numeric columns
must have no nulls (``models.impute``). An empty training table raises ValueError.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftwise.operators.categories import offsets, with_codes
from shiftwise.session import materialize

#: Columns of the system solved on the driver: numeric ones, intercept, and all categories but the widest.
LIMIT = 2048
CELLS = 1 << 22  # cells of the dense block that a task multiplies at a time


def _partial_outer(size: int):
    """Sum of weight * row * row' over a task's sparse rows: its upper triangle as (i, j, value)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, step = np.zeros((size, size)), max(1, CELLS // size)
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                lengths = part.column("places").value_lengths().to_numpy(zero_copy_only=False)
                rows = np.zeros((part.num_rows, size))
                rows[np.repeat(np.arange(part.num_rows), lengths), part.column("places").flatten().to_numpy()] = (
                    part.column("amounts").flatten().to_numpy())
                total += (rows * part.column("weight").to_numpy()[:, None]).T @ rows
        i, j = np.nonzero(np.triu(total))
        yield pa.record_batch({"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "value": pa.array(total[i, j])})
    return run


def weighted_outer(rows: DataFrame, size: int) -> DataFrame:
    """(i, j, value), i <= j: sum of weight * row * row' over sparse rows (places, amounts, weight)."""
    parts = rows.select("places", "amounts", "weight").mapInArrow(_partial_outer(size), "i int, j int, value double")
    return parts.groupBy("i", "j").agg(F.sum("value").alias("value"))


@dataclass(frozen=True)
class Design:
    """Training rows as sparse vectors: intercept, centred numeric columns, one-hot categories, centred label."""

    rows: DataFrame  # places, amounts, weight, wide (the eliminated category's value, or null)
    names: list  # of the places before the label, (column, value) for categories
    means: dict
    label_mean: float
    wide: str | None

    @property
    def size(self) -> int:
        return len(self.names) + 1

    @cached_property
    def by_wide(self) -> DataFrame:
        """(wide, places, amounts, n): the sums of the other columns over the rows of each value; read twice, so written."""
        cells = self.rows.where("wide is not null").select("wide", F.explode(F.arrays_zip("places", "amounts")).alias("x"))
        sums = cells.groupBy("wide", F.col("x.places").alias("place")).agg(F.sum("x.amounts").alias("amount"))
        found = F.array_sort(F.collect_list(F.struct("place", "amount")))  # no more than ``size`` entries
        packed = sums.groupBy("wide").agg(found.alias("cells"))
        return materialize(packed.select(
            "wide", F.col("cells.place").alias("places"), F.col("cells.amount").alias("amounts"),
            F.get("cells", F.lit(0))["amount"].alias("n")), "ridge_sums")


def design(train: DataFrame, numeric, categories, dictionary: DataFrame, label: str, eliminate: bool = True) -> Design:
    """``eliminate`` takes the category with the most values out of the vectors."""
    numeric, categories = list(numeric), list(categories)
    train = train.where(F.col(label).isNotNull())
    means = train.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in [*numeric, label]]).first().asDict()
    if means[label] is None:
        raise ValueError("no training rows")
    starts = offsets(dictionary, categories)
    sizes = {c: starts[k + 1] - starts[k] for k, c in enumerate(categories)}
    wide = max(categories, key=lambda c: (sizes[c], c)) if eliminate and categories else None
    kept = [c for c in categories if c != wide]
    size = 2 + len(numeric) + sum(sizes[c] for c in kept)
    if size > LIMIT:
        raise ValueError(f"{size} columns besides the widest category; at most {LIMIT} (use models.ridge_pipeline)")
    codes = {(r["column"], r["code"]): r["value"] for r in dictionary.where(F.col("column").isin(*kept)).collect()} if kept else {}
    names, at = ["intercept", *numeric], {}
    for c in kept:
        at[c] = len(names)
        names += [(c, codes[c, k]) for k in range(1, sizes[c] + 1)]
    coded = with_codes(train, dictionary, kept)
    ones = F.array_compact(F.array(*[F.when(F.col(f"{c}_code") > 0, F.col(f"{c}_code") + (at[c] - 1)) for c in kept])
                           ) if kept else F.array().cast("array<int>")

    def centred(c: str) -> Column:
        return F.col(c).cast("double") - F.lit(means[c])

    rows = coded.select(
        F.concat(F.array(*[F.lit(k) for k in range(1 + len(numeric))]), ones, F.array(F.lit(size - 1))).alias("places"),
        F.concat(F.array(F.lit(1.0), *[centred(c) for c in numeric]), F.transform(ones, lambda _: F.lit(1.0)),
                 F.array(centred(label))).alias("amounts"),
        F.lit(1.0).alias("weight"), (F.col(wide).cast("string") if wide else F.lit(None).cast("string")).alias("wide"))
    return Design(rows, names, {c: means[c] for c in numeric}, means[label], wide)


@dataclass(frozen=True)
class RidgeModel:
    numeric: dict  # column -> weight
    means: dict
    intercept: float  # at the means
    categories: DataFrame  # (column, value, coefficient), written


def _matrix(entries: DataFrame, size: int) -> np.ndarray:
    got = entries.toPandas()
    out = np.zeros((size, size))
    out[got["i"], got["j"]] = got["value"]
    return out + np.triu(out, 1).T


def solve(d: Design, alpha: float) -> tuple[np.ndarray, DataFrame | None]:
    """Weights of the kept columns, and (value, coefficient) of the eliminated category."""
    parts = weighted_outer(d.rows, d.size)
    if d.wide:
        taken = weighted_outer(d.by_wide.select("places", "amounts", (F.lit(-1.0) / (F.col("n") + alpha)).alias("weight")), d.size)
        parts = parts.unionByName(taken).groupBy("i", "j").agg(F.sum("value").alias("value"))
    whole = _matrix(parts, d.size)
    a, r = whole[:-1, :-1].copy(), whole[:-1, -1]
    a[np.arange(1, len(a)), np.arange(1, len(a))] += alpha  # all but the intercept
    scale = 1.0 / np.sqrt(np.maximum(np.diag(a), np.finfo(float).tiny))
    w = scale * np.linalg.lstsq(a * scale[:, None] * scale, r * scale, rcond=1e-15)[0]
    if not d.wide:
        return w, None
    weights = F.array(*[F.lit(float(x)) for x in w], F.lit(-1.0))  # the label's place turns its sum into r_v
    against = F.aggregate(F.zip_with("places", "amounts", lambda i, x: F.get(weights, i) * x), F.lit(0.0), lambda s, x: s + x)
    return w, d.by_wide.select(F.col("wide").alias("value"), (-against / (F.col("n") + alpha)).alias("coefficient"))


def fit_ridge(train: DataFrame, numeric, categories, dictionary: DataFrame, label: str, alpha: float) -> RidgeModel:
    d = design(train, numeric, categories, dictionary, label)
    w, eliminated = solve(d, alpha)
    table = train.sparkSession.createDataFrame(
        [(*name, float(x)) for name, x in zip(d.names, w) if isinstance(name, tuple)],
        "column string, value string, coefficient double")
    if eliminated is not None:
        table = table.unionByName(eliminated.select(F.lit(d.wide).alias("column"), "value", "coefficient"))
    numbers = {name: float(x) for name, x in zip(d.names[1:], w[1:]) if isinstance(name, str)}
    return RidgeModel(numbers, d.means, d.label_mean + float(w[0]), materialize(table, "ridge_coefficients"))


def with_prediction(model: RidgeModel, df: DataFrame, categories, out: str = "prediction") -> DataFrame:
    """Adds the model's value; the category joins are plain, so the planner sizes their small side."""
    total = F.lit(model.intercept)
    for c, w in model.numeric.items():
        total = total + (F.col(c).cast("double") - F.lit(model.means[c])) * F.lit(w)
    for c in categories:
        side = model.categories.where(F.col("column") == c).select(
            F.col("value").alias(f"_{c}_value"), F.col("coefficient").alias(f"_{c}_weight"))
        df = df.join(side, F.col(c).cast("string") == F.col(f"_{c}_value"), "left")
        total = total + F.coalesce(f"_{c}_weight", F.lit(0.0))
    return df.withColumn(out, total).drop(*[f"_{c}_{k}" for c in categories for k in ("value", "weight")])


def _named(names: list, numeric_suffix: str = "_imp") -> Column:
    """A place's feature name: the column, or column=value for a category."""
    return F.array(*[F.lit(n.removesuffix(numeric_suffix) if isinstance(n, str) else f"{n[0]}={n[1]}") for n in names])


def gram(train: DataFrame, numeric, categories, dictionary: DataFrame, label: str) -> DataFrame:
    """(feature_a, feature_b, cosine): the entries of the centred X'X and X'y other than 0, over the lengths of both columns.

    All categories take part, none is eliminated; the intercept is left out.
    """
    d = design(train, numeric, categories, dictionary, label, eliminate=False)
    entries = materialize(weighted_outer(d.rows, d.size).where("i > 0 and value <> 0"), "ridge_gram")
    lengths = entries.where("i = j").select(F.col("i").alias("k"), F.sqrt("value").alias("length"))
    names = _named([*d.names, label])
    a, b = lengths.toDF("i", "length_i"), lengths.toDF("j", "length_j")
    first, second = F.get(names, F.col("i")), F.get(names, F.col("j"))
    return entries.join(a, "i").join(b, "j").select(
        F.least(first, second).alias("feature_a"), F.greatest(first, second).alias("feature_b"),
        (F.col("value") / F.col("length_i") / F.col("length_j")).alias("cosine"))


def residuals(model: RidgeModel, train: DataFrame, categories, label: str, alpha: float) -> DataFrame:
    """(feature, gap): |x'(y - Xw - b) - alpha w| of each column, over the column's length and the label's; 0 at the solution.

    Taken from the training rows anew, so it checks the sums, the elimination and the solution together.
    """
    numeric = list(model.numeric)
    miss = F.col(label) - F.col("_fit")
    rows = with_prediction(model, train.where(F.col(label).isNotNull()), categories, "_fit")
    cells = rows.select(
        miss.alias("miss"), F.col(label).cast("double").alias("y"),
        F.explode(F.concat(
            F.array(*[F.struct(F.lit(c).alias("column"), F.lit(None).cast("string").alias("value"),
                               (F.col(c).cast("double") - F.lit(model.means[c])).alias("x")) for c in numeric]),
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"), F.lit(1.0).alias("x"))
                      for c in categories]))).alias("cell"))
    sums = cells.groupBy("cell.column", "cell.value").agg(
        F.sum(F.col("cell.x") * F.col("miss")).alias("pull"), F.sum(F.col("cell.x") * F.col("cell.x")).alias("square"),
        F.sum(F.col("y") * F.col("y")).alias("label_square"))
    numbers = train.sparkSession.createDataFrame([(c, None, float(w)) for c, w in model.numeric.items()],
                                                 "column string, value string, coefficient double")
    weights = numbers.unionByName(model.categories).toDF("_column", "_value", "coefficient")
    same = (F.col("column") == F.col("_column")) & F.col("value").eqNullSafe(F.col("_value"))
    length = F.sqrt(F.col("square")) * F.sqrt(F.col("label_square"))
    return sums.join(weights, same).select(
        F.concat(F.regexp_replace("column", "_imp$", ""), F.coalesce(F.concat(F.lit("="), "value"), F.lit(""))).alias("feature"),
        F.coalesce(F.abs(F.col("pull") - F.lit(alpha) * F.col("coefficient")) / F.nullif(length, F.lit(0.0)), F.lit(0.0)).alias("gap"))
