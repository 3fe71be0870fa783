"""Exact order statistics by distributed selection.

``percentile`` keeps a value -> count map of a whole group in one task; here no
task holds more than its share of the distinct values:

1. equal values of a group are counted (partial aggregation first);
2. the counted values are range-partitioned on (group, value);
3. every partition gives one count per group it holds, and a running sum over
   those few rows says how many values of the group lie before the partition;
4. each distinct value then knows the ranks it covers, and only the rows that
   cover a wanted rank are kept.

Null values take no part, a null group is a group. Groups of no value at all
have no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftwise.session import materialize


def placed(values: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """One row per distinct value of each group: keys, value, n (how often), before (values below it), total."""
    counted = values.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    counted = materialize(counted, "selection_counts")  # read twice: once to find the ranges
    ranged = materialize(counted.repartitionByRange(*keys, value).withColumn("part", F.spark_partition_id()),
                         "selection_ranges")
    sums = ranged.groupBy("part", *keys).agg(F.sum("n").alias("part_n"))
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # at most one row per partition
    offsets = sums.select(F.col("part").alias("_part"), *[F.col(k).alias(f"_{k}") for k in keys],
                          F.coalesce(F.sum("part_n").over(earlier), F.lit(0)).alias("ahead"),
                          F.sum("part_n").over(whole).alias("total"))
    inside = Window.partitionBy("part", *keys).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("local", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    same = F.col("part") == F.col("_part")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return local.join(offsets, same).select(*keys, value, "n", (F.col("ahead") + F.col("local")).alias("before"), "total")


def quantiles(values: DataFrame, keys: list[str], share: float = 0.5, value: str = "value",
              out: str = "quantile") -> DataFrame:
    """Per group the linearly interpolated quantile at ``share``, as ``percentile`` defines it."""
    at = (F.col("total") - 1) * F.lit(float(share))
    low, high = F.floor(at), F.ceil(at)

    def covers(rank: Column) -> Column:
        return (F.col("before") <= rank) & (rank < F.col("before") + F.col("n"))

    near = placed(values, keys, value).where(covers(low) | covers(high))  # two rows of a group at most
    picked = near.groupBy(*keys).agg(
        F.max(F.when(covers(low), F.col(value))).alias("_low"), F.max(F.when(covers(high), F.col(value))).alias("_high"),
        F.max(at - low).alias("_share"))
    between = (F.lit(1.0) - F.col("_share")) * F.col("_low") + F.col("_share") * F.col("_high")
    return picked.select(*keys, F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(between).alias(out))


def medians(values: DataFrame, keys: list[str], value: str = "value", out: str = "median") -> DataFrame:
    return quantiles(values, keys, 0.5, value, out)


def column_values(df: DataFrame, cols) -> DataFrame:
    """(column, value): the columns' values as doubles, one row each."""
    return df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], list(cols), "column", "value")


def column_medians(df: DataFrame, cols) -> DataFrame:
    """One row with the exact median of each column (null where a column has no value)."""
    found = medians(column_values(df, cols), ["column"])
    return found.agg(*[F.max(F.when(F.col("column") == c, F.col("median"))).alias(c) for c in cols])


def cuts(values: DataFrame, keys: list[str], parts: int, value: str = "value") -> DataFrame:
    """(keys, value): the distinct values at ranks floor(k * (total - 1) / parts), k = 1 .. parts - 1.

    A value that covers ranks before .. before + n - 1 is a cut if some k falls among them, which whole-number
    division tells without looking at the k one by one.
    """
    def least(rank: str) -> Column:
        """The smallest k with k * (total - 1) / parts >= rank."""
        return F.expr(f"(({rank}) * {parts} + total - 2) div nullif(total - 1, 0)")

    first, beyond = F.greatest(least("before"), F.lit(1)), F.least(least("before + n"), F.lit(parts))
    return placed(values, keys, value).where((F.col("total") > 1) & (first < beyond)).select(*keys, value)
