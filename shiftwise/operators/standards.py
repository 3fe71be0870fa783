"""Department productivity standards from sales volume."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftwise.config import LaborConfig
from shiftwise.functions.columns import cap_at_zero
from shiftwise.operators.selection import medians
from shiftwise.session import materialize


def dept_stats(sales: DataFrame, value: str = "weekly_sales") -> DataFrame:
    """Exact (interpolated) median and mean of capped weekly sales per department.

    The median comes from distributed selection, so no task holds a whole
    department's values; a department without any value has a NULL median.
    """
    capped = sales.select("dept", cap_at_zero(value).alias("v"))
    middle = medians(capped, ["dept"], "v", "median_weekly_sales").withColumnRenamed("dept", "_dept")
    means = capped.groupBy("dept").agg(F.avg("v").alias("avg_weekly_sales"))
    return means.join(middle, F.col("dept").eqNullSafe(F.col("_dept")), "left").select(
        "dept", "median_weekly_sales", "avg_weekly_sales")


def volume_cutoffs(stats: DataFrame, cfg: LaborConfig = LaborConfig()) -> DataFrame:
    """Linear-interpolated quantiles of the department medians (one row)."""
    return stats.agg(
        F.percentile("median_weekly_sales", cfg.low_quantile).alias("low_cutoff"),
        F.percentile("median_weekly_sales", cfg.high_quantile).alias("high_cutoff"))


def labor_standards(sales: DataFrame, cfg: LaborConfig = LaborConfig(),
                    keep_stats: bool = False) -> DataFrame:
    stats = materialize(dept_stats(sales), "dept_stats")  # one row per department, read three times
    cut = volume_cutoffs(stats, cfg)
    low = cut.select("low_cutoff").scalar()
    high = cut.select("high_cutoff").scalar()
    (hi_name, hi_t), (mid_name, mid_t), (lo_name, lo_t) = cfg.tier_targets
    m = F.col("median_weekly_sales")
    tier = F.when(m >= high, F.lit(hi_name)).when(m >= low, F.lit(mid_name)).otherwise(F.lit(lo_name))
    out = stats.withColumn("volume_tier", tier)
    t = F.col("volume_tier")
    out = out.withColumn("target_sales_per_labor_hour",
                         F.when(t == hi_name, F.lit(hi_t)).when(t == mid_name, F.lit(mid_t))
                         .otherwise(F.lit(lo_t)))
    if keep_stats:
        return out
    return out.select("dept", "volume_tier", "target_sales_per_labor_hour")
