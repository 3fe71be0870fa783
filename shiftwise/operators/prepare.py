"""Join and clean the three inputs into one store x dept x week modeling table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftwise.config import EXTERNAL_COLS, MARKDOWN_COLS
from shiftwise.functions.columns import cap_at_zero


def join_inputs(sales: DataFrame, stores: DataFrame, features: DataFrame) -> DataFrame:
    """sales LEFT JOIN stores ON store, LEFT JOIN features ON (store, date, is_holiday)."""
    df = sales.join(stores, "store", "left")
    return df.join(features, ["store", "date", "is_holiday"], "left")


def cap_sales(df: DataFrame, col: str = "weekly_sales",
              audit_col: str = "weekly_sales_original") -> DataFrame:
    """Keep the original value for audit, then cap negatives at zero (NULL stays NULL)."""
    return df.withColumns({audit_col: F.col(col), col: cap_at_zero(col)})


def fill_markdowns(df: DataFrame, cols=MARKDOWN_COLS) -> DataFrame:
    """A missing markdown means no markdown was active."""
    return df.fillna(0.0, subset=list(cols))


def fill_externals(df: DataFrame, cols=EXTERNAL_COLS, store: str = "store",
                   dept: str = "dept", date: str = "date") -> DataFrame:
    """Forward fill within store in (dept, date) order, then backward fill in
    global (store, dept, date) order, so a store's leading gap takes the first
    later value, possibly from the next store.

    Computed without a window over a whole store or the whole table:
      1. forward fill inside each (store, dept) series (same window
         partitioning as the lag features);
      2. per series, its first and last present value (one small row per series);
      3. on that small table, the value carried from earlier departments of the
         store and the first value at or after this store;
      4. join the small table back on (store, dept) and coalesce.
    """
    cols = list(cols)
    upto = Window.partitionBy(store, dept).orderBy(date).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    filled = df.withColumns({f"__ff_{c}": F.last(c, ignorenulls=True).over(upto) for c in cols})
    # first / last present value per series: min_by / max_by skip rows whose
    # ordering is NULL. Grouping by the window's own partition keys needs no
    # further exchange of the fact table.
    summary = filled.groupBy(store, dept).agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(date))).alias(f"__first_{c}") for c in cols],
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(date))).alias(f"__last_{c}") for c in cols])

    earlier = Window.partitionBy(store).orderBy(dept).rowsBetween(Window.unboundedPreceding, -1)
    whole_store = Window.partitionBy(store).orderBy(dept).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    carried = summary.select(
        store, dept,
        *[F.last(f"__last_{c}", ignorenulls=True).over(earlier).alias(f"__carry_{c}") for c in cols],
        *[F.first(f"__first_{c}", ignorenulls=True).over(whole_store).alias(f"__sfirst_{c}")
          for c in cols],
    )
    # One row per store; ordered over all stores. The table has one row per
    # store, so the single-partition window is bounded by the store count.
    per_store = carried.groupBy(store).agg(
        *[F.max(f"__sfirst_{c}").alias(f"__sfirst_{c}") for c in cols])
    later_stores = Window.orderBy(store).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    backfill = per_store.select(
        store, *[F.first(f"__sfirst_{c}", ignorenulls=True).over(later_stores).alias(f"__back_{c}")
                 for c in cols])
    fills = carried.join(backfill, store).select(
        store, dept, *[f"__carry_{c}" for c in cols], *[f"__back_{c}" for c in cols])

    out = filled.join(fills, [store, dept], "left")
    out = out.withColumns({c: F.coalesce(f"__ff_{c}", f"__carry_{c}", f"__back_{c}") for c in cols})
    return out.drop(*[f"__{p}_{c}" for p in ("ff", "carry", "back") for c in cols])


def prepare_modeling_data(sales: DataFrame, stores: DataFrame, features: DataFrame) -> DataFrame:
    """Join, keep an audit copy of sales, cap negatives, fill markdowns and externals."""
    df = join_inputs(sales, stores, features)
    df = cap_sales(df)
    df = fill_markdowns(df)
    return fill_externals(df)
