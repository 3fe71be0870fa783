"""Calendar, lag and rolling-mean features.

All lag and rolling columns share one window spec (partition store, dept;
order date), so the plan has a single Exchange + Sort + Window for them. A
partition is one weekly series, bounded by the number of weeks whatever the
data volume. Lags and rolling frames are row offsets, as in the published
pipeline: a missing week shifts them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftwise.config import LAGS, ROLLING_WINDOWS
from shiftwise.functions.calendar import calendar_columns


def series_window(keys=("store", "dept"), order="date"):
    return Window.partitionBy(*keys).orderBy(order)


def lag_columns(value="weekly_sales", lags=LAGS, keys=("store", "dept"), order="date"):
    w = series_window(keys, order)
    return {f"lag_{n}": F.lag(value, n).over(w) for n in lags}


def rolling_columns(value="weekly_sales", windows=ROLLING_WINDOWS, keys=("store", "dept"),
                    order="date"):
    """Mean of the previous ``n`` rows (shift 1, minimum one present value)."""
    w = series_window(keys, order)
    return {f"rolling_{n}_mean": F.avg(value).over(w.rowsBetween(-n, -1)) for n in windows}


def create_features(df: DataFrame, value: str = "weekly_sales", date: str = "date",
                    lags=LAGS, windows=ROLLING_WINDOWS) -> DataFrame:
    cols = calendar_columns(date)
    cols.update(lag_columns(value, lags, order=date))
    cols.update(rolling_columns(value, windows, order=date))
    return df.withColumns(cols)
