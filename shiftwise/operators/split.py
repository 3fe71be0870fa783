"""Time-based train / holdout split."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftwise.config import REQUIRED_MODEL_COLS


def holdout_start(df: DataFrame, weeks: int = 13, date: str = "date") -> Column:
    """max(date) - (weeks - 1) weeks, as a scalar subquery (max over ALL rows,
    taken before rows with missing lags are dropped)."""
    return F.date_sub(df.agg(F.max(date)).scalar(), 7 * (weeks - 1))


@dataclass
class Split:
    train: DataFrame
    holdout: DataFrame
    start: Column


def time_split(df: DataFrame, weeks: int = 13, date: str = "date",
               required=REQUIRED_MODEL_COLS, start: Column | None = None) -> Split:
    """``start`` may be given when a smaller table has the same dates (e.g. the
    weekly sales the feature table was built from), so the max is taken there."""
    if start is None:
        start = holdout_start(df, weeks, date)
    model_df = df.na.drop(how="any", subset=list(required))
    return Split(train=model_df.where(F.col(date) < start),
                 holdout=model_df.where(F.col(date) >= start),
                 start=start)


def split_summary(df: DataFrame, weeks: int = 13, date: str = "date",
                  start: Column | None = None) -> DataFrame:
    """One row per side: rows, first and last date, and the holdout start."""
    s = time_split(df, weeks, date, start=start)
    side = lambda part, name: part.agg(
        F.lit(name).alias("split"), F.count(F.lit(1)).alias("n_rows"),
        F.min(date).alias("first_date"), F.max(date).alias("last_date"))
    return (side(s.train, "train").unionByName(side(s.holdout, "holdout"))
            .withColumn("holdout_start", s.start))
