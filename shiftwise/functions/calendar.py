"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shiftwise.functions.columns import col

# ISO weeks that count as holiday weeks in the derived inputs.
HOLIDAY_ISO_WEEKS = (6, 22, 27, 36, 47, 52)


def monday(ts) -> Column:
    """Monday of the ISO week containing ``ts``, as a DATE (date arithmetic
    only, no timestamp truncation per row)."""
    return F.trunc(F.to_date(col(ts)), "week")


def is_holiday_week(d) -> Column:
    return F.weekofyear(col(d)).isin(*HOLIDAY_ISO_WEEKS)


def calendar_columns(d="date") -> dict[str, Column]:
    """year, month, ISO week, quarter and a December flag."""
    c = col(d)
    return {
        "year": F.year(c),
        "month": F.month(c),
        "weekofyear": F.weekofyear(c),
        "quarter": F.quarter(c),
        "is_december": (F.month(c) == 12).cast("int"),
    }
