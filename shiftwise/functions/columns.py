"""Column-expression helpers built only from ``pyspark.sql.functions``.

Everything here returns a ``Column`` and stays inside whole-stage codegen;
no Python runs per row.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den) -> Column:
    """``num / NULLIF(den, 0)``: NULL instead of an ANSI divide-by-zero error."""
    return col(num) / F.nullif(col(den), F.lit(0))


def cap_at_zero(c) -> Column:
    """Negative values become 0; NULL stays NULL (pandas ``clip(lower=0)``)."""
    c = col(c)
    return F.when(c < 0, F.lit(0.0)).otherwise(c)


def greatest_or_null(c, floor=0.0) -> Column:
    """SQL ``GREATEST(c, floor)`` with NULL propagation.

    Spark's ``greatest`` skips NULL arguments; the mart semantics need a NULL
    input to stay NULL.
    """
    c = col(c)
    return F.when(c.isNotNull(), F.greatest(c, F.lit(floor)))


def map_with_default(c, mapping: Mapping, default) -> Column:
    """Dictionary lookup; NULL and unknown keys give ``default``."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col(c)), F.lit(default))


def is_truthy(c) -> Column:
    """True when the value reads as 'true' or '1' in any case; else False (never NULL)."""
    text = F.lower(col(c).cast("string"))
    return F.coalesce(text.isin("true", "1"), F.lit(False))


def bool_to_int(c) -> Column:
    """Holiday flag as 1/0 integer; anything that is not true/1 gives 0."""
    return F.when(is_truthy(c), F.lit(1)).otherwise(F.lit(0))


def normalize_name(name: str, slash: bool = False) -> str:
    """Trim, spaces and dashes to '_', optionally '/' to '_', lower case."""
    out = name.strip().replace(" ", "_").replace("-", "_")
    if slash:
        out = out.replace("/", "_")
    return out.lower()


def standardize_columns(df: DataFrame, slash: bool = False) -> DataFrame:
    """Rename every column to clean snake case (a metadata-only projection)."""
    return df.toDF(*[normalize_name(c, slash) for c in df.columns])


def normalize_bool_columns(df: DataFrame) -> DataFrame:
    """Boolean columns become 1/0 integers; ``is_holiday`` is read as text truth."""
    out = []
    for f in df.schema.fields:
        if f.name == "is_holiday":
            out.append(bool_to_int(f.name).alias(f.name))
        elif f.dataType.typeName() == "boolean":
            out.append(F.col(f.name).cast("int").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def slug(c) -> Column:
    """Lower-case, spaces and dashes to '_' (one output per model)."""
    return F.lower(F.regexp_replace(col(c), "[ -]", "_"))


def slug_text(name: str) -> str:
    return re.sub(r"[ -]", "_", name).lower()
