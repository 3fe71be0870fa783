"""Shared helpers of the corpus operators: words, written stages, distributed ranks.

Every operator selects the columns it needs first, so extra columns of the
input, also those named like an output column, never clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shiftwise.session import materialize

#: ASCII white space of the word rule [^\x20\x09-\x0D]+ (fixed value).
SPACE = "[\\x20\\x09-\\x0D]"
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def empty_if_null(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def words(text: Column) -> Column:
    """Array of the text's words. Only the ends can yield empty pieces, so those are trimmed first."""
    inner = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE + "+"))


def word_count(text: Column) -> Column:
    """Number of words without building them: word starts are counted by their first characters."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def text_crc32(c: str) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes (null text: of none, which is 0)."""
    return F.crc32(F.encode(empty_if_null(c), "UTF-8"))


def ordered(df: DataFrame, by: list, partitions: int, name: str) -> tuple[DataFrame, DataFrame]:
    """Rows in one global order without a single-task sort.

    Range-partitions on ``by`` plus a unique row number, so that equal keys,
    also repeated rows, spread over partitions; sorts inside each; and writes
    the rows with ``part`` (partition number) and ``row`` (place inside it).
    Returns the written rows and the list of partitions with their row counts.
    The list has as many rows as there are partitions.
    """
    numbered = materialize(df.withColumn("row_id", F.monotonically_increasing_id()), f"{name}_numbered")
    keys = [*by, F.col("row_id")]
    placed = (numbered.repartitionByRange(partitions, *keys).sortWithinPartitions(*keys)
              .withColumn("at", F.monotonically_increasing_id())
              .withColumn("part", F.shiftright("at", 33))
              .withColumn("row", F.col("at").bitwiseAND(F.lit((1 << 33) - 1)))
              .drop("at", "row_id"))
    placed = materialize(placed, f"{name}_ordered")
    return placed, placed.groupBy("part").agg(F.count(F.lit(1)).alias("part_rows"))


def global_rank(df: DataFrame, by: list, partitions: int, name: str) -> DataFrame:
    """``df`` with ``rank`` (long, from 0) in the order of ``by``; see :func:`ordered`.

    The offsets of the partitions come from a window over one row per
    partition, the only single-task step.
    """
    placed, parts = ordered(df, by, partitions, name)
    w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("part_rows").over(w), F.lit(0)).alias("before"))
    # one row per partition, a fixed number: safe to broadcast
    return (placed.join(F.broadcast(offsets), "part")
            .withColumn("rank", F.col("before") + F.col("row")).drop("part", "row", "before"))


def partitions_for(rows: int, per_task: int = 200_000, least: int = 8) -> int:
    """Tasks for ``rows`` narrow rows."""
    return max(least, -(-rows // per_task))
