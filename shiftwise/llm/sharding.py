"""Hilbert-curve sharding: nearby metadata in the same shard, equal row counts.

Several metadata dimensions (source, language, size, id) are quantised to
2**bits cells of about equal weight, the cells are numbered along a Hilbert
curve, rows are put in curve order and cut into runs. A filter on any of the
dimensions then touches few shards. Law ``rows``: counts differ by one at most.

Rows of equal text form a group and stand together, at the curve place of the
group's first row; only where a cut falls inside a group (one of ``shards - 1``
cuts) does it lie in two shards, or in more if it is larger than a shard.

Only DataFrame expressions run. Null dimensions take cell 0; null text has no
bytes; an empty table gives no rows; repeated rows are rows of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shiftwise.llm.common import empty_if_null, global_rank, partitions_for, table, text_crc32
from shiftwise.session import materialize

OVERHEAD = 16  # bytes a row counts besides its text


def hilbert_index(cells: list[Column], bits: int) -> Column:
    """Index along the Hilbert curve of a point with ``len(cells)`` coordinates below 2**bits.

    The coordinates are turned into the curve's transposed form one bit plane
    and one axis at a time (a fold over bits x axes steps), Gray-coded, and
    their bits interleaved.
    """
    n = len(cells)
    if n * bits > 62:
        raise ValueError("the index must fit a long")
    planes = [(1 << b, axis) for b in range(bits - 1, 0, -1) for axis in range(n)]
    point = F.array(*[c.cast("long") for c in cells])
    zero = F.lit(0).cast("long")

    def rotate(x: Column, step: Column) -> Column:
        q, axis = step["q"], step["axis"]
        low = q - 1
        first, own = x[0], F.get(x, axis)
        on = own.bitwiseAND(q) != 0
        swap = first.bitwiseXOR(own).bitwiseAND(low)

        def turned(v: Column, j: Column) -> Column:
            return (F.when(on, F.when(j == 0, v.bitwiseXOR(low)).otherwise(v))
                    .otherwise(F.when((j == 0) | (j == axis), v.bitwiseXOR(swap)).otherwise(v)))

        return F.transform(x, turned)

    if planes:
        steps = F.array(*[F.struct(F.lit(q).cast("long").alias("q"), F.lit(a).alias("axis")) for q, a in planes])
        point = F.aggregate(steps, point, rotate)
    gray = F.aggregate(point, F.array().cast("array<long>"), lambda seen, v: F.concat(
        seen, F.array(v.bitwiseXOR(F.coalesce(F.get(seen, F.size(seen) - 1), zero)))))
    # undo the excess: a bit set in the last axis flips all lower bits of every axis
    qs = F.array(*[F.lit(1 << b).cast("long") for b in range(bits - 1, 0, -1)]) if bits > 1 else \
        F.array().cast("array<long>")

    def finish(x: Column) -> Column:
        last = F.get(x, F.lit(n - 1))
        flips = F.aggregate(qs, zero, lambda t, q: F.when(last.bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t))
        return F.transform(x, lambda v: v.bitwiseXOR(flips))

    # interleave: the highest bit of every axis first
    taps = F.array(*[F.struct(F.lit(a).alias("axis"), F.lit(1 << b).cast("long").alias("q"))
                     for b in range(bits - 1, -1, -1) for a in range(n)])
    start = F.struct(zero.alias("k"), finish(gray).alias("x"))
    return F.aggregate(taps, start, lambda s, t: F.struct(
        (s["k"] * 2 + F.when(F.get(s["x"], t["axis"]).bitwiseAND(t["q"]) != 0, 1).otherwise(0)).alias("k"),
        s["x"].alias("x")))["k"]


def numeric_cells(df: DataFrame, cols: list[str], bits: int) -> dict[str, Column]:
    """Cell of each numeric column: how many of the 2**bits - 1 quantile cuts lie below the value."""
    share = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = df.agg(*[F.percentile_approx(c, share, 10_000).alias(c) for c in cols]).first()
    return {c: _cell(c, sorted(set(cuts[c] or []))) for c in cols}


def _cell(col: str, cuts: list) -> Column:
    if not cuts:
        return F.lit(0)
    below = F.filter(F.array(*[F.lit(v) for v in cuts]), lambda m: m < F.col(col))
    return F.when(F.col(col).isNull(), 0).otherwise(F.size(below))


def text_cells(df: DataFrame, col: str, bits: int, name: str) -> DataFrame:
    """Distinct values of a text column with their cell: values in code point order, 2**bits runs of them.

    The ranks are found without a single-task sort; one hot value is one row here.
    """
    values = materialize(df.select(F.col(col).alias("value")).distinct(), f"{name}_{col}")
    distinct = values.count()
    ranked = global_rank(values, [F.col("value").asc_nulls_first()], partitions_for(distinct, least=1), f"{name}_{col}")
    # spread the distinct values over the whole range of cells
    cell = F.floor(F.col("rank") * F.lit(1 << bits) / F.lit(max(1, distinct)))
    return ranked.select("value", cell.cast("int").alias("cell"))


def hilbert_shards(docs: DataFrame, shards: int = 40, bits: int = 5, id_col: str = "doc_id",
                   text_col: str = "text", text_dims: tuple = ("source", "lang")) -> DataFrame:
    """Every row with its shard (0 to shards - 1) and slot (its place there).

    Columns: doc_id, size, text_crc32, law, shard, slot, grown_shard (null:
    only the law ``key`` has one), curve (Hilbert index).
    """
    base = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(empty_if_null(text_col)) + OVERHEAD).cast("long").alias("size"),
        text_crc32(text_col).alias("text_crc32"),
        *[F.xxhash64(F.lit(seed), empty_if_null(text_col)).alias(f"group{seed}") for seed in (1, 2)], *text_dims)
    base = materialize(base, "shard_rows")
    cells = numeric_cells(base, ["size", "doc_id"], bits)
    for dim in text_dims:
        codes = text_cells(base, dim, bits, "shard").withColumnRenamed("value", f"value_{dim}")
        base = base.join(codes.withColumnRenamed("cell", f"cell_{dim}"),
                         F.col(dim).eqNullSafe(F.col(f"value_{dim}")), "left")
    index = hilbert_index([*[F.coalesce(F.col(f"cell_{d}"), F.lit(0)) for d in text_dims],
                           cells["size"], cells["doc_id"]], bits)
    group = ["group1", "group2"]
    own = materialize(base.select("doc_id", "size", "text_crc32", *group, index.alias("own")), "shard_curve")
    # only texts that come more than once; a hot one is one row here, and its copies are split by the skew join
    first = own.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "own")).alias("first"))
    first = first.where("n > 1").select(*group, F.col("first.own").alias("shared"))
    placed = own.join(first, group, "left").withColumn("curve", F.coalesce("shared", "own")).drop("own", "shared")
    n = base.count()
    ranked = global_rank(placed, [F.col("curve"), *group, F.col("doc_id").asc_nulls_first()], partitions_for(n), "shard")
    # the first n % shards shards hold one row more
    small, more = divmod(n, shards)
    edge = more * (small + 1)
    past = F.col("rank") - F.lit(edge)
    shard = F.when(past < 0, F.floor(F.col("rank") / (small + 1))).otherwise(
        F.lit(more) + F.floor(past / max(small, 1))).cast("int")
    slot = F.when(past < 0, F.col("rank") % (small + 1)).otherwise(past % max(small, 1))
    return ranked.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), shard.alias("shard"),
                         slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards(table(spark, sf_dir, "documents"))
