"""Reference-shaped inputs derived from the TPC-H-style tables.

sales    store x dept x week   (lineitem, part, supplier)
stores   store                 (nation)
features store x week          (orders, customer)
test     store x dept x future week

Heavy work is two scans with joins and a partial (map-side) aggregation down
to weekly grain; everything after that is small. Money is summed exactly and
converted to double once, so any engine gives the same bits. The per-row math
runs on 64-bit integers (cents, discount points) rather than wide decimals:
the values are the same as DECIMAL(18,2) arithmetic, but no per-row
BigDecimal objects are created, which matters at billions of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftwise.functions.calendar import is_holiday_week, monday

# Department number by the first word of p_type.
DEPT_BY_TYPE = {"ECONOMY": 1, "LARGE": 2, "MEDIUM": 3, "PROMO": 4, "SMALL": 5, "STANDARD": 6}
# Store type by region key modulo 3; size = 40000 + 7000 * nation key.
STORE_TYPES = ("A", "B", "C")
SIZE_BASE, SIZE_STEP = 40000, 7000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _dept_expr(type_col: str, grain: str = "type", brand_col: str = "p_brand"):
    """Department number from the first word of the type (NULL when unknown).

    ``grain="brand_type"`` gives the larger variant used for volume benches:
    brand number * 10 + type number (e.g. Brand#13, PROMO -> 134).
    """
    word = F.split_part(F.col(type_col), F.lit(" "), F.lit(1))
    pairs = [x for k, v in DEPT_BY_TYPE.items() for x in (F.lit(k), F.lit(v))]
    kind = F.try_element_at(F.create_map(*pairs), word)
    if grain == "type":
        return kind
    if grain == "brand_type":
        brand = F.regexp_extract(F.col(brand_col), r"#(\d+)", 1).try_cast("int")
        return brand * 10 + kind
    raise ValueError(f"unknown department grain {grain!r}")


def cents(c) -> "F.Column":
    """A double money value rounded half-up to cents (as DECIMAL(x,2)), as a long."""
    return (F.col(c).cast("decimal(15,2)") * 100).cast("bigint")


def exact_ratio(units, scale: int) -> "F.Column":
    """``units / 10**scale`` as the double nearest to the exact decimal value."""
    return (units.cast("decimal(38,0)") / F.lit(10 ** scale)).cast("double")


def derive_sales(spark: SparkSession, sf_dir: str, grain: str = "type") -> DataFrame:
    """Weekly sales per (store, dept); returned-and-filled lines count negative.

    Every line counts: one of an unknown part or supplier has a NULL dept or store."""
    sign = F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"),
                  F.lit(-1)).otherwise(F.lit(1))
    # price (cents) x (100 - discount points): exact amount in 1/10000 units
    points = (F.col("l_discount").cast("decimal(4,2)") * 100).cast("bigint")
    amount = cents("l_extendedprice") * (F.lit(100) - points) * sign
    lines = (
        table(spark, sf_dir, "lineitem")
        .select("l_partkey", "l_suppkey",
                monday("l_shipdate").alias("date"), amount.alias("amount"))
    )
    part = (table(spark, sf_dir, "part")
            .select(F.col("p_partkey"), _dept_expr("p_type", grain).alias("dept")))
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("store"))
    joined = (lines
              .join(part, lines.l_partkey == part.p_partkey, "left")
              .join(supplier, lines.l_suppkey == supplier.s_suppkey, "left"))
    return (joined.groupBy("store", "dept", "date")
            .agg(exact_ratio(F.sum("amount"), 4).alias("weekly_sales"))
            .withColumn("is_holiday", is_holiday_week("date")))


def derive_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    kind = F.element_at(F.array(*[F.lit(t) for t in STORE_TYPES]),
                        (F.col("n_regionkey") % 3 + 1).cast("int"))
    return n.select(
        F.col("n_nationkey").alias("store"),
        kind.alias("type"),
        (F.lit(SIZE_BASE) + F.lit(SIZE_STEP) * F.col("n_nationkey")).alias("size"),
    )


def derive_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store x week external features from orders and customers."""
    o = table(spark, sf_dir, "orders").select(
        "o_custkey", monday("o_orderdate").alias("date"),
        cents("o_totalprice").alias("price"), "o_orderpriority")
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("store"), cents("c_acctbal").alias("acctbal"))
    j = o.join(c, o.o_custkey == c.c_custkey)
    n = F.count(F.lit(1))
    aggs = [
        (exact_ratio(F.sum("price"), 2) / n).alias("temperature"),
        (exact_ratio(F.max("price"), 2) / 1000).alias("fuel_price"),
        exact_ratio(F.min("price"), 2).alias("cpi"),
        F.when(n >= 2, exact_ratio(F.sum("acctbal"), 2) / n).alias("unemployment"),
    ]
    for k in range(1, 6):
        aggs.append(exact_ratio(F.sum(F.when(F.col("o_orderpriority").startswith(str(k)),
                                             F.col("price"))), 2).alias(f"markdown{k}"))
    g = j.groupBy("store", "date").agg(*aggs)
    return g.select("store", "date", is_holiday_week("date").alias("is_holiday"),
                    "temperature", "fuel_price", "markdown1", "markdown2", "markdown3",
                    "markdown4", "markdown5", "cpi", "unemployment")


def derive_test(sales: DataFrame, weeks: int = 13) -> DataFrame:
    """Future keys: every (store, dept) series times the next ``weeks`` Mondays."""
    last = sales.agg(F.max("date")).scalar()
    series = sales.select("store", "dept").distinct()
    future = F.sequence(F.date_add(last, 7), F.date_add(last, 7 * weeks),
                        F.expr("INTERVAL 7 DAYS"))
    return (series.select("store", "dept", F.explode(future).alias("date"))
            .withColumn("is_holiday", is_holiday_week("date")))
