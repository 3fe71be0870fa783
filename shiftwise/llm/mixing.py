"""Mixing sources to target weights by Sainte-Lague apportionment.

The mix has as many equal blocks of ``block`` words as all documents hold.
Each source's target is its weighted share, capped at ``epochs`` times its
size, the excess going to the others by weight. The blocks are then
apportioned to the sources by highest quotients (target / (2 seats + 1)), so
each source gets an integer quota in every shard; since the method is
house-monotone, the quotas of shard after shard are increments of one
allocation. Within a source the documents stand in a seeded order, which cut
into blocks is the order in which the shards take them: whole passes first, the
remaining blocks of the quota are the first of that order.

Only DataFrame expressions run. Null text has no words; a null source is a
source of its own, ordered last; empty documents take nothing; repeated rows
are documents of their own; an empty table gives no rows. Reruns agree: the
order depends on seed, doc_id and size only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shiftwise.llm.common import SPACE, WORD, empty_if_null, global_rank, ordered, partitions_for, table
from shiftwise.session import materialize

WEIGHTS = (5, 2, 1)  # repeating, by the sources' order
EPOCHS = 3
BLOCK = 64  # words
SEED = 17
SHARDS = 16


def source_sizes(rows: DataFrame, weights: tuple = WEIGHTS) -> DataFrame:
    """Per source its words and its weight; sources rank by code point, null last."""
    sizes = materialize(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "mix_sources")
    ranked = global_rank(sizes, [F.col("source").asc_nulls_last()], partitions_for(sizes.count(), least=1), "mix_sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    return ranked.withColumn("weight", weight)


def targets(sources: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """Adds ``target``: shares by weight of all words, none above ``epochs`` times its source.

    Each round caps the sources that exceed their limit at the present level
    and spreads the rest; it ends when no further source exceeds it.
    """
    limit = F.col("source_size") * float(epochs)
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = None
    while total:
        free = F.lit(True) if level is None else F.col("weight") * F.lit(level) <= limit
        fixed, weight = sources.agg(F.sum(F.when(free, 0.0).otherwise(limit)), F.sum(F.when(free, F.col("weight")))).first()
        new = (total - fixed) / weight if weight else level
        if level is not None and not new > level * (1 + 1e-12):
            break
        level = new
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(float(level or 0.0)), limit))


def apportion(sources: DataFrame, seats: int) -> DataFrame:
    """Adds ``quota``: seats by Sainte-Lague's highest quotients, target / (2k + 1).

    A divisor just too large gives every source a lower bound of its seats and
    one just too small an upper bound; only the quotients between them, about
    two a source, are ranked for the seats still open. Ties go to the source
    with the lower rank.
    """
    total, n = sources.agg(F.sum("target"), F.count(F.lit(1))).first()
    if not seats or not total:
        return sources.withColumn("quota", F.lit(0).cast("long"))

    def at(divisor: float) -> Column:
        return F.floor(F.col("target") / F.lit(divisor) + 0.5).cast("long")

    low = at(total / (seats - n / 2 - 1)) if seats > n / 2 + 1 else F.lit(0).cast("long")
    base = sources.withColumns({"low": low, "high": at(total / (seats + n / 2 + 1)) + 1})
    open_seats = seats - (base.agg(F.sum("low")).first()[0] or 0)
    seat = base.select("rank", "target", F.explode(F.sequence("low", "high")).alias("k"))
    best = (seat.select("rank", (F.col("target") / (2 * F.col("k") + 1)).alias("quotient"))
            .where("quotient > 0").orderBy(F.desc("quotient"), "rank").limit(open_seats))
    won = best.groupBy("rank").agg(F.count(F.lit(1)).alias("won"))
    return (base.join(won, "rank", "left")
            .withColumn("quota", F.col("low") + F.coalesce("won", F.lit(0))).drop("low", "high", "won"))


def shard_quotas(sources: DataFrame, blocks: int, shards: int) -> DataFrame:
    """``sources`` with ``upto``: per shard the blocks that the source holds in it and the shards before.

    The method is house-monotone, so the quota of a shard is the growth of the allocation as the mix grows by that
    shard. All the shards' allocations are found at once, as :func:`apportion` finds one; ``upto`` has one number a shard.
    """
    total, n = sources.agg(F.sum("target"), F.count(F.lit(1))).first()
    if not blocks or not total:
        return sources.withColumn("upto", F.array_repeat(F.lit(0).cast("long"), shards))
    ends = F.array(*[F.struct(F.lit(s).alias("shard"), F.lit(blocks * (s + 1) // shards).cast("long").alias("seats")) for s in range(shards)])
    each = sources.select("rank", "target", F.explode(ends).alias("end")).select("rank", "target", "end.shard", "end.seats")

    def at(seats: Column) -> Column:
        return F.floor(F.col("target") * seats / F.lit(total) + 0.5).cast("long")

    half = n / 2 + 1
    each = each.withColumns({"low": F.greatest(at(F.col("seats") - half), F.lit(0)), "high": at(F.col("seats") + half) + 1})
    each = materialize(each, "mix_quotas")  # sources x shards rows
    still = each.groupBy(F.col("shard").alias("s")).agg((F.first("seats") - F.sum("low")).alias("open"))
    seat = each.select("rank", "target", "shard", F.explode(F.sequence("low", "high")).alias("k"))
    seat = seat.withColumn("quotient", F.col("target") / (2 * F.col("k") + 1)).where("quotient > 0")
    place = F.row_number().over(Window.partitionBy("shard").orderBy(F.desc("quotient"), "rank"))  # about 2 a source
    won = (seat.withColumn("place", place).join(F.broadcast(still), F.col("shard") == F.col("s")).where("place <= open")
           .groupBy("rank", "shard").agg(F.count(F.lit(1)).alias("won")))
    quota = each.join(won, ["rank", "shard"], "left").select("rank", "shard", (F.col("low") + F.coalesce("won", F.lit(0))).alias("quota"))
    upto = quota.groupBy("rank").agg(F.transform(F.array_sort(F.collect_list(F.struct("shard", "quota"))), lambda x: x["quota"]).alias("upto"))
    return sources.join(upto, "rank")


def sized(docs: DataFrame, keep: list[Column], source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``keep`` with source and the number of words."""
    size = F.regexp_count(empty_if_null(text_col), F.lit(WORD)).cast("long")
    return docs.select(*keep, F.col(source_col).alias("source"), size.alias("size"))


def mix(rows: DataFrame, name: str = "mix", weights: tuple = WEIGHTS, epochs: int = EPOCHS, block: int = BLOCK,
        seed: int = SEED, shards: int = SHARDS) -> DataFrame:
    """``rows`` (doc_id, source, size, ...) with source_size, target, quota (blocks), taken (words) and shard.

    A source's blocks are its words in a seeded order of its documents, pass after pass. Shard after shard takes as
    many of them as its quota says; ``shard`` is where a document's first taken word goes (null: nothing taken).

    The running size inside a source comes from a range partitioning on
    (source, seeded hash, doc_id, size): a source that holds a third of all
    rows spreads over many tasks, and offsets are added per (source, partition).
    """
    rows = rows.withColumn("_order", F.xxhash64(F.lit(seed), "doc_id", "size"))
    placed, _ = ordered(rows, [F.col("source").asc_nulls_last(), F.col("_order"), F.col("doc_id"), F.col("size")],
                        partitions_for(rows.count()), name)
    sources = targets(source_sizes(placed, weights), epochs)
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    sources = shard_quotas(sources, -(-total // block), shards).withColumn("quota", F.element_at("upto", -1))
    # words of a source in earlier partitions: one row per (source, partition) that meet, about sources + partitions
    runs = placed.groupBy("source", "part").agg(F.sum("size").alias("run"))
    runs = runs.withColumn("before", F.coalesce(F.sum("run").over(
        Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    info = runs.join(sources.select(F.col("source").alias("s"), "source_size", "target", "quota", "upto"),
                     F.col("source").eqNullSafe(F.col("s"))).drop("s", "run")
    info = info.select(F.col("source").alias("s"), F.col("part").alias("p"), "before", "source_size", "target", "quota", "upto")
    own = Window.partitionBy("part", "source").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    running = placed.withColumn("ahead", F.coalesce(F.sum("size").over(own), F.lit(0)))
    found = running.join(info, (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s")))
    words_taken = F.least(F.col("quota") * block, F.col("source_size") * epochs)
    passes = F.when(F.col("source_size") > 0, F.floor(words_taken / F.col("source_size"))).otherwise(0)
    rest = words_taken - passes * F.col("source_size")
    at = F.col("before") + F.col("ahead")
    part = F.greatest(F.least(rest - at, F.col("size")), F.lit(0))
    taken = (passes * F.col("size") + part).cast("long")
    first = F.floor(at / block)  # the document's first word lies in this block of its source
    shard = F.size(F.filter("upto", lambda u: u <= first))
    return (found.withColumn("taken", taken).withColumn("shard", F.when(F.col("taken") > 0, shard))
            .drop("part", "row", "before", "ahead", "p", "s", "_order", "upto"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                **options) -> DataFrame:
    """doc_id, size, source_size, target, taken, the source's quota of blocks, and the shard."""
    rows = sized(docs, [F.col(id_col).alias("doc_id")], source_col, text_col)
    return mix(rows, **options).select("doc_id", "size", "source_size", "target", "taken", "quota", "shard")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed documents: whole copies as often as taken, and where the quota ends inside a
    document its first words. Columns are those of ``docs`` (n_chars, if there, counts the text kept).

    Only ids, hashes and sizes are put in order; the texts meet what is taken of them in one exchange.
    """
    key = [F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("doc_id").isNull().alias("_none"),
           F.xxhash64("source", "text").alias("_key")]
    at = ["_id", "_none", "_key"]
    mixed = mix(sized(docs, [F.col("doc_id"), *key]), "mix_stage")
    # rows equal in id, source and text are as good as each other: the first of them by their other columns takes the most
    takes = mixed.groupBy(*at).agg(F.first("size").alias("_size"), F.sort_array(F.collect_list("taken"), asc=False).alias("_takes"))
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *key)
    others = [F.col(f"_row.`{c}`") for c in docs.columns if c not in ("doc_id", "source", "text")]
    nth = F.row_number().over(Window.partitionBy(*at).orderBy(*others, F.lit(0)))
    rows = own.join(takes, at).withColumn("_taken", F.get("_takes", nth - 1))
    whole = F.when(F.col("_size") > 0, F.floor(F.col("_taken") / F.col("_size"))).otherwise(0)
    rest = F.when(F.col("_size") > 0, F.col("_taken") % F.col("_size")).otherwise(0)
    copies = rows.withColumn("_cut", F.explode(F.concat(
        F.array_repeat(F.lit(0).cast("long"), whole.cast("int")),
        F.when(rest > 0, F.array(rest.cast("long"))).otherwise(F.array().cast("array<long>")))))
    text = F.col("_row.text")
    # the words with the white space before each; only the one document a source's quota cuts gets here
    head = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(f"{SPACE}*{WORD}"), F.lit(0)),
                                F.lit(1), F.col("_cut").cast("int")), "")
    copies = copies.withColumn("_text", F.when(F.col("_cut") > 0, head).otherwise(text))
    cols = []
    for c in docs.columns:
        col = F.col(f"_row.`{c}`")
        if c == "text":
            col = F.col("_text")
        elif c == "n_chars":
            col = F.when(F.col("_cut") > 0, F.length("_text")).otherwise(col)
        cols.append(col.cast(docs.schema[c].dataType).alias(c))
    return copies.select(*cols)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))
