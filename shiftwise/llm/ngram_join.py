"""N-gram Jaccard self-join by rare-first prefix filtering.

A document's set holds the hashes of its distinct five-word shingles. Texts
with equal sets form a class, and only classes are joined. One total order
holds for all shingles: by how often their hash bucket occurs in the whole
corpus (a count sketch that grows with it, 32 MB at most), rarest first, then
by hash. Two sets
with Jaccard >= t must share a shingle among the first n - ceil(t n) + 1 of
each (prefix filter), so only those are shuffled, joined, and filtered:

* length: t |a| <= |b|;
* positional: what precedes and follows the shared shingle must leave room for
  the overlap that t demands;
* prefix overlap: the side whose prefix ends first has all its common shingles
  of the prefix in the other's prefix, so overlap <= shared + |rest|;
* pair prefix: for the two lengths at hand the prefixes end earlier, after
  n - o + 1 shingles each if the sets must overlap in o;
* suffix: the sets' counts in 16 hash ranges bound the overlap from above.

What passes is verified once per pair on the whole sets. Groups of thousands
of near copies would yield millions of pairs; since the result is components,
each class first meets the class that leads most of its posting lists, a few
rounds long, and only pairs that are still in different components after that
are enumerated. No pair that could connect two components is left out.

Null, empty or wordless texts have no set and link with nothing. Repeated rows
fall into one class. A component's id is its smallest doc_id (null if none).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shiftwise.llm.common import WORD, empty_if_null, table
from shiftwise.llm.fill_middle import text_parts
from shiftwise.llm.hashing import (SKETCH_BITS, SLICE, add_up, bucket, in_marks, marked, mix, shingle_sets,
                                   sliced)
from shiftwise.session import materialize, remove_folder, run_folder, scratch

WORDS = 5
PERCENT = 75
STAR_ROUNDS = 2
SLICES_SCHEMA = pa.schema([("part", pa.int64()), ("slice", pa.int32()), ("counts", pa.binary())])
MOST_SKETCH_BITS = 25  # 32 MB, the largest sketch that is broadcast
MOST_COUNT = 255  # a byte; with 16 shingles a bucket only frequent ones get there


def class_key(hashes: np.ndarray) -> int:
    """A signed 64-bit key of a sorted set."""
    at = np.arange(1, len(hashes) + 1, dtype=np.uint64)
    return int(mix(np.array([mix(hashes + at * np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)
                             + np.uint64(len(hashes))]))[0].astype(np.int64))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def sketch_bits(text_bytes: int) -> int:
    """Buckets for a corpus of so many bytes: one for about 16 shingles (a word is some 6 bytes), 2**22 to 2**25."""
    return min(max(SKETCH_BITS, (text_bytes // 96).bit_length()), MOST_SKETCH_BITS)


def _capped(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum(a.astype(np.uint32) + b, MOST_COUNT).astype(np.uint8)


def shingle_sketch(texts: DataFrame, size: int) -> np.ndarray:
    """Occurrences (documents, up to MOST_COUNT) per hash bucket over the whole corpus."""
    from pyspark import TaskContext

    bits = sketch_bits(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0)

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.uint8)
        for b in it:
            for _, _, part in byte_parts(b):
                at, n = np.unique(bucket(np.concatenate(shingle_sets(part, size)), bits), return_counts=True)
                total[at] = _capped(total[at], n)
        slices = sliced(total, TaskContext.get().partitionId())
        yield pa.RecordBatch.from_pandas(slices, schema=SLICES_SCHEMA, preserve_index=False)

    counts = add_up(texts.select("text").mapInArrow(count, SLICE), texts.rdd.getNumPartitions(), _capped, np.uint8)
    return counts if len(counts) else np.zeros(1 << bits, np.uint8)


def prefixes(texts: DataFrame, sketch, size: int, percent: int) -> DataFrame:
    """(doc_id, key, cls, n_shingles, prefix): one row per document; ``sketch`` is the broadcast count sketch."""
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sketch.value
        bits = len(counts).bit_length() - 1
        for b in it:
            for row, upto, part in byte_parts(b):
                cls, n, firsts = [], [], []
                for h in shingle_sets(part, size):
                    n.append(len(h))
                    cls.append(class_key(h) if len(h) else None)
                    order = np.lexsort((h, counts[bucket(h, bits)]))[: prefix_length(len(h), percent)] if len(h) else []
                    firsts.append(h[order].astype(np.int64) if len(h) else np.zeros(0, np.int64))
                ends = np.concatenate(([0], np.cumsum([len(f) for f in firsts]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(row, upto - row), b.column("key").slice(row, upto - row), pa.array(cls, pa.int64()),
                     pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(firsts)))],
                    names=["doc_id", "key", "cls", "n_shingles", "prefix"])

    return texts.mapInArrow(batches, "doc_id long, key long, cls long, n_shingles long, prefix array<long>")


def byte_parts(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[bytes]]]:
    """(from row, to row, texts as bytes) of a batch, about a million bytes at a time, without Python strings."""
    for row, upto, data, begins, ends in text_parts(batch, "text", 1_000_000):
        whole = data.tobytes()
        yield row, upto, [whole[a:b] for a, b in zip(begins.tolist(), ends.tolist())]


def whole_sets(texts: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(cls, shingles) of the wanted classes. A sketch of their keys, of fixed size, keeps most other sets out of the shuffle."""
    marks = texts.sparkSession.sparkContext.broadcast(marked(wanted, "cls"))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = set()
        for b in it:
            for _, _, part in byte_parts(b):
                keys, found = [], []
                for h in shingle_sets(part, size):
                    if len(h):
                        k = class_key(h)
                        if k not in sent and in_marks(np.array([k]), marks.value)[0]:
                            sent.add(k)
                            keys.append(k)
                            found.append(h.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(found, pa.binary())], names=["cls", "shingles"])

    sets = texts.select("text").mapInArrow(batches, "cls long, shingles binary")
    return sets.join(wanted.select("cls"), "cls", "left_semi").groupBy("cls").agg(F.first("shingles").alias("shingles"))


def _similar(a: bytes, b: bytes, percent: int) -> bool:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    both = len(x) + len(y)
    need = -(-percent * both // (100 + percent))
    # suffix filter: per hash range the overlap is at most the smaller count
    top = np.uint64(60)
    most = np.minimum(np.bincount((x >> top).astype(np.int64), minlength=16),
                      np.bincount((y >> top).astype(np.int64), minlength=16)).sum()
    if most < need:
        return False
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * shared >= percent * (both - shared)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar."""
    @F.pandas_udf("boolean")
    def similar(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([_similar(p, q, percent) for p, q in zip(x, y)], dtype=bool)

    left = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(left, "a").join(right, "b").where(similar("x", "y")).select("a", "b")


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, comp) of the linked nodes, comp the smallest node reachable.

    Every round takes the smallest label among a node's neighbours and then the
    label's own label; rounds end when nothing changes (about the logarithm of
    the longest chain).
    """
    edges = materialize(links.select("a", "b").union(links.select("b", "a")).distinct(), f"{name}_edges")
    labels = materialize(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                         .select("node", F.least("node", "m").alias("comp")), f"{name}_labels")
    while True:
        near = (edges.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near")))
        stepped = labels.join(near, "node").select("node", "comp", F.least("comp", "near").alias("new"))
        up = labels.select(F.col("node").alias("new"), F.col("comp").alias("jump"))
        after = stepped.join(up, "new", "left").select(
            "node", F.col("comp").alias("old"), F.least("new", F.coalesce("jump", "new")).alias("comp"))
        after = materialize(after, f"{name}_labels")
        moved = after.where("old <> comp").limit(1).count()
        labels = after.drop("old")
        if not moved:
            return labels


def _long_enough(percent: int, x: str = "n", y: str = "m") -> Column:
    return (100 * F.col(x) >= percent * F.col(y)) & (100 * F.col(y) >= percent * F.col(x))


def _need(percent: int) -> Column:
    """Least overlap of similar sets of n and m shingles."""
    return F.ceil(F.lit(percent) * (F.col("n") + F.col("m")) / F.lit(100.0 + percent))


def _may_overlap(percent: int) -> Column:
    """Prefix overlap filter where ``shared`` bounds the common prefix shingles of sets of n and m: what lies
    behind the longer prefix can add only the rest."""
    rest = F.ceil(F.lit(percent) * F.greatest("n", "m") / 100.0) - 1
    return F.col("shared") + rest >= _need(percent)


def star_pairs(lists: DataFrame, tried: DataFrame | None, percent: int) -> DataFrame:
    """Per class one untried partner of another component: the class that leads most of its posting lists.

    A list is led by its richest class (most shared shingles); lists within one component are over.
    """
    lead = lists.groupBy("h").agg(F.max(F.struct("rich", "n", "cls", "comp")).alias("lead"),
                                  F.min("comp").alias("least"), F.max("comp").alias("most")).where("least <> most")
    votes = (lists.join(lead, "h").where((F.col("comp") != F.col("lead.comp")))
             .select("cls", "n", F.col("lead.cls").alias("other"), F.col("lead.n").alias("m"),
                     F.least("rich", "lead.rich").alias("shared"))  # no pair shares more than either shares with all
             .where(_long_enough(percent) & _may_overlap(percent)).groupBy("cls", "other").agg(F.count(F.lit(1)).alias("votes"))
             .select(F.least("cls", "other").alias("a"), F.greatest("cls", "other").alias("b"), "cls", "votes"))
    if tried is not None:
        votes = votes.join(tried, ["a", "b"], "left_anti")
    best = votes.groupBy("cls").agg(F.max(F.struct("votes", "a", "b")).alias("best"))
    return best.select("best.a", "best.b").distinct()


def cross_pairs(lists: DataFrame, tried: DataFrame | None, percent: int) -> DataFrame:
    """All pairs of different components that share a shingle of their pair prefixes and pass the filters.

    Sets of n and m that overlap in t share one shingle at least among the first n - t + 1 of one and the first
    m - t + 1 of the other, so only places inside those parts meet. Asking for more shared shingles needs longer
    parts, which reach into the frequent shingles: fewer pairs in the end, but far more rows on the way.
    """
    open_lists = lists.groupBy("h").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("h")
    rest = lists.join(open_lists, "h", "left_semi")
    x = rest.select("h", F.col("cls").alias("a"), "n", F.col("pos").alias("i"), F.col("comp").alias("c"))
    y = rest.select("h", F.col("cls").alias("b"), F.col("n").alias("m"), F.col("pos").alias("j"), F.col("comp").alias("d"))
    room = (F.least("i", "j") + 1 + F.least(F.col("n") - F.col("i") - 1, F.col("m") - F.col("j") - 1)) >= _need(percent)
    inside = (F.col("i") <= F.col("n") - _need(percent)) & (F.col("j") <= F.col("m") - _need(percent))
    met = x.join(y, "h").where((F.col("a") < F.col("b")) & (F.col("c") != F.col("d")) & _long_enough(percent) & room
                               & inside)
    pairs = met.select("a", "b").distinct()
    return pairs.join(tried, ["a", "b"], "left_anti") if tried is not None else pairs


def linked(texts: DataFrame, size: int = WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(documents, classes): per document doc_id, key, cls, n_shingles; per class cls and component_id.

    ``texts`` has doc_id, key and text. Only the two tables stay written.
    """
    with scratch(texts.sparkSession):
        return _linked(texts, size, percent)


def _linked(texts: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    spark = texts.sparkSession
    sketch = spark.sparkContext.broadcast(shingle_sketch(texts, size))
    first_run, firsts_run = uuid.uuid4().hex, uuid.uuid4().hex
    long_rows = materialize(prefixes(texts, sketch, size, percent), "join_prefixes", first_run)
    docs = materialize(long_rows.drop("prefix"), "join_docs", kept=True)
    wordy = long_rows.where("cls is not null")
    classes = materialize(wordy.groupBy("cls").agg(F.min("doc_id").alias("rep")), "join_classes")
    firsts = wordy.groupBy("cls").agg(F.first("n_shingles").alias("n"), F.first("prefix").alias("prefix"))
    firsts = materialize(firsts, "join_firsts", firsts_run)
    remove_folder(spark, run_folder(spark, first_run))  # before the entries take their place on disk
    entries = firsts.select("cls", F.col("n").cast("int").alias("n"), F.posexplode("prefix").alias("pos", "h"))
    # dealt once by shingle for both the count and the join; both stream, so no task holds a frequent shingle's list
    entries = entries.repartition("h")
    often = entries.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1").select("h")
    shared = entries.join(often, "h", "left_semi")
    lists = materialize(shared.withColumn("rich", F.count(F.lit(1)).over(Window.partitionBy("cls"))), "join_lists")
    remove_folder(spark, run_folder(spark, firsts_run))  # the prefixes live on in the lists
    labels = links = tried = None
    for step in range(STAR_ROUNDS + 1):
        here = lists.withColumn("comp", F.col("cls")) if labels is None else (
            lists.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("comp", F.coalesce("comp", "cls")))
        pairs = star_pairs(here, tried, percent) if step < STAR_ROUNDS else cross_pairs(here, tried, percent)
        pairs = materialize(pairs, "join_pairs")
        if not pairs.limit(1).count():
            continue
        wanted = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
        step_run = uuid.uuid4().hex
        sets = materialize(whole_sets(texts, materialize(wanted, "join_wanted"), size), "join_sets", step_run)
        new = materialize(verified(pairs, sets, percent), "join_links")
        remove_folder(spark, run_folder(spark, step_run))
        tried = pairs if tried is None else tried.union(pairs)
        links = new if links is None else links.union(new)
        found = new.limit(1).count()
        if found:
            labels = components(links)
    named = classes.select("cls", "rep")
    if labels is not None:
        named = named.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
        ids = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
        named = named.join(ids, "comp").select("cls", "component_id")
    else:
        named = named.select("cls", F.col("rep").alias("component_id"))
    return docs, materialize(named, "join_components", kept=True)


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("key"),
                       empty_if_null(text_col).alias("text"))


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, class_id."""
    rows, classes = linked(keyed(docs, id_col, text_col))
    return rows.join(classes, "cls", "left").select(
        "doc_id", "n_shingles", F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.col("cls").alias("class_id"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component (the smallest doc_id, then text key) and every document without words."""
    rows, classes = linked(keyed(docs))
    first = (rows.where("cls is not null").select("doc_id", "key", "cls").join(classes, "cls")
             .groupBy(F.coalesce("component_id", "cls").alias("grp"), F.col("component_id").isNull().alias("anon"))
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("w")))
    at = ["_id", "_none", "_text_key"]  # without nulls, so that the join and the window share one exchange of the texts
    winners = materialize(first.select(F.coalesce("w.doc_id", F.lit(0)).alias("_id"), F.col("w.none").alias("_none"),
                                       F.col("w.key").alias("_text_key")).distinct(), "join_kept")
    wordy = F.coalesce(F.rlike("text", F.lit(WORD)), F.lit(False))
    own = docs.where(wordy).withColumns({"_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), "_none": F.col("doc_id").isNull(),
                                         "_text_key": F.xxhash64("text")})
    won = own.join(winners, at, "left_semi")
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    once = Window.partitionBy(*at).orderBy(*others, F.lit(0))
    won = won.withColumn("_nth", F.row_number().over(once)).where("_nth = 1")
    return won.select(*[F.col(f"`{c}`") for c in docs.columns]).union(docs.where(~wordy))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"))
