"""Benchmark decontamination by a prefix-filtered set join.

An item's windows are its runs of ``WINDOW`` consecutive words (a shorter item
is one window); a window is the set of its word shingles. A document's run of
words can only equal a window if it contains all of the window's shingles, so
of the window's shingles, ordered by how often they occur in all documents,
rarest first, one is a necessary prefix. Documents are asked for those prefix
shingles alone. Each occurrence found says where the window would begin, which
bounds it by the document's two ends (position and length), and what passes is
verified word by word against the item-sized window.

Two passes read the documents: one counts the items' shingles in all of them
(a window with a shingle that occurs nowhere is dropped for good), one looks
for the prefixes. Both keep other shingles back by a bit filter whose size
follows the number of marked shingles, 32 MB at most; a full filter would let
more through, never less. Windows meet documents in a join by shingle, whose
rows carry the few words around, so that no text is shuffled. Equal texts share
their hits under a 128-bit key and are looked through once a task.

Null or wordless documents and items have no words, no window, no hit. A hit
by an item without id counts its words, but no item; ids that repeat count
once. Ties of rarity go to the smaller hash. Repeated documents count each;
empty tables give no rows or no hits; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftwise.llm.common import empty_if_null, table
from shiftwise.llm.fill_middle import text_parts
from shiftwise.llm.hashing import bits_for, in_marks, marked, mix, powers, prefix_sums
from shiftwise.session import materialize

WINDOW = 10
SHINGLE = 3
PART = 1_000_000

# The word rule [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z became a-z (fixed value), as bytes of UTF-8: digits, a-z and
# whatever is not ASCII.
_BYTES = np.arange(256)
IS_WORD = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)


class Words:
    """The words of texts that lie one after another: bytes, begin, end, text and hash of each."""

    def __init__(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray):
        self.data = LOWER[data]
        inside = IS_WORD[self.data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        full = begins < ends  # words end with their text
        heads, tails = begins[full], ends[full] - 1
        first[heads] = inside[heads]
        last[tails] = inside[tails]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.text = np.searchsorted(ends, self.start, "right")
        self.n = np.bincount(self.text, minlength=len(begins))
        self.first = np.concatenate(([0], np.cumsum(self.n)))
        sums = prefix_sums(self.data)
        _, down = powers(len(data) + 1)
        self.hash = mix((sums[self.end] - sums[self.start]) * down[self.start] ^ (self.end - self.start).astype(np.uint64))

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every run of ``size`` words within one text."""
        k = len(self.hash) - size + 1
        if k <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.text[:k] == self.text[size - 1:])
        h = np.full(len(at), size, np.uint64)
        for j in range(size):
            h = (h ^ self.hash[at + j]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return at, mix(h).view(np.int64)

    def said(self, a: int, b: int) -> str:
        """Words a to b - 1, one space apart."""
        return b" ".join([self.data[s:e].tobytes() for s, e in zip(self.start[a:b].tolist(), self.end[a:b].tolist())]).decode()


def shingle_size(words: int) -> int:
    return min(SHINGLE, words)


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(item_id, said, words, shingles): every window of every item, shingles in the order of their places."""
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            ids = batch.column("item_id").to_pylist()
            for row, _, data, begins, ends in text_parts(batch, "text", PART):
                w = Words(data, begins, ends)
                hashes = {}
                for size in range(1, SHINGLE + 1):
                    at, h = w.shingles(size)
                    hashes[size] = dict(zip(at.tolist(), h.tolist()))
                out = []
                for t, n in enumerate(w.n.tolist()):
                    words = min(n, window)
                    for a in range(w.first[t], w.first[t] + n - words + 1 if n else w.first[t]):
                        size = shingle_size(words)
                        out.append({"item_id": ids[row + t], "said": w.said(a, a + words), "words": words,
                                    "shingles": [hashes[size][a + j] for j in range(words - size + 1)]})
                yield pa.RecordBatch.from_pylist(out, WINDOW_SCHEMA)

    rows = items.select(F.col(id_col).cast("string").alias("item_id"), empty_if_null(text_col).alias("text"))
    return rows.mapInArrow(batches, "item_id string, said string, words int, shingles array<long>")


WINDOW_SCHEMA = pa.schema([("item_id", pa.string()), ("said", pa.string()), ("words", pa.int32()),
                           ("shingles", pa.list_(pa.int64()))])


def shingle_counts(texts: DataFrame, marks, sizes: list[int]) -> DataFrame:
    """(h, n): occurrences of the marked shingles in all documents, added up by batch before the shuffle."""
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            found = [np.zeros(0, np.int64)]
            for _, _, data, begins, ends in text_parts(batch, "text", PART):
                w = Words(data, begins, ends)
                for size in sizes:
                    _, h = w.shingles(size)
                    found.append(h[in_marks(h, marks.value)])
            h, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n)], names=["h", "n"])

    return texts.select("text").mapInArrow(batches, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def occurrences(texts: DataFrame, marks, sizes: list[int], window: int) -> DataFrame:
    """One row per document: doc_id, key, n_words and ``found``, the places of marked shingles with the words that a
    window around them may hold: (h, at: the shingle's first word, from: first of the words said, said)."""
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # texts of this task that have been looked through
        for batch in it:
            ids = batch.column("doc_id")
            for row, upto, data, begins, ends in text_parts(batch, "text", PART):
                w = Words(data, begins, ends)
                keys = [hashlib.blake2b(data[a:b], digest_size=16).digest() for a, b in zip(begins.tolist(), ends.tolist())]
                found: list[list] = [[] for _ in keys]
                fresh = np.array([k not in seen for k in keys], bool)
                places: dict = {k: i for i, k in reversed(list(enumerate(keys)))}
                fresh &= np.array([places[k] == i for i, k in enumerate(keys)], bool)
                for size in sizes:
                    at, h = w.shingles(size)
                    hit = np.flatnonzero(in_marks(h, marks.value) & fresh[w.text[at]])
                    around = window - size if size == SHINGLE else 0  # shorter windows are the shingle itself
                    for a, key in zip(at[hit].tolist(), h[hit].tolist()):
                        t = int(w.text[a])
                        low, high = max(int(w.first[t]), a - around), min(int(w.first[t + 1]), a + size + around)
                        found[t].append({"h": key, "at": a - int(w.first[t]), "from": low - int(w.first[t]),
                                         "said": w.said(low, high)})
                for t in np.flatnonzero(fresh).tolist():
                    if found[t]:
                        seen.add(keys[t])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(row, upto - row), pa.array(keys, pa.binary()), pa.array(w.n.astype(np.int64)), pa.array(found, FOUND)],
                    names=["doc_id", "key", "n_words", "found"])

    return texts.mapInArrow(batches, "doc_id long, key binary, n_words long, "
                                     "found array<struct<h:long,at:int,from:int,said:string>>")


FOUND = pa.list_(pa.struct([("h", pa.int64()), ("at", pa.int32()), ("from", pa.int32()), ("said", pa.string())]))


def prefixes(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """(h, said, words, place): each window that may occur under its rarest shingle, and where in it that stands."""
    parts = windows.select("said", "words", F.posexplode("shingles").alias("place", "h"))
    ordered = parts.join(counts, "h", "left")
    return (ordered.groupBy("said", "words")
            .agg(F.min(F.struct("n", "h", "place")).alias("first"), F.min(F.coalesce("n", F.lit(0))).alias("least"))
            .where("least > 0").select("first.h", "said", "words", "first.place"))


def verified(found: DataFrame, prefix: DataFrame) -> DataFrame:
    """(key, start, words, said) of the windows that stand in a text, each once."""
    start = F.col("at") - F.col("place")
    wide = F.col("p.h").alias("h"), "place", "words", F.col("p.said").alias("window")
    met = found.join(prefix.alias("p").select(*wide), "h")
    inside = (start >= 0) & (start + F.col("words") <= F.col("n_words"))
    equal = F.array_join(F.slice(F.split("said", " "), start - F.col("from") + 1, F.col("words")), " ") == F.col("window")
    return met.where(inside).where(equal).select("key", start.alias("start"), "words", "window").distinct()


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items (sorted ids as strings)."""
    if window < SHINGLE:
        raise ValueError(f"a window has {SHINGLE} words at least")
    context = docs.sparkSession.sparkContext
    per_item = materialize(item_windows(items, item_id_col, item_text_col, window), "decon_items")
    windows = materialize(per_item.groupBy("said", "words").agg(F.first("shingles").alias("shingles")), "decon_windows")
    sizes = sorted({shingle_size(r["words"]) for r in windows.select("words").distinct().collect()})  # WINDOW rows at most
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), empty_if_null(text_col).alias("text"))

    asked = windows.select(F.explode("shingles").alias("h")).distinct()
    width = bits_for(asked.count())
    counts = materialize(shingle_counts(texts, context.broadcast(marked(asked, "h", width)), sizes), "decon_counts")
    prefix = materialize(prefixes(windows, counts), "decon_prefixes")
    width = bits_for(prefix.count())
    rows = materialize(occurrences(texts, context.broadcast(marked(prefix, "h", width)), sizes, window), "decon_rows")

    found = rows.where(F.size("found") > 0).select("key", "n_words", F.inline("found"))
    hits = materialize(verified(found, prefix), "decon_hits")
    words = (hits.select("key", F.explode(F.sequence("start", F.col("start") + F.col("words") - 1)).alias("at")).distinct()
             .groupBy("key").agg(F.count(F.lit(1)).alias("n_hit")))
    named = (hits.select("key", F.col("window").alias("said")).distinct()
             .join(per_item.where("item_id is not null").select("said", "item_id").distinct(), "said")
             .select("key", "item_id").distinct()
             .groupBy("key").agg(F.array_sort(F.collect_list("item_id")).alias("items")))
    per_key = materialize(words.join(named, "key", "left"), "decon_keys")
    none = F.array().cast("array<string>")
    return rows.join(per_key, "key", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", none).alias("items"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return done.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


#: Brute force: every run of words of a window's length in every document against every window.
SQL = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL
),
item_places AS (
  SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
  FROM item_words WHERE len(w) > 0
),
item_windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS said FROM item_places),
doc_words AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
doc_places AS (
  SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
  FROM doc_words, (SELECT DISTINCT n FROM item_windows) sizes WHERE len(w) >= n
),
hits AS (
  SELECT r, i, p.n, item_id
  FROM (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS said FROM doc_places) p JOIN item_windows USING (n, said)
),
hit_words AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS j FROM hits) x GROUP BY r),
hit_items AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hits WHERE item_id IS NOT NULL) x GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""
