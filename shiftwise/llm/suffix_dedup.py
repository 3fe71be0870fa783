"""Exact repeated-passage removal by depth-limited radix sort of suffixes.

Every byte position with 200 bytes before its document's end starts a suffix
that matters to depth 200. The suffixes are put into equal groups by passes
from coarse to fine digits, and a suffix alone in its group leaves:

1. Leading digit. A 100-byte string inside the 200 (the one of smallest hash,
   so equal suffixes choose the same) stands for the suffix. Neighbouring
   suffixes mostly choose the same one and stay together as one *run*, about
   50 suffixes, so a run, not a suffix, is a row.
2. Whole runs. Runs that are equal over all their bytes are repeated suffix by
   suffix; a run whose digit no other run has is over.
3. Last digit. The remaining runs share a digit but differ somewhere: where
   copies begin, end or were edited. One place stands for each different run;
   its bytes (at most 300) are sorted by digit, and its single suffixes are
   grouped by the hash of all 200 bytes. Equal groups are exactly the repeated
   windows.

All grouping is by (digit hash, content hash), 128 bits. Digits with very many
different runs, such as the edge of a passage that a third of all documents
share, do not meet in one task: their suffixes are rows of their own, counted
with partial aggregation, and the joins that bring verdicts back can be split
by key. Equal texts share one key (64-bit hash of the text) and are sent at
most twice by a task. Texts are shuffled twice, and runs once, and only those
that a filter of fixed size does not rule out.

Null text is empty; texts under 200 bytes only lose nothing; repeated rows are
copies of each other, so both lose what they share; an empty table gives no
rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftwise.llm.common import empty_if_null, table
from shiftwise.llm.hashing import in_marks, marked, mix, powers, prefix_sums
from shiftwise.session import materialize

DEPTH = 200
PIECE = 1_000_000  # bytes hashed at a time
MANY = 1000  # different runs of one digit that one task compares; more become rows
_INDEX = np.uint64((1 << 24) - 1)


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """min(v[i:i + width]) for every i, from running minima inside blocks."""
    pad = -len(v) % width
    blocks = np.concatenate([v, np.full(pad, np.iinfo(v.dtype).max, v.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(v) - width + 1
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def runs_of(a: np.ndarray, ends: np.ndarray, depth: int = DEPTH) -> pd.DataFrame:
    """Runs in concatenated texts (``ends``: their ends): start, n (suffixes), h (digit) and ctx (content) hashes, text number."""
    digit = depth // 2
    width = depth - digit + 1
    n = len(a) - depth + 1
    if n <= 0:
        return pd.DataFrame({"start": [], "n": [], "h": [], "ctx": [], "text": []}).astype("int64")
    sums = prefix_sums(a)
    _, down = powers(len(a) + 1)
    grams = mix((sums[digit:] - sums[:-digit]) * down[: len(a) - digit + 1])
    place = np.arange(len(grams), dtype=np.uint64)
    best = (sliding_min((grams & ~_INDEX) | place, width) & _INDEX).astype(np.int64)[:n]
    s = np.arange(n)
    text = np.searchsorted(ends, s, "right")
    fits = s + depth <= ends[np.minimum(text, len(ends) - 1)]
    new = np.empty(n, bool)
    new[0] = True
    new[1:] = (best[1:] != best[:-1]) | (text[1:] != text[:-1]) | (fits[1:] != fits[:-1])
    start = np.flatnonzero(new)
    count = np.diff(np.append(start, n))
    ok = fits[start]
    start, count = start[ok], count[ok]
    at = best[start]
    content = (sums[start + count - 1 + depth] - sums[start]) * down[start]
    shape = (count.astype(np.uint64) << np.uint64(32)) ^ (at - start).astype(np.uint64)
    return pd.DataFrame({"start": start, "n": count, "h": grams[at].astype(np.int64),
                         "ctx": mix(content ^ mix(shape)).astype(np.int64), "text": text[start]})


def pieces(texts: list[str], keys: list, depth: int) -> Iterator[tuple]:
    """(bytes, ends, first offsets, keys): texts in pieces of about PIECE bytes; a longer text is cut with an overlap."""
    run, ends, firsts, ids, n = [], [], [], [], 0
    for t, k in zip(texts, keys):
        b = (t or "").encode()
        if len(b) < depth:
            continue
        for at in range(0, len(b) - depth + 1, PIECE):
            part = b[at:at + PIECE + depth - 1]
            run.append(part)
            n += len(part)
            ends.append(n)
            firsts.append(at)
            ids.append(k)
            if n >= PIECE:
                yield b"".join(run), np.array(ends), np.array(firsts), np.array(ids)
                run, ends, firsts, ids, n = [], [], [], [], 0
    if run:
        yield b"".join(run), np.array(ends), np.array(firsts), np.array(ids)


def sent_again(keys: pd.Series, sent: dict, most: int) -> np.ndarray:
    """Which rows are not yet the ``most + 1``-th of their key in this task."""
    out = np.ones(len(keys), bool)
    for i, k in enumerate(keys.tolist()):
        sent[k] = sent.get(k, 0) + 1
        out[i] = sent[k] <= most
    return out


def counted_runs(texts: DataFrame, depth: int) -> DataFrame:
    """(h, ctx, c): contents of runs, counted inside each piece. A text's third copy in a task adds nothing new."""
    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sent: dict = {}
        for b in it:
            b = b[sent_again(b["key"], sent, 2)]
            for raw, ends, _, _ in pieces(b["text"].tolist(), b["key"].tolist(), depth):
                r = runs_of(np.frombuffer(raw, np.uint8), ends, depth)
                yield r.groupby(["h", "ctx"], as_index=False, sort=False).size().rename(columns={"size": "c"})

    return texts.select("key", "text").mapInPandas(batches, "h long, ctx long, c long")


def marked_runs(texts: DataFrame, marks, depth: int) -> DataFrame:
    """(h, ctx, key, lo, n) of the runs whose digit the broadcast filter does not rule out, once per text and task."""
    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sent: dict = {}
        for b in it:
            b = b[sent_again(b["key"], sent, 1)]
            for raw, ends, firsts, ids in pieces(b["text"].tolist(), b["key"].tolist(), depth):
                r = runs_of(np.frombuffer(raw, np.uint8), ends, depth)
                r = r[in_marks(r["h"].to_numpy(), marks.value)]
                t = r["text"].to_numpy()
                begin = np.concatenate(([0], ends[:-1]))
                yield pd.DataFrame({"h": r["h"], "ctx": r["ctx"], "key": ids[t],
                                    "lo": (r["start"].to_numpy() - begin[t] + firsts[t]).astype(np.int64),
                                    "n": r["n"].astype(np.int32)})

    return texts.select("key", "text").mapInPandas(batches, "h long, ctx long, key long, lo long, n int")


def maybe_in(marks):
    """Column function: whether the broadcast filter of fixed size does not rule a key out."""
    @F.pandas_udf("boolean")
    def maybe(k: pd.Series) -> pd.Series:
        return pd.Series(in_marks(k.to_numpy(), marks.value))

    return maybe


def contexts(texts: DataFrame, open_runs: DataFrame, depth: int) -> DataFrame:
    """``open_runs`` (key, h, lo, n, kinds) with the bytes they cover."""
    spans = open_runs.groupBy("key").agg(F.collect_list(F.struct("h", "lo", "n", "kinds")).alias("runs"))
    marks = texts.sparkSession.sparkContext.broadcast(marked(open_runs, "key"))
    one = texts.select("key", "text").where(maybe_in(marks)("key")).dropDuplicates(["key"])

    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in it:
            out = []
            for key, text, runs in zip(b["key"], b["text"], b["runs"]):
                raw = text.encode()
                out += [(r["h"], r["kinds"], key, r["lo"], r["n"], raw[r["lo"]:r["lo"] + r["n"] - 1 + depth]) for r in runs]
            yield pd.DataFrame(out, columns=["h", "kinds", "key", "lo", "n", "raw"])

    return one.join(spans, "key").mapInPandas(batches, CONTEXT)


CONTEXT = "h long, kinds long, key long, lo long, n int, raw binary"


def suffix_hashes(raws: list[bytes], n: np.ndarray, depth: int) -> np.ndarray:
    """Hashes of the first ``n`` whole windows of every byte string, one after the other."""
    a = np.frombuffer(b"".join(raws), np.uint8)
    sums = prefix_sums(a)
    _, down = powers(len(a) + 1)
    begin = np.concatenate(([0], np.cumsum([len(r) for r in raws])[:-1]))
    at = np.repeat(begin, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return mix((sums[at + depth] - sums[at]) * down[at])


def repeated_in(df: pd.DataFrame, depth: int) -> pd.DataFrame:
    """Spans (key, lo, hi) of the suffixes that occur twice or more among runs of the same digit, neighbours merged."""
    if not len(df):
        return pd.DataFrame({"key": [], "lo": [], "hi": []}).astype("int64")
    n = df["n"].to_numpy().astype(np.int64)
    w = suffix_hashes(df["raw"].tolist(), n, depth)
    h, row = np.repeat(df["h"].to_numpy(), n), np.repeat(np.arange(len(df)), n)
    order = np.lexsort((w, h))
    same = (h[order][1:] == h[order][:-1]) & (w[order][1:] == w[order][:-1])
    twice = np.zeros(len(w), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)
    place = df["lo"].to_numpy()[row[at]] + at - (np.cumsum(n) - n)[row[at]]
    new = np.ones(len(at), bool)
    new[1:] = (row[at][1:] != row[at][:-1]) | (place[1:] != place[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    if not len(at):
        first = last = np.zeros(0, int)
    return pd.DataFrame({"key": df["key"].to_numpy()[row[at][first]], "lo": place[first], "hi": place[last] + depth})


def spans_by_digit(open_runs: DataFrame, depth: int) -> DataFrame:
    """Runs sorted by digit; whole digits are handled together, batch after batch."""
    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left = None
        for b in it:
            if not len(b):
                continue
            b = b if left is None else pd.concat([left, b], ignore_index=True)
            last = b["h"].to_numpy() == b["h"].iloc[-1]
            left = b[last]
            yield repeated_in(b[~last].reset_index(drop=True), depth)
        if left is not None:
            yield repeated_in(left.reset_index(drop=True), depth)

    return open_runs.repartition("h").sortWithinPartitions("h").mapInPandas(batches, "key long, lo long, hi long")


def spans_by_suffix(open_runs: DataFrame, depth: int) -> DataFrame:
    """The same for digits with many runs: every suffix is a row, counted with partial aggregation."""
    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in it:
            for at in range(0, len(b), 1000):
                p = b.iloc[at:at + 1000]
                n = p["n"].to_numpy().astype(np.int64)
                lo = np.repeat(p["lo"].to_numpy(), n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                yield pd.DataFrame({"h": np.repeat(p["h"].to_numpy(), n), "w": suffix_hashes(
                    p["raw"].tolist(), n, depth).astype(np.int64), "key": np.repeat(p["key"].to_numpy(), n), "lo": lo})

    rows = open_runs.mapInPandas(batches, "h long, w long, key long, lo long")
    same = rows.groupBy("h", "w").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("h", "w")
    return rows.join(same, ["h", "w"]).select("key", "lo", (F.col("lo") + depth).alias("hi"))


def repeated_spans(texts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(key, lo, hi): bytes lo to hi of the texts of that key are covered by repeated suffixes; spans may overlap."""
    contents = (counted_runs(texts, depth).repartition("h").groupBy("h", "ctx").agg(F.sum("c").alias("copies")))
    digits = contents.groupBy("h").agg(F.sum("copies").alias("total"), F.count(F.lit(1)).alias("kinds")).where("total > 1")
    alive = materialize(contents.join(digits, "h").select("h", "ctx", "copies", "kinds"), "dedup_alive")
    marks = texts.sparkSession.sparkContext.broadcast(marked(alive, "h"))
    hit = materialize(marked_runs(texts, marks, depth).join(alive, ["h", "ctx"]), "dedup_runs")
    told = hit.where("copies > 1").select("key", "lo", (F.col("lo") + F.col("n") - 1 + depth).alias("hi"))
    one = (hit.where("kinds > 1").groupBy("h", "ctx").agg(F.min(F.struct("key", "lo", "n", "kinds")).alias("one"))
           .select("h", "one.*"))
    found = materialize(contexts(texts, materialize(one, "dedup_open"), depth), "dedup_contexts")
    return (told.union(spans_by_digit(found.where(F.col("kinds") <= MANY), depth))
            .union(spans_by_suffix(found.where(F.col("kinds") > MANY), depth)))


def remaining(raw: bytes, spans) -> tuple[int, int, bytes]:
    """(bytes removed, maximal removed runs, what is left)."""
    s = sorted((int(x["lo"]), int(x["hi"])) for x in spans)
    kept, at, removed, n, i = [], 0, 0, 0, 0
    while i < len(s):
        lo, hi = s[i]
        while i + 1 < len(s) and s[i + 1][0] <= hi:
            i += 1
            hi = max(hi, s[i][1])
        kept.append(raw[at:lo])
        removed, n, at, i = removed + hi - lo, n + 1, hi, i + 1
    kept.append(raw[at:])
    return removed, n, b"".join(kept)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH,
          with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and the kept bytes)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(empty_if_null(text_col)).alias("key"),
                       empty_if_null(text_col).alias("text"))
    spans = repeated_spans(rows, depth)
    spans = materialize(spans.distinct(), "dedup_spans")
    per_text = materialize(spans.groupBy("key").agg(F.collect_list(F.struct("lo", "hi")).alias("spans")), "dedup_texts")
    marks = docs.sparkSession.sparkContext.broadcast(marked(per_text, "key"))
    maybe = maybe_in(marks)

    def cut(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in it:
            out = []
            for d, text, spans in zip(b["doc_id"], b["text"], b["spans"]):
                raw = text.encode()
                removed, n, kept = remaining(raw, spans if spans is not None else [])
                out.append((None if pd.isna(d) else int(d), len(raw), removed, n, hashlib.sha256(kept).hexdigest(),
                            kept if with_text else None))
            df = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
            yield df.astype({"doc_id": "Int64"})

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    touched = rows.where(maybe("key")).join(per_text, "key", "left").mapInPandas(cut, schema)
    raw = F.col("text").cast("binary")
    clean = rows.where(~maybe("key")).select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.sha2(raw, 256).alias("kept_sha256"),
        (raw if with_text else F.lit(None).cast("binary")).alias("kept"))
    out = touched.union(clean)
    return out if with_text else out.drop("kept")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"))
