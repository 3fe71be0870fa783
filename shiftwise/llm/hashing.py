"""Vectorised hashing of words and byte strings, and count sketches of fixed size."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    if len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((BASE, INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[k] = np.cumprod(p, dtype=np.uint64)
    return _POWERS[0][:n], _POWERS[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits depend on all input bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def prefix_sums(a: np.ndarray) -> np.ndarray:
    """Polynomial prefix hash: the bytes i to j hash to (out[j] - out[i]) * BASE**-i."""
    up, _ = powers(len(a) + 1)
    out = np.empty(len(a) + 1, np.uint64)
    out[0] = 0
    np.cumsum((a.astype(np.uint64) + np.uint64(1)) * up[: len(a)], out=out[1:])
    return out


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (white space is space and \\t to \\r; A-Z count as a-z) and the text each is from."""
    a = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    a = np.where((a >= 65) & (a <= 90), a + 32, a).astype(np.uint8)
    space = np.concatenate(([True], (a == 32) | ((a >= 9) & (a <= 13))))
    edge = np.flatnonzero(space[1:] != space[:-1])
    start, end = edge[0::2], edge[1::2]
    sums = prefix_sums(a)
    _, down = powers(len(a) + 1)
    h = mix((sums[end] - sums[start]) * down[start] ^ (end - start).astype(np.uint64))
    begin = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    return h, np.searchsorted(begin, start, "right") - 1


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its ``size``-word shingles; a shorter text has its whole word sequence as one."""
    h, doc = word_hashes(texts)
    first = np.searchsorted(doc, np.arange(len(texts) + 1))
    n = np.diff(first)
    windows = max(len(h) - size + 1, 0)
    s = np.zeros(windows, np.uint64)
    for k in range(size):
        s = mix(s * np.uint64(31) + h[k:k + windows])
    out = []
    for i, m in enumerate(n.tolist()):
        if m >= size:
            out.append(np.unique(s[first[i]:first[i] + m - size + 1]))
        elif m:
            x = np.zeros(1, np.uint64)
            for k in range(m):
                x = mix(x * np.uint64(31) + h[first[i] + k:first[i] + k + 1])
            out.append(mix(x + np.uint64(m)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def in_parts(texts: list[str | None], limit: int = 1_000_000) -> Iterator[list[bytes]]:
    """The texts as bytes, in runs of about ``limit`` bytes."""
    run, n = [], 0
    for t in texts:
        run.append((t or "").encode())
        n += len(run[-1])
        if n >= limit:
            yield run
            run, n = [], 0
    if run:
        yield run


SKETCH_BITS = 22
SLICES = 64
FAN = 64


def bucket(h: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64)


SLICE = "part long, slice int, counts binary"


def sliced(total: np.ndarray, part: int) -> pd.DataFrame:
    return pd.DataFrame({"part": part, "slice": range(SLICES),
                         "counts": [zlib.compress(x.tobytes(), 1) for x in np.split(total, SLICES)]})


def add_up(rows: DataFrame, parts: int, join=np.add, kind=np.uint32) -> np.ndarray:
    """The tasks' arrays (sent as slices) joined element by element, in rounds of at most FAN arrays a task.

    The result has a fixed size whatever the corpus.
    """
    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = None
        for x in pdf["counts"]:
            x = np.frombuffer(zlib.decompress(x), kind)
            total = x.copy() if total is None else join(total, x)
        return pd.DataFrame({"part": [int(pdf["part"].iloc[0]) // FAN], "slice": [int(pdf["slice"].iloc[0])],
                             "counts": [zlib.compress(total.tobytes(), 1)]})

    while True:
        rows = rows.groupBy((F.floor(F.col("part") / FAN)).alias("grp"), "slice").applyInPandas(add, SLICE)
        parts = -(-parts // FAN)
        if parts <= 1:
            break
    got = sorted((r["slice"], r["counts"]) for r in rows.collect())  # SLICES rows
    return np.concatenate([np.frombuffer(zlib.decompress(bytes(x)), kind) for _, x in got]) if got else np.zeros(0, kind)


MARK_BITS = 23


MOST_MARK_BITS = 28  # 32 MB, the largest filter that is broadcast


def bits_for(values: int) -> int:
    """Bits of a filter over so many values: one in 16 set or less, between 1 MB and 32 MB."""
    return min(max(MARK_BITS, (16 * max(values, 1) - 1).bit_length()), MOST_MARK_BITS)


def mark_bucket(values: np.ndarray, bits: int = MARK_BITS) -> np.ndarray:
    return (mix(values.astype(np.int64).view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


def marked(rows: DataFrame, col: str, width: int = MARK_BITS) -> np.ndarray:
    """A filter of ``width`` bits (:func:`bits_for`) over the values of a long column; it never misses a value."""
    def mark(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(1 << width, bool)
        for b in it:
            seen[mark_bucket(b[col].to_numpy(), width)] = True
        yield sliced(np.packbits(seen), TaskContext.get().partitionId())

    bits = add_up(rows.select(col).mapInPandas(mark, SLICE), rows.rdd.getNumPartitions(), np.bitwise_or, np.uint8)
    return bits if len(bits) else np.zeros((1 << width) // 8, np.uint8)


def in_marks(values: np.ndarray, marks: np.ndarray) -> np.ndarray:
    at = mark_bucket(values, (8 * len(marks)).bit_length() - 1)
    return (marks[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
