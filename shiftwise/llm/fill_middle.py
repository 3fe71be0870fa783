"""Fill-in-middle transformation over a wavelet matrix of character classes.

Every byte of the UTF-8 text belongs to one of four classes: a byte inside a
character, a letter inside a run of letters, a letter that starts a run, or any
other character's first byte. A wavelet matrix over that sequence answers "how
many bytes of this class come before position i" in two steps, one per bit of
the class. Ranks combine into counts: units ([A-Za-z]+ or one other character)
that begin before i, and characters before i. A cut after u units is the place
where unit u + 1 begins, found by bisection on those ranks, for both cuts of
all texts of a batch at once.

The cuts and the form follow from the id's hash, so reruns agree. Prefix,
middle and suffix go out as ``<P>``prefix``<S>``suffix``<M>``middle (psm) or
``<S>``suffix``<P>``prefix``<M>``middle (spm); a text that holds a marker, is
empty, or falls to the plain share stays as it is. ``restored`` is the inverse.

Arrow batches are read in place, in parts of about ``PART`` bytes (a longer
text is a part of its own); nothing is shuffled. Null text is empty; a null id
hashes as no digits; repeated rows give repeated results; an empty table gives
no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftwise.llm.common import empty_if_null, table

# Markers, seed of the id's hash, shares in percent.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = 1
PLAIN_FROM = 90
SPM_BELOW = 20

PART = 4_000_000
WITHIN, INSIDE, FIRST, OTHER = 0, 1, 2, 3  # byte classes
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


class Bits:
    """A bit sequence with counted words: rank in constant time."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Set bits before each position."""
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[i >> 6] + np.bitwise_count(self.words[i >> 6] & low)


class WaveletMatrix:
    """Ranks of small symbols: per bit, highest first, the bits in an order stably sorted by the bits above."""

    def __init__(self, symbols: np.ndarray, bits: int = 2):
        self.levels: list[tuple[int, Bits, int]] = []
        for level in range(bits - 1, -1, -1):
            up = (symbols >> level & 1).astype(bool)
            self.levels.append((level, Bits(up), int(len(up) - np.count_nonzero(up))))
            symbols = np.concatenate((symbols[~up], symbols[up]))

    def rank(self, symbol: int, i: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before each position."""
        low, high = np.zeros(1, np.int64), np.asarray(i, np.int64)
        for level, up, zeros in self.levels:
            if symbol >> level & 1:
                low, high = zeros + up.ones(low), zeros + up.ones(high)
            else:
                low, high = low - up.ones(low), high - up.ones(high)
        return high - low


def byte_classes(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Class of each byte; no run of letters goes on over a text's beginning."""
    lower = data | 0x20
    letter = (lower >= 97) & (lower <= 122)
    goes_on = letter.copy()
    goes_on[1:] &= letter[:-1]
    goes_on[begins[begins < len(data)]] = False
    out = np.full(len(data), OTHER, np.uint8)
    out[letter] = FIRST
    out[goes_on] = INSIDE
    out[(data & 0xC0) == 0x80] = WITHIN
    return out


class Units:
    """Units and characters of texts that lie one after another in ``data``."""

    def __init__(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray):
        self.begins, self.ends = begins, ends
        self.matrix = WaveletMatrix(byte_classes(data, begins))
        self.skip = self.units_before(begins)
        self.n = self.units_before(ends) - self.skip

    def units_before(self, i: np.ndarray) -> np.ndarray:
        """Units that begin before each position."""
        return self.matrix.rank(FIRST, i) + self.matrix.rank(OTHER, i)

    def chars_before(self, i: np.ndarray) -> np.ndarray:
        return self.units_before(i) + self.matrix.rank(INSIDE, i)

    def cut(self, units: np.ndarray) -> np.ndarray:
        """Per text the position after its first ``units`` units: the first place whose unit is one more, or the end."""
        low, high = self.begins.copy(), self.ends.copy()
        while (low < high).any():
            mid = (low + high) >> 1
            beyond = self.units_before(np.minimum(mid + 1, self.ends)) - self.skip > units
            high = np.where(beyond, mid, high)
            low = np.where(beyond | (low >= high), low, mid + 1)
        return low


def draws(ids: list) -> np.ndarray:
    """Four unsigned 32-bit numbers per id."""
    out = bytearray()
    for i in ids:
        out += hashlib.sha256(f"{SEED}:{'' if i is None else i}".encode()).digest()[:16]
    return np.frombuffer(bytes(out), ">u4").astype(np.int64).reshape(-1, 4)


def _transformed(ids: list, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
    units, h = Units(data, begins, ends), draws(ids)
    picks = h[:, :2] % (units.n + 1)[:, None]
    first, second = units.cut(picks.min(axis=1)), units.cut(picks.max(axis=1))
    chars = [units.chars_before(x) for x in (begins, first, second)]
    whole = data.tobytes()
    marked = any(m in whole for m in (PREFIX, SUFFIX, MIDDLE))
    forms, outputs = [], []
    for a, b, c, d, h3, h4 in zip(begins.tolist(), first.tolist(), second.tolist(), ends.tolist(), h[:, 2].tolist(), h[:, 3].tolist()):
        if a == d or h3 % 100 >= PLAIN_FROM or (marked and any(whole.find(m, a, d) >= 0 for m in (PREFIX, SUFFIX, MIDDLE))):
            forms.append("plain")
            outputs.append(whole[a:d])
        elif h4 % 100 < SPM_BELOW:
            forms.append("spm")
            outputs.append(b"".join((SUFFIX, whole[c:d], PREFIX, whole[a:b], MIDDLE, whole[b:c])))
        else:
            forms.append("psm")
            outputs.append(b"".join((PREFIX, whole[a:b], SUFFIX, whole[c:d], MIDDLE, whole[b:c])))
    plain = np.array([f == "plain" for f in forms], bool)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(units.n), pa.array(forms, pa.string()),
         pa.array(chars[1] - chars[0], mask=plain), pa.array(chars[2] - chars[1], mask=plain),
         pa.array(outputs, pa.binary()).cast(pa.string())],
        names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def text_parts(batch: pa.RecordBatch, column: str, limit: int = PART) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(from row, to row, bytes, begins, ends): runs of rows of about ``limit`` bytes, read from Arrow's buffers in place."""
    texts = batch.column(column).cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1 + texts.offset)[texts.offset:]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        upto = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        edges = offsets[row:upto + 1] - offsets[row]
        yield row, upto, data[offsets[row]:offsets[upto]], edges[:-1], edges[1:]
        row = upto


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part: int = PART) -> DataFrame:
    """One row per document: doc_id, n (units), form, prefix_chars, middle_chars (null if plain) and the output text."""
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            ids = batch.column("doc_id").to_pylist()
            for row, upto, data, begins, ends in text_parts(batch, "text", part):
                yield _transformed(ids[row:upto], data, begins, ends)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), empty_if_null(text_col).alias("text"))
    return rows.mapInArrow(batches, SCHEMA)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output was made from. Each marker stands once in it, so splitting there is exact."""
    p, s, m = (x.decode() for x in (PREFIX, SUFFIX, MIDDLE))

    def before(c: Column, mark: str) -> Column:
        return F.substring_index(c, mark, 1)

    def after(c: Column, mark: str) -> Column:
        return F.substring_index(c, mark, -1)

    out = F.col(output)
    middle, rest = after(out, m), before(out, m)
    psm = F.concat(before(after(rest, p), s), middle, after(rest, s))
    spm = F.concat(after(rest, p), middle, before(after(rest, s), p))
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(out)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = fill_in_middle(table(spark, sf_dir, "documents"))
    return done.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(), 256).alias("restored_sha256"))


#: The same rows by regular expressions and lists.
SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u
  FROM documents
),
hashed AS (
  SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS UBIGINT) AS h1, CAST('0x' || h[9:16] AS UBIGINT) AS h2,
         CAST('0x' || h[17:24] AS UBIGINT) AS h3, CAST('0x' || h[25:32] AS UBIGINT) AS h4
  FROM d
),
cut AS (
  SELECT *, CAST(least(h1 % (n + 1), h2 % (n + 1)) AS BIGINT) AS a, CAST(greatest(h1 % (n + 1), h2 % (n + 1)) AS BIGINT) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM hashed
),
parts AS (
  SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s
  FROM cut
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""
