"""Cost-balanced packing of documents into token sequences.

A piece of n tokens costs n + n*n / (6 * hidden): the linear and the quadratic
part of a transformer's work. Documents longer than a sequence are cut at
multiples of its length; whole pieces are sequences of their own. The
remainders are dealt to groups of bounded size, and in each group go, in
descending length, to the lowest-cost sequence that still has room. A group
opens as many sequences as its tokens need; what fits nowhere is cut to fill
the gaps, so a group pads less than one sequence.

Tokenisation runs once, in Arrow batches; only remainders carry their ids (two
bytes each) through the one shuffle. Null text is empty: its document is the
end id alone. Repeated rows are packed each; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftwise.llm.common import table

LENGTH = 2048
END_ID = 1
HIDDEN = 2048
GROUP = 4096  # documents whose remainders one task packs at a time
CACHE = 400_000  # distinct chunks in each of the two generations a worker keeps

# Character classes below U+0250, where they are stable; other texts take the tokenizer's own path (fixed values).
_L = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_N = "0-9²³¹¼-¾"
_S = " \t-\r\x85\xa0"
_OUTSIDE = re.compile("[^\x00-ɏ]|<\\|endoftext\\|>")
_RARE = re.compile("[^\x01-\x08\n\x0e-\x84\x86-\x9f¡-ɏ]|<\\|endoftext")
_RUNS = ("  ", "\n\n", " \n", "\n ")
_PIECES = re.compile(f"'(?:[sdmt]|ll|ve|re)| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")


class ChunkIds(dict):
    """Chunk of text -> its ids as little-endian 16-bit integers.

    Holds two generations: when the young one is full it becomes the old one,
    so frequent chunks survive and memory stays bounded.
    """

    def __init__(self, encode):
        super().__init__()
        self.encode, self.old = encode, {}

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= CACHE:
            self.old = dict(self)
            self.clear()
        ids = self.old.get(chunk)
        if ids is None:
            ids = array("H", [i for piece in _PIECES.findall(chunk) for i in self.encode(piece.encode())]).tobytes()
        self[chunk] = ids
        return ids


class Encoder:
    """Ids of a byte-level BPE file (tokenizers JSON) as 16-bit integers, END_ID last.

    Texts below U+0250 are split by the vocabulary's own word pattern and each
    distinct piece is encoded once, by the same vocabulary in rank form; every
    other text goes through the tokenizers library whole. Where white space
    stands alone, a space opens a piece and a line feed is one, whatever
    surrounds them, so the text falls into chunks that are looked up whole.
    """

    def __init__(self, json_path: str, rank_path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(json_path)
        if self.whole.get_vocab_size() > 1 << 16:
            raise ValueError("ids must fit 16 bits")
        with open(rank_path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        words = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.chunks = ChunkIds(words._core_bpe.encode_single_piece)
        self.end = array("H", [END_ID]).tobytes()

    def __call__(self, text: str | None) -> bytes:
        text = text or ""
        rare = _RARE.search(text)
        if rare and _OUTSIDE.search(text):
            return array("H", self.whole.encode(text, add_special_tokens=False).ids).tobytes() + self.end
        if rare or text.endswith((" ", "\n")) or any(run in text for run in _RUNS):
            chunks = _PIECES.findall(text)
        else:
            chunks = text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")
        return b"".join(map(self.chunks.__getitem__, chunks)) + self.end


_ENCODERS: dict = {}


def encoder(paths: tuple) -> Encoder:
    """One encoder a worker process."""
    if paths not in _ENCODERS:
        _ENCODERS[paths] = Encoder(*paths)
    return _ENCODERS[paths]


def public_paths() -> tuple:
    import public_tokenizers as p

    return p.path("byte_bpe_50k.json"), p.path("byte_bpe_50k.tiktoken"), p.PATTERN


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def piece_cost(n):
    return n + n * n / (6.0 * HIDDEN)


PIECES = "doc_id long, start long, length long, doc_tokens long, ids_crc32 long, ids binary, grp long"


def cut(batches: Iterator[pd.DataFrame], paths: tuple, groups: int, length: int = LENGTH) -> Iterator[pd.DataFrame]:
    """Documents -> pieces: whole sequences with their checksum, and remainders with their ids."""
    encode, seen = encoder(paths), 0
    for batch in batches:
        out = []
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            doc_id = None if pd.isna(doc_id) else int(doc_id)
            ids = np.frombuffer(encode(text), dtype="<u2")
            n, whole = len(ids), len(ids) // length
            seen += 1
            grp = zlib.crc32(b"%d %d" % (doc_id or 0, seen)) % groups
            for k in range(whole):
                out.append((doc_id, k * length, length, n, crc32(ids[k * length:(k + 1) * length]), None, grp))
            if n > whole * length:
                out.append((doc_id, whole * length, n - whole * length, n, None, ids[whole * length:].tobytes(), grp))
        df = pd.DataFrame(out, columns=["doc_id", "start", "length", "doc_tokens", "ids_crc32", "ids", "grp"])
        yield df.astype({"doc_id": "Int64", "ids_crc32": "Int64"})


def assign(lengths: np.ndarray, length: int = LENGTH) -> list[tuple[int, int, int, int]]:
    """(piece, from, size, sequence) for pieces shorter than a sequence, given in descending length."""
    n_seq = -(-int(lengths.sum()) // length)
    cost, free = np.zeros(n_seq), np.full(n_seq, length)
    out, left = [], []
    for i, n in enumerate(lengths.tolist()):
        room = np.flatnonzero(free >= n)
        if len(room):
            s = room[np.argmin(cost[room])]
            out.append((i, 0, n, int(s)))
            cost[s] += piece_cost(n)
            free[s] -= n
        else:
            left.append(i)
    for i in left:
        at, n = 0, int(lengths[i])
        while at < n:
            room = np.flatnonzero(free > 0)
            s = room[np.argmin(cost[room])]
            size = min(n - at, int(free[s]))
            out.append((i, at, size, int(s)))
            cost[s] += piece_cost(size)
            free[s] -= size
            at += size
    return out


PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack_group(pdf: pd.DataFrame) -> pd.DataFrame:
    """Pieces of one group -> pieces with sequence and offset."""
    base = int(pdf["grp"].iloc[0]) << 32
    rest = pdf[pdf["ids"].notna()].sort_values(["length", "doc_id", "start"], ascending=[False, True, True])
    done = pdf[pdf["ids"].isna()]
    ids = [np.frombuffer(x, dtype="<u2") for x in rest["ids"]]
    docs, starts, totals = rest["doc_id"].tolist(), rest["start"].tolist(), rest["doc_tokens"].tolist()
    out, used = [], {}
    for i, at, size, s in assign(rest["length"].to_numpy(dtype=np.int64)):
        out.append((docs[i], starts[i] + at, size, crc32(ids[i][at:at + size]), totals[i], base + s, used.get(s, 0)))
        used[s] = used.get(s, 0) + size
    n_seq = len(used)
    for k, r in enumerate(done.itertuples(index=False)):
        out.append((r.doc_id, r.start, r.length, int(r.ids_crc32), r.doc_tokens, base + n_seq + k, 0))
    df = pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
    df["doc_id"] = pd.array([None if pd.isna(x) else int(x) for x in df["doc_id"]], dtype="Int64")
    return df


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", paths: tuple | None = None,
         group: int = GROUP) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    paths = paths or public_paths()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    groups = max(1, -(-docs.count() // group))
    pieces = rows.mapInPandas(lambda it: cut(it, paths, groups), PIECES)
    return pieces.groupBy("grp").applyInPandas(pack_group, PACKED)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
