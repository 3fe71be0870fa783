import random

import brute
import numpy as np
import pytest

from shiftwise.llm import suffix_dedup
from shiftwise.llm.suffix_dedup import dedup, sliding_min


def result(df, **kw):
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
                  for r in dedup(df, **kw).collect())


def corpus(rng):
    def text(n):
        return "".join(rng.choice("abcdefgh é\n") for _ in range(n))

    passages = [text(k) for k in (199, 200, 201, 260, 400, 900)]
    rows = [text(rng.randrange(600)) for _ in range(20)]
    for _ in range(40):
        rows.append("".join(rng.choice([text(rng.randrange(120)), rng.choice(passages)]) for _ in range(rng.randrange(1, 6))))
    base = text(1500)
    for _ in range(8):
        t = list(base)
        for _ in range(rng.randrange(4)):
            t[rng.randrange(len(t))] = "Z"
        rows.append("".join(t))
    rows += ["x" * 150, "x" * 200, "x" * 201, "y" * 350, "ab" * 400, "abc" * 30, base[:700] + base[:700]]
    return rows


def test_matches_brute_force(docs):
    for seed in (1, 2):
        rng = random.Random(seed)
        rows = list(enumerate(corpus(rng)))
        rows += [(500, None), (501, ""), (502, "\U0001F600" * 70), (503, "\U0001F600" * 70), (7, rows[7][1]), (None, rows[45][1])]
        assert result(docs(rows)) == brute.repeats(rows)


def test_many_runs_of_a_digit(docs, monkeypatch):
    """The row-wise way gives the same as the batch-wise way."""
    rng = random.Random(3)
    rows = list(enumerate(corpus(rng)))
    want = brute.repeats(rows)
    monkeypatch.setattr(suffix_dedup, "MANY", 0)
    assert result(docs(rows)) == want


def test_cut_texts(docs, monkeypatch):
    """Texts longer than a piece, cut with an overlap (run in this process, so the small piece holds)."""
    rng = random.Random(5)
    monkeypatch.setattr(suffix_dedup, "PIECE", 700)
    t = "".join(rng.choice("abcd") for _ in range(3000))
    got = list(suffix_dedup.pieces([t], [1], 200))
    starts = [(f + s, n) for raw, ends, firsts, _ in got for f, r in [(firsts[0], suffix_dedup.runs_of(
        np.frombuffer(raw, np.uint8), ends))] for s, n in zip(r["start"], r["n"])]
    assert sum(n for _, n in starts) == 3000 - 199
    assert sorted(x for s, n in starts for x in range(s, s + n)) == list(range(2801))


def test_planted_table_and_text(spark, docs):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert result(d) == brute.repeats([(r["doc_id"], r["text"]) for r in d.collect()])
    got = dedup(docs([(1, "a" * 250), (2, "b" * 10)]), with_text=True).collect()
    assert sorted(bytes(r["kept"]) for r in got) == [b"", b"b" * 10]
    assert dedup(docs([])).count() == 0


@pytest.mark.parametrize("width", [1, 3, 7])
def test_sliding_min(width):
    v = np.random.default_rng(1).integers(0, 50, 40).astype(np.uint64)
    assert sliding_min(v, width).tolist() == [min(v[i:i + width]) for i in range(len(v) - width + 1)]
