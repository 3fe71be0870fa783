import math
import random

import numpy as np
import pytest

from shiftwise.llm.vector_search import search

SCHEMA = "vec_id long, embedding array<float>, label int, score double, rank int"


def brute(rows, every=20, k=20):
    ok = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows if v and all(
        c is not None and math.isfinite(c) for c in v) and any(v)]
    out = {}
    for qi, q in ok:
        if qi is not None and qi % every == 0:
            scored = []
            for i, x in ok:
                if i != qi and len(x) == len(q):
                    s = 0.0
                    for a, b in zip(x, q):
                        s += a * b
                    scored.append((-s, i))
            out[qi] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def run(spark, rows, **kw):
    df = spark.createDataFrame(
        [(i, v and [c if c is None else float(c) for c in v], 0, 0.5, 9) for i, v in rows], SCHEMA)
    out = {}
    for r in sorted(search(df, **kw).collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_odd_rows_and_ties(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(1, 60)]
    rows += [(100 + i, [1.0, 0, 0, 0, 0, 0, 0, 2.0]) for i in range(30)]  # ties, the queries 100 and 120 among them
    rows += [(200, None), (201, []), (202, [0.0] * 8), (203, [None] + [1.0] * 7), (204, [math.nan] + [1.0] * 7),
             (220, [math.inf] + [1.0] * 7), (240, [1.0, 2.0]), (241, [2.0, 2.0]), (260, [9.0] * 8)]
    want = brute(rows)
    assert run(spark, rows) == want
    assert run(spark, [(0, [1.0, 2.0])]) == {}
    assert run(spark, []) == {}


@pytest.mark.parametrize("name", ["sf0.01", "sf0.1"])
def test_recall(spark, name):
    v = spark.read.parquet(f"/root/testdata/{name}/embeddings.parquet").collect()
    x = np.array([r["embedding"] for r in v], dtype=float)
    ids = np.array([r["vec_id"] for r in v])
    got = {}
    for r in search(spark.read.parquet(f"/root/testdata/{name}/embeddings.parquet")).collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    hits = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        s = x @ x[i]
        s[i] = -np.inf
        best = set(ids[np.lexsort((ids, -s))[:20]].tolist())
        hits += len(best & set(got[int(ids[i])]))
        total += len(best)
        assert len(got[int(ids[i])]) == 20
    assert hits >= 0.9 * total


def test_recall_on_unstructured_vectors():
    """One block of Gaussian vectors of uneven norms, the hardest case."""
    from shiftwise.llm.vector_search import search_block

    rng = np.random.default_rng(3)
    x = rng.standard_normal((8192, 64)) * rng.uniform(0.5, 1.5, (8192, 1))
    ids = np.arange(len(x))
    asked = ids[::200]
    got = search_block(ids, x, asked, x[asked], float((x * x).sum(axis=1).max()))
    hits = 0
    for i in asked:
        s = x @ x[i]
        s[i] = -np.inf
        hits += len(set(np.argsort(-s)[:20]) & set(got[got["query_id"] == i]["vec_id"]))
    assert hits >= 0.9 * 20 * len(asked)
