import math
import random

import numpy as np
import pytest

from shiftwise.llm import hard_negatives as hn


def plainly(rows, every, positives=5, negatives=10, low=30, high=90):
    """(vec_id, label, vector) rows -> result rows, one product after another."""
    fine = []
    for r, (i, label, v) in enumerate(rows):
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v):
            fine.append((r, i, label, [math.floor(256 * x) for x in v]))
    last = float("inf")
    out = []
    for r, i, label, v in fine:
        if i is None or i % every:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), last if j is None else j, s, other == label)
                         for s, j, other, w in fine if s != r and len(w) == len(v)), key=lambda x: x[:3])
        for ps, p, _, _ in [x for x in scored if x[3]][:positives]:
            hit = [x for x in scored if not x[3] and low * -ps <= 100 * -x[0] <= high * -ps][:negatives]
            out += [(i, None if p == last else p, k, None if n == last else n, -ps, -ns) for k, (ns, n, _, _) in enumerate(hit, 1)]
    return sorted(out, key=str)


def run(spark, rows, **more):
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "vec_id long, label int, embedding array<double>, rank int, row string")
    got = hn.hard_negatives(df, **more)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def vectors(n, dim, kinds, seed):
    rng = np.random.default_rng(seed)
    middles = rng.standard_normal((kinds, dim))
    return [(i, int(rng.integers(0, kinds)), (middles[i % kinds] + 0.6 * rng.standard_normal(dim)).round(3).tolist()) for i in range(n)]


def test_walk_is_in_order():
    rng = random.Random(2)
    a, b = (sorted((rng.random() for _ in range(n)), reverse=True) for n in (7, 5))
    seen = list(hn.walk(a, b))
    assert [x[0] for x in seen] == sorted((x + y for x in a for y in b), reverse=True)
    assert len({x[1:] for x in seen}) == 35


def test_cells_fill_blocks():
    got = hn.cell_blocks([(4, 0, 0, 10), (4, 0, 1, 3), (4, 1, 0, 60), (4, 2, 2, 30), (8, 0, 0, 1)], 100)
    assert got == [(4, 0, 0, 0, 1), (4, 0, 1, 0, 1), (4, 1, 0, 1, 3), (4, 2, 2, 4, 2), (8, 0, 0, 6, 1)]


@pytest.mark.parametrize("dim,elements,group", [(8, 400, 3), (1, 1 << 20, 4096)])
def test_against_brute_force(spark, dim, elements, group):
    rows = vectors(400, dim, 4, dim)
    got = run(spark, rows, every=20, elements=elements, group=group, codes=4)
    assert got == plainly(rows, 20) and len(got) > 100


def test_nulls_ties_repeats_and_dimensions(spark):
    rows = vectors(150, 6, 3, 9)
    same = [0.5, -0.25, 0.125, 0.5, 0.0, 0.25]
    rows += [(1000 + i, i % 2, same) for i in range(120)]  # one cell, all ties
    rows += [(1000, 0, same)] * 3  # an anchor's copies
    rows += [(200, None, same), (300, 0, None), (400, 1, []), (500, 1, [float("nan")] * 6), (600, 1, [float("inf")] * 6),
             (700, 1, [0.1, None, 0.1, 0.1, 0.1, 0.1]), (None, 0, same), (None, 1, [x * 0.6 for x in same]), (800, 2, [0.0] * 6)]
    rows += vectors(60, 5, 2, 4)  # ids come again with another dimension
    assert run(spark, rows, every=50, elements=300, codes=3) == plainly(rows, 50)


def test_scores_beyond_doubles(spark):
    rng = np.random.default_rng(8)
    rows = [(i, int(i % 3), (rng.standard_normal(4) * 400_000).tolist()) for i in range(200)]
    assert run(spark, rows, every=25) == plainly(rows, 25)


def test_empty_table_and_no_partners(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, 1, [1.0, 0.0])]) == []
    assert run(spark, [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0])]) == []


def test_query_equals_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    duckdb.sql(f"create or replace view embeddings as select * from '{sf}/embeddings.parquet'")
    want = sorted(duckdb.sql(hn.SQL).fetchall(), key=str)
    assert sorted((tuple(r) for r in hn.query(spark, sf).collect()), key=str) == want and want
