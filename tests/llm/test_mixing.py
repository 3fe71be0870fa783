import random
from collections import defaultdict

import brute
import pytest

from shiftwise.llm import mixing


def reference(sizes, seats, weights=(5, 2, 1), epochs=3):
    """Targets by water filling and seats one by one to the highest quotient."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(epochs * sizes[s] for s in capped)
        t = {s: epochs * sizes[s] if s in capped else left * w[s] / sum(w[x] for x in free) for s in names}
        over = {s for s in free if t[s] > epochs * sizes[s] * (1 + 1e-12)}
        if not over:
            break
        capped |= over
    quota = dict.fromkeys(names, 0)
    for _ in range(seats):
        best = max(names, key=lambda s: (t[s] / (2 * quota[s] + 1), -names.index(s)))
        quota[best] += 1
    return t, quota


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(docs, seed):
    rng = random.Random(seed)
    names = ["a", "b", "c", "d", "é", "\U0001F600", None]
    rows = [(i, "w " * rng.randrange(80), "en", rng.choice(names[: 3 + 2 * seed - 2] if seed < 3 else names)) for i in range(200)]
    rows += [(500, None, "en", "a"), (501, "", "en", "zero"), (600, "q " * 20, "en", "b"), (600, "q " * 20, "en", "b"),
             (None, "x y", "en", "c")]
    got = mixing.mix_sources(docs(rows), block=16).collect()
    assert len(got) == len(rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(brute.words(r[1]))
    total = sum(sizes.values())
    target, quota = reference(sizes, -(-total // 16))
    assert sorted((r["source_size"], round(r["target"], 6), r["quota"]) for r in got) == sorted(
        (sizes[r[3]], round(target[r[3]], 6), quota[r[3]]) for r in rows)
    by_id = {r[0]: r[3] for r in rows}
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[by_id[r["doc_id"]]] += r["taken"]
    for s in sizes:
        assert taken[s] == min(quota[s] * 16, 3 * sizes[s])
    again = mixing.mix_sources(docs(rows[::-1]).repartition(5), block=16).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_empty(docs):
    assert mixing.mix_sources(docs([])).count() == 0
    got = mixing.mix_sources(docs([(1, None), (2, "")])).collect()
    assert [(r["taken"], r["target"]) for r in got] == [(0, 0.0)] * 2


def test_shard_quotas_add_up(spark):
    s = spark.createDataFrame([(0, "a", 500.0), (1, "b", 300.0), (2, "c", 7.0)], "rank long, source string, target double")
    for blocks, shards in ((40, 4), (1000, 7), (3, 5)):
        upto = {r["source"]: r["upto"] for r in mixing.shard_quotas(s, blocks, shards).collect()}
        for k in range(shards):  # every prefix of shards is the apportionment of its blocks
            whole = {r["source"]: r["quota"] for r in mixing.apportion(s, blocks * (k + 1) // shards).collect()}
            assert {name: u[k] for name, u in upto.items()} == whole
        assert all(list(u) == sorted(u) for u in upto.values())


def test_shards_hold_their_quotas(docs):
    rng = random.Random(4)
    rows = [(i, "w " * rng.randrange(60), "en", rng.choice("abc")) for i in range(300)]
    got = mixing.mix_sources(docs(rows), block=8, shards=6).collect()
    assert all((r["shard"] is None) == (r["taken"] == 0) for r in got)
    assert {r["shard"] for r in got if r["taken"]} == set(range(6))
    words = defaultdict(int)
    for r in got:
        if r["taken"]:
            words[r["shard"]] += min(r["taken"], r["size"])
    assert max(words.values()) <= 2 * sum(len(brute.words(r[1])) for r in rows) / 6


def test_stage_takes_effect(spark, docs):
    d = docs([(i, f" a{i}\nb c  d{i} " * 8, "en", "x" if i % 3 else "y") for i in range(30)])
    got = mixing.stage(spark, d, "")
    assert got.columns == d.columns
    words = defaultdict(int)
    for r in got.collect():
        words[r["doc_id"]] += len(brute.words(r["text"]))
        assert r["n_chars"] == len(r["text"])
    want = {r["doc_id"]: r["taken"] for r in mixing.mix_sources(d).collect()}
    assert {k: v for k, v in want.items() if v} == dict(words)
