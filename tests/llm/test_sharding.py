import itertools
import random
import zlib

from pyspark.sql import functions as F

from shiftwise.llm.sharding import hilbert_index, hilbert_shards


def test_hilbert_curve_is_a_walk(spark):
    """Neighbours on the curve differ by one in one coordinate, and every cell is met once."""
    for n, bits in ((2, 3), (3, 2), (4, 2), (2, 1)):
        cells = list(itertools.product(range(1 << bits), repeat=n))
        df = spark.createDataFrame(cells, ", ".join(f"c{i} int" for i in range(n)))
        got = df.withColumn("k", hilbert_index([F.col(f"c{i}") for i in range(n)], bits)).orderBy("k").collect()
        assert [r["k"] for r in got] == list(range(len(cells)))
        for a, b in itertools.pairwise(got):
            assert sum(abs(x - y) for x, y in zip(a[:n], b[:n])) == 1


def test_rows_law_and_edge_cases(docs):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randrange(30), rng.choice(["en", "de", None]), rng.choice(["a", "b", None])) for i in range(95)]
    rows += [(7, None, None, None), (None, "x", "en", "a"), (3, "same", "en", "a"), (3, "same", "en", "a")]
    got = hilbert_shards(docs(rows), shards=10).collect()
    assert len(got) == len(rows)
    assert sorted((r["doc_id"] or -1, r["size"], r["text_crc32"]) for r in got) == sorted(
        (r[0] or -1, len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)
    shards = {s: sorted(r["slot"] for r in got if r["shard"] == s) for s in range(10)}
    assert all(v == list(range(len(v))) for v in shards.values())
    sizes = [len(v) for v in shards.values()]
    assert max(sizes) - min(sizes) <= 1
    assert {r["law"] for r in got} == {"rows"} and {r["grown_shard"] for r in got} == {None}


def test_empty_and_fewer_rows_than_shards(docs):
    assert hilbert_shards(docs([]), shards=4).count() == 0
    got = hilbert_shards(docs([(1, "a"), (2, "b")]), shards=4).collect()
    assert sorted((r["shard"], r["slot"]) for r in got) == [(0, 0), (1, 0)]


def test_curve_prunes_every_dimension(docs):
    rows = [(i, "w " * (1 + i * 37 % 200), "en" if i % 3 else "de", f"s{i % 8}") for i in range(800)]
    got = hilbert_shards(docs(rows), shards=16).join(docs(rows).select("doc_id", "source"), "doc_id").collect()
    touched = [len({r["shard"] for r in got if r["source"] == f"s{k}"}) for k in range(8)]
    assert sum(touched) / 8 < 12  # a random layout touches all 16


def test_equal_texts_stand_together(docs):
    rng = random.Random(5)
    rows = [(i, f"text {i}" if i % 3 else f"copy {rng.randrange(40)}", rng.choice(["en", "de"]), rng.choice("abcd")) for i in range(600)]
    rows += [(1000 + i, "hot", "en", "abcd"[i % 4]) for i in range(120)] + [(None, None, None, None), (2000, "", "en", "a")]
    text = dict((r[0], r[1] or "") for r in rows)
    got = hilbert_shards(docs(rows), shards=12).collect()
    where = {}
    for r in got:
        where.setdefault(text[r["doc_id"]], set()).add(r["shard"])
    assert sum(len(v) - 1 for v in where.values()) <= 11
    assert len(where["hot"]) <= 4  # 120 rows in shards of 60
    place = {}
    for r in sorted(got, key=lambda r: (r["shard"], r["slot"])):
        place.setdefault(text[r["doc_id"]], []).append((r["shard"], r["slot"]))
    order = {(r["shard"], r["slot"]): i for i, r in enumerate(sorted(got, key=lambda r: (r["shard"], r["slot"])))}
    for v in place.values():
        at = [order[x] for x in v]
        assert at == list(range(at[0], at[0] + len(at)))
