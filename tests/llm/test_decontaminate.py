import random
import re

import pytest

from shiftwise.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def plainly(docs, items, window=dc.WINDOW):
    windows = {}
    for item, t in items:
        w = words(t)
        n = min(len(w), window)
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault((n, tuple(w[i:i + n])), set()).add(item)
    out = []
    for doc, t in docs:
        w = words(t)
        hit, found = set(), set()
        for n in {n for n, _ in windows}:
            for i in range(len(w) - n + 1):
                ids = windows.get((n, tuple(w[i:i + n])))
                if ids:
                    hit |= set(range(i, i + n))
                    found |= {str(x) for x in ids if x is not None}
        out.append((doc, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def run(spark, docs, doc_rows, item_rows, **more):
    items = spark.createDataFrame([(*r, 1, "y") for r in item_rows], "item_id long, text string, n_words int, said string")
    got = dc.decontaminate(docs(doc_rows), items, **more)
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_words_of_texts_without_gaps():
    import numpy as np

    texts = ["Ab c", "d", "", "é字x 9", " ", "z_z"]
    data = "".join(texts).encode()
    ends = np.cumsum([len(t.encode()) for t in texts])
    w = dc.Words(np.frombuffer(data, np.uint8), np.concatenate(([0], ends[:-1])), ends)
    assert w.n.tolist() == [len(words(t)) for t in texts]
    assert [w.said(i, i + 1) for i in range(len(w.start))] == [x for t in texts for x in words(t)]
    assert w.shingles(2)[0].tolist() == [0, 3, 5]


@pytest.mark.parametrize("window", [3, 10])
def test_against_plain_reading(spark, docs, window):
    rng = random.Random(3)
    vocabulary = ["a", "The", "of", "éa", "字", "x9", "lo", "ng"]

    def text(n, end=" "):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", "-", ", ", "\n", end]) for _ in range(n))

    item_rows = [(i, text(rng.randrange(0, 25))) for i in range(30)]
    item_rows += [(30, "The of"), (31, "x9"), (32, None), (33, ""), (34, "-- ..."), (None, "lo lo lo lo"), (5, "ng ng NG"),
                  (5, "ng ng ng"), (40, "a a a a a a a a a a a a a a a a a")]
    doc_rows = [(i, text(rng.randrange(0, 120))) for i in range(60)]
    doc_rows += [(100 + i, text(5) + (t or "").upper() + text(5)) for i, t in item_rows if i]
    doc_rows += [(200, None), (201, ""), (202, "..."), (203, "a " * 300), (203, "a " * 300), (None, item_rows[0][1])]
    got = run(spark, docs, doc_rows, item_rows, window=window)
    assert got == plainly(doc_rows, item_rows, window)


def test_many_copies_and_a_very_long_text(spark, docs):
    rng = random.Random(4)
    item = " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(30))
    common = " ".join(["the of and"] * 20)
    long = (common + " ") * 3000 + item + " " + common
    doc_rows = [(i, f"{common} {item}") for i in range(300)] + [(1000 + i, common) for i in range(300)] + [(5000, long)]
    item_rows = [(1, item), (2, common), (3, "nowhere to be found " * 5)]
    assert run(spark, docs, doc_rows, item_rows) == plainly(doc_rows, item_rows)


def test_empty_tables(spark, docs):
    assert run(spark, docs, [], [(1, "a b c")]) == []
    assert run(spark, docs, [(1, "a b c")], []) == [(1, 3, 0, [])]
    assert run(spark, docs, [(1, "a b c")], [(1, "z z z")]) == [(1, 3, 0, [])]


def test_query_equals_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    for t in ("documents", "benchmark"):
        duckdb.sql(f"create or replace view {t} as select * from '{sf}/{t}.parquet'")
    want = sorted(duckdb.sql(dc.SQL).fetchall(), key=str)
    q = dc.query(spark, sf)
    assert q.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted((tuple(r) for r in q.collect()), key=str) == want
    assert any(r[5] for r in want)
