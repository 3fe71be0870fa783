import hashlib
import random
import re

import numpy as np
import pytest

from shiftwise.llm import fill_middle as fm


def plainly(doc_id, text):
    t = text or ""
    u = re.findall("[A-Za-z]+|[^A-Za-z]", t)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (doc_id, len(u), "plain", None, None, t)
    out = f"<S>{s}<P>{p}<M>{m}" if h4 % 100 < 20 else f"<P>{p}<S>{s}<M>{m}"
    return (doc_id, len(u), "spm" if h4 % 100 < 20 else "psm", len(p), len(m), out)


def test_wavelet_ranks():
    rng = np.random.default_rng(1)
    for n in (0, 1, 63, 64, 65, 1000):
        s = rng.integers(0, 8, n).astype(np.uint8)
        w = fm.WaveletMatrix(s, bits=3)
        at = np.arange(n + 1)
        for c in range(8):
            assert w.rank(c, at).tolist() == [int((s[:i] == c).sum()) for i in at]


def texts():
    rng = random.Random(5)
    alphabet = ["a", "Zq", " ", "\n", "é", "字", "🙂", "<P", "<", ">", "S>", "9", "\x00", "é", "."]
    out = ["", None, "word", "  ", "字", "a<P>b", "x<S>", "<M>", "no marker <P <S <M", "a" * 5000]
    return out + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 80))) for _ in range(400)]


@pytest.mark.parametrize("part", [40, fm.PART])
def test_against_plain_reading(spark, docs, part):
    rows = [(i, t) for i, t in enumerate(texts())] + [(3, "repeated id a b"), (3, "repeated id a b"), (None, "no id here"),
                                                      (-7, "minus id"), (10 ** 15, "long id")]
    done = fm.fill_in_middle(docs(rows), part=part)
    got = done.withColumn("back", fm.restored()).collect()
    key = lambda r: (str(r[0]), r[1], r[5])
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted((plainly(*r) for r in rows), key=key)
    texts_of = sorted((str(i), t or "") for i, t in rows)
    assert sorted((str(r["doc_id"]), r["back"]) for r in got) == texts_of
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_very_long_text_and_empty_table(spark, docs):
    long = "word 字 " * 400_000
    got = fm.fill_in_middle(docs([(2, long)])).withColumn("back", fm.restored()).first()
    assert tuple(got)[:6] == plainly(2, long) and got["back"] == long
    assert fm.fill_in_middle(docs([])).count() == 0


def test_query_equals_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    duckdb.sql(f"create or replace view documents as select * from '{sf}/documents.parquet'")
    want = sorted(duckdb.sql(fm.SQL).fetchall(), key=str)
    q = fm.query(spark, sf)
    assert q.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert sorted((tuple(r) for r in q.collect()), key=str) == want
