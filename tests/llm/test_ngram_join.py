import os
import random

import brute

from shiftwise.llm import ngram_join as module
from shiftwise.llm.ngram_join import ngram_join, stage
from shiftwise.session import checkpoint_dir, materialize


def result(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join(df).collect())


def corpus(rng):
    rows = []
    for i in range(25):
        base = [rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(40)) for _ in range(rng.randrange(1, 120))]
        for _ in range(rng.choice([1, 1, 2, 3, 12])):
            w = list(base)
            for _ in range(rng.randrange(5)):
                w[rng.randrange(len(w))] = rng.choice("xyz") + str(rng.randrange(9))
            rows.append(" ".join(w))
    line = "this same passage of quite a few words stands in very many of the documents of this corpus"
    rows += [f"{line} {' '.join(str(rng.randrange(1000)) for _ in range(k))}" for k in (0, 1, 2, 3, 4, 5, 6, 40, 60)]
    return rows


def test_matches_brute_force(docs):
    for seed in (1, 2):
        rng = random.Random(seed)
        rows = [(i * 3 % 1009, t) for i, t in enumerate(corpus(rng))]
        rows += [(2000, None), (2001, ""), (2002, " \n"), (2003, "One two"), (2004, "one  TWO"), (2005, "two one"),
                 (2006, "É é"), (2007, "é É"), (2008, "w " * 30000), (2009, "w " * 29000), (5000, rows[0][1]), (5000, rows[0][1])]
        assert result(docs(rows)) == brute.join_components(rows)


def test_chains_and_empty(docs):
    """A chain of near copies, each like the next, the ends unlike: one component."""
    w = [f"w{i}" for i in range(60)]
    rows = []
    for k in range(30):
        rows.append((100 - k, " ".join(w)))
        w[2 * k % 60] = f"n{k}"
    assert result(docs(rows)) == brute.join_components(rows)
    assert ngram_join(docs([])).count() == 0 and ngram_join(docs([(1, None)])).count() == 1


def test_planted_table(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert result(d) == brute.join_components([(r["doc_id"], r["text"]) for r in d.collect()])


def test_stage_keeps_one_of_each(spark, docs):
    rng = random.Random(4)
    rows = [(i, t) for i, t in enumerate(corpus(rng))] + [(900, None), (901, ""), (901, ""), (902, "a b"), (902, "a b"), (None, "q r s")]
    d = docs(rows)
    got = stage(spark, d, "")
    assert got.columns == d.columns
    want = {c for _, n, c in brute.join_components([r for r in rows if r[0] is not None]) if n}
    ids = [r["doc_id"] for r in got.collect()]
    assert sorted(i for i in ids if i is not None) == sorted([*want, 900, 901, 901]) and ids.count(None) == 1


def test_entries_are_written_without_the_documents_prefixes(spark, docs, monkeypatch):
    """The entries are the join's largest exchange: by then the prefixes of all documents are off the disk."""
    seen = {}

    def watched(df, name, *args, **kwargs):
        tables = os.path.join(checkpoint_dir(spark).removeprefix("file:"), "tables")
        seen[name] = {t for run in os.listdir(tables) for t in os.listdir(os.path.join(tables, run))}
        return materialize(df, name, *args, **kwargs)

    monkeypatch.setattr(module, "materialize", watched)
    rows = ngram_join(docs([(i, f"some words of a text that comes twice {i // 2}") for i in range(8)])).collect()
    assert {r["component_id"] for r in rows} == {0, 2, 4, 6}
    assert "join_prefixes" in seen["join_firsts" if "join_firsts" in seen else "join_lists"]
    assert "join_prefixes" not in seen["join_lists"]
