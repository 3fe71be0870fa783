import random

import brute

from shiftwise.llm.quality import quality_rules, stage

DIR = "/root/testdata/sf0.01"


def test_counts_match_brute_force(docs):
    rng = random.Random(1)
    rows = []
    for i in range(60):
        w = [rng.choice(["a", "bb", "c#", "é<", "\U0001F600x"]) for _ in range(rng.randrange(60))]
        rows.append((i, "".join(x + rng.choice([" ", "\n", "\t", "\x0b", "  "]) for x in w)))
    rows += [(100, None), (101, ""), (102, "\n \n"), (103, "x " * 5000), (103, "x " * 5000), (None, "one two"),
             (104, "a\na\n a\n\x85\n\x85"), (105, " b  c")]
    got = quality_rules(docs(rows)).collect()
    want = sorted((r[0] or -1, *brute.quality(r[1])) for r in rows)
    assert sorted((r["doc_id"] or -1, r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"],
                   r["n_repeat_words"]) for r in got) == want
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    assert quality_rules(docs([])).count() == 0


def test_labels_held_out(spark):
    """No rule sees a label; the verdicts agree with them."""
    d = spark.read.parquet(f"{DIR}/documents.parquet")
    lab = spark.read.parquet(f"{DIR}/labels.parquet")
    by = {r["doc_id"]: r["quality"] for r in lab.collect()}
    got = quality_rules(d).collect()
    usable = [r for r in got if not r["base_failed"] and r["doc_id"] in by]
    good = [r["kept"] for r in usable if by[r["doc_id"]] == 1]
    bad = [r["kept"] for r in usable if by[r["doc_id"]] == 0]
    assert sum(good) >= 0.99 * len(good)
    assert sum(bad) <= 0.15 * len(bad)


def test_stage_keeps_columns(spark, docs):
    text = "The cat sat on the mat and then it went home to sleep for a while. " * 1
    d = docs([(i, f"{text}Number {i} is a very different sentence about dogs, birds and other things.") for i in range(30)]
             + [(99, "#### $$$$ " * 30), (98, None)])
    got = stage(spark, d, "")
    assert got.columns == d.columns
    assert {r["doc_id"] for r in got.collect()} == set(range(30))
