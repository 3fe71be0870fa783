import os
import random
import subprocess
import sys
import tempfile
from collections import Counter, defaultdict

import brute
import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

from shiftwise.session import checkpoint_dir, materialize


def test_stages_on_a_small_table(spark, docs, tmp_path):
    rng = random.Random(6)
    vocabulary = [a + b + c for a in "bcdfgl" for b in "aeio" for c in ("nder", "st", "ling", "m", "tter")]

    def text(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n)) + "."

    rows = [(i, text(rng.randrange(60, 200)), "en", f"s{i % 4}") for i in range(60)]
    near = [(100 + i, rows[i][1].replace(rows[i][1].split()[7], "changed", 1), "en", "s1") for i in range(10)]
    junk = [(200 + i, "#### $$$$ " * 40, "en", "s0") for i in range(5)]
    secret = [(300, text(80) + ' token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" end', "en", "s2")]
    d = docs(rows + near + junk + secret + [(400, None, None, None), (401, "", "en", None)])
    kept = {}
    out = d
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, out, "")
        if name != "pack":
            assert got.columns == d.columns
        out = materialize(got, f"test_{name}")
        kept[name] = out.collect()
    assert {r["doc_id"] for r in kept["quality_rules"]} == {*range(60), *range(100, 110), 300}
    assert {r["doc_id"] for r in kept["near_duplicates"]} == {
        r for r in range(60)} | {300} == {c for _, _, c in brute.join_components([(r[0], r[1]) for r in rows + near + secret])}
    assert not any("24be64439e" in r["text"] for r in kept["secrets"]) and len(kept["secrets"]) == 61
    clean = {r["doc_id"]: r["text"] for r in kept["secrets"]}
    for r in rows:
        assert clean[r[0]] == r[1]
    for r in kept["mix"]:
        assert clean[r["doc_id"]].startswith(r["text"])
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = defaultdict(int)
    for r in kept["mix"]:
        tokens[r["doc_id"]] += len(whole.encode(r["text"], add_special_tokens=False).ids) + 1
    packed = Counter()
    for r in kept["pack"]:
        packed[r["doc_id"]] += r["length"]
    assert packed == tokens


def test_run(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    used = defaultdict(list)
    for r in out:
        used[r["sequence_id"]].append((r["offset"], r["length"]))
    assert out and all(sum(n for _, n in v) <= 2048 for v in used.values())


def test_empty_table(spark, docs):
    out = docs([])
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, out, ""), f"empty_{name}")
        assert out.count() == 0


def test_stages_return_small_plans(spark, docs):
    """A plan that inlines its own columns over and over ends a driver of ordinary size on any input."""
    out = docs([(i, f"some words of document number {i} " * 12, "en", f"s{i % 3}") for i in range(30)])
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, out, "")
        assert len(got._jdf.queryExecution().optimizedPlan().toString()) < 100_000, name
        out = materialize(got, f"plan_{name}")


def test_repeated_rows_take_part_once_each(spark, docs):
    row = (1, "the same text in every row of this small table " * 8, "en", "s0")
    out = docs([row] * 5 + [(None, None, None, None)] * 3)
    sizes = {}
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, out, ""), f"repeat_{name}")
        sizes[name] = out.count()
    assert sizes["quality_rules"] in (0, 5) and sizes["near_duplicates"] <= 1


def _written(spark):
    tables = os.path.join(checkpoint_dir(spark).removeprefix("file:"), "tables")
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(tables) for f in files if f.endswith(".parquet")}


def test_run_leaves_its_result_only(spark):
    before = _written(spark)
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    left = [f for f in _written(spark) if f not in before]
    assert left and all("/pack/" in f for f in left) and out.count()


def test_stages_write_no_text_twice(spark, docs):
    """The mix puts ids and sizes in order, not texts; the join leaves two narrow tables."""
    rng = random.Random(8)
    text = [" ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(4000)) for _ in range(24)]
    d = materialize(docs([(i, t, "en", f"s{i % 2}") for i, t in enumerate(text)]), "test_narrow")
    for stage in (corpus_pipeline.mixing.stage, corpus_pipeline.ngram_join.stage):
        before = _written(spark)
        got = stage(spark, d, "")
        left = {f: n for f, n in _written(spark).items() if f not in before}
        assert sum(left.values()) < sum(map(len, text)) / 4, stage.__module__
        assert got.count() >= 1


def test_shuffle_files_go_with_their_query(spark):
    folder = tempfile.mkdtemp(prefix="shuffles-")
    code = (
        "import glob; from shiftwise.session import get_session, materialize\n"
        f"s = get_session('local[2]', 4, extra={{'spark.local.dir': {folder!r}}}, driver_memory='1g')\n"
        "materialize(s.range(100000).selectExpr('id % 1000 k').groupBy('k').count(), 'x')\n"
        f"print('left', len(glob.glob({folder!r} + '/**/shuffle_*.data', recursive=True)))\n"
        "s.stop()\n")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, cwd=os.path.dirname(corpus_pipeline.__file__))
    assert "left 0" in out.stdout, out.stdout + out.stderr[-2000:]


def test_mix_of_repeated_and_null_ids(spark, docs):
    """Rows equal in id, source and text, with and without an id, each take their own share."""
    rows = [(1, "one two three four", "en", "a")] * 3 + [(None, "five six seven", "en", "a")] * 2 + [(None, "eight", "de", "b"), (0, "nine ten", "en", "b"),
            (0, None, "en", "b"), (2, "w " * 200, "en", None)]
    d = docs(rows)
    want = sum(r["taken"] for r in corpus_pipeline.mixing.mix_sources(d).collect())
    got = corpus_pipeline.mixing.stage(spark, d, "").collect()
    assert sum(len(brute.words(r["text"])) for r in got) == want
    assert {(r["doc_id"], r["source"]) for r in got} <= {(r[0], r[3]) for r in rows}
