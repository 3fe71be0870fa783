import random
import textwrap

from shiftwise.llm.license_scan import FAMILIES, TEMPLATES, license_scan, variants


def test_held_out_accuracy(docs):
    """New variants (another seed, other filler) among plain sentences; none was trained on."""
    rng = random.Random(77)
    names = "the house stands on a hill near old river and version of free garden under terms see public source".split()
    rows, want = [], {}
    for i in range(400):
        lines = [" ".join(rng.choice(names) for _ in range(rng.randrange(3, 25))) + "." for _ in range(rng.randrange(1, 6))]
        if i % 2:
            f, t = TEMPLATES[i % len(TEMPLATES)]
            w = t.split()
            if len(w) > 12:
                w.pop(rng.randrange(len(w)))
            lines.insert(rng.randrange(len(lines) + 1), " ".join(w))
            want[i] = f
        rows.append((i, "\n".join(lines)))
    rows += [(900, None), (901, ""), (902, "\n\n"), (None, "Released under the MIT License."), (903, "x " * 50000),
             (904, "Released under the MIT License.\nfoo\nLicensed under CC BY-NC 4.0."), (904, "a"), (904, "a")]
    got = license_scan(docs(rows)).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got if r["doc_id"] != 904}
    right = sum(by[i]["family"] == want.get(i) for i in range(400))
    wrong_clean = sum(by[i]["family"] is not None for i in range(0, 400, 2))
    assert right >= 0.97 * 400 and wrong_clean <= 2
    assert by[900]["n_paragraphs"] == by[901]["n_paragraphs"] == by[902]["n_paragraphs"] == 0
    assert by[None]["family"] == "MIT"
    two = next(r for r in got if r["doc_id"] == 904 and r["n_paragraphs"] == 3)
    assert two["families"] == "CC-BY-NC-4.0,MIT" and two["paragraphs"] == "0:MIT,2:CC-BY-NC-4.0"


def test_planted_lines(spark):
    """Every notice line of the corpus is found with its family, and nothing else."""
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r["doc_id"]: r for r in license_scan(d).collect()}
    exact = {t: f for f, t in TEMPLATES}
    for r in d.collect():
        want = sorted({exact[x] for x in (r["text"] or "").split("\n") if x in exact})
        assert got[r["doc_id"]]["families"] == ",".join(want), r["doc_id"]


def test_empty_and_variants(docs):
    assert license_scan(docs([])).count() == 0
    assert variants(TEMPLATES[0], ["x"]) == variants(TEMPLATES[0], ["x"]) and "MIT" in FAMILIES


def test_wrapped_notices_and_several_in_one_line(docs):
    """Notices wrapped as licence files and headers are, with and without comment marks, and many in one long line."""
    long = [(f, t) for f, t in TEMPLATES if len(t) > 100]
    rows, want = [], {}
    for i, (f, t) in enumerate(long):
        for j, mark in enumerate(("", " * ", "# ")):
            for k, width in enumerate((40, 72)):
                doc = i * 100 + j * 10 + k
                rows.append((doc, "plain words before it\n\n" + "\n".join(mark + x for x in textwrap.wrap(t, width)) + "\n\nthe end"))
                want[doc] = f
    filler = " the house stands on a hill near the old river and nobody lives there any more"
    one = [TEMPLATES[0][1], TEMPLATES[4][1], TEMPLATES[10][1]]
    rows.append((9000, filler * 20 + " " + (filler * 20 + " ").join(one) + filler * 20))
    rows.append((9001, filler * 200))
    got = {r["doc_id"]: r for r in license_scan(docs(rows)).collect()}
    assert {k: got[k]["families"] for k in want} == want
    assert got[9000]["families"] == "Apache-2.0,BSD-3-Clause,MIT" and got[9001]["families"] == ""
