import hashlib
import math
import random
import re
import string

import brute

from shiftwise.llm.secret_scan import CLASSES, background, secret_scan, stage


def test_base_spans_match_brute_force(docs):
    rng = random.Random(4)
    bits = ["token", "Secret", "API_KEY", "apikey", "passwd", "PassWord", "=", ":", " ", "  ", '"', "'", "abc", "abcdef1",
            "AKIA", "AKIA" + "X9" * 8, "0a" * 12, "0a" * 11, "é", "\U0001F600", "\n", "\t", "ZZZZ", "."]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(60)))) for i in range(300)]
    rows += [(900, None), (901, ""), (902, "token=token:longvalue"), (903, "AKIAAKIA" + "A" * 14), (904, "x" * 50000),
             (905, ("token = '" + "q1" * 10 + "' ") * 300), (900, None), (None, "secret: hunter22")]
    got = secret_scan(docs(rows)).collect()
    want = []
    for r in rows:
        b = brute.base_spans(r[1])
        want.append((r[0] or -1, *[sum(k == i for _, k, _ in b) for i in range(3)],
                     hashlib.sha256(brute.joined(b).encode()).hexdigest()))
    assert sorted((r["doc_id"] or -1, r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in got) == sorted(want)
    assert secret_scan(docs([])).count() == 0


def _corpus(rng):
    names = ["the", "and", "house", "garden", "quiet", "morning", "walked", "through", "seven", "little", "people"]
    rows, planted = [], set()
    for i in range(400):
        text = " ".join(rng.choice(names) for _ in range(120))
        if i % 4 == 0:
            key = "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(48))
            text += " " + key + " end"
            planted.add(i)
        elif i % 4 == 1:
            text += " " + "".join(rng.choice(names) for _ in range(10)) + " " + "-".join(rng.choice(names) for _ in range(8))
        rows.append((i, text))
    return rows, planted


def test_battery_finds_random_runs_only(docs):
    rows, planted = _corpus(random.Random(8))
    got = {r["doc_id"]: r["spans"] for r in secret_scan(docs(rows)).collect()}
    hits = {k for k, v in got.items() if "random" in v}
    assert len(hits & planted) >= 0.95 * len(planted)
    assert len(hits - planted) <= 2


def test_keys_that_touch_names_paths_or_base_spans(docs):
    """Ways to stand beside a key, 20 keys each; none was tested when the whole run had to fit one encoding."""
    rng = random.Random(5)
    rows, _ = _corpus(rng)
    alnum = string.ascii_letters + string.digits

    def key(n, extra=""):
        """Random, with every symbol of ``extra`` somewhere inside."""
        out = [rng.choice(alnum + extra) for _ in range(n)]
        for at, c in zip(rng.sample(range(1, n - 1), len(extra)), extra):
            out[at] = c
        return "".join(out)

    ways = [lambda: ("AWS_SECRET_ACCESS_KEY=", key(64, "/+")), lambda: ("sig=", key(63, "+/") + "="), lambda: ("NAME=", key(64)),
            lambda: ("some_dir-x_", key(64, "/+")), lambda: ("a/b+c/", key(64, "-_")), lambda: ("", key(66, "+/-_")),
            lambda: ("AKIA" + "X9" * 8, "q" + key(64)), lambda: ("a=b=c=", key(64) + "==")]
    prose = rows[2][1] + " \u00e9 "
    texts = {1000 + i: (prose + a, b) for i in range(20 * len(ways)) for a, b in [ways[i % len(ways)]()]}
    got = {r["doc_id"]: r["spans"] for r in secret_scan(docs(rows + [(k, a + b + " end") for k, (a, b) in texts.items()])).collect()}
    found = [0] * len(ways)
    for k, (a, b) in texts.items():
        spans = [tuple(map(int, x.split(":")[1:])) for x in got[k].split(",") if x.startswith("random")]
        found[k % len(ways)] += any(s <= len(a) + 1 and len(a) + len(b) <= e for s, e in spans)
        assert not any(p <= s and e <= q for s, e in spans for p, q in spans if (s, e) != (p, q)), got[k]
    assert min(found) >= 15 and sum(found) >= 0.9 * len(texts), found


def test_stage_masks(spark, docs):
    rows, planted = _corpus(random.Random(9))
    rows += [(1000, 'a token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" é'), (1001, None), (1002, "clean text")]
    d = docs(rows)
    got = {r["doc_id"]: r for r in stage(spark, d, "").collect()}
    assert stage(spark, d, "").columns == d.columns and len(got) == len(rows)
    assert got[1000]["text"] == 'a [SECRET]" é' and got[1001]["text"] is None and got[1002]["text"] == "clean text"
    before = dict(rows)
    for k, r in got.items():
        if k in planted:
            assert r["text"].count("[SECRET]") <= 1 and r["n_chars"] == len(r["text"])
        elif k < 1000:
            assert r["text"] == before[k]


def test_background_counts_every_adjacent_window(spark):
    rng = random.Random(6)
    texts = [None, "", "a" * 19, "Ab c" * 5, "".join(rng.choice("aabcdnxyzN ,é") for _ in range(60000)),
             "".join(rng.choice(string.ascii_letters) for _ in range(20160))]
    want = {}
    for text in texts:
        v = [ord(c) - ord("a") for c in (text or "").lower() if c in string.ascii_lowercase]
        for cls, n in enumerate(CLASSES):
            for at in range(0, len(v) - n + 1, n):
                w = v[at:at + n]
                chi = (26 * sum(w.count(x) ** 2 for x in set(w)) / n - n - 25) / math.sqrt(50 * (n - 1) / n)
                runs = (sum((a > 12.5) != (b > 12.5) for a, b in zip(w, w[1:])) - (n - 1) / 2) / math.sqrt((n - 1) / 4)
                serial = sum((a - 12.5) * (b - 12.5) for a, b in zip(w, w[1:])) / (675 / 12) / math.sqrt(n - 1)
                k = (cls, min(int(4 * (max(chi, 0) ** 2 + runs ** 2 + serial ** 2)), 400))
                want[k] = want.get(k, 0) + 1
    got = background(spark.createDataFrame([(x,) for x in texts], "text string")).collect()
    assert {(r["cls"], r["bin"]): r["n"] for r in got} == want


def test_background_reads_counts_from_shared_sums(spark):
    """No letter is searched for in every window (26 passes over each of six classes before), and full counts fit their bits."""
    texts = [c * n for c in "aijrsz" for n in (20, 27, 96, 97, 20160, 20163)] + ["az" * 48, "mn" * 5000]
    d = spark.createDataFrame([(x,) for x in texts], "text string")
    got = background(d)
    assert not re.findall(r"(?<!_)replace\(", got._jdf.queryExecution().optimizedPlan().toString())
    want = {}
    for text in texts:
        v = [ord(c) - 97 for c in text]
        for cls, n in enumerate(CLASSES):
            seen = {}  # windows of one text differ in few ways
            for at in range(0, len(v) - n + 1, n):
                w = tuple(v[at:at + n])
                if w not in seen:
                    chi = (26 * sum(w.count(x) ** 2 for x in set(w)) / n - n - 25) / math.sqrt(50 * (n - 1) / n)
                    runs = (sum((a > 12.5) != (b > 12.5) for a, b in zip(w, w[1:])) - (n - 1) / 2) / math.sqrt((n - 1) / 4)
                    serial = sum((a - 12.5) * (b - 12.5) for a, b in zip(w, w[1:])) / (675 / 12) / math.sqrt(n - 1)
                    seen[w] = (cls, min(int(4 * (max(chi, 0) ** 2 + runs ** 2 + serial ** 2)), 400))
                want[seen[w]] = want.get(seen[w], 0) + 1
    assert {(r["cls"], r["bin"]): r["n"] for r in got.collect()} == want


def test_one_key_among_many_runs_of_few_long_documents(docs):
    """Three texts give 12 windows of a class if each gives four: no p-value under 1/13, and nothing found."""
    rng = random.Random(3)
    names = ["the", "and", "house", "garden", "quiet", "morning", "walked", "through", "seven", "little", "people"]
    rows = []
    for i in range(3):
        words = [rng.choice(names) for _ in range(30000)]
        for at in range(0, 30000, 300):
            words[at] = "-".join(rng.choice(names) for _ in range(9))
        words[150] = "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(96))
        rows.append((i, " ".join(words)))
    for r in secret_scan(docs(rows)).collect():
        at = rows[r["doc_id"]][1].split(" ")[150]
        start = rows[r["doc_id"]][1].index(at)
        assert r["spans"] == f"random:{start}:{start + 96}", r["doc_id"]


def test_texts_with_very_many_matches(spark, docs):
    """25,000 base matches beside half as many runs: passes over them must not copy what they have so far."""
    text = ("secret=abcdef \U0001F600 " + "deadbeef" * 3 + "zz/" + "x-" * 12 + "\n") * 12500
    d = docs([(1, text), (2, "plain")])
    got = {r["doc_id"]: r for r in secret_scan(d).collect()}
    base = brute.base_spans(text)
    assert got[1]["base_sha256"] == hashlib.sha256(brute.joined(base).encode()).hexdigest() and len(base) == 25000
    masked = {r["doc_id"]: r["text"] for r in stage(spark, d, "").collect()}
    spans = [tuple(map(int, x.split(":")[1:])) for x in got[1]["spans"].split(",")]
    assert masked == {1: _masked(text, spans), 2: "plain"}


def _masked(text, spans):
    out, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            out += [text[at:start], "[SECRET]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def test_runs_less_base_spans_and_nested_spans_match_brute_force(spark):
    """Both passes over spans in order, against all pairs."""
    from pyspark.sql import functions as F

    from shiftwise.llm.secret_scan import _left, redacted, with_spans
    rng = random.Random(12)
    rows = []
    for i in range(200):
        text = "".join(rng.choice("abé\U0001F600") for _ in range(rng.choice([60, 60, 700 * 8])))
        cuts = sorted(rng.sample(range(len(text) + 1), rng.choice([0, 2, 8, min(len(text), 1400) // 2 * 2 - 2])))
        runs = [(a, b, text[a:b]) for a, b in zip(cuts[::2], cuts[1::2])]
        base = sorted((a, rng.randrange(3), a + rng.randrange(1, 30)) for a in rng.choices(range(len(text) - 30), k=rng.choice([0, 1, 9, 400])))
        tested = [(a, min(a + rng.randrange(1, 30), len(text)), rng.randrange(6), rng.randrange(3))
                  for a in rng.choices(range(len(text) - 1), k=rng.choice([0, 1, 9, 300]))]
        rows.append((i, text, runs, base, tested + tested[:2]))
    df = spark.createDataFrame(rows, "id int, text string, r array<struct<start:int,end:int,found:string>>, "
                               "base array<struct<start:int,kind:int,end:int>>, runs array<struct<start:int,end:int,cls:int,bin:int>>")
    bins = [0, 1, -1, 2, 0, 1]
    got = with_spans(df, bins).withColumns({"left": _left(F.col("r"), F.col("base")), "new": redacted(F.col("text"), F.col("all_spans"))})
    for r in got.collect():
        _, text, runs, base, tested = rows[r["id"]]
        covered = {p for a, _, b in base for p in range(a, b)}
        left = []
        for a, b, _ in runs:
            for p in range(a, b):
                if p not in covered:
                    if p > a and p - 1 not in covered:
                        left[-1][1] += text[p]
                    else:
                        left.append([p, text[p]])
        assert [list(x) for x in r["left"] if x["found"]] == left
        hits = {(a, b) for a, b, c, k in tested if k <= bins[c]}
        outer = {x for x in hits if not any(y != x and y[0] <= x[0] and x[1] <= y[1] for y in hits)}
        spans = sorted(base + [(a, 3, b) for a, b in outer])
        assert [tuple(x) for x in r["all_spans"]] == spans
        assert r["new"] == _masked(text, [(a, b) for a, _, b in spans])


def test_departure_and_cut_match_brute_force(spark, docs):
    from pyspark.sql import functions as F

    from shiftwise.llm.secret_scan import RATE, departure, limits
    rng = random.Random(13)
    rows = []
    for _ in range(300):
        alphabet = rng.choice(["0123456789abcdef", string.ascii_lowercase, string.ascii_letters + string.digits])
        few = rng.choice([alphabet, alphabet[:4]])
        rows.append(("".join(rng.choice(few) for _ in range(rng.randrange(20, 130))), alphabet))
    df = spark.createDataFrame([(rows,)], "x array<struct<m:string,alphabet:string>>")
    for (m, alphabet), y in zip(rows, df.select(departure(F.col("x")).alias("t")).first()["t"]):
        v, a, n = [alphabet.index(c) for c in m], len(alphabet), len(m)
        mid = (a - 1) / 2
        chi = max((a * sum(v.count(x) ** 2 for x in set(v)) / n - n - (a - 1)) / math.sqrt(2 * (a - 1) * (n - 1) / n), 0)
        runs = (sum((p > mid) != (q > mid) for p, q in zip(v, v[1:])) - (n - 1) / 2) / math.sqrt((n - 1) / 4)
        serial = sum((p - mid) * (q - mid) for p, q in zip(v, v[1:])) / ((a * a - 1) / 12) / math.sqrt(n - 1)
        assert math.isclose(y["t"], chi ** 2 + runs ** 2 + serial ** 2, rel_tol=1e-9, abs_tol=1e-9)

    texts = docs([(i, " ".join(rng.choice(["stone", "water", "bright", "of", "seven"]) for _ in range(4000))) for i in range(20)])
    tested = [(rng.randrange(6), rng.choice([0, 1, 2, 5, 40, 200, 400])) for _ in range(500)]
    scanned = spark.createDataFrame([([t],) for t in tested], "runs array<struct<cls:int,bin:int>>")
    text = {}
    for r in background(texts).collect():
        text.setdefault(r["cls"], []).extend([r["bin"]] * r["n"])
    p = sorted(((sum(x <= b for x in text.get(c, [])) + 1) / (len(text.get(c, [])) + 1), c, b) for c, b in tested)
    passed = [x for i, (x, _, _) in enumerate(p) if x <= RATE * sum(y <= x for y, _, _ in p) / len(p)]
    cut = max(passed, default=-1)
    assert 0 < cut < p[-1][0]
    found = limits(scanned, texts)
    for (c, b) in set(tested):
        x = (sum(y <= b for y in text.get(c, [])) + 1) / (len(text.get(c, [])) + 1)
        assert (b <= found[c]) == (x <= cut and b < 400), (c, b)
