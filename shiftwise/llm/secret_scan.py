"""Secret scan: fixed patterns plus a randomness test battery.

The base patterns (assignments, access keys, hex runs) give spans by rule. The
battery looks at every other run of 20 or more key characters, = only at its
end, and at what base spans leave of a run. A run that mixes + / with - _ is
tested whole, and so are its parts between - _ and between + /; of the spans
found, those inside another are left out. The battery infers the run's encoding
(hex, base32, base36, base62, base64, letters), and measures how far it departs from uniform random symbols by three tests: chi-squared over
the alphabet, the number of runs above and below the middle symbol, and serial
correlation. The sum of squared z-scores is the departure.

Ordinary text departs too, but the shorter it is the less it shows. So the
p-value of a run is the share of text windows *of its length class*, all
adjacent ones of the letters of every document, that depart as little; Benjamini-Hochberg over all runs
of the corpus then bounds the share of false discoveries. Histograms (length
classes x departure bins, a fixed number of cells) are all that leaves Spark.

Only DataFrame expressions run. Null text is empty; positions are code points,
ends exclusive; repeated rows are scanned each; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftwise.llm.common import empty_if_null, table
from shiftwise.session import materialize

# The base patterns and their least lengths.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = ("((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ASSIGN_LEAST = 6
ACCESS = "AKIA[A-Z0-9]{16,}"  # a maximal run, as with + and a least length of 20
HEX = "[0-9a-f]{24,}"  # likewise, 24
RUN = "(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}=*"
MIXED = "[+/].*[_-]|[_-].*[+/]"

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: (encoding rule, alphabet), first match counts; runs without digits are letters, digits alone are numbers and skipped.
ENCODINGS = (
    ("^[0-9]+$", ""),
    ("^[0-9a-f]+$", DIGITS + "abcdef"),
    ("^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("^[a-z]+$", LOWER),
    ("^[A-Z]+$", UPPER),
    ("^[A-Z2-7]+$", UPPER + "234567"),
    ("^[a-z0-9]+$", LOWER + DIGITS),
    ("^[A-Z0-9]+$", UPPER + DIGITS),
    ("^[A-Za-z]+$", UPPER + LOWER),
    ("^[A-Za-z0-9]+$", UPPER + LOWER + DIGITS),
    ("^[A-Za-z0-9_-]+$", UPPER + LOWER + DIGITS + "-_"),
    ("^[A-Za-z0-9+/]+$", UPPER + LOWER + DIGITS + "+/"),
    ("^[A-Za-z0-9+/_-]+$", UPPER + LOWER + DIGITS + "+/-_"),
)
CLASSES = (20, 28, 36, 48, 64, 96)  # least length of each length class, multiples of 4
CHANGE = 1 << 20  # above twice any sum of a window's products, so both fit one number
PIECE = 20160  # letters handled together: a multiple of every class's length, so no window is cut
FIELD, PER_NUMBER = 7, 9  # bits of a letter's count in a window, and counts in one 64-bit number
COUNTS = ("c0", "c1", "c2")  # the numbers that hold the 26 counts
BLOCK = 256  # items of one inner pass of ``_running``
BINS_PER_UNIT, LAST_BIN = 4, 400
RATE = 0.05  # bound on the expected share of false discoveries


def _running(items: Column, state: Column, kind: str, step) -> Column:
    """The arrays (of DDL type ``kind``) that ``step(state, item) -> (state, array)`` gives, item after item, chained.

    Appending to one array copies it for every item; blocks keep the copied part short, so time is linear in the items.
    """
    none = F.array().cast(f"array<{kind}>")

    def one(a: Column, x: Column) -> Column:
        after, found = step(a["s"], x)
        return F.struct(after.alias("s"), F.concat(a["out"], found).alias("out"))

    def block(a: Column, xs: Column) -> Column:
        done = F.array(F.aggregate(xs, F.struct(a["s"].alias("s"), none.alias("out")), one))
        return F.get(F.transform(done, lambda d: F.struct(
            d["s"].alias("s"), F.concat(a["out"], F.array(d["out"])).alias("out"))), F.lit(0))

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int")),
                         lambda k: F.slice(items, k * BLOCK + 1, F.lit(BLOCK)))
    start = F.struct(state.alias("s"), F.array().cast(f"array<array<{kind}>>").alias("out"))
    short = F.aggregate(items, F.struct(state.alias("s"), none.alias("out")), one, lambda a: a["out"])
    return F.when(F.size(items) <= BLOCK, short).otherwise(F.aggregate(blocks, start, block, lambda a: F.flatten(a["out"])))


def _spans(text: Column, pattern: str, kind: int, values_group: int | None = None, least: int = 0) -> Column:
    """Array of (start, kind, end, found) of the leftmost non-overlapping matches."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = found if values_group is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(values_group))
    gaps = F.split(text, pattern, -1)
    steps = F.zip_with(F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found,
                                  lambda g, m: F.struct(F.length(g).alias("gap"), m.alias("m"))),
                       values, lambda x, v: F.struct(x["gap"].alias("gap"), x["m"].alias("m"), F.length(v).alias("n")))
    fields = "struct<start:int,kind:int,end:int,found:string,n:int>"

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        start = at + x["gap"]
        end = start + F.length(x["m"])
        return end, F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"),
                                     x["m"].alias("found"), x["n"].alias("n")))

    # bound to a lambda's variable, so that the matches are looked for once
    spans = F.get(F.transform(F.array(steps), lambda x: _running(x, F.lit(0), fields, step)), F.lit(0))
    spans = F.filter(spans, lambda s: s["n"] >= least) if least else spans
    return F.when(F.rlike(text, F.lit(pattern)), spans).otherwise(F.array().cast(f"array<{fields}>"))


def _bare(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))


def _total(values: Column, start: float = 0.0) -> Column:
    return F.aggregate(values, F.lit(start), lambda s, v: s + v)


def _score(a: Column, n: Column, squares: Column, changes: Column, products: Column) -> Column:
    """Sum of squared z-scores from the sums of squared symbol counts, changes of half, and neighbours' products."""
    chi = F.greatest((a * squares / n - n - (a - 1)) / F.sqrt(2 * (a - 1) * (n - 1) / n), F.lit(0.0))
    runs_z = (changes - (n - 1) / 2) / F.sqrt((n - 1) / 4)
    serial = products / ((a * a - 1) / 12) / F.sqrt(n - 1)
    return chi * chi + runs_z * runs_z + serial * serial


def departure(runs: Column) -> Column:
    """For an array of structs (m: symbols, alphabet, ...) adds ``t``: sum of squared z-scores of the three tests."""
    def measured(x: Column) -> Column:
        a, m = x["alphabet"], x["m"]
        counts = F.transform(F.split(a, ""), lambda c: F.length(m) - F.length(F.replace(m, c, F.lit(""))))
        return F.struct(x.alias("x"), F.length(a).cast("double").alias("a"), F.length(m).cast("double").alias("n"),
                        _total(F.transform(counts, lambda c: c.cast("double") * c)).alias("squares"),
                        F.transform(F.split(m, ""), lambda c: (F.position(c, a) - 1).cast("double")).alias("v"))

    def tested(y: Column) -> Column:
        a, n, v = y["a"], y["n"], y["v"]
        k = F.size(v) - 1
        mean = (a - 1) / 2
        first, second = F.slice(v, F.lit(1), k), F.slice(v, F.lit(2), k)
        changes = _total(F.zip_with(first, second, lambda p, q: F.when((p > mean) != (q > mean), 1.0).otherwise(0.0)))
        products = _total(F.zip_with(first, second, lambda p, q: (p - mean) * (q - mean)))
        return F.struct(y["x"].alias("x"), _score(a, n, y["squares"], changes, products).alias("t"))

    return F.transform(F.transform(runs, measured), tested)


def _class(n: Column) -> Column:
    out = F.lit(0)
    for i, least in enumerate(CLASSES[1:], 1):
        out = F.when(n >= least, i).otherwise(out)
    return out


def _bin(t: Column) -> Column:
    return F.least(F.floor(t * BINS_PER_UNIT), F.lit(LAST_BIN)).cast("int")


PIECES = "struct<start:int,found:string>"


def _left(runs: Column, base: Column) -> Column:
    """Array of (start, found): what the base spans leave of the runs; one pass over both in order of their starts."""
    last = F.lit(2**31 - 1)

    def event(start: Column, run: int, end: Column, found: Column) -> Column:
        return F.struct(start.alias("start"), F.lit(run).alias("run"), end.alias("end"), found.alias("found"))

    events = F.concat(F.array_sort(F.concat(
        F.transform(base, lambda b: event(b["start"], 0, b["end"], F.lit(""))),
        F.transform(runs, lambda r: event(r["start"], 1, r["end"], r["found"])))),
        F.array(event(last, 1, last, F.lit(""))))  # brings out the rest of the last run
    none = F.array().cast(f"array<{PIECES}>")

    def step(s: Column, x: Column) -> tuple[Column, Column]:
        """``at`` to ``end`` is open of the run that begins at ``start``, ``cover`` the furthest end of a base span."""
        run = x["run"] == 1
        stop = F.when(run, s["end"]).otherwise(F.least(x["start"], s["end"]))
        piece = F.struct(s["at"].alias("start"), F.substring(s["found"], s["at"] - s["start"] + 1, stop - s["at"]).alias("found"))
        return F.struct(
            F.when(run, s["cover"]).otherwise(F.greatest(s["cover"], x["end"])).alias("cover"),
            F.when(run, F.greatest(x["start"], s["cover"])).otherwise(F.greatest(s["at"], x["end"])).alias("at"),
            F.when(run, x["end"]).otherwise(s["end"]).alias("end"), F.when(run, x["start"]).otherwise(s["start"]).alias("start"),
            F.when(run, x["found"]).otherwise(s["found"]).alias("found"),
        ), F.when(stop > s["at"], F.array(piece)).otherwise(none)

    nothing = F.struct(F.lit(0).alias("cover"), F.lit(0).alias("at"), F.lit(0).alias("end"), F.lit(0).alias("start"),
                       F.lit("").alias("found"))
    cut = F.get(F.transform(F.array(events), lambda e: _running(e, nothing, PIECES, step)), F.lit(0))
    whole = F.transform(runs, lambda r: F.struct(r["start"].alias("start"), r["found"].alias("found")))
    return F.when((F.size(runs) > 0) & (F.size(base) > 0), cut).otherwise(whole)


def _with_parts(piece: Column) -> Column:
    """Array of (start, found): the piece and, if it mixes encodings, its parts of one encoding."""
    def step(at: Column, x: Column) -> tuple[Column, Column]:
        part = F.array(F.struct(at.alias("start"), x.alias("found")))
        return at + F.length(x) + 1, F.when(F.length(x) >= CLASSES[0], part).otherwise(F.array().cast(f"array<{PIECES}>"))

    def parts(marks: str) -> Column:
        cut = F.array(F.split(piece["found"], marks, -1))
        return F.get(F.transform(cut, lambda c: _running(c, piece["start"], PIECES, step)), F.lit(0))

    whole = F.array(piece)
    return F.when(F.rlike(piece["found"], F.lit(MIXED)), F.concat(whole, parts("[_-]"), parts("[+/]"))).otherwise(whole)


def scan(docs: DataFrame, keep: list[Column], text_col: str = "text") -> DataFrame:
    """``keep`` plus base (spans) and runs (tested spans with length class and departure bin)."""
    df = docs.select(*keep, empty_if_null(text_col).alias("_text"))
    text = F.col("_text")
    df = df.withColumns({
        "_assign": _spans(text, ASSIGN, 0, 2, ASSIGN_LEAST), "_access": _spans(text, ACCESS, 1),
        "_hex": _spans(text, HEX, 2), "_run": _spans(text, RUN, 3)})
    df = df.withColumn("base", F.array_sort(F.concat(_bare(F.col("_assign")), _bare(F.col("_access")), _bare(F.col("_hex")))))
    df = df.withColumn("_left", _left(F.col("_run"), F.col("base")))
    df = df.withColumn("_pieces", F.flatten(F.transform(F.filter(
        "_left", lambda x: F.length(x["found"]) >= CLASSES[0]), _with_parts)))

    def encoded(r: Column) -> Column:
        m = F.rtrim(r["found"], F.lit("="))
        alphabet = F.lit("")
        for rule, letters in reversed(ENCODINGS):
            alphabet = F.when(F.rlike(m, F.lit(rule)), F.lit(letters)).otherwise(alphabet)
        return F.struct(r["start"].alias("start"), (r["start"] + F.length(r["found"])).alias("end"), m.alias("m"),
                        alphabet.alias("alphabet"))

    usable = F.filter(F.transform("_pieces", encoded), lambda r: (r["alphabet"] != "") & (F.length(r["m"]) >= CLASSES[0]))
    df = df.withColumn("_tested", departure(usable))
    return df.withColumns({
        "runs": F.transform("_tested", lambda y: F.struct(
            y["x"]["start"].alias("start"), y["x"]["end"].alias("end"),
            _class(F.length(y["x"]["m"])).alias("cls"), _bin(y["t"]).alias("bin"))),
    }).drop("_assign", "_access", "_hex", "_run", "_left", "_pieces", "_tested")


def _pair_tables() -> tuple[list[Column], Column]:
    """By 36 * x + y of two base-36 digits (a letter's is 10 to 35): three tables of letter counts, and one of the neighbours' product.

    A count has seven bits, enough for a window's letters; nine letters share a number. The product is of twice the
    distances from the middle letter, plus CHANGE where the two lie in different halves; other digits are no neighbours.
    """
    def table(values: list[int]) -> Column:
        return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")  # folded to a literal

    def count(u: int, group: int) -> int:
        return 1 << FIELD * (u % PER_NUMBER) if u >= 0 and u // PER_NUMBER == group else 0

    def product(u: int, w: int) -> int:
        p = (2 * u - 25) * (2 * w - 25)
        return 0 if min(u, w) < 0 else p + CHANGE if p < 0 else p

    pairs = [(x - 10, y - 10) for x in range(36) for y in range(36)]
    return ([table([count(u, g) + count(w, g) for u, w in pairs]) for g in range(3)], table([product(u, w) for u, w in pairs]))


def _starts(units: Column, size: int) -> Column:
    """Where ``size`` adjacent units each begin, the whole ones (at least one, if need be of fewer)."""
    last = F.greatest(F.floor(F.size(units) / size).cast("int") - 1, F.lit(0))
    return F.sequence(F.lit(0), last * size, F.lit(size))


def _sum_at(units: Column, k: Column, size: int) -> Column:
    """Sum of ``size`` units from k, written out: a loop over a slice costs several times as much."""
    return reduce(add, [F.get(units, k + j) for j in range(size)])


def _field(structs: str, name: str) -> Column:
    return F.transform(structs, lambda x: x[name])


def _each(units: Column, size: int, last: bool) -> Column:
    """Of every ``size`` adjacent units the last one, or the sum."""
    return F.transform(_starts(units, size), lambda k: F.get(units, k + (size - 1)) if last else _sum_at(units, k, size))


def background(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """cls, bin, n: how many text windows of each length class depart how far, over all adjacent windows.

    The same departure as ``departure`` gives, from sums shared by the classes: letter counts, and products and changes
    of neighbours, of four letters each, read from tables over two letters.
    """
    letters = F.lower(F.regexp_replace(empty_if_null(text_col), "[^A-Za-z]+", ""))
    df = docs.select(F.explode(F.regexp_extract_all(letters, F.lit(f"[a-z]{{1,{PIECE}}}"), F.lit(0))).alias("piece"))
    df = df.where(F.length("piece") >= CLASSES[0])
    # four letters and the one behind them (0: none) as one base-36 number
    fives = F.regexp_extract_all(F.concat("piece", F.lit("0")), F.lit("(?=(.{5})).{4}"), F.lit(1))
    counts, products = _pair_tables()

    def unit(x: Column) -> Column:
        def pair(behind: int) -> Column:
            return F.call_function("div", x, F.lit(36 ** behind)) % 1296 if behind else x % 1296

        link = F.get(products, pair(0))
        return F.struct(*[(F.get(t, pair(3)) + F.get(t, pair(1))).alias(c) for c, t in zip(COUNTS, counts)],
                        (F.get(products, pair(3)) + F.get(products, pair(2)) + F.get(products, pair(1)) + link).alias("s"),
                        link.alias("link"))

    parts = (*COUNTS, "s", "link")
    kind = f"array<struct<cls:int,n:int,{','.join(f'{c}:bigint' for c in COUNTS)},s:bigint>>"

    def windows(four: Column, sixteen: Column, cls: int, n: int) -> Column:
        units, size = (sixteen, n // 16) if n % 16 == 0 else (four, n // 4)
        found = F.transform(_starts(units["s"], size), lambda k: F.struct(
            F.lit(cls).alias("cls"), F.lit(n).alias("n"), *[_sum_at(units[c], k, size).alias(c) for c in COUNTS],
            (_sum_at(units["s"], k, size) - F.get(units["link"], k + (size - 1))).alias("s")))
        return F.when(F.length("piece") >= n, found).otherwise(F.array().cast(kind))

    def bound(columns: Column, inner) -> Column:
        """The array ``inner`` gives, with the columns bound to a lambda's variable: computed once, not once an element."""
        return F.flatten(F.transform(F.array(columns), inner))

    def all_windows(four: Column) -> Column:
        sixteen = F.struct(*[_each(four[c], 4, c == "link").alias(c) for c in parts])
        return bound(sixteen, lambda wide: F.concat(*[windows(four, wide, i, n) for i, n in enumerate(CLASSES)]))

    df = df.withColumn("four", F.transform(F.transform(fives, lambda q: F.conv(q, 36, 10).cast("int")), unit))
    columns = F.struct(*[_field("four", c).alias(c) for c in parts])
    df = df.select(F.explode(bound(columns, all_windows)).alias("x")).select("x.*")
    n, a, squares = F.col("n").cast("double"), float(len(LOWER)), F.lit(0)
    for u in range(len(LOWER)):
        count = F.shiftright(COUNTS[u // PER_NUMBER], FIELD * (u % PER_NUMBER)).bitwiseAND(F.lit((1 << FIELD) - 1))
        squares = squares + count * count
    changes = F.floor((F.col("s") + CHANGE // 2) / CHANGE)
    t = _score(F.lit(a), n, squares.cast("double"), changes.cast("double"), (F.col("s") - changes * CHANGE) / 4.0)
    return df.select("cls", _bin(t).alias("bin")).groupBy("cls", "bin").agg(F.count(F.lit(1)).alias("n"))


def limits(scanned: DataFrame, docs: DataFrame, text_col: str = "text", rate: float = RATE) -> list[int]:
    """Per length class the largest departure bin that counts as random (-1: none).

    Benjamini-Hochberg over all tested runs: with p(class, bin) the share of
    the class's text windows up to that bin, the cut is the largest p with
    p <= rate * (runs up to p) / (all runs).
    """
    def histogram(one: DataFrame) -> dict:
        return {(r["cls"], r["bin"]): r["n"] for r in one.collect()}  # at most classes x bins rows

    runs = histogram(scanned.select(F.explode("runs").alias("x")).groupBy("x.cls", "x.bin").agg(F.count(F.lit(1)).alias("n")))
    text = histogram(background(docs, text_col)) if runs else {}
    p = {}
    for c in range(len(CLASSES)):
        total, up = sum(n for (k, _), n in text.items() if k == c), 0
        for b in range(LAST_BIN + 1):
            up += text.get((c, b), 0)
            p[c, b] = (up + 1) / (total + 1)
    cut, seen, total = -1.0, 0, sum(runs.values())
    for value, n in sorted((p[k], n) for k, n in runs.items()):
        seen += n
        if value <= rate * seen / total:
            cut = value
    return [max((b for b in range(LAST_BIN) if p[c, b] <= cut), default=-1) for c in range(len(CLASSES))]


def with_spans(scanned: DataFrame, bins: list[int]) -> DataFrame:
    """Adds ``all_spans``: base spans and the runs that the battery holds for random."""
    limit = F.array(*[F.lit(b) for b in bins])
    fields = "struct<start:int,kind:int,end:int>"

    def outer(end: Column, x: Column) -> tuple[Column, Column]:
        """Spans come by start, longer ones first: one that ends no later than one before lies inside it or repeats it."""
        span = F.array(F.struct(x["start"].alias("start"), F.lit(3).alias("kind"), x["end"].alias("end")))
        return F.greatest(end, x["end"]), F.when(x["end"] > end, span).otherwise(F.array().cast(f"array<{fields}>"))

    found = scanned.withColumn("_random", F.array_sort(F.transform(
        F.filter("runs", lambda r: r["bin"] <= F.get(limit, r["cls"])),
        lambda r: F.struct(r["start"].alias("start"), (-r["end"]).alias("back"), r["end"].alias("end")))))
    return found.withColumn("all_spans", F.array_sort(F.concat(
        "base", _running(F.col("_random"), F.lit(0), fields, outer)))).drop("_random")


def _joined(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = RATE) -> DataFrame:
    """One row per document: counts of the base kinds, digest of the base spans, all spans."""
    scanned = materialize(scan(docs, [F.col(id_col).alias("doc_id")], text_col).drop("_text"), "secret_scan")
    found = with_spans(scanned, limits(scanned, docs, text_col, rate))
    return found.select(
        "doc_id", *[_count(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:3])], F.sha2(_joined("base"), 256).alias("base_sha256"),
        _joined("all_spans").alias("spans"))


def _count(kind: int) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


def redacted(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """The text with every span, overlaps merged, replaced by ``mask``."""
    def joined(wide: Column) -> Column:
        def step(at: Column, x: Column) -> tuple[Column, Column]:
            gap = F.decode(F.substring(wide, at * 4 + 1, (x["start"] - at) * 4), "UTF-32")
            return F.greatest(at, x["end"]), F.when(x["start"] >= at, F.array(gap)).otherwise(F.array().cast("array<string>"))

        end = F.struct(F.length(text).alias("start"), F.lit(len(KINDS)).alias("kind"), F.length(text).alias("end"))
        return F.array_join(_running(F.concat(spans, F.array(end)), F.lit(0), "string", step), mask)

    # four bytes a code point, so that a span is cut without walking there; encoded once, as a lambda's variable
    return F.get(F.transform(F.array(F.encode(text, "UTF-32")), joined), F.lit(0))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked (n_chars, if there, counts the masked text)."""
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    scanned = materialize(scan(docs, [own]).drop("_text"), "secret_scan")  # the scan is dearer than writing the rows
    found = with_spans(scanned, limits(scanned, docs)).withColumn("_text", empty_if_null("_row.text"))
    hit = F.size("all_spans") > 0
    found = found.withColumn("_new", F.when(hit, redacted(F.col("_text"), F.col("all_spans"))))
    cols = []
    for c in docs.columns:
        col = F.col(f"_row.`{c}`")
        if c == "text":
            col = F.when(hit, F.col("_new")).otherwise(col)
        elif c == "n_chars":
            col = F.when(hit, F.length("_new")).otherwise(col)
        cols.append(col.cast(docs.schema[c].dataType).alias(c))
    return found.select(*cols)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))
