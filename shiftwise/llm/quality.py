"""Quality rules by weak supervision.

Eight rules vote good (1), bad (-1) or abstain (0) on each document. What a
vote is worth is not set by hand: expectation-maximisation estimates, for each
rule, how often it casts each vote on good and on bad documents, from the
agreements of the rules over the whole corpus; the posterior probability of
"good" then replaces an all-must-pass filter.

Only DataFrame expressions run. The EM sees the counted vote patterns, at most
3**8 rows whatever the corpus. Null or empty text has no words, abstains where
a ratio has no base, and fails the base rule; repeated rows count each; an
empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftwise.llm.common import WORD, empty_if_null, table, words
from shiftwise.session import materialize

WINDOW = 8
SYMBOLS = "[#*$%&|<>]"  # fixed value

# The rules' bounds: (rule, bad if, good if) as SQL over the features below.
RULES = (
    ("symbols", "n_symbols > 0.2 * n_words", "n_symbols <= 0.02 * n_words"),
    ("repeats", "n_repeat_words > 0.15 * n_words", "n_repeat_words <= 0.02 * n_words"),
    ("lines", "n_dup_lines > 0.35 * n_lines", "n_dup_lines <= 0.1 * n_lines"),
    ("capitals", "n_capitals > 0.4 * word_chars", "n_capitals < 0.1 * word_chars"),
    ("variety", "n_distinct < 0.4 * n_words", "n_distinct > 0.6 * n_words"),
    ("word_length", "word_chars < 4.2 * n_words or word_chars > 7 * n_words",
     "word_chars between 4.5 * n_words and 6.2 * n_words"),
    ("length", "n_words < 10", "n_words >= 50"),
    ("exclamations", "n_exclamations > 0.5 * n_words", "n_exclamations <= 0.05 * n_words"),
)

#: What the rules claim before any data: a bad vote is rare on good documents, a good vote is common on both.
START_GOOD = {-1: 0.005, 0: 0.095, 1: 0.90}
START_BAD = {-1: 0.30, 0: 0.20, 1: 0.50}


@dataclass
class VoteModel:
    """P(vote | good) and P(vote | bad) of each rule, and the share of good documents."""

    good: list = field(default_factory=lambda: [dict(START_GOOD) for _ in RULES])
    bad: list = field(default_factory=lambda: [dict(START_BAD) for _ in RULES])
    prior: float = 0.9
    steps: int = 0

    def posterior(self) -> Column:
        """P(good | votes) as an expression over the array column ``votes``."""
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for i in range(len(RULES)):
            v = F.get("votes", F.lit(i))
            w = {k: math.log(self.good[i][k] / self.bad[i][k]) for k in (-1, 0, 1)}
            odds = odds + F.when(v == 1, F.lit(w[1])).when(v == -1, F.lit(w[-1])).otherwise(F.lit(w[0]))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))

    def probability(self, votes: tuple) -> float:
        """The same for one pattern."""
        odds = math.log(self.prior / (1 - self.prior)) + sum(
            math.log(self.good[i][v] / self.bad[i][v]) for i, v in enumerate(votes))
        return 1 / (1 + math.exp(-odds)) if odds > -700 else 0.0

    def accuracies(self) -> list[float]:
        """Per rule: probability that a vote which is not an abstention is right."""
        p = self.prior
        return [(p * g[1] + (1 - p) * b[-1]) / (p * (g[1] + g[-1]) + (1 - p) * (b[1] + b[-1]))
                for g, b in zip(self.good, self.bad)]


def repeated_window_words(df: DataFrame, hash_col: str, out: str, window: int = WINDOW) -> DataFrame:
    """Adds the number of words (given by their hashes) inside windows of ``window`` words that occur twice or more in the row's text.

    Windows are compared by 64-bit hashes, built by doubling (1, 2, 4, 8 words).
    Rows without a repeated window, nearly all, stop after one distinct count.
    """
    if window & (window - 1):
        raise ValueError("the window must be a power of two")
    step, last = 1, hash_col
    while step < window:
        n = F.greatest(F.size(last) - step, F.lit(0))
        df = df.withColumn(f"_k{step}", F.zip_with(F.slice(last, F.lit(1), n), F.slice(last, F.lit(1 + step), n),
                                                   lambda a, b: F.xxhash64(a, b)))
        df = df.drop(last) if last != hash_col else df
        last, step = f"_k{step}", step * 2
    pairs = F.sort_array(F.transform(last, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
    repeated = F.size(F.array_distinct(last)) < F.size(last)
    df = df.withColumn("_s", F.when(repeated, pairs)).drop(last)
    m = F.greatest(F.size("_s") - 1, F.lit(0))
    starts = F.sort_array(F.array_distinct(F.flatten(F.zip_with(
        F.slice("_s", F.lit(1), m), F.slice("_s", F.lit(2), m),
        lambda a, b: F.when(a["k"] == b["k"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>"))))))
    df = df.withColumn("_d", starts).drop("_s")
    m = F.greatest(F.size("_d") - 1, F.lit(0))
    gaps = F.zip_with(F.slice("_d", F.lit(1), m), F.slice("_d", F.lit(2), m), lambda a, b: F.least(F.lit(window), b - a))
    covered = F.aggregate(gaps, F.lit(0).cast("long"), lambda s, g: s + g) + F.lit(window)
    return df.withColumn(out, F.when(F.size("_d") > 0, covered).otherwise(F.lit(0)).cast("long")).drop("_d")


def features(docs: DataFrame, keep: list[Column], text_col: str = "text") -> DataFrame:
    """``keep`` plus the documents' counts. Names starting with ``_`` are internal."""
    text = empty_if_null(text_col)
    df = docs.select(*keep, text.alias("_text"))
    df = df.withColumn("_words", words(F.col("_text"))).withColumn(
        "_lines", F.filter(F.split("_text", "\n"), lambda x: F.rlike(x, F.lit(WORD))))
    df = df.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "_hashes": F.transform("_words", lambda w: F.xxhash64(w)),
    }).drop("_words")
    df = repeated_window_words(df, "_hashes", "n_repeat_words")
    return df.withColumns({
        "n_symbols": F.regexp_count("_text", F.lit(SYMBOLS)).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_capitals": F.regexp_count("_text", F.lit("[A-Z]")).cast("long"),
        "n_distinct": F.size(F.array_distinct("_hashes")).cast("long"),
        "n_exclamations": (F.length("_text") - F.length(F.replace("_text", F.lit("!"), F.lit("")))).cast("long"),
    }).drop("_text", "_hashes", "_lines")


def vote_columns() -> Column:
    """Array of the rules' votes; without words every rule but ``length`` abstains."""
    out = []
    for name, bad, good in RULES:
        vote = F.when(F.expr(bad), -1).when(F.expr(good), 1).otherwise(0)
        out.append((vote if name == "length" else F.when(F.col("n_words") == 0, 0).otherwise(vote)).cast("int"))
    return F.array(*out)


def fit(voted: DataFrame, max_steps: int = 100, tol: float = 1e-6, trust: float = 4.0) -> VoteModel:
    """EM over the counted vote patterns of all documents.

    ``trust`` is the weight of the claimed vote rates against those estimated
    (the same at every corpus size); it keeps the two classes from turning
    into two kinds of bad document when rules overlap.

    The counting runs on Spark; what reaches the driver is one row per vote
    pattern, at most 3**rules rows however large the corpus.
    """
    counted = voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()
    patterns = sorted((tuple(r["votes"]), r["n"]) for r in counted)
    total = sum(n for _, n in patterns)
    model = VoteModel()
    for step in range(max_steps if total else 0):
        seen = {True: [dict.fromkeys((-1, 0, 1), 0.0) for _ in RULES],
                False: [dict.fromkeys((-1, 0, 1), 0.0) for _ in RULES]}
        n_good = 0.0
        for votes, n in patterns:
            p = model.probability(votes)
            n_good += n * p
            for i, v in enumerate(votes):
                seen[True][i][v] += n * p
                seen[False][i][v] += n * (1 - p)

        def rates(good: bool, size: float, claim: dict) -> list:
            size = max(size, 1e-9)
            return [{v: (x / size + trust * claim[v]) / (1 + trust) for v, x in r.items()} for r in seen[good]]

        share = min(max(n_good / total, 1e-4), 1 - 1e-4)
        new = VoteModel(rates(True, n_good, START_GOOD), rates(False, total - n_good, START_BAD), share, step + 1)
        moved = max(abs(x - y) for i in range(len(RULES)) for v in (-1, 0, 1)
                    for x, y in ((model.good[i][v], new.good[i][v]), (model.bad[i][v], new.bad[i][v])))
        model = new
        if moved < tol:
            break
    return model


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def judged(feats: DataFrame, model: VoteModel, threshold: float = 0.5) -> DataFrame:
    """Adds base_failed, quality (posterior) and kept."""
    return (feats.withColumn("base_failed", base_failed()).withColumn("quality", model.posterior())
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold)))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its counts, votes, posterior and verdict."""
    feats = features(docs, [F.col(id_col).alias("doc_id")], text_col).withColumn("votes", vote_columns())
    feats = materialize(feats, "quality_features")
    return judged(feats, fit(feats)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "quality")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the rules keep, with their own columns."""
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    feats = features(docs, [own], "text").withColumn("votes", vote_columns())
    feats = materialize(feats, "quality_features")  # every vote is read several times: from a written column, not the whole expression
    return judged(feats, fit(feats)).where("kept").select("_row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))
