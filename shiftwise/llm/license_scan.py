"""Licence scan: a trained paragraph classifier confirmed by template comparison.

Training rows are made on Spark from the notice templates below (seeded
variants: dropped words, cut ends, words of the corpus around them) and from a
bounded sample of corpus paragraphs that resemble no template, as class
``unknown``. Features are the presence of word 1- and 2-grams; the model is a
sparse multinomial logistic regression (elastic net). A temperature fitted on
held-out rows calibrates the probabilities, and the acceptance threshold is set
on held-out unknown rows. The model (a vocabulary of bounded size) is broadcast
and scores every paragraph of every whole text; a prediction counts only if the
paragraph also shares enough of a template's word pairs.

A paragraph is a non-empty line. A notice may be wrapped over lines or stand in
a longer one, so besides each line the runs of words around a template's pairs
are scored: windows of template length over the words of consecutive lines
(blank lines end them, comment marks are no words). Every family that passes
counts, at the line where its window starts. Null or empty text has none; repeated rows are
scanned each; an empty table gives no rows, and then nothing but templates is
trained on.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftwise.llm.common import empty_if_null, table
from shiftwise.session import materialize

# Usual notices of the licence families.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License. See LICENSE in the project root for license information."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "Dedicated to the public domain under the Creative Commons CC0 1.0 Universal waiver."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
)
UNKNOWN = "unknown"
FAMILIES = tuple(dict.fromkeys(f for f, _ in TEMPLATES))
VARIANTS = 60  # training variants of a template
SAMPLE = 4000  # corpus paragraphs taken as unknown rows: the bound of the training sample
VOCABULARY = 4096  # n-grams the model may use
CONFIRM = 0.6  # share of a template's word pairs that the paragraph must hold
FALSE_RATE = 0.002  # of held-out unknown rows, the share that may pass the threshold
SEED = 23

WORDS = re.compile(r"[a-z0-9.]*[a-z0-9]")


def grams(paragraph: str) -> list[str]:
    """Distinct 1- and 2-grams of the lower-cased words."""
    w = WORDS.findall(paragraph.lower())
    return list(dict.fromkeys([*w, *map(" ".join, zip(w, w[1:]))]))


PAIRS = [(f, frozenset(g for g in grams(t) if " " in g)) for f, t in TEMPLATES]


def resemblance(found: set, family: str | None = None) -> float:
    """Largest share of a template's word pairs among ``found`` (of one family, or of all)."""
    return max(len(p & found) / len(p) for f, p in PAIRS if family in (None, f))


#: Word pair -> templates that hold it, and each template's number of words.
HOLDERS = {}
for _i, (_, _p) in enumerate(PAIRS):
    for _g in _p:
        HOLDERS.setdefault(_g, []).append(_i)
LENGTHS = [len(WORDS.findall(t.lower())) for _, t in TEMPLATES]


def windows(words: list[str]) -> list[tuple]:
    """(template, start, end) of the best window of each cluster of a template's word pairs.

    A window is half as long again as its template, which leaves room for words
    between; one with fewer pairs than CONFIRM asks for is not kept, nor one
    that overlaps a window of another family which holds more of its template.
    """
    at = {}
    for i, pair in enumerate(map(" ".join, zip(words, words[1:]))):
        for k in HOLDERS.get(pair, ()):
            at.setdefault(k, []).append((i, pair))
    out = []
    for k, hits in at.items():
        least, room = CONFIRM * len(PAIRS[k][1]), LENGTHS[k] + LENGTHS[k] // 2
        if len(hits) < least:
            continue
        inside, low, best = {}, 0, None
        for i, pair in hits:
            inside[pair] = inside.get(pair, 0) + 1
            while hits[low][0] < i + 2 - room:
                old = hits[low][1]
                inside[old] -= 1
                if not inside[old]:
                    del inside[old]
                low += 1
            if best and hits[low][0] >= best[2]:  # a cluster of its own
                out.append((best[0] / len(PAIRS[k][1]), k, best[1], best[2]))
                best = None
            if len(inside) >= least and (best is None or len(inside) > best[0]):
                best = (len(inside), hits[low][0], i + 2)
        if best:
            out.append((best[0] / len(PAIRS[k][1]), k, best[1], best[2]))
    kept = []
    for _, k, start, end in sorted(out, key=lambda x: (-x[0], -len(PAIRS[x[1]][1]), *x[1:])):
        if not any(start < e and s < end and PAIRS[k][0] != PAIRS[o][0] for o, s, e in kept):
            kept.append((k, start, end))
    return kept


def variants(template: tuple, filler: list[str]) -> list[tuple]:
    """Seeded variants: some words dropped, ends cut, words of the corpus before and after."""
    family, text = template
    rng, out = random.Random(f"{SEED}{text}"), [(family, text)]
    w = text.split()
    for _ in range(VARIANTS):
        kept = [x for x in w if rng.random() > 0.08] or w
        if len(kept) > 10 and rng.random() < 0.5:
            kept = kept[rng.randrange(3): len(kept) - rng.randrange(3)]
        if filler and rng.random() < 0.4:
            kept = rng.choices(filler, k=rng.randrange(8)) + kept + rng.choices(filler, k=rng.randrange(8))
        if resemblance(set(grams(" ".join(kept))), family) >= 0.5:
            out.append((family, " ".join(kept)))
    return out


@dataclass
class Model:
    """Weights per n-gram and class, intercepts, temperature and threshold."""

    weights: dict
    intercept: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.5

    def logits(self, found: list[str]) -> np.ndarray | None:
        rows = [self.weights[g] for g in found if g in self.weights]
        return self.intercept + np.sum(rows, axis=0) if rows else None

    def probabilities(self, found: list[str]) -> np.ndarray | None:
        """Calibrated; None where no n-gram of the paragraph is in the model, which leaves the intercepts: unknown."""
        z = self.logits(found)
        if z is None:
            return None
        z = np.exp((z - z.max()) / self.temperature)
        return z / z.sum()


def train(spark: SparkSession, paragraphs: DataFrame) -> Model:
    """``paragraphs`` has one column, text. The sample is taken by the order of a seeded hash, so reruns agree."""
    order = F.xxhash64(F.lit(SEED), "text")
    sample = [r["text"] for r in paragraphs.orderBy(order, "text").limit(SAMPLE).collect()]
    unknown = [t for t in sample if resemblance(set(grams(t))) < 0.2]
    filler = [w for t in unknown[:200] for w in t.split()[:5]]
    rows = [(f, t) for x in TEMPLATES for f, t in variants(x, filler)] + [(UNKNOWN, t[:2000]) for t in unknown]
    rows += [(UNKNOWN, t) for t in ("see the license", "under the terms of the agreement", "all rights reserved",
                                    "version 2.0 of the report", "free software", "driving license required")]
    names = (UNKNOWN, *FAMILIES)
    random.Random(SEED).shuffle(rows)
    df = spark.createDataFrame([(float(names.index(f)), grams(t), i % 4 == 0) for i, (f, t) in enumerate(rows)],
                               "label double, grams array<string>, held boolean")
    df = materialize(df.repartition(4), "license_rows")
    counted = CountVectorizer(inputCol="grams", outputCol="features", binary=True, vocabSize=VOCABULARY, minDF=3.0).fit(
        df.where("label > 0 and not held"))
    training = counted.transform(df.where("not held")).cache()
    fitted = LogisticRegression(regParam=0.002, elasticNetParam=0.5, maxIter=40, family="multinomial").fit(training)
    coef = fitted.coefficientMatrix.toArray().T
    classes = fitted.numClasses
    intercept = np.full(len(names), -30.0)
    intercept[:classes] = fitted.interceptVector.toArray()
    weights = {}
    for gram, w in zip(counted.vocabulary, coef):
        if w.any():
            weights[gram] = np.concatenate([w, np.zeros(len(names) - classes)])
    training.unpersist()
    model = Model(weights, intercept)
    held = [(names.index(f), model.logits(grams(t))) for i, (f, t) in enumerate(rows) if i % 4 == 0]
    held = [(y, intercept if z is None else z) for y, z in held]

    def loss(t: float) -> float:
        out = 0.0
        for y, z in held:
            z = (z - z.max()) / t
            out -= z[y] - math.log(np.exp(z).sum())
        return out

    model.temperature = min((0.25 * 1.1 ** i for i in range(40)), key=loss)
    passed = sorted((1 - (lambda e: e[0] / e.sum())(np.exp((z - z.max()) / model.temperature)) for y, z in held if y == 0),
                    reverse=True)
    model.threshold = max(0.5, passed[min(int(FALSE_RATE * len(passed)), len(passed) - 1)] + 1e-9 if passed else 0.5)
    return model


OUT = ("doc_id long, n_paragraphs long, n_license long, family string, probability double, similarity double, "
       "families string, paragraphs string")


def scan_text(text: str, model: Model) -> tuple:
    """Counts, the surest licence, all families, and the paragraphs found as number:family."""
    n, best_of, words, numbers = 0, {}, [], []
    names = (UNKNOWN, *FAMILIES)

    def score(w: list[str], line: int, family: str | None = None) -> None:
        """Keeps a paragraph that the model and a template hold for a licence, of ``family`` if one is given."""
        all_grams = list(dict.fromkeys([*w, *map(" ".join, zip(w, w[1:]))]))
        p = model.probabilities(all_grams)
        if p is None:
            return
        k = int(np.argmax(p[1:])) + 1
        if family not in (None, names[k]) or not (1 - p[0] > model.threshold and p[k] > p[0]):
            return
        similar = resemblance(set(all_grams), names[k])
        if similar >= CONFIRM:
            one = (float(p[k]), similar, names[k], line)
            best_of[line, names[k]] = max(best_of.get((line, names[k]), one), one)

    def close() -> None:
        for k, start, end in windows(words):
            score(words[start:end], numbers[start], PAIRS[k][0])
        words.clear()
        numbers.clear()

    for line in text.split("\n"):
        if not line.strip():
            close()
            continue
        n += 1
        w = WORDS.findall(line.lower())
        if not w:  # a bare comment mark is a blank line inside a comment
            continue
        words += w
        numbers += [n - 1] * len(w)
        if any(x in model.weights for x in w) or any(f"{a} {b}" in model.weights for a, b in zip(w, w[1:])):
            score(w, n - 1)
    close()
    found = sorted(best_of.values(), key=lambda x: (x[3], x[2]))
    if not found:
        return n, 0, None, None, None, "", ""
    best = max(found, key=lambda x: (round(x[0], 6), x[1], x[2]))
    return (n, len({x[3] for x in found}), best[2], round(best[0], 6), round(best[1], 6), ",".join(sorted({x[2] for x in found})),
            ",".join(f"{x[3]}:{x[2]}" for x in found))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None) -> DataFrame:
    """One row per document: its paragraphs, those under a known licence, and the licence found."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), empty_if_null(text_col).alias("text"))
    spark = docs.sparkSession
    if model is None:
        lines = rows.select(F.explode(F.split("text", "\n")).alias("text")).where(F.length(F.trim("text")) > 0)
        # only the sample leaves the scan; each task keeps at most SAMPLE lines of its own
        model = train(spark, lines)
    shared = spark.sparkContext.broadcast(model)  # at most VOCABULARY x classes weights

    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in it:
            found = [scan_text(t, shared.value) for t in b["text"]]
            out = pd.DataFrame(found, columns=["n_paragraphs", "n_license", "family", "probability", "similarity",
                                               "families", "paragraphs"])
            out.insert(0, "doc_id", b["doc_id"].astype("Int64").to_numpy())
            yield out

    return rows.mapInPandas(batches, OUT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))
