"""Licence scan: a trained paragraph classifier names the licence family,
templates confirm it.

A paragraph is a line with a word; notices wrapped over several lines are found
as runs of lines.  Features are a paragraph's distinct words and word pairs,
lower-cased, that a notice holds.  Training rows are the template notices,
stretches of them (a notice is often quoted in part), and, as the class ``none``,
all distinct paragraphs of the corpus that resemble no template, whole.  Those that
hold the same terms are one row with their number as its weight, so that the fit
covers every paragraph and grows with the different sets of terms.  An
L1-penalised multinomial logistic regression leaves few weights.

Scoring: weights are looked up and summed within the row.  A family is reported
only above ``cutoff``, the probability that all but one in a thousand of the corpus'
ordinary paragraphs stay below (the calibrated unknown class; every one of them
is scored and counted), and is confirmed if enough of a template's word pairs occur in the paragraph.
Most paragraphs are settled before that, with the same result: a sum above the
cutoff needs one of the words of ``Model.gate``, and a run that can be confirmed
one of ``run_gate``.  The features of other paragraphs are not formed.

Wrapped notices: a run is two or more consecutive lines with a word, with at
most ``RUN_WORDS`` words between the first and the last line, whatever the
number of lines.  It is scored, and confirmed with the word pairs across its
line ends, like a line.  Of confirmed places of one family that overlap, and of
runs of several that share more than an outer line, lines come before runs,
then the most alike, the shortest and the first run is kept; a run's place is
its first line.  Only documents that hold enough of a template's
word pairs can have a run, so only their runs are formed.

Training uses the library's own logistic regression; everything else is
DataFrame expressions.

Defined results: null and empty texts have no paragraph; equal paragraphs are
judged once for each place; ties go to the family first in the alphabet;
each row is judged by itself, whatever rows share its doc_id, null or not, and
documents without a paragraph are left out; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import json
import math
from functools import lru_cache

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.llm.common import cut, id_text

SIMILARITY = 0.6  # share of a template's word pairs that confirms
RESEMBLES = 0.3  # share from which a corpus paragraph is no negative example
ODDS = 0.999  # share of the ordinary paragraphs below the cutoff
STEP = 0.01  # in log odds, to which the cutoff is rounded up
RUN_WORDS = 80  # between the first and the last line of a run; the longest template has fewer than half
MAX_WORDS = 60  # of a drawn paragraph; a longer one is represented by so many from a drawn place on

# Short notices of licence families, as commonly quoted.
TEMPLATES = {
    "agpl": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License.",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "bsd": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ),
    "cc0": (
        "Dedicated to the public domain under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
        "SPDX-License-Identifier: MIT",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright. All rights reserved. No part of this publication may be reproduced without the prior written permission of the publisher.",
        "Confidential and proprietary. Unauthorized copying of this file is strictly prohibited.",
    ),
}
NONE = "none"


def paragraphs(docs: DataFrame) -> DataFrame:
    """``doc_id, line, words`` of every line with a word."""
    own = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "t"))
    return own.select("doc_id", "line", _words(F.col("t")).alias("words")).where(F.size("words") > 0)


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}.+-]+|[.](?!\p{N})"), "")


def _pairs(words: str | Column) -> Column:
    """Distinct word pairs; of a single word, the word."""
    words = F.col(words) if isinstance(words, str) else words
    later = F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
    joined = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), later, lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(F.when(F.size(words) < 2, words).otherwise(joined))


def _features(words: str | Column) -> Column:
    words = F.col(words) if isinstance(words, str) else words
    return F.array_distinct(F.concat(words, _pairs(words)))


def templates(spark: SparkSession) -> DataFrame:
    rows = [(family, text) for family, texts in TEMPLATES.items() for text in texts]
    own = spark.createDataFrame(rows, "family string, t string")
    return own.select("family", _words(F.col("t")).alias("words")).withColumn("pairs", _pairs("words"))


@lru_cache
def _template_rows() -> list:
    return templates(SparkSession.getActiveSession()).collect()


def _texts(values: list[str]) -> Column:
    """An array of texts without line ends as one literal: a plan with a node for
    each of them would be many times as large."""
    return F.split(F.lit("\n".join(values)), "\n")


def run_gate() -> list[str]:
    """Words of which a text holds one if it holds ``SIMILARITY`` of any
    template's word pairs.  Of a template's n pairs, n - ceil(n * SIMILARITY) + 1
    cannot all be missing; those with the longest words, as the rarest, are
    taken, and of each the longer word."""
    out = set()
    for row in _template_rows():
        pairs = sorted((max(p.split(" "), key=lambda w: (len(w), w)) for p in row["pairs"]), key=lambda w: (-len(w), w))
        least = next(k for k in range(len(pairs) + 1) if k / len(pairs) >= SIMILARITY)
        out.update(pairs[: len(pairs) - least + 1])
    return sorted(out)


def similarity(pairs: Column, family: Column | None = None) -> Column:
    """Largest share of a template's word pairs among the given ones, over all
    templates or those of a family."""
    out = []
    for row in _template_rows():
        share = F.size(F.array_intersect(pairs, _texts(row["pairs"]))) / F.lit(len(row["pairs"]))
        out.append(share if family is None else F.when(family == row["family"], share).otherwise(F.lit(0.0)))
    return F.greatest(*out)


def drawn(docs: DataFrame, n: int) -> DataFrame:
    """``words`` of about the ``n`` distinct lines with the smallest hashes, for a
    fit on part of a corpus (``op3`` fits on all of it).  The number of distinct
    lines, estimated first, tells the bound on hashes that leaves a few times
    ``n``, so that only those are shuffled; it is raised while they are too few."""
    lines = docs.select(F.explode(F.split("text", "\n")).alias("t")).where(F.col("t").rlike(r"[\p{L}\p{N}+-]"))
    lines = lines.withColumn("h", F.xxhash64("t"))
    distinct = lines.agg(F.approx_count_distinct("h").alias("n")).first()["n"]
    part = 2.0 * n / max(1, distinct)
    while True:
        bound = F.lit(min(int(min(part, 1.0) * 2**64) - 2**63, 2**63 - 1))
        own = cut(lines.where(F.col("h") <= bound).distinct().orderBy("h", "t").limit(n))
        if part >= 1.0 or own.count() == n:
            break
        part *= 8
    words = own.select("h", _words(F.col("t")).alias("w")).where(F.size("w") > 0)
    start = F.pmod("h", F.greatest(F.size("w") - MAX_WORDS, F.lit(0)) + 1).cast("int") + 1
    words = words.select(F.slice("w", start, MAX_WORDS).alias("words")).distinct()
    return words.withColumn("h", F.xxhash64("words"))


def noted(words: DataFrame) -> DataFrame:
    """``features_of, n``: the distinct paragraphs of ``words`` by the notice
    terms they hold, without those that resemble a template."""
    known = sorted({f for row in _template_rows() for f in (*row["words"], *row["pairs"])})
    single = [f for f in known if " " not in f]
    own = _held(words, _in=F.transform("words", lambda w: F.when(w.isin(single), w)))
    rest = F.greatest(F.size("_in") - 1, F.lit(0))
    pairs = F.zip_with(F.slice("_in", 1, rest), F.slice("_in", 2, rest), lambda a, b: F.concat(a, F.lit(" "), b))
    terms = F.sort_array(F.array_distinct(F.filter(F.concat("_in", pairs), lambda x: x.isin(known))))
    hashes = [F.xxhash64("words").alias("k1"), F.xxhash64(F.lit(1), "words").alias("k2")]
    own = own.select(*hashes, F.array_join(terms, "\n").alias("terms")).distinct()
    own = cut(own.groupBy("terms").agg(F.count(F.lit(1)).alias("n")))
    own = own.select(F.array_remove(F.split("terms", "\n"), "").alias("features_of"), "n")
    some = F.exists("features_of", lambda x: F.contains(x, F.lit(" ")))
    return own.where(F.when(some, similarity(F.col("features_of"))).otherwise(0.0) < RESEMBLES)


def training(docs: DataFrame, sample: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Feature rows with their numbers: of notices (``family, features_of, n``) and
    of all ordinary paragraphs, or of about 2 * ``sample`` drawn ones."""
    notices = templates(docs.sparkSession)
    n = F.size("words")
    width = F.greatest(F.lit(3), F.ceil(n * 0.6).cast("int"))
    stretches = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), n - width + 1)), lambda i: F.slice("words", i, width))
    positive = notices.select("family", F.explode(F.concat(F.array("words"), stretches)).alias("words"))
    positive = positive.select("family", _features("words").alias("features_of"), F.lit(1).cast("long").alias("n"))
    if sample is None:
        words = _held(docs.select(F.explode(F.split("text", "\n")).alias("t")), words=_words(F.col("t"))).where(F.size("words") > 0)
    else:
        words = drawn(docs, 2 * sample)
    return positive, noted(words.select("words"))


class Model:
    """Non-zero weights by term, intercepts by family, and the cutoff."""

    def __init__(self, families: list[str], intercepts: list[float], terms: list[tuple[str, list[float]]], cutoff: float = 0.5):
        self.families, self.intercepts, self.terms, self.cutoff = families, intercepts, terms, cutoff

    def gate(self) -> list[str] | None:
        """Words of which any paragraph above the cutoff holds one; None if there
        is no such list.  Above the cutoff c a family leads ``none`` by log(c / (1 - c)).
        Terms, most frequent first, are left out while all their gains together
        stay below what the family that needs least still lacks; of a pair the
        rarer word stands for both."""
        lead = math.log(self.cutoff / max(1e-12, 1 - self.cutoff))
        needed = min(self.intercepts[-1] - b + lead for b in self.intercepts[:-1]) - 1e-6
        if needed <= 0:
            return None
        rank = {term: i for i, (term, _) in enumerate(self.terms)}
        out, left = set(), 0.0
        for term, w in self.terms:
            gain = max(w[:-1]) - w[-1]
            if gain > 0 and left + gain < needed:
                left += gain
            elif gain > 0:
                out.add(max(term.split(" "), key=lambda x: (rank.get(x, len(rank)), len(x), x)))
        return sorted(out)


def fit(docs: DataFrame, sample: int | None = None) -> Model:
    """Fitted and calibrated on all paragraphs, or on about 2 * ``sample``."""
    positive, ordinary = training(id_text(docs), sample)
    ordinary = cut(ordinary)
    rows = cut(positive.unionByName(ordinary.select(F.lit(NONE).alias("family"), "features_of", "n")))
    families = sorted(TEMPLATES) + [NONE]
    number = F.array_position(_texts(families), F.col("family")) - 1
    counted = rows.groupBy("family").agg(F.sum("n").alias("all"))
    weighted = rows.join(F.broadcast(counted), "family").select(
        number.cast("double").alias("label"), "features_of", (F.col("n") / F.col("all")).alias("weight")
    )
    notice = F.max(F.when(F.col("family") != NONE, 1).otherwise(0))
    terms = rows.select("family", "n", F.explode("features_of").alias("term")).groupBy("term").agg(F.sum("n").alias("n"), notice.alias("notice"))
    terms = terms.where("notice = 1").orderBy(F.desc("n"), "term").select("term")
    vector = CountVectorizerModel.from_vocabulary([r["term"] for r in terms.collect()], "features_of", "features")
    vector.setBinary(True)
    model = LogisticRegression(
        maxIter=40, regParam=1e-3, elasticNetParam=1.0, standardization=False, weightCol="weight", family="multinomial"
    ).fit(vector.transform(weighted).select("label", "features", "weight"))
    weights = model.coefficientMatrix.toArray()
    present = [i for i in range(weights.shape[0])]
    intercepts = list(model.interceptVector) + [-50.0] * (len(families) - len(present))
    terms = []
    for j, term in enumerate(vector.vocabulary):
        if weights[:, j].any():
            terms.append((term, [float(weights[i, j]) for i in present] + [0.0] * (len(families) - len(present))))
    found = Model(families, [float(x) for x in intercepts], terms)
    best = F.array_max(F.slice(vector_to_array("probability"), 1, len(families) - 1))
    found.cutoff = max(0.5, _cutoff(model.transform(vector.transform(ordinary)).select("n", best.alias("p"))))
    return found


def _cutoff(scored: DataFrame) -> float:
    """The least probability, in steps of ``STEP`` of its log odds, that at most
    one in a thousand of ``n, p`` reach."""
    p = F.greatest(F.lit(1e-15), F.least(F.lit(1 - 1e-15), "p"))
    steps = scored.groupBy(F.floor(F.log(p / (1 - p)) / STEP).alias("step")).agg(F.sum("n").alias("n"))
    steps = sorted(((r["step"], r["n"]) for r in steps.collect()), reverse=True)
    left = round(sum(n for _, n in steps) * (1 - ODDS))
    for step, n in steps:
        left -= n
        if left < 0:
            return 1 / (1 + math.exp(-(step + 1) * STEP))
    return 0.0


def _held(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are computed once a row: an explode keeps them from
    being merged into later steps, which would repeat them for each line."""
    own = F.struct(*[c.alias(name) for name, c in columns.items()])
    out = df.select("*", F.explode(F.array(own)).alias("_held"))
    return out.select(*df.columns, *[F.col(f"_held.{name}").alias(name) for name in columns])


def _scored(own: DataFrame, model: Model) -> DataFrame:
    """Adds ``scored``: the likeliest family (never ``none``) and its
    probability for those of ``paragraphs`` (structs with ``features_of``) that
    have a weighted feature, with their other fields."""
    k = len(model.families)
    shape = "array<struct<term:string,w:array<double>>>"
    weights = F.from_json(F.lit(json.dumps([{"term": t, "w": w} for t, w in model.terms])), shape)
    fields = [f.name for f in own.schema["paragraphs"].dataType.elementType.fields if f.name != "features_of"]
    named = _texts(model.families)
    own = _held(own, _terms=F.array_intersect(F.flatten("paragraphs.features_of"), weights["term"]))
    hit = F.when(F.size("_terms") > 0, F.filter(weights, lambda e: F.array_contains("_terms", e["term"])))
    own = _held(own, _weights=F.coalesce(hit, F.array().cast(shape)))

    def present(x):
        return x.withField("features_of", F.array_intersect(x["features_of"], "_terms"))

    def logits(x):
        start = F.array(*[F.lit(b) for b in model.intercepts])
        hit = F.filter("_weights", lambda e: F.array_contains(x["features_of"], e["term"]))
        sums = F.aggregate(hit, start, lambda acc, e: F.zip_with(acc, e["w"], lambda a, b: a + b))
        return F.struct(*[x[f].alias(f) for f in fields], sums.alias("z"))

    def judged(x):
        best = F.array_max(F.slice(x["z"], 1, k - 1))
        top = F.array_max(x["z"])
        total = F.aggregate(x["z"], F.lit(0.0), lambda a, z: a + F.exp(z - top))
        family = F.element_at(named, F.array_position(x["z"], best).cast("int"))
        return F.struct(*[x[f].alias(f) for f in fields], family.alias("family"), (F.exp(best - top) / total).alias("probability"))

    own = _held(own, _hit=F.filter(F.transform("paragraphs", present), lambda x: F.size(x["features_of"]) > 0))
    own = _held(own, _z=F.transform("_hit", logits))
    return _held(own, scored=F.transform("_z", judged)).drop("_terms", "_weights", "_hit", "_z")


def _runs(own: DataFrame) -> DataFrame:
    """Adds ``runs``: ``line, last, pairs, features_of`` of the runs of
    ``lines`` that hold enough of any template's word pairs; ``pairs`` are those
    that a template has."""
    known = sorted({p for row in _template_rows() for p in row["pairs"]})
    none = F.array().cast("array<array<string>>")
    gate = run_gate()
    near = F.exists("lines", lambda words: F.exists(words, lambda w: w.isin(gate)))
    whole = F.array_intersect(_pairs(F.flatten("lines")), _texts(known))
    own = _held(own, _pairs=F.when(near, whole).otherwise(F.array().cast("array<string>")))
    own = _held(own, _some=F.when(F.size("_pairs") > 0, similarity(F.col("_pairs")) >= SIMILARITY).otherwise(False))

    def across(words, i):  # the pair over the end of line i (from 0)
        after = F.element_at("lines", i + 2)
        ends = (i + 2 <= F.size("lines")) & (F.size(words) > 0) & (F.size(F.get("lines", i + 1)) > 0)
        pair = F.concat_ws(" ", F.element_at(words, -1), F.element_at(after, 1))
        return F.array_intersect(F.when(ends, F.array(pair)).otherwise(F.array().cast("array<string>")), "_pairs")

    within = F.transform("lines", lambda words: F.array_intersect(_pairs(words), "_pairs"))
    own = _held(
        own,
        _sizes=F.when(F.col("_some"), F.transform("lines", lambda words: F.size(words))).otherwise(F.array().cast("array<int>")),
        _within=F.when(F.col("_some"), within).otherwise(none),
        _across=F.when(F.col("_some"), F.transform("lines", across)).otherwise(none),
    )

    def ends(i):  # last lines (from 1) of the runs from line i on
        start = F.struct(i.alias("last"), F.lit(0).alias("words"), F.lit(True).alias("on"), F.array().cast("array<int>").alias("found"))
        later = F.sequence(i + 1, F.least(F.size("_sizes"), i + 1 + RUN_WORDS))

        def step(acc, j):
            words = F.element_at("_sizes", j)
            on = acc["on"] & (words > 0) & (acc["words"] <= RUN_WORDS)
            hit = F.size(F.element_at("_within", j)) + F.size(F.element_at("_across", j - 1)) > 0
            found = F.when(on & hit, F.concat(acc["found"], F.array(j))).otherwise(acc["found"])
            return F.struct(j.alias("last"), (acc["words"] + words).alias("words"), on.alias("on"), found.alias("found"))

        return F.when(i < F.size("_sizes"), F.aggregate(later, start, step, lambda acc: acc["found"])).otherwise(
            F.array().cast("array<int>")
        )

    def pairs(i, j):
        inside = F.concat(F.slice("_within", i, j - i + 1), F.slice("_across", i, j - i))
        return F.struct((i - 1).alias("line"), (j - 1).alias("last"), F.array_distinct(F.flatten(inside)).alias("pairs"))

    places = F.when(F.size("_sizes") > 0, F.sequence(F.lit(1), F.size("_sizes"))).otherwise(F.array().cast("array<int>"))
    first = F.filter(places, lambda i: F.size(F.element_at("_within", i)) + F.size(F.element_at("_across", i)) > 0)
    own = _held(own, _first=first)
    own = _held(own, _found=F.flatten(F.transform("_first", lambda i: F.transform(ends(i), lambda j: pairs(i, j)))))
    own = _held(own, _found2=F.filter("_found", lambda x: similarity(x["pairs"]) >= SIMILARITY))

    def features(x):
        words = F.flatten(F.slice("lines", x["line"] + 1, x["last"] - x["line"] + 1))
        return F.struct(x["line"].alias("line"), x["last"].alias("last"), x["pairs"].alias("pairs"), words.alias("words"))

    own = _held(own, _words=F.transform("_found2", features))
    runs = F.transform("_words", lambda x: x.withField("features_of", _features(x["words"])).dropFields("words"))
    return _held(own, runs=runs).drop("_pairs", "_some", "_sizes", "_within", "_across", "_first", "_found", "_found2", "_words")


def _apart(sure: str, runs: str) -> Column:
    """The confirmed lines, and of the confirmed runs (best first) those that
    overlap no place of their family before them, and share at most an outer
    line with a run of another."""

    def step(acc, x):
        def same(y):
            return (y["family"] == x["family"]) & (y["line"] <= x["last"]) & (x["line"] <= y["last"])

        taken = F.exists(acc, lambda y: same(y) | ((y["line"] < y["last"]) & (y["line"] < x["last"]) & (x["line"] < y["last"])))
        return F.when(taken, acc).otherwise(F.concat(acc, F.array(x)))

    return F.aggregate(runs, F.col(sure), step)


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``doc_id, n_paragraphs, n_predicted`` (paragraphs above
    the cutoff, and wrapped notices found) and ``licenses`` (array of (line,
    family, probability, similarity), the confirmed ones, by line)."""
    own = _held(id_text(docs, id_col, text_col), lines=F.transform(F.split("text", "\n"), _words)).drop("text")
    own = own.withColumn("n_paragraphs", F.size(F.filter("lines", lambda w: F.size(w) > 0)).cast("long")).where("n_paragraphs > 0")
    own = _runs(own)

    gate = model.gate()

    def near(words):
        return F.size(words) > 0 if gate is None else F.exists(words, lambda w: w.isin(gate))

    def paragraph(i):
        return F.struct(i.alias("line"), i.alias("last"), _features(F.get("lines", i)).alias("features_of"))

    def above(x):
        return x["probability"] >= model.cutoff

    own = _held(own, _at=F.filter(F.transform("lines", lambda words, i: F.when(near(words), i)), lambda i: i.isNotNull()))
    own = _held(own, paragraphs=F.transform("_at", paragraph)).drop("_at")
    own = _held(_scored(own, model), _above=F.filter("scored", above))
    own = own.drop("paragraphs", "scored").withColumnRenamed("runs", "paragraphs")
    own = _held(_scored(own, model), _runs=F.filter("scored", above)).drop("paragraphs", "scored")

    def entry(x, share):
        return F.struct(x["line"].alias("line"), x["last"].alias("last"), x["family"].alias("family"),
                        x["probability"].alias("probability"), share.alias("similarity"))

    def line(x):
        return entry(x, similarity(_pairs(F.element_at("lines", x["line"] + 1)), x["family"]))

    def confirmed(x):
        return x["similarity"] >= SIMILARITY

    own = _held(
        own,
        _lines=F.filter(F.transform("_above", line), confirmed),
        _runs2=F.filter(F.transform("_runs", lambda x: entry(x, similarity(x["pairs"], x["family"]))), confirmed),
    )
    ranked = F.array_sort(F.transform("_runs2", lambda x: F.struct((-x["similarity"]).alias("a"), (x["last"] - x["line"]).alias("b"), x["line"].alias("c"), x.alias("x"))))
    own = _held(own, _ranked=ranked["x"])
    own = _held(own, _places=_apart("_lines", "_ranked"))
    out = F.transform("_places", lambda x: x.dropFields("last"))
    return own.select(
        "doc_id", "n_paragraphs",
        (F.size("_above") + F.size("_places") - F.size("_lines")).cast("long").alias("n_predicted"), F.array_sort(out).alias("licenses"),
    )


def digest(found: DataFrame) -> DataFrame:
    """The columns of the ``op3`` query."""
    families = F.array_sort(F.array_distinct(F.transform("licenses", lambda x: x["family"])))
    return found.select(
        "doc_id", "n_paragraphs", "n_predicted", F.size("licenses").cast("long").alias("n_confirmed"),
        F.array_join(families, ",").alias("families"),
        F.array_join(F.transform("licenses", lambda x: F.concat_ws(":", x["line"], x["family"])), ",").alias("places"),
    )
