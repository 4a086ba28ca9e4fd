"""Licence families of paragraphs, by a trained classifier and a comparison with templates.

A paragraph is a line of a text.  Its features are the pairs and triples of
consecutive words (in lower case) that occur in ``TEMPLATES`` and hold a word
other than ``COMMON`` ones.  A multinomial logistic regression over these
sparse features is trained on the templates' sentences and parts of them, one
class a family, and on paragraphs of the documents without a licence word, as
the class ``unknown`` (from at most about ``BACKGROUND`` documents, a
documented bound, drawn by a hash of the id).  A temperature, fitted on
sentence parts that the regression hasn't seen, calibrates the probabilities.

A paragraph without a feature is unknown.  Otherwise the likeliest class is
taken; a family needs a probability of ``MIN_PROBABILITY`` and a template that
confirms it: ``MIN_OVERLAP`` of the paragraph's pairs of words are in the
family's templates, or ``MIN_CONTAINED`` of the pairs of one of its sentences
are in the paragraph.

DataFrame operations, with Spark's own logistic regression on the small
training table.  Prediction is row by row, without a join or shuffle: weights
and templates are constants of the plan, bounded by ``TEMPLATES``.

Defined results: null, empty and wordless texts have no licence; an empty
table gives an empty result; a document may have several paragraphs and
families; families are listed once, in order; equal probabilities give the
class first in order; repeated rows each get their result.
"""

from __future__ import annotations

import json
import math
import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm.common import let, share, stored

UNKNOWN = "unknown"
BACKGROUND = 2000
MIN_PROBABILITY = 0.5
MIN_OVERLAP = 0.5
MIN_CONTAINED = 0.6

#: Sentences that public licences and notices of them are known by.
TEMPLATES = {
    "agpl": [
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License",
        "This work is licensed under the GNU Affero General Public License, version 3.",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS basis",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice",
        "Released under the BSD License.",
        "Licensed under the BSD 3-Clause License.",
    ],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc0": ["Licensed under CC0 1.0.", "the author has waived all copyright and related or neighboring rights to this work."],
    "gpl": [
        "you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This work is licensed under the GNU General Public License, version 3.",
        "This work is licensed under the GNU General Public License, version 2.",
    ],
    "lgpl": [
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "This work is licensed under the GNU Lesser General Public License, version 3.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
}

#: Words that don't make a feature by themselves.
COMMON = frozenset("a all an and any are as at be by can for form free in is it later may not of on or out list shall the this to use with without work you your".split())

#: What stands between words: anything but these characters, and marks at a word's end.
BETWEEN = r"[^a-z0-9./+\n-]+|[./+-]+(?=[^a-z0-9]|$)"


def plain(text: str, k: int) -> list[str]:
    """Runs of k words of a template."""
    w = re.sub(BETWEEN, " ", text.lower()).split()
    return [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)]


def vocabulary() -> list[str]:
    grams = {g for sentences in TEMPLATES.values() for s in sentences for k in (2, 3) for g in plain(s, k)}
    return sorted(g for g in grams if set(g.split()) - COMMON)


def telling() -> list[str]:
    """Words without one of which a paragraph has no feature."""
    return sorted({w for g in vocabulary() for w in g.split()} - COMMON)


def paragraphs(text: Column) -> Column:
    """The words of each line."""
    clean = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), BETWEEN, " ")
    return F.transform(F.split(clean, "\n"), lambda x: F.filter(F.split(x, " "), lambda w: w != ""))


def runs(words: Column, k: int) -> Column:
    n = F.size(words) - (k - 1)
    made = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.array_join(F.slice(words, i, F.lit(k)), " "))
    return F.when(n < 1, F.array().cast("array<string>")).otherwise(made)


def features(words: Column) -> Column:
    """The features of a paragraph, each once."""
    known, some = vocabulary(), telling()
    none = F.array().cast("array<string>")
    found = F.array_distinct(F.filter(F.concat(runs(words, 2), runs(words, 3)), lambda g: g.isin(known)))
    return F.when(F.exists(words, lambda w: w.isin(some)), found).otherwise(none)


def _constant(value, kind: str) -> Column:
    """A constant of the plan."""
    return F.from_json(F.lit(json.dumps(value)), kind)


class Model:
    """Classes in order, their intercepts, their weights by feature, and the temperature."""

    def __init__(self, classes: list[str], intercepts: list[float], weights: dict[str, list[float]], temperature: float):
        self.classes, self.intercepts, self.weights, self.temperature = classes, intercepts, weights, temperature

    def probabilities(self, grams: list[str], temperature: float | None = None) -> list[float]:
        z = [b + sum(self.weights[g][i] for g in grams) for i, b in enumerate(self.intercepts)]
        e = [math.exp((x - max(z)) / (temperature or self.temperature)) for x in z]
        return [x / sum(e) for x in e]


def _examples(docs: DataFrame, background: int) -> DataFrame:
    """(family, words, seen): training paragraphs; parts with seen = 0 are for the temperature."""
    spark = docs.sparkSession
    rows = []
    for family, sentences in sorted(TEMPLATES.items()):
        for s in sentences:
            w = s.split()
            n = len(w)
            rows += [(family, x, 1) for x in dict.fromkeys([s, " ".join(w[: n * 2 // 3 + 1]), " ".join(w[n // 3 :])])]
            rows += [(family, x, 0) for x in (" ".join(w[: n // 2 + 1]), "Notice: " + s)]
    quoted = ", ".join(f"('{family}', '{text}', {seen})" for family, text, seen in rows)  # no sentence has a quote
    own = spark.sql(f"select * from values {quoted} as t(family, text, seen)").select("family", F.flatten(paragraphs(F.col("text"))).alias("words"), "seen")
    total = max(1, docs.count())
    drawn = docs.where(share(F.col("doc_id"), 8) * total < background).select(F.explode(paragraphs(F.col("text"))).alias("words"))
    plainly = drawn.where(~F.exists("words", lambda w: w.rlike("licen[cs]e|copyright|warrant|permission|redistribut")))
    other = plainly.select(F.lit(UNKNOWN).alias("family"), "words", F.when(share(F.array_join("words", " "), 9) < 0.5, 1).otherwise(0).alias("seen"))
    # Single features in other company, as texts of any kind may have them.
    stray = [g for g in vocabulary() if len(g.split()) == 2]
    lone = spark.range(1).select(F.explode(_constant(stray, "array<string>")).alias("g"))
    lone = lone.select(F.lit(UNKNOWN).alias("family"), F.split("g", " ").alias("words"), F.when(share(F.col("g"), 10) < 0.5, 1).otherwise(0).alias("seen"))
    return own.unionByName(other).unionByName(lone)


def fit(docs: DataFrame, background: int = BACKGROUND) -> Model:
    rows = _examples(docs, background).select("family", features(F.col("words")).alias("grams"), "seen")
    # Equal examples become one row with a weight: some hundred rows, stored in one file, which the fit reads again and again.
    rows = rows.groupBy("family", "grams", "seen").agg(F.sqrt(F.count("*")).alias("weight"))
    rows = stored(rows.coalesce(1), "licences")
    known = vocabulary()
    index = StringIndexer(inputCol="family", outputCol="label", stringOrderType="alphabetAsc").fit(rows)
    counted = CountVectorizerModel.from_vocabulary(known, "grams", "features").transform(index.transform(rows.where("seen = 1")))
    learnt = LogisticRegression(family="multinomial", regParam=0.001, maxIter=80, weightCol="weight", standardization=False).fit(counted)
    weights = learnt.coefficientMatrix.toArray().T.tolist()
    model = Model(list(index.labels), learnt.interceptVector.toArray().tolist(), dict(zip(known, weights, strict=True)), 1.0)
    held = [(model.classes.index(r.family), r.grams, r.weight) for r in rows.where("seen = 0").collect()]  # a few hundred at most

    def loss(t: float) -> float:
        return -sum(w * math.log(max(model.probabilities(g, t)[y], 1e-12)) for y, g, w in held)

    model.temperature = min((2 ** (k / 4) for k in range(-12, 13)), key=loss)
    return model


def classified(words: Column, model: Model) -> Column:
    """family, probability, overlap, contained and confirmed of a paragraph; null without a feature."""
    classes = _constant(model.classes, "array<string>")
    templates = {f: [sorted(set(plain(s, 2))) for s in v] for f, v in TEMPLATES.items()}
    sentences = _constant([templates.get(c, []) for c in model.classes], "array<array<array<string>>>")
    together = _constant([sorted({g for s in templates.get(c, []) for g in s}) for c in model.classes], "array<array<string>>")
    weights = _constant(model.weights, "map<string,array<double>>")

    def scored(grams: Column) -> Column:
        def z_of(b: Column, i: Column) -> Column:
            return F.aggregate(grams, b, lambda a, g: a + F.get(F.element_at(weights, g), i))

        def said(z: Column) -> Column:
            top = F.array_max(z)
            mass = F.aggregate(z, F.lit(0.0), lambda a, x: a + F.exp((x - top) / model.temperature))
            return compared((F.array_position(z, top) - 1).cast("int"), 1 / mass)

        return F.when(F.size(grams) > 0, let(F.transform(_constant(model.intercepts, "array<double>"), z_of), said))

    def compared(best: Column, probability: Column) -> Column:
        def judged(two: Column) -> Column:
            overlap = F.size(F.array_intersect(two, F.get(together, best))) / F.greatest(F.size(two), F.lit(1))
            parts = F.transform(F.get(sentences, best), lambda s: F.size(F.array_intersect(two, s)) / F.size(s))
            contained = F.coalesce(F.array_max(parts), F.lit(0.0))
            family = F.get(classes, best)
            sure = (family != UNKNOWN) & (probability >= MIN_PROBABILITY) & ((overlap >= MIN_OVERLAP) | (contained >= MIN_CONTAINED))
            return F.struct(
                family.alias("family"), probability.alias("probability"), overlap.alias("overlap"), contained.alias("contained"), sure.alias("confirmed")
            )

        return let(F.array_distinct(runs(words, 2)), judged)

    return let(features(words), scored)


def scan(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``licences`` (line, family, probability, overlap, contained, confirmed; only lines with features)."""
    numbered = F.transform(paragraphs(F.col(f"`{text}`")), lambda w, i: F.struct(i.alias("line"), w.alias("words")))
    some = telling()
    lines = F.filter(numbered, lambda x: F.exists(x["words"], lambda w: w.isin(some)))
    found = F.transform(lines, lambda x: let(classified(x["words"], model), lambda c: F.when(c.isNotNull(), F.struct(x["line"].alias("line"), c.alias("is")))))
    work = docs.withColumn("licences", F.filter(found, lambda x: x.isNotNull()))
    flat = F.transform("licences", lambda x: F.struct(x["line"].alias("line"), *[x["is"][c].alias(c) for c in ("family", "probability", "overlap", "contained", "confirmed")]))
    return work.withColumn("licences", flat)


def report(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id, number of confirmed paragraphs, families, and all paragraphs with features."""
    sure = F.filter("licences", lambda x: x["confirmed"])
    return scan(docs.select("doc_id", "text"), model).select(
        "doc_id",
        F.size(sure).cast("long").alias("n_licences"),
        F.array_sort(F.array_distinct(F.transform(sure, lambda x: x["family"]))).alias("families"),
        "licences",
    )
