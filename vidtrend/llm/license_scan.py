"""Licence scan: a trained paragraph classifier, confirmed by template comparison.

Training rows are runs of words cut from the licence templates below, and lines of
a bounded sample of the corpus as the unknown class.  Features are the word
n-grams (one to three words) of the templates, weights a sparse multinomial logistic
regression.  A temperature is then fitted on the families' rows and on unknown rows held
out of training, the decision threshold on the latter.  Scanning
takes every line of every text as a paragraph, and every run of wrapped lines joined,
sums the weights of their n-grams and applies the softmax.  Only n-grams with a weight are
built, where their words stand; paragraphs whose n-grams
cannot reach the threshold, by an upper bound of their weights, are dropped before.
A joined run is numbered by its first line, and reported if none of its lines is.  Each prediction is
compared with its family's templates: it is confirmed if 0.8 of the five-word
shingles of the shorter of both are shared.

Everything is DataFrame operations and Spark's own logistic regression; a paragraph's
n-grams meet the weights in a join, and sums are aggregated before the shuffle.

Defined results: null and empty texts have no paragraph; a line is wrapped if it has
50 to 100 characters, does not end a sentence and the next line is not blank; rows with equal or null ids are scanned each for
itself; repeated paragraphs repeat; an empty table gives an empty result.  Extra
columns are ignored.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vidtrend.llm.common import keep, least_hashed

UNKNOWN = "unknown"
#: Statements of licence families as they are published.
TEMPLATES: dict[str, list[str]] = {
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files, to deal in the Software without restriction, including without limitation the rights to use,"
        " copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of"
        " the Software.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed"
        " on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "BSD": [
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following"
        " disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
        " products derived from this software without specific prior written permission.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License v2.0 or later.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General"
        " Public License as published by the Free Software Foundation.",
    ],
    "AGPL": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "You can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by"
        " the Free Software Foundation.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "ISC": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "Public-Domain": [
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this"
        " work under CC0 1.0 Universal.",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-ND": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ],
    "Proprietary": [
        "All rights reserved. No part of this publication may be reproduced without the prior written permission of the"
        " publisher.",
        "This software is proprietary and confidential. Unauthorized copying of this file is strictly prohibited.",
    ],
}
#: The marks that end a sentence, and the length of a wrapped line.
ENDS, WRAPPED = r"[.!?:;]\s*$", (50, 100)
FAMILIES = [UNKNOWN, *TEMPLATES]


def words(text: Column) -> Column:
    """Lower-case words; the marks that tell versions and variants apart stay inside words."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}.+-]+|[.]+(?=\P{N}|$)"), lambda w: w != "")


def ngrams(tokens: Column, n: int) -> Column:
    """The runs of n words, as text."""
    last = F.size(tokens) - (n - 1)
    runs = F.transform(F.sequence(F.lit(1), last), lambda k: F.array_join(F.slice(tokens, k, n), " "))
    return F.when(last >= 1, runs).otherwise(F.array().cast("array<string>"))


def features(tokens: Column) -> Column:
    return F.array_distinct(F.concat(ngrams(tokens, 1), ngrams(tokens, 2), ngrams(tokens, 3)))


def shingles(tokens: Column, n: int = 5) -> Column:
    """Distinct five-word shingles; a shorter text is one shingle."""
    return F.array_distinct(F.when(F.size(tokens) >= n, ngrams(tokens, n)).otherwise(F.array(F.array_join(tokens, " "))))


def literal_rows(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """Given rows as a DataFrame, from a literal."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def templates(spark: SparkSession) -> DataFrame:
    rows = [{"family": f, "template": k, "text": t} for f, own in TEMPLATES.items() for k, t in enumerate(own)]
    return literal_rows(spark, rows, "family:string,template:int,text:string").withColumn("tokens", words(F.col("text"))).drop("text")


def training_rows(documents: DataFrame, sample_docs: int, seed: int) -> DataFrame:
    """(label, tokens): every template, and runs of its words from each fourth of it on, and
    the lines of ``sample_docs`` documents, those of the smallest hashed ids, without a
    template's three-word run."""
    spark = documents.sparkSession
    own = templates(spark)
    size = F.size("tokens")
    cuts = F.array(*[F.struct(F.floor(size * F.lit(a / 8)).alias("at"), F.ceil(size * F.lit(n / 8)).alias("n"))
                     for a, n in ((0, 8), (0, 6), (2, 6), (1, 6), (0, 5), (3, 5), (0, 4), (2, 4), (4, 4))])
    runs = (own.select("family", "tokens", F.explode(cuts).alias("cut"))
            .select("family", F.slice("tokens", (F.col("cut.at") + 1).cast("int"), F.greatest(F.col("cut.n").cast("int"), F.lit(3))).alias("tokens")))
    # a run that two families share says nothing about either
    shared = runs.groupBy("tokens").agg(F.min("family").alias("family"), F.max("family").alias("other"))
    known = shared.select(F.when(F.col("family") == F.col("other"), F.col("family")).otherwise(UNKNOWN).alias("family"), "tokens")
    some = least_hashed(documents.select("doc_id", "text"), F.xxhash64("doc_id", F.lit(seed)), sample_docs, ["doc_id"])
    lines = some.select(F.explode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("line")).select(words(F.col("line")).alias("tokens"))
    grams = own.select(F.explode(ngrams(F.col("tokens"), 3)).alias("gram")).distinct()
    known_grams = F.array(*[F.lit(r.gram) for r in grams.collect()])  # the templates' runs
    plain = (lines.where(F.size("tokens") > 0).distinct()
             .where(~F.arrays_overlap(ngrams(F.col("tokens"), 3), known_grams)).select(F.lit(UNKNOWN).alias("family"), "tokens"))
    number = F.create_map(*[F.lit(x) for k, f in enumerate(FAMILIES) for x in (f, float(k))])
    return known.unionByName(plain).select(number[F.col("family")].alias("label"), "tokens")


def fit(documents: DataFrame, sample_docs: int = 300, vocabulary: int = 1 << 14, regularization: float = 1e-4,
        seed: int = 11) -> tuple[DataFrame, list[float], float, float]:
    """(weights, biases, temperature, threshold).  ``weights`` has a row (gram, w) for each
    n-gram of the templates that the regression uses; its size is bounded by ``vocabulary``."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizer

    spark = documents.sparkSession
    rows = keep(training_rows(documents, sample_docs, seed)
                .withColumn("grams", features(F.col("tokens"))), "licence-rows").withColumn("fold", F.pmod(F.xxhash64("tokens"), F.lit(5)))
    count = CountVectorizer(inputCol="grams", outputCol="features", vocabSize=vocabulary, binary=True, minDF=1.0)
    counted = count.fit(rows.where(F.col("label") > 0))
    train = counted.transform(rows.where((F.col("fold") != 0) | (F.col("label") > 0)))
    # the mean of the unknown rows' weights is that of one family, so rare families are learned
    share = {r.label: r["count"] for r in train.groupBy("label").count().collect()}
    weight = F.create_map(*[F.lit(x) for k, n in share.items() for x in (k, 1.0 / n)])
    model = LogisticRegression(family="multinomial", regParam=regularization, elasticNetParam=0.5, maxIter=60,
                               weightCol="weight", standardization=False).fit(train.withColumn("weight", weight[F.col("label")]))
    matrix, intercept = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    classes = matrix.shape[0]
    grams = [{"gram": g, "w": [*map(float, matrix[:, k]), *[0.0] * (len(FAMILIES) - classes)]}
             for k, g in enumerate(counted.vocabulary) if abs(matrix[:, k]).max() > 1e-9]
    weights = keep(literal_rows(spark, grams, "gram:string,w:array<double>"), "licence-weights")
    biases = [*map(float, intercept), *[-100.0] * (len(FAMILIES) - classes)]
    # calibration: the temperature of least loss, then the threshold that no held-out unknown row passes
    held = rows.where((F.col("fold") == 0) | (F.col("label") > 0)).withColumn("row", F.monotonically_increasing_id())
    logits = _logits(keep(held.select("row", "label", "grams"), "licence-held"), ["row", "label"], weights, biases)
    grid = [0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 4.0]
    losses = logits.agg(*[F.avg(-F.log(F.greatest(F.element_at(softmax(F.col("z"), t), (F.col("label") + 1).cast("int")), F.lit(1e-12))))
                          .alias(f"t{k}") for k, t in enumerate(grid)]).first()
    temperature = min(zip([x if x is not None else 0.0 for x in losses], grid))[1]
    top = logits.where("label = 0").agg(F.max(1 - softmax(F.col("z"), temperature)[0])).first()[0] or 0.0
    return weights, biases, temperature, min(0.9, max(0.5, float(top)))


def _logits(rows: DataFrame, keys: list[str], weights: DataFrame, biases: list[float]) -> DataFrame:
    """``keys`` and ``z``, the class scores of rows (keys, grams); keys are unique."""
    hit = rows.select(*keys, F.explode("grams").alias("gram")).join(weights, "gram")
    sums = hit.groupBy(*keys).agg(*[F.sum(F.col("w")[k]).alias(f"s{k}") for k in range(len(biases))])
    known = [c.eqNullSafe(d) for c, d in ((F.col(f"a.{k}"), F.col(f"b.{k}")) for k in keys)]
    both = known[0]
    for c in known[1:]:
        both &= c
    z = F.array(*[F.coalesce(F.col(f"b.s{k}"), F.lit(0.0)) + F.lit(b) for k, b in enumerate(biases)])
    return rows.alias("a").join(sums.alias("b"), both, "left").select(*[F.col(f"a.{k}") for k in keys], z.alias("z"))


def softmax(z: Column, temperature: float) -> Column:
    top = F.array_max(z)
    e = F.transform(z, lambda x: F.exp((x - top) / temperature))
    total = F.aggregate(e, F.lit(0.0), lambda a, x: a + x)
    return F.transform(e, lambda x: x / total)


def held(column: Column) -> Column:
    """The column through a generator, so that later steps do not compute it again."""
    return F.explode(F.array(column))


def paragraphs(documents: DataFrame) -> DataFrame:
    """(doc, doc_id, first, last, text): every line, and every run of wrapped lines joined."""
    lines = documents.where(F.col("text").isNotNull()).select(
        "doc_id", F.monotonically_increasing_id().alias("doc"), held(F.split("text", "\n", -1)).alias("lines"))
    places = F.sequence(F.lit(0), F.size("lines") - 1)

    def goes_on(k: Column) -> Column:
        line = F.rtrim(F.get("lines", k))
        return F.length(line).between(*WRAPPED) & ~line.rlike(ENDS) & F.coalesce(F.get("lines", k + 1).rlike(r"\S"), F.lit(False))

    marked = lines.select("*", held(F.transform(places, goes_on)).alias("on"))
    before = lambda k: (k > 0) & F.get("on", F.greatest(k - 1, F.lit(0)))
    runs = marked.select("*", held(F.arrays_zip(F.filter(places, lambda k: F.get("on", k) & ~before(k)).alias("a"),
                                                F.filter(places, lambda k: ~F.get("on", k) & before(k)).alias("b"))).alias("runs"))
    single = F.transform("lines", lambda x, k: F.struct(k.alias("first"), k.alias("last"), x.alias("text")))
    joined = F.transform("runs", lambda r: F.struct(r["a"].alias("first"), r["b"].alias("last"),
                                                    F.array_join(F.slice("lines", r["a"] + 1, r["b"] - r["a"] + 1), " ").alias("text")))
    return runs.select("doc", "doc_id", F.inline(F.concat(single, joined)))


class Bound:
    """What the scan knows of the weights before any join: their n-grams, and how much each
    can lift a family over the unknown class."""

    def __init__(self, model: tuple[DataFrame, list[float], float, float]) -> None:
        weights, biases, temperature, threshold = model
        rows = weights.collect()  # bounded by the vocabulary of ``fit``
        self.of_length: dict[int, list[str]] = {1: [], 2: [], 3: []}
        self.worth: dict[float, list[str]] = {}
        for r in rows:
            self.of_length[r.gram.count(" ") + 1].append(r.gram)
            most = max(w - r.w[0] for w in r.w[1:])
            if most > 0:  # rounded up, so that few values are told apart
                self.worth.setdefault(math.ceil(most * 4) / 4 if most > 0.25 else math.ceil(most * 32) / 32, []).append(r.gram)
        self.words = sorted({w for r in rows for w in r.gram.split(" ")})
        self.need = temperature * (math.log(threshold / (1 - threshold)) - math.log(len(biases) - 1)) - max(b - biases[0] for b in biases[1:])

    def known(self, tokens: Column) -> Column:
        """The distinct n-grams of ``tokens`` that have a weight.  A longer one is built only
        where each of its words is a word of some weighted n-gram."""
        def stands(n: int):
            return lambda k: F.get(tokens, k + (n - 1)).isin(self.words)

        def run(n: int):
            return lambda k: F.concat_ws(" ", *[F.get(tokens, k + j) for j in range(n)])

        def weighted(n: int):
            return lambda g: g.isin(self.of_length[n])

        places = F.sequence(F.lit(0), F.size(tokens) - 1)
        found = []
        for n in (1, 2, 3):
            places = F.filter(places, stands(n))
            found.append(F.filter(F.transform(places, run(n)), weighted(n)))
        return F.array_distinct(F.concat(*found))

    def can_be_told(self, grams: Column) -> Column:
        """False only for n-grams that no family's score over the unknown class's can lift to
        the threshold: each counts as the most it adds to any, rounded up."""
        if not self.worth or self.need <= 0:
            return F.lit(self.need <= 0)

        def worth(g: Column) -> Column:
            out = None
            for v, own in sorted(self.worth.items(), key=lambda x: -len(x[1])):
                out = (F if out is None else out).when(g.isin(own), F.lit(float(v)))
            return out.otherwise(F.lit(0.0))

        return F.aggregate(grams, F.lit(0.0), lambda a, g: a + worth(g)) >= self.need - 1e-6


def scan(documents: DataFrame, model: tuple[DataFrame, list[float], float, float], similarity: float = 0.8,
         bounded: bool = True) -> DataFrame:
    """Rows (doc_id, paragraph, family, probability, similarity, confirmed): every paragraph
    whose family the model tells from the unknown class, with the best share of five-word
    shingles it has in common with a template of that family.  ``bounded``: drop paragraphs
    that cannot reach the threshold before their n-grams meet the weights; the rows are the same."""
    weights, biases, temperature, threshold = model
    spark = documents.sparkSession
    bound = Bound(model)
    named = (paragraphs(documents).select("*", held(words(F.col("text"))).alias("tokens")).where(F.size("tokens") > 0)
             .select("*", held(bound.known(F.col("tokens"))).alias("grams")))
    named = named.where(bound.can_be_told(F.col("grams"))) if bounded else named
    rows = keep(named.select("doc", "doc_id", "first", "last", "tokens", "grams", F.monotonically_increasing_id().alias("row")), "licence-lines")
    z = _logits(rows.select("row", "grams"), ["row"], weights, biases)
    rows = rows.drop("grams")
    p = z.select("row", softmax(F.col("z"), temperature).alias("p"))
    best = F.array_position("p", F.array_max("p")).cast("int")
    told = (p.where(1 - F.col("p")[0] >= threshold).withColumn("p", F.concat(F.array(F.lit(-1.0)), F.slice("p", 2, len(FAMILIES))))
            .select("row", F.element_at(F.array(*map(F.lit, FAMILIES)), best).alias("family"), F.array_max("p").alias("probability")))
    found = keep(rows.join(told, "row"), "licence-told")
    line = found.where("first = last").select(F.col("doc").alias("d"), F.col("first").alias("n"))
    again = (F.col("first") < F.col("last")) & (F.col("doc") == F.col("d")) & F.col("n").between(F.col("first"), F.col("last"))
    found = keep(found.join(line, again, "left_anti").drop("doc", "last").withColumnRenamed("first", "paragraph"), "licence-found")
    own = templates(spark).select("family", "template", shingles(F.col("tokens")).alias("shingles"))
    own = own.select("family", "template", F.size("shingles").alias("of"), F.explode("shingles").alias("shingle"))
    mine = found.select("row", "family", shingles(F.col("tokens")).alias("s"))
    mine = mine.select("row", "family", F.size("s").alias("size"), F.explode("s").alias("shingle"))
    share = (mine.join(own, ["family", "shingle"]).groupBy("row", "template")
             .agg((F.count("*") / F.min(F.least("size", "of"))).alias("share")).groupBy("row").agg(F.max("share").alias("similarity")))
    near = F.coalesce("similarity", F.lit(0.0))
    return (found.join(share, "row", "left")
            .select("doc_id", "paragraph", "family", "probability", near.alias("similarity"), (near >= similarity).alias("confirmed")))
