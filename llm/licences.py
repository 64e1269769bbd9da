"""Licence scan: a trained paragraph classifier with an unknown class, confirmed by templates.

A paragraph is a line, and also a sentence wrapped over lines: neighbouring lines of which the words around the break stand next to each
other in a template, with one of them changed, added or left out at most (`CHAIN`). A blank line ends it. Its features are the word pairs it shares with the vocabulary of the templates, each once. A multinomial
logistic regression over them is fitted here, on the templates and variations of them: each with single words left out, cut short,
or with other openings, against sentences about rights that name no licence. Every third variation is left out of the fit; the
probability that a family needs is the one at which those unknown sentences, and the same share of families, stay right (`calibrated`).
A prediction also has to share enough of its pairs with a template of the family, else it is unknown.

The data meets the model in SQL functions only: paragraphs with a trigger become word pairs, these are joined with the
table of weights and summed per paragraph. Triggers allow for any signs or breaks between their words, as the words of the classifier do.
Paragraphs without one have no licence by definition and never leave the scan. A line
that thousands of documents share is summed within each of them; no key gathers them.
A line has its own family if that is sure, else that of the wrapped sentence it is part of, else it is unknown.

Defined results: null and empty texts give no row, nor do lines without a trigger that are not part of a sure wrapped sentence. Null ids and repeated rows give the rows of
their texts. Extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sentences by which public licences are granted or recognised.
TEMPLATES = {
    "apache": (
        "Licensed under the Apache License, Version 2.0",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
        "Apache License 2.0", "Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
        "MIT License",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "GPLv3", "GPLv2", "GPL-3.0", "GPL-2.0", "GNU GPL", "GNU GPLv3", "GNU GPL version 2",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 3",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-3.0-only",
        "LGPLv3", "LGPL-3.0", "LGPL-2.1", "GNU LGPL", "GNU LGPLv3",
    ),
    "agpl": (
        "This program is licensed under the GNU Affero General Public License, version 3",
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "AGPLv3", "AGPL-3.0", "GNU AGPL", "GNU AGPLv3",
    ),
    "bsd": (
        "Licensed under the BSD 3-Clause License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
        "BSD 3-Clause", "BSD-2-Clause", "BSD License",
    ),
    "mozilla": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "SPDX-License-Identifier: MPL-2.0",
        "MPL-2.0", "Mozilla Public License 2.0",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0",
        "CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0",
        "CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0",
        "CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    "cc0": (
        "CC0 1.0 Universal Public Domain Dedication",
        "dedicated to the public domain under CC0",
    ),
}
UNKNOWN = "unknown"
OTHERS = (
    "All rights reserved", "Licensed under the terms of the agreement", "See the license for details", "This work is licensed",
    "Copyright of this work belongs to its author", "a driving license is required", "The license was released in version 2",
    "Permission is granted by the owner of this work", "Released under a new name", "published by the foundation",
    "under the terms of the contract", "public transport is free of charge", "The public domain was renamed",
    "a copy of the license may be obtained at the office", "Licensed to sell in source and other forms",
    "This work is under review", "software and documentation files were lost", "the general public was admitted",
)
OPENINGS = ("", "Released under the", "Distributed under the", "Available under the", "Published under the terms of the", "This text is licensed under the")
APART = "[^A-Za-z0-9]+"
TRIGGERS = "(?i)licen[sc]e|copyright|apache|redistribut|spdx|cc0|(?<![a-z])gnu(?![a-z])|(?<![a-z])[al]?gpl(?![a-uw-z])|(?<![a-z])(?:mpl|bsd)(?![a-z])|" + "|".join(
    t.replace(" ", APART) for t in ("mozilla public", "creative commons", "cc by", "public domain", "free of charge", "rights reserved")
)


#: 'gplv3' is two words.
VERSIONS = ("gplv(?=[0-9])", "gpl v")


def words_of(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", re.sub(*VERSIONS, text.lower()))


def pairs_of(words: list[str]) -> set[str]:
    return {f"{a} {b}" for a, b in zip(words, words[1:])}


def variations(text: str) -> list[list[str]]:
    words = words_of(text)
    name = words[words.index("the") + 1 :] if "the" in words[:6] else words
    out = [words, *(words[:i] + words[i + 1 :] for i in range(len(words)) if len(words) > 3)]
    out += [words[: n] for n in range(max(4, len(words) * 2 // 3), len(words))]
    return out + [words_of(o) + name for o in OPENINGS if name != words or len(words) <= 3]


#: Pairs of words of a template that are next to each other or have one word between them.
CHAIN = sorted({f"{a} {b}" for ts in TEMPLATES.values() for t in ts for w in [words_of(t)] for k in (1, 2) for a, b in zip(w, w[k:])})


@dataclass(frozen=True)
class Classifier:
    families: tuple[str, ...]
    vocabulary: tuple[str, ...]
    weights: np.ndarray  # vocabulary and bias x families with the unknown one last
    least: float

    def matrix(self, texts: list[list[str]]) -> np.ndarray:
        place = {g: i for i, g in enumerate(self.vocabulary)}
        x = np.zeros((len(texts), len(place) + 1))
        x[:, -1] = 1
        for row, words in zip(x, texts):
            row[[place[g] for g in pairs_of(words) if g in place]] = 1
        return x

    def probabilities(self, texts: list[list[str]]) -> np.ndarray:
        return softmax(self.matrix(texts) @ self.weights)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


@cache
def classifier(steps: int = 400, rate: float = 2.0, penalty: float = 1e-4) -> Classifier:
    families = tuple(TEMPLATES)
    texts, labels = [], []
    for f, family in enumerate(families):
        for template in TEMPLATES[family]:
            made = variations(template)
            texts += made
            labels += [f] * len(made)
    for other in OTHERS:
        made = [words_of(other), *(words_of(other)[:i] + words_of(other)[i + 1 :] for i in range(len(words_of(other))))]
        texts += made
        labels += [len(families)] * len(made)
    vocabulary = tuple(sorted(set().union(*(pairs_of(words_of(t)) for ts in TEMPLATES.values() for t in ts))))
    model = Classifier(families, vocabulary, np.zeros((len(vocabulary) + 1, len(families) + 1)), 0.0)
    x, y = model.matrix(texts), np.eye(len(families) + 1)[labels]
    late = np.arange(len(texts)) % 3 == 2
    weights = model.weights.copy()
    for _ in range(steps):
        p = softmax(x[~late] @ weights)
        weights -= rate * (x[~late].T @ (p - y[~late]) / (~late).sum() * len(families) + penalty * weights)
    held = softmax(x[late] @ weights)
    unknown = y[late][:, -1] == 1
    top = held[:, :-1].max(1)
    # No unknown sentence of the held-out third may pass, nor a family below half.
    least = float(max(0.5, np.nextafter(top[unknown].max(), 2)))
    return Classifier(families, vocabulary, weights, least)


def weights_table(spark, model: Classifier) -> DataFrame:
    """(pair, weights) of the vocabulary, and per pair the templates that hold it."""
    held = [pairs_of(words_of(t)) for ts in TEMPLATES.values() for t in ts]
    rows = [
        (g, [float(w) for w in model.weights[i]], [float(g in h) / len(h) for h in held])
        for i, g in enumerate(model.vocabulary)
    ]
    return spark.createDataFrame(rows, "pair string, weights array<double>, shares array<double>")


def wrapped(above, below):
    """Whether the break between two lines, given as their words, is within a sentence of a template."""
    last = F.size(above) - 1
    around = ((F.get(above, last), F.get(below, F.lit(0))), (F.get(above, last - 1), F.get(below, F.lit(0))), (F.get(above, last), F.get(below, F.lit(1))))
    either = [F.concat_ws(" ", x, y).isin(CHAIN) for x, y in around]
    return either[0] | either[1] | either[2]


def paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, row, first, last, words): lines with a trigger, and wrapped sentences with one, of (doc_id, text)."""
    text = F.col("text").cast("string")
    lines = docs.filter(text.rlike(TRIGGERS)).select("doc_id", F.monotonically_increasing_id().alias("row"), F.split(text, "\n").alias("bodies"))
    words = lines.select("doc_id", "row", "bodies", F.transform(
        "bodies", lambda x: F.regexp_extract_all(F.regexp_replace(F.lower(x), *VERSIONS), F.lit("[a-z0-9]+"), F.lit(0))
    ).alias("words"))
    # Line i, from 1, goes on in the next.
    broken = words.select("*", F.filter(
        F.sequence(F.lit(1), F.size("words")), lambda i: (i < F.size("words")) & wrapped(F.get("words", i - 1), F.get("words", i))
    ).alias("breaks"))
    spans = broken.select(
        "*", F.filter("breaks", lambda i: ~F.array_contains("breaks", i - 1)).alias("starts"),
        F.filter("breaks", lambda i: ~F.array_contains("breaks", i + 1)).alias("stops"),
    )
    single = F.filter(
        F.transform("bodies", lambda x, i: F.when(x.rlike(TRIGGERS), F.struct(i.alias("first"), i.alias("last"), F.get("words", i).alias("words")))),
        lambda p: p.isNotNull(),
    )
    joined = F.transform(F.arrays_zip("starts", "stops"), lambda z: F.struct(
        (z["starts"] - 1).alias("first"), z["stops"].alias("last"),
        F.flatten(F.slice("words", z["starts"], z["stops"] - z["starts"] + 2)).alias("words"),
    ))
    joined = F.filter(joined, lambda p: F.array_join(p["words"], " ").rlike(TRIGGERS))
    return spans.select("doc_id", "row", F.explode(F.concat(single, joined)).alias("p")).select("doc_id", "row", "p.*")


def licence_lines(docs: DataFrame, least_share: float = 0.5) -> DataFrame:
    """(doc_id, line, family, probability, template_share) of lines of (doc_id, text) with a trigger or in a sure wrapped sentence."""
    spark, model = docs.sparkSession, classifier()
    paired = paragraphs(docs).select(
        "doc_id", "row", "first", "last",
        F.array_distinct(F.zip_with("words", F.expr("slice(words, 2, greatest(size(words) - 1, 0))"), lambda a, b: F.concat_ws(" ", a, b))).alias("pairs"),
    )
    n, templates = len(model.families) + 1, [f for f, ts in TEMPLATES.items() for _ in ts]
    exploded = paired.select("doc_id", "row", "first", "last", F.explode_outer("pairs").alias("pair"))
    summed = (
        exploded.join(weights_table(spark, model), "pair", "left").groupBy("row", "first", "last", "doc_id")
        .agg(
            F.array(*(F.coalesce(F.sum(F.col("weights")[i]), F.lit(0.0)) + float(model.weights[-1, i]) for i in range(n))).alias("margins"),
            F.array(*(F.coalesce(F.sum(F.col("shares")[i]), F.lit(0.0)) for i in range(len(templates)))).alias("shares"),
        )
    )
    known = F.slice("margins", 1, n - 1)
    exps = F.aggregate("margins", F.lit(0.0), lambda a, m: a + F.exp(m - F.array_max("margins")))
    best = F.array_position(known, F.array_max(known)).cast("int")
    probability = F.exp(F.array_max(known) - F.array_max("margins")) / exps
    share = F.array_max(F.transform("shares", lambda s, i: F.when(F.element_at(F.array(*(F.lit(model.families.index(t)) for t in templates)), i + 1) == best - 1, s).otherwise(0.0)))
    scored = summed.select("row", "doc_id", "first", "last", best.alias("best"), probability.alias("probability"), share.alias("template_share"))
    sure = (F.col("probability") >= model.least) & (F.col("template_share") >= least_share)
    found = scored.select(
        "row", "doc_id", F.explode(F.sequence("first", "last")).alias("line"), (F.col("first") == F.col("last")).alias("single"), sure.alias("sure"),
        F.when(sure, F.element_at(F.array(*map(F.lit, model.families)), F.col("best"))).otherwise(UNKNOWN).alias("family"),
        F.round("probability", 9).alias("probability"), F.round("template_share", 9).alias("template_share"),
    ).filter("single OR sure")
    picked = found.groupBy("row", "line", "doc_id").agg(F.max(F.struct("sure", "single", "family", "probability", "template_share")).alias("p"))
    return picked.select("doc_id", F.col("line").cast("long").alias("line"), "p.family", "p.probability", "p.template_share")
