"""Licence families of paragraphs: n-gram logistic regression, calibrated, confirmed by template comparison.

Model: multinomial logistic regression over the word unigrams and bigrams of a paragraph that hold a licence word (``LEXICON``), fitted here
on the labelled table ``LABELLED`` with an L2 penalty. ``unknown`` is one of its classes, with ordinary sentences that use licence words as
its examples. The temperature of the softmax is the one of smallest log loss when each paragraph is left out in turn. A paragraph is given a
family if that has a calibrated probability of ``PROBABILITY`` or more and the paragraph holds at least ``CONTAINED`` of the word pairs of one
of the family's templates; else it is unknown. A notice may be wrapped: a line with a licence word that is unknown by itself is judged once
more with the lines around it, up to an empty one and as far as the longest template could reach, and the notice counts at its first such line.

Scoring is column expressions inside one scan: the weights are literals whose size is that of the labelled table, and paragraphs
without a licence word, which have no feature at all, are passed over by one pattern. No shuffle, no Python on the executors.

Defined results: paragraphs are lines, numbered from 0; a null text counts as empty and has none; null ids and repeated rows are carried;
only the key and ``text`` are read, so other columns may have any name; texts and lines of any length are scored whole; of families of equal
probability the first in the order of the templates counts; an empty table gives an empty one.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.llm.tables import text_of

WORD = r"[a-z0-9][a-z0-9.+-]*[a-z0-9+]|[a-z0-9]"
PROBABILITY = 0.5
CONTAINED = 0.6
PENALTY = 0.02

LEXICON = (
    "license licensed licenses licence licenced licences apache mit gnu gpl lgpl agpl gplv2 gplv3 general lesser public bsd mozilla mpl cc by-nc by-sa by-nd "
    "creative commons attribution noncommercial sharealike noderivatives copyright rights reserved permission permitted warranty domain unlicense cc0 "
    "redistribution redistributions sublicense clause proprietary isc spdx-license-identifier apache-2.0 gpl-3.0-or-later lgpl-2.1-only bsd-3-clause mpl-2.0"
).split()

#: Templates and further labelled paragraphs, by family.
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "Licensed under the GPL version 2.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "Licensed under the LGPL.",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Released under the BSD 3-Clause License.",
        "Licensed under the BSD license.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "public-domain": (
        "This is free and unencumbered software released into the public domain.",
        "This work is dedicated to the public domain under CC0 1.0.",
        "Released into the public domain.",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright 2020 Example Corporation. All rights reserved.",
        "This document is proprietary and may not be copied without permission.",
    ),
}
UNKNOWN = (
    "The driver needs a valid license to drive in this country.",
    "The general public was invited to the opening of the museum.",
    "A public hearing about the new road is planned for May.",
    "He is the sole owner of the domain and renews it each year.",
    "She got permission from her teacher to leave early.",
    "The warranty covers repairs for two years.",
    "The Apache helicopter landed near the village.",
    "Apache tribes lived in the south west.",
    "Students at MIT built a small robot.",
    "Human rights groups protested in the capital.",
    "A table was reserved for eight guests.",
    "The creative team met in the commons room.",
    "Attribution of the painting to the master is disputed.",
    "The general public license fee for television was raised.",
    "Fishing licenses are sold at the town hall.",
    "The second clause of the contract was removed.",
    "Copyright law differs between countries.",
    "Authors hold the copyright in their works.",
    "The redistribution of income was debated in parliament.",
    "Version 2.0 of the game was released in May.",
    "The mit of the baseball player was old.",
    "The lesser evil was chosen by the general.",
    "He used poetic license in his public speech.",
    "You must be licensed to practise medicine here.",
)
FAMILIES = ("unknown", *TEMPLATES)
LABELLED = [(0, t) for t in UNKNOWN] + [(k, t) for k, family in enumerate(FAMILIES) if family in TEMPLATES for t in TEMPLATES[family]]


def words_of(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


def features_of(text: str) -> set[str]:
    words, lexicon = words_of(text), set(LEXICON)
    pairs = {f"{a} {b}" for a, b in zip(words, words[1:]) if a in lexicon or b in lexicon}
    return pairs | {w for w in words if w in lexicon}


def _fit(matrix: np.ndarray, labels: np.ndarray, steps: int = 400) -> np.ndarray:
    """Weights (features and bias by class) by gradient descent with momentum."""
    weights = np.zeros((matrix.shape[1], len(FAMILIES)))
    speed, target = np.zeros_like(weights), np.eye(len(FAMILIES))[labels]
    for _ in range(steps):
        gradient = matrix.T @ (_softmax(matrix @ weights) - target) / len(labels) + PENALTY / 10 * weights
        speed = 0.9 * speed - 0.8 * gradient
        weights += speed
    return weights


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@lru_cache(maxsize=1)
def model() -> tuple[dict[str, list[float]], list[float]]:
    """Weights by feature and the biases, both over the temperature."""
    names = sorted(set().union(*(features_of(t) for _, t in LABELLED)))
    matrix = np.array([[float(n in f) for n in names] + [1.0] for f in (features_of(t) for _, t in LABELLED)])
    labels = np.array([k for k, _ in LABELLED])
    held = np.stack([matrix[i] @ _fit(np.delete(matrix, i, 0), np.delete(labels, i), 60) for i in range(len(labels))])
    loss = {t: -np.log(_softmax(held / t)[np.arange(len(labels)), labels] + 1e-12).mean() for t in (0.5, 0.7, 1.0, 1.4, 2.0)}
    weights = _fit(matrix, labels) / min(loss, key=loss.get)
    return {n: w.tolist() for n, w in zip(names, weights)}, weights[-1].tolist()


def _array(values: list, kind: str) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")


def _pairs(words: Column) -> Column:
    return F.array_distinct(F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.size(words)), lambda a, b: F.concat_ws(" ", a, b)))


def _reach(lines: Column, longest: int, joined) -> Column:
    """Of lines' words in their order away from a line: ``words`` up to an empty line or until they are ``longest``, and the number ``n`` of lines."""

    def step(a: Column, w: Column) -> Column:
        taken = a["open"] & (F.size(w) > 0) & (F.size(a["words"]) < longest)
        return F.struct(F.when(taken, joined(a["words"], w)).otherwise(a["words"]).alias("words"), F.when(taken, a["n"] + 1).otherwise(a["n"]).alias("n"), taken.alias("open"))

    return F.aggregate(lines, F.struct(F.array().cast("array<string>").alias("words"), F.lit(0).alias("n"), F.lit(True).alias("open")), step)


def scan(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: key, ``n_candidates`` (paragraphs with a licence word) and ``licenses``: (paragraph, family, probability, contained)."""
    weights, bias = model()
    by_feature = F.map_from_arrays(_array(list(weights), "string"), F.array(*[_array(w, "double") for w in weights.values()]))
    lexicon = "(?i)(?<![a-z0-9])(?:" + "|".join(re.escape(w) for w in sorted(LEXICON, key=len, reverse=True)) + ")(?![a-z0-9])"
    pairs_of = {f: [sorted({f"{a} {b}" for a, b in zip(words_of(t), words_of(t)[1:])}) for t in TEMPLATES[f]] for f in TEMPLATES}

    longest = max(len(words_of(t)) for f in TEMPLATES for t in TEMPLATES[f])
    flat = F.array(*[_array(t, "string") for f in TEMPLATES for t in pairs_of[f]])
    known = _array(sorted({p for f in TEMPLATES for t in pairs_of[f] for p in t}), "string")

    some = text_of().rlike(lexicon)
    found = docs.select(
        F.col(key).alias("key"),
        F.when(some, F.transform(F.split(text_of(), "\n", -1), lambda line, i: F.when(line.rlike(lexicon), i))).alias("numbers"),
        F.when(some, F.transform(F.split(text_of(), "\n", -1), lambda line: F.regexp_extract_all(F.lower(line), F.lit(f"({WORD})"), F.lit(1)))).alias("tokens"),
    )
    found = found.select("key", F.filter("numbers", lambda i: i.isNotNull()).alias("numbers"), "tokens")
    # Windows are formed only where all the lines together hold enough of a template.
    found = found.withColumn("held", F.array_intersect(known, _pairs(F.flatten("tokens"))))
    wrapped = (F.size("held") > 0) & F.exists(flat, lambda t: F.size(F.array_intersect(t, F.col("held"))) >= CONTAINED * F.size(t))

    def line_of(i: Column) -> Column:
        return F.struct(i.alias("paragraph"), i.alias("lo"), i.alias("hi"), F.element_at("tokens", i + 1).alias("words"))

    def window_of(i: Column) -> Column:
        before = _reach(F.reverse(F.slice("tokens", F.greatest(i - longest + 1, F.lit(1)), F.least(i, F.lit(longest)))), longest, lambda a, w: F.concat(w, a))
        after = _reach(F.slice("tokens", i + 2, longest), longest, F.concat)
        return F.struct(i.alias("paragraph"), before.alias("before"), after.alias("after"))

    def joined(x: Column) -> Column:
        i = x["paragraph"]
        words = F.concat(x["before"]["words"], F.element_at("tokens", i + 1), x["after"]["words"])
        return F.struct(i.alias("paragraph"), (i - x["before"]["n"]).alias("lo"), (i + x["after"]["n"]).alias("hi"), words.alias("words"))

    windows = F.filter(F.transform(F.transform("numbers", window_of), joined), lambda x: x["lo"] < x["hi"])
    units = F.concat(F.transform("numbers", line_of), F.coalesce(F.when(wrapped, windows), F.slice(F.transform("numbers", line_of), 1, 0)))
    place = ("paragraph", "lo", "hi")
    pairs = F.transform("lines", lambda x: F.struct(*[x[c].alias(c) for c in place], x["words"].alias("words"), _pairs(x["words"]).alias("pairs")))
    scores = F.transform(
        "lines",
        lambda x: F.struct(
            *[x[c].alias(c) for c in place],
            x["pairs"].alias("pairs"),
            F.aggregate(
                F.filter(F.concat(F.array_distinct(x["words"]), x["pairs"]), lambda g: F.array_contains(F.map_keys("weights"), g)),
                F.col("bias"),
                lambda s, g: F.zip_with(s, F.element_at("weights", g), lambda a, b: a + b),
            ).alias("scores"),
        ),
    )

    def judged(x: Column) -> Column:
        best = F.array_max(x["scores"])
        number = F.array_position(x["scores"], best).cast("int")
        total = F.aggregate(x["scores"], F.lit(0.0), lambda s, v: s + F.exp(v - best))
        share = F.array_max(
            F.transform(F.element_at("templates", number), lambda t: F.size(F.array_intersect(t, x["pairs"])) / F.size(t))
        )
        return F.struct(*[x[c].alias(c) for c in place], F.element_at("families", number).alias("family"), (1 / total).alias("probability"), F.coalesce(share, F.lit(0.0)).alias("contained"))

    templates = F.array(F.array().cast("array<array<string>>"), *[F.array(*[_array(t, "string") for t in pairs_of[f]]) for f in TEMPLATES])
    named = found.select("key", F.size(F.coalesce("numbers", F.array())).cast("long").alias("n_candidates"), units.alias("lines"))
    literals = [by_feature.alias("weights"), _array(bias, "double").alias("bias"), templates.alias("templates"), _array(list(FAMILIES), "string").alias("families")]
    steps = named.withColumn("lines", pairs).select("*", *literals).withColumn("lines", scores)
    steps = steps.select("key", "n_candidates", F.transform("lines", judged).alias("lines"))
    kept = F.filter("lines", lambda x: (x["family"] != "unknown") & (x["probability"] >= PROBABILITY) & (x["contained"] >= CONTAINED))
    steps = steps.select("key", "n_candidates", kept.alias("lines"))

    def reported(x: Column) -> Column:
        """A line by itself, or a window that holds none of its family and no earlier window's line."""
        alone = lambda y: (y["lo"] == y["hi"]) & y["paragraph"].between(x["lo"], x["hi"])
        earlier = lambda y: (y["paragraph"] < x["paragraph"]) & (y["hi"] >= x["paragraph"])
        return (x["lo"] == x["hi"]) | ~F.exists("lines", lambda y: (y["family"] == x["family"]) & (alone(y) | earlier(y)))

    names = ("paragraph", "family", "probability", "contained")
    licenses = F.array_sort(F.transform(F.filter("lines", reported), lambda x: F.struct(*[x[c].alias(c) for c in names])))
    kind = "array<struct<paragraph:int,family:string,probability:double,contained:double>>"
    return steps.select(F.col("key").alias(key), "n_candidates", F.coalesce(licenses, F.array().cast(kind)).alias("licenses"))
