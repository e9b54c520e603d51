"""Operator 5: licence scans with a trained paragraph classifier, in DataFrame and SQL functions only.

A paragraph is a line of a text with a word in it. Features are its words and word pairs, restricted to those
that some licence template has and ordinary paragraphs hardly ever. One pass over the texts notes which of the templates'
n-grams each paragraph has; all counts, the fit, the threshold and the scores are taken from these notes, of every paragraph
of the table. A multinomial logistic regression over the licence families and an unknown class is fitted by gradient
descent whose every step is two joins and two grouped sums; the training rows are the templates' lines and half of the
table's own paragraphs as unknown, those of equal features as one row with their number. The decision threshold is
calibrated on the other half: at most one in a thousand with any evidence may pass. A prediction is confirmed by
comparison with the family's template: enough of the paragraph's word pairs must stand there.

Scoring explodes the n-grams noted, joins the weights (broadcast: at most ``MAX_FEATURES`` rows) and sums per
paragraph; since only distinctive n-grams have weights, few rows reach the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import packed, stored

MAX_FEATURES, STEPS = 4096, 12
PASSING = 0.001  # share of held-out unknown paragraphs that may pass the threshold
GRID = 10_000  # probabilities are counted in steps of 1 / GRID for the threshold
ALIKE = 0.5  # share of a paragraph's n-grams that its family's template must have
COMMON = 0.002  # share of all paragraphs from which an n-gram is no evidence

# Templates: opening lines and usual notices of widely used licences.
TEMPLATES = {
    "apache-2.0": """Apache License Version 2.0, January 2004
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Licensed under the Apache License, Version 2.0.
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
SPDX-License-Identifier: Apache-2.0""",
    "mit": """The MIT License (MIT)
Released under the MIT License.
This project is licensed under the terms of the MIT License.
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY
SPDX-License-Identifier: MIT""",
    "bsd-3-clause": """BSD 3-Clause License
Licensed under the 3-Clause BSD License.
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software
SPDX-License-Identifier: BSD-3-Clause""",
    "gpl": """GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007
This work is licensed under the GNU General Public License, version 3.
This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/
SPDX-License-Identifier: GPL-3.0-or-later""",
    "mpl-2.0": """Mozilla Public License Version 2.0
This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.
If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/
SPDX-License-Identifier: MPL-2.0""",
    "cc-by": """Licensed under a Creative Commons Attribution 4.0 International License.
Licensed under CC BY 4.0.
This work is licensed under a Creative Commons Attribution 4.0 license (CC BY 4.0).
https://creativecommons.org/licenses/by/4.0/""",
    "cc-by-nc": """Licensed under CC BY-NC 4.0.
This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.
Attribution-NonCommercial: you may not use the material for commercial purposes.
https://creativecommons.org/licenses/by-nc/4.0/""",
    "public-domain": """This is free and unencumbered software released into the public domain.
This work is dedicated to the public domain under CC0 1.0 Universal.
To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.""",
    "all-rights-reserved": """All rights reserved.
Copyright (c) 2020 The Authors. All rights reserved.
No part of this publication may be reproduced without prior written permission of the publisher.""",
}
FAMILIES = sorted(TEMPLATES)
UNKNOWN = len(FAMILIES)


def word_list(text: Column) -> Column:
    """Lower-cased words: runs of letters, digits, and dots or hyphens inside them."""
    clean = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}.\-]+|[.\-]+(?=\s|$)", " ")
    return F.filter(F.split(clean, " "), lambda w: w != "")


def n_grams(words: str) -> Column:
    """Words and word pairs of an array column."""
    return F.expr(f"concat({words}, if(size({words}) > 1, zip_with(slice({words}, 1, size({words}) - 1), slice({words}, 2, size({words}) - 1), (a, b) -> concat(a, ' ', b)), array()))")


def paragraphs(texts: DataFrame, text_col: str, *keep: str) -> DataFrame:
    """(keep..., para, line): the non-empty lines of texts, numbered from 0."""
    lines = texts.select(*keep, F.posexplode(F.split(F.col(text_col), "\\n")).alias("para", "line"))
    return lines.where(F.col("line").rlike(r"[\p{L}\p{N}]"))


def template_lines(spark: SparkSession) -> DataFrame:
    rows = [(y, line) for y, name in enumerate(FAMILIES) for line in TEMPLATES[name].split("\n")]
    return spark.createDataFrame(rows, "y int, line string")


def _softmax(z: DataFrame, bias: list[float]) -> DataFrame:
    """``z`` with class scores w0, w1, ... replaced by probabilities p0, p1, ..., step by step so that no
    expression is repeated."""
    n = range(len(bias))
    rest = [c for c in z.columns if c not in {f"w{k}" for k in n}]
    z = z.select(*rest, *[(F.col(f"w{k}") + bias[k]).alias(f"s{k}") for k in n])
    z = z.withColumn("top", F.greatest(*[f"s{k}" for k in n]))
    z = z.select(*rest, *[F.exp(F.col(f"s{k}") - F.col("top")).alias(f"e{k}") for k in n])
    z = z.withColumn("total", sum((F.col(f"e{k}") for k in n), F.lit(0.0)))
    return z.select(*rest, *[(F.col(f"e{k}") / F.col("total")).alias(f"p{k}") for k in n])


def _grams(lines: DataFrame, *keep: str) -> DataFrame:
    """(keep..., f): the distinct n-grams of each line."""
    return lines.withColumn("w", word_list(F.col("line"))).select(*keep, F.explode(F.array_distinct(n_grams("w"))).alias("f"))


def _known(spark: SparkSession) -> list[list[str]]:
    """The n-grams of each family's template, in order of ``FAMILIES``."""
    rows = _grams(template_lines(spark), "y").groupBy("y").agg(F.sort_array(F.collect_set("f")).alias("f")).orderBy("y")
    return [r.f for r in rows.collect()]  # templates only


def evidence(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rid, para, total, hits, alike), once for each paragraph of distinct (id, text): how many n-grams it has, those
    that some template has too, and whether one family's template has ``ALIKE`` of them."""
    known = _known(docs.sparkSession)
    names = sorted({f for family in known for f in family})
    src = docs.select(F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("rid"), F.col(f"`{text_col}`").alias("text"))
    own = paragraphs(src, "text", "rid").withColumn("w", word_list(F.col("line"))).select("rid", "para", F.array_distinct(n_grams("w")).alias("own"))
    notes = own.select("rid", "para", F.size("own").alias("total"), F.filter("own", lambda g: g.isin(names)).alias("hits"))
    least = ALIKE * F.col("total")
    some = F.exists(F.lit(known), lambda family: F.size(F.array_intersect("hits", family)) >= least)
    notes = notes.withColumn("alike", F.when(F.size("hits") >= least, some).otherwise(F.lit(False)))
    return stored(notes.dropDuplicates(["rid", "para"]), "evidence")


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, list[float], float]:
    """(weights (f, w0, w1, ...), bias per class, calibrated threshold). Nulls take no part, repeated rows count once."""
    return fit(evidence(docs, id_col, text_col))


def fit(notes: DataFrame) -> tuple[DataFrame, list[float], float]:
    """``train`` from the ``evidence`` of all paragraphs."""
    spark = notes.sparkSession
    known = template_lines(spark).withColumn("r", F.xxhash64("y", "line")).distinct()
    # a paragraph that is mostly made of some template's n-grams is no example of the unknown
    unknown = notes.where("not alike").withColumn("half", F.pmod(F.xxhash64("rid", "para"), F.lit(2)))
    common = unknown.select(F.explode("hits").alias("f")).groupBy("f").agg(F.count("*").alias("n"))
    common = common.where(F.col("n") > max(3.0, COMMON * notes.count()))
    vocab = stored(_grams(known, "y").groupBy("f").agg(F.countDistinct("y").alias("n")).join(common, "f", "left_anti").orderBy("n", "f").limit(MAX_FEATURES).select("f"), "vocabulary")
    names = [r.f for r in vocab.collect()]  # at most MAX_FEATURES
    # paragraphs of equal features are one row with their number; those without any have no gradient
    alone = unknown.where("half = 0").select(F.array_sort(F.filter("hits", lambda g: g.isin(names))).alias("own")).where("size(own) > 0")
    alone = alone.groupBy("own").agg(F.count("*").alias("n")).select(F.xxhash64(F.lit(UNKNOWN), "own").alias("r"), F.lit(UNKNOWN).alias("y"), "n", F.explode("own").alias("f"))
    x = stored(_grams(known, "r", "y").join(F.broadcast(vocab), "f").select("r", "y", F.lit(1).cast("long").alias("n"), "f").unionByName(alone), "features")
    n_classes = UNKNOWN + 1
    n_unknown = unknown.where("half = 0").count()
    n_rows = n_unknown + known.count()
    bias = [0.0] * UNKNOWN + [2.0]  # a paragraph without evidence is unknown; the rest is learnt
    ws, rs = [f"w{c}" for c in range(n_classes)], [f"r{c}" for c in range(n_classes)]
    weights = vocab.select("f", *[F.lit(0.0).alias(w) for w in ws], F.lit(1e-3).alias("g2"))
    for _ in range(STEPS):
        z = x.join(F.broadcast(weights), "f").groupBy("r", "y", "n").agg(*[F.sum(w).alias(w) for w in ws])
        weight = F.col("n") * F.when(F.col("y") == UNKNOWN, n_rows / (2.0 * max(1, n_unknown))).otherwise(n_rows / (2.0 * UNKNOWN * 5))
        resid = _softmax(z, bias).select("r", *[(weight * (F.col(f"p{c}") - (F.col("y") == c).cast("double"))).alias(rs[c]) for c in range(n_classes)])
        grad = x.select("r", "f").join(resid, "r").groupBy("f").agg(*[(F.sum(r) / n_rows).alias(r) for r in rs])
        step = weights.join(grad, "f", "left").fillna(0.0, rs)
        squared = sum((F.col(r) * F.col(r) for r in rs), F.lit(0.0))
        step = step.withColumn("g2", F.col("g2") * 0.9 + squared)
        moved = [(F.col(w) * 0.999 - 0.5 * F.col(r) / F.sqrt(F.col("g2") + 1e-8)).alias(w) for w, r in zip(ws, rs)]
        weights = stored(step.select("f", *moved, "g2"), "weights")
    weights = weights.select("f", *ws)
    held = _scored(unknown.where("half = 1").select("rid", "para", F.explode("hits").alias("f")), weights, bias, "rid", "para")
    counts = held.groupBy(F.ceil(F.col("prob") * GRID).alias("step")).agg(F.count("*").alias("n"))  # at most GRID + 1 rows
    top = counts.agg(F.expr(f"percentile(step, {1 - PASSING}, n)")).first()[0]
    return weights, bias, max(0.5, min(0.99, float(top or 0.0) / GRID))


def _scored(grams: DataFrame, weights: DataFrame, bias: list[float], *key: str, least: float = 0.0) -> DataFrame:
    """(key..., c, prob): the likeliest licence family of each paragraph with evidence, if its probability is
    ``least`` or more. The condition stands inside an array: as a filter it would be pushed below the sums
    and every probability written out in full there."""
    ws = [f"w{c}" for c in range(len(bias))]
    z = grams.join(F.broadcast(weights), "f").groupBy(*key).agg(*[F.sum(w).alias(w) for w in ws])
    best = F.greatest(*[F.struct(F.col(f"p{c}").alias("prob"), F.lit(-c).alias("c")) for c in range(UNKNOWN)])
    scored = _softmax(z, bias).withColumn("best", best).withColumn("likely", F.filter(F.array("best"), lambda x: x["prob"] >= least))
    return scored.select(*key, F.explode("likely").alias("x")).select(*key, (-F.col("x.c")).alias("c"), "x.prob")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, licences): see ``packed`` for ``row``; ``licences`` is an array of (para, family, prob, alike) in order
    of paragraphs, empty where none is found. ``para`` counts the lines of the text from 0.

    A null or empty text has no paragraphs; repeated rows are scanned alike; equally likely families: the
    first by name. An empty table gives an empty result.
    """
    notes = evidence(docs, id_col, text_col)  # repeated rows share their rid and are noted once
    weights, bias, threshold = fit(notes)
    src = packed(docs, text_col).withColumn("rid", F.xxhash64(F.col(f"row.`{id_col}`"), "text"))
    likely = _scored(notes.select("rid", "para", F.explode("hits").alias("f")), weights, bias, "rid", "para", least=threshold)
    # confirmation: compare the n-grams of the paragraphs found with the family's template
    spark = docs.sparkSession
    named = spark.createDataFrame([(c, FAMILIES[c], known) for c, known in enumerate(_known(spark))], "c int, family string, known array<string>")
    found = notes.join(likely, ["rid", "para"]).join(F.broadcast(named), "c")
    found = found.withColumn("alike", F.size(F.array_intersect("hits", "known")) / F.col("total")).where(F.col("alike") >= ALIKE)
    lists = found.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("para", "family", "prob", "alike"))).alias("licences"))
    kind = lists.schema["licences"].dataType
    return src.select("row", "rid").join(lists, "rid", "left").select("row", F.coalesce("licences", F.array().cast(kind)).alias("licences"))
