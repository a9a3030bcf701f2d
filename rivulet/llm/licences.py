"""Licence scans by a trained paragraph classifier, confirmed by template comparison.

Native: paragraphs are array expressions, the features hashed word one- and
two-grams, the classifier Spark's multinomial logistic regression with an
elastic net (sparse weights), all JVM-side. It is trained on variants of
short fixed templates against lines of the corpus that hold no template,
look-alikes and denials (the unknown class). A family is named only if its
probability clears a limit calibrated on unknown paragraphs that speak of
licences and were kept out of training, and a template of the family is
mostly contained in the paragraph. Only sentences with a word of a small
set are classified; the set is made so that no sentence that could be
confirmed is without one.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import bounded_sample, col, saved, table

# Usual notices of each family.
TEMPLATES = {
    "agpl-3.0": ["This work is licensed under the GNU Affero General Public License, version 3.",
                 "distributed under the terms of the GNU AGPL v3 or later", "License: AGPLv3", "SPDX-License-Identifier: AGPL-3.0-or-later"],
    "apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
                   "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS.",
                   "Apache License Version 2.0, January 2004", "License: Apache 2.0", "SPDX-License-Identifier: Apache-2.0"],
    "bsd": ["Released under the BSD 3-Clause License.", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
            "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software.",
            "BSD 2-Clause License", "BSD 3-Clause License", "License: BSD", "SPDX-License-Identifier: BSD-3-Clause", "SPDX-License-Identifier: BSD-2-Clause"],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.",
              "SPDX-License-Identifier: CC-BY-4.0"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
                 "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
                 "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "cc0": ["Released under CC0 1.0 Universal.", "To the extent possible under law, the author has waived all copyright and related rights to this work.",
            "SPDX-License-Identifier: CC0-1.0"],
    "epl-2.0": ["This program is made available under the terms of the Eclipse Public License 2.0.", "SPDX-License-Identifier: EPL-2.0"],
    "gpl-2.0": ["This work is licensed under the GNU General Public License, version 2.", "distributed under the terms of the GNU GPL v2 or later",
                "License: GPLv2", "SPDX-License-Identifier: GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-or-later"],
    "gpl-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
                "distributed under the terms of the GNU GPL v3 or later", "License: GPLv3", "SPDX-License-Identifier: GPL-3.0-or-later",
                "SPDX-License-Identifier: GPL-3.0-only"],
    "isc": ["Released under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
            "License: ISC", "SPDX-License-Identifier: ISC"],
    "lgpl-3.0": ["This library is licensed under the GNU Lesser General Public License, version 3.", "SPDX-License-Identifier: LGPL-3.0-only"],
    "mit": ["Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
            "The MIT License (MIT)", "License: MIT", "SPDX-License-Identifier: MIT"],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Mozilla Public License Version 2.0", "License: MPL 2.0", "SPDX-License-Identifier: MPL-2.0"],
    "unlicense": ["This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: Unlicense"],
}
LOOK_ALIKES = [
    "All rights reserved.", "Copyright 2020 by the authors.", "No part of this publication may be reproduced without permission.",
    "Licensed under the terms of our own commercial agreement.", "This work is licensed to the customer for internal use only.",
    "Released under the terms of the contract with the publisher.", "He lost his driving licence, version two of the story says.",
    "The warranty of this product is void if the seal is broken.", "You may redistribute the leaflets in your town.",
    "Permission is required before you enter the building.", "The public domain of the kingdom was sold.",
    "He read about the GNU General Public License, version 3, in a book.", "An essay on the MIT License and its history.",
    "The Apache License, Version 2.0, is often compared with others.", "Their lawyers dislike the BSD 3-Clause License.",
    "See the licence file for more.", "Licensed under the house rules, version 7.", "The university has a general public reading room.",
]
#: What speaks of licences: an unconfirmed paragraph with one of these counts as unknown.
ANCHOR = r"(?i)licen[sc]|copyright|spdx|warrant|redistribut|permission|public domain|free software|creative commons|\bcc0\b|\bcc[ -]by\b"
#: A template is confirmed by at least this share of its pairs of neighbouring words.
LEAST = 0.6
#: What a line of a comment begins with.
_MARKS = r"(?m)^[ \t]*(?:/\*+!?|\*+/|\*+|//+!?|#+|--+|;+|%+|<!--|>+|dnl\b|(?i:rem)\b)?[ \t]*"
FAMILIES = sorted(TEMPLATES)
UNKNOWN = len(FAMILIES)
#: Words too common to tell a sentence by.
_COMMON = set("a above all an and any are as be by for from in is it may not of on or that the this to under use used with without work you".split())


def pairs_of(template: str) -> list[str]:
    """The different pairs of neighbouring words of a template."""
    w = re.findall("[a-z0-9]+", template.lower())
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:])})


def gate_words(least: float = LEAST) -> list[str]:
    """Words of which every sentence that holds ``least`` of a template's pairs has at least one.

    For each template, words are taken until fewer than ``least`` of its pairs are without any of them.
    """
    chosen: set[str] = set()
    for template in sorted(t for ts in TEMPLATES.values() for t in ts):
        pairs = [p.split() for p in pairs_of(template)]
        while True:
            free = [p for p in pairs if chosen.isdisjoint(p)]
            if len(free) < least * len(pairs):
                break
            count: dict[str, int] = {}
            for w in (w for p in free for w in set(p)):
                count[w] = count.get(w, 0) + 1
            chosen.add(min(count, key=lambda w: (w in _COMMON, len(w) < 3, -count[w], w)))
    return sorted(chosen)


#: Sentences without a match can be confirmed by no template and speak of no licence.
GATE = ANCHOR + r"|(?<![a-z0-9])(?:" + "|".join(gate_words()) + ")(?![a-z0-9])"


#: The same where lines may be broken and begin with comment marks.
_GATE_WRAPPED = GATE.replace("[ -]by", r"[\s*/#;%-]+by").replace(" ", r"[\s*/#;%-]+")


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def grams(w: Column) -> Column:
    """Words and pairs of neighbours."""
    pairs = F.transform(F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), lambda b, i: F.concat_ws(" ", F.get(w, i), b))
    return F.concat(w, pairs)


def segments(text: Column) -> Column:
    """What in a text can name a licence: sentences of its paragraphs that pass the gate, with their lines.

    Comment marks at the ends of lines go, paragraphs end at blank lines, and the wrapped lines of a
    sentence are joined with a blank. ``parts`` are the lines of a wrapped sentence that pass it
    too: where sentences lack their stops, each line may be a notice of its own.
    """
    bare = F.regexp_replace(F.regexp_replace(text, _MARKS, ""), r"(?m)[ \t\r]*(?:\*+/|-->)?[ \t\r]*$", "")
    cut = F.flatten(F.transform(F.split(bare, r"\n\s*\n"), lambda x: F.split(x, r"(?<=[.;:!?])(?<!(?i:licen[sc]e|identifier) ?:)\s+(?=\p{Lu})")))
    whole = lambda x: F.trim(F.regexp_replace(x, r"\s+", " "))
    made = F.transform(cut, lambda x: F.struct(
        whole(x).alias("whole"), F.when(F.trim(x).contains("\n"), F.filter(F.split(x, "\n"), lambda y: y.rlike(GATE)))
        .otherwise(F.array().cast("array<string>")).alias("parts")))
    found = F.filter(made, lambda x: x["whole"].rlike(GATE))
    return F.when(text.rlike(_GATE_WRAPPED), found).otherwise(F.array().cast("array<struct<whole:string,parts:array<string>>>"))


def _denied(template: str) -> list[str]:
    """The template with a "not" before its verb, if it has one."""
    out = re.sub(r"(?i)\b(licensed|released|distributed|granted|permitted)\b", r"not \1", template, count=1)
    return [out] if out != template else []


def examples(docs: DataFrame, text: str, rows: int, seed: int, lines_each: int) -> DataFrame:
    """``label, w``: templates whole, with each word or a third left out, and with corpus words around; unknown paragraphs."""
    spark = docs.sparkSession
    plain = [(float(i), t) for i, f in enumerate(FAMILIES) for t in TEMPLATES[f]]
    thirds = []
    for i, t in plain:
        w = t.split()
        if len(w) >= 12:
            thirds += [(i, " ".join(w[len(w) // 3:])), (i, " ".join(w[:-(len(w) // 3)]))]
    unknown = [(float(UNKNOWN), t) for t in LOOK_ALIKES + [x for _, t in plain for x in _denied(t)]]
    known = spark.createDataFrame(plain + thirds + unknown, "label double, text string")
    known = known.select("label", words(F.col("text")).alias("w"))
    less = known.where(F.size("w") >= 4).select("label", F.explode(F.transform("w", lambda _, i: F.filter("w", lambda x, j: i != j))).alias("w"))
    less = less.join(known.select("w"), "w", "left_anti").select("label", "w")  # without its "NC" a notice is another family's
    few = bounded_sample(docs.where(col(text).isNotNull()).select(col(text).alias("text")), rows, seed, "text")
    by_hash = F.array_sort(F.transform(F.array_distinct(F.split("text", "\n")), lambda x: F.struct(F.xxhash64(F.lit(seed), x), x.alias("line"))))
    lines = few.select(F.explode(F.slice(by_hash, 1, lines_each)["line"]).alias("line"))
    lines = lines.select(words(F.col("line")).alias("w")).where(F.size("w") > 0).withColumn("grams", grams(F.col("w")))
    lines = lines.where(F.greatest(*[_share(t) for ts in TEMPLATES.values() for t in ts]) < LEAST).select("w")
    lines = saved(lines, "licence-lines").withColumn("i", F.pmod(F.xxhash64("w"), F.lit(97)))
    many = known.withColumn("i", F.explode(F.array(*[F.lit(x) for x in range(0, 97, 12)])))
    around = many.join(lines.groupBy("i").agg(F.min("w").alias("v")), "i").select(
        "label", F.concat(F.slice("v", 1, 4), "w", F.slice("v", 5, 4)).alias("w"))
    return known.union(less).union(around).union(lines.select(F.lit(float(UNKNOWN)).alias("label"), "w"))


def _features(df: DataFrame, size: int) -> DataFrame:
    return HashingTF(numFeatures=size, binary=True, inputCol="grams", outputCol="features").transform(
        df.withColumn("grams", grams(F.col("w"))))


def _named(df: DataFrame, model: LogisticRegressionModel) -> DataFrame:
    """Adds the likeliest family and its probability."""
    p = model.transform(df).withColumn("p", F.slice(vector_to_array("probability"), 1, UNKNOWN))
    return (p.withColumn("probability", F.array_max("p")).withColumn("at", F.array_position("p", F.col("probability")) - 1)
            .withColumn("family", F.get(F.array(*[F.lit(f) for f in FAMILIES]), F.col("at").cast("int"))))


def train(docs: DataFrame, *, text: str = "text", rows: int = 1000, seed: int = 4, size: int = 1 << 14, lines_each: int = 4) -> tuple:
    """(model, probability limit, feature size), fitted on templates and corpus lines that hold none.

    The sample is bounded: about ``rows`` documents, and of each at most ``lines_each`` whole lines,
    both chosen by a hash. The limit is the 95th percentile of the likeliest family's probability over unknown
    paragraphs that pass for notices (they hold an anchor) and were not trained on.
    """
    all_ = saved(_features(examples(docs, text, rows, seed, lines_each), size).withColumn("test", F.pmod(F.xxhash64("w"), F.lit(4)) == 0)
                 .select("label", "w", "features", "test"), "licence-examples")
    known = F.col("label") != UNKNOWN
    fit = all_.where(known | ~F.col("test")).coalesce(2)
    model = LogisticRegression(family="multinomial", maxIter=40, regParam=5e-4, elasticNetParam=0.5).fit(fit)
    kept = _named(all_.where(~known & F.col("test") & F.array_join("w", " ").rlike(ANCHOR)), model)
    limit = kept.agg(F.percentile_approx("probability", 0.95)).first()[0]
    return model, max(0.5, limit or 0.5), size


def _share(template: str) -> Column:
    """Share of a template's neighbour pairs among ``grams``."""
    pairs = pairs_of(template)
    return F.size(F.array_intersect(F.array(*map(F.lit, pairs)), F.col("grams"))) / F.lit(len(pairs))


def _contained(w: Column, family: Column) -> Column:
    """Largest share of a template's neighbour pairs found in the paragraph, over the family's templates."""
    out = F.lit(0.0)
    for f in FAMILIES:
        out = F.when(family == f, F.greatest(*[_share(t) for t in TEMPLATES[f]], F.lit(0.0))).otherwise(out)
    return out


def paragraphs(docs: DataFrame, model: tuple, *, doc: str = "doc_id", text: str = "text", least: float = LEAST) -> DataFrame:
    """``row, doc_id, paragraph, family, probability, similarity``: each sentence of a paragraph that passes the gate.

    A wrapped sentence is judged whole; lines of it are rows of their own if they name a family where
    the whole names none, or another family at least as fully. A document without one has a row with null paragraph. ``family`` is ``unknown`` where the
    probability or the template comparison does not confirm one.
    """
    lr, limit, size = model
    rows = docs.select(F.monotonically_increasing_id().alias("row"), col(doc).alias("doc_id"),
                       segments(F.coalesce(col(text), F.lit(""))).alias("segments"))
    p = rows.select("row", "doc_id", F.posexplode_outer("segments").alias("at_segment", "segment"))
    p = p.select("row", "doc_id", "at_segment", F.explode_outer(F.concat(F.array("segment.whole"), "segment.parts")).alias("paragraph"),
                 F.col("segment.whole").alias("whole"))
    p = p.withColumn("w", F.when(F.col("paragraph").isNull(), F.array().cast("array<string>")).otherwise(words(F.col("paragraph"))))
    p = _named(_features(p, size), lr).withColumn("similarity", _contained(F.col("w"), F.col("family")))
    sure = (F.col("probability") >= limit) & (F.col("similarity") >= least)
    p = p.select("row", "doc_id", "at_segment", "paragraph", (F.col("paragraph") == F.col("whole")).alias("is_whole"),
                 F.when(F.col("paragraph").isNotNull(), F.when(sure, F.col("family")).otherwise("unknown")).alias("family"),
                 "probability", "similarity")
    judged = F.struct("paragraph", "family", "probability", "similarity", "is_whole")
    p = p.groupBy("row", "doc_id", "at_segment").agg(F.collect_list(judged).alias("judged"))
    whole = F.get(F.filter("judged", lambda x: x["is_whole"]), F.lit(0))
    named = whole["family"] != "unknown"
    other = F.filter("judged", lambda x: ~x["is_whole"] & (x["family"] != "unknown") & F.when(
        named, (x["family"] != whole["family"]) & (x["similarity"] >= whole["similarity"])).otherwise(True))
    picked = F.when(whole.isNull(), F.col("judged")).when(named | (F.size(other) == 0), F.concat(F.array(whole), other)).otherwise(other)
    return p.select("row", "doc_id", F.explode(picked).alias("x")).select(
        "row", "doc_id", "x.paragraph", "x.family", "x.probability", "x.similarity")


def licences(docs: DataFrame, model: tuple, **options) -> DataFrame:
    """One row per document row: ``doc_id, licences, n_paragraphs, n_unknown``.

    ``licences`` lists the confirmed families in order, comma-joined (empty if none); the counts are
    of paragraphs that name a confirmed family and of those that only look like it. Null and empty
    texts, and texts without such paragraphs, have none. Null and repeated ids keep their rows; an
    empty table gives no rows; other columns are ignored. Very long texts are read whole.
    """
    sure = (F.col("family") != "unknown")
    return (paragraphs(docs, model, **options).groupBy("row", "doc_id")
            .agg(F.array_join(F.array_sort(F.collect_set(F.when(sure, F.col("family")))), ",").alias("licences"),
                 F.count_if(sure).alias("n_paragraphs"), F.count_if(~sure & F.col("paragraph").rlike(ANCHOR)).alias("n_unknown")).drop("row"))


def op4_licences(spark, sf_dir):
    """Licences of all documents."""
    docs = table(spark, sf_dir, "documents")
    return licences(docs, train(docs))
