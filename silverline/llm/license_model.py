"""Licence scan: a trained paragraph classifier, native to Spark.

Every paragraph (line) of a document that names a licensing term or holds
2-grams of the templates (two, or the only one of a template: fewer cannot be
confirmed) is scored by a multinomial logistic regression over word 1- and
2-grams; its classes are licence families and `unknown`. Lines longer than a
window of WINDOWS are scored window by window, at both sizes, so a notice inside
a long line counts as one on its own. Training is Spark's own, over the family
templates below with words left out in several ways, against paragraphs that
are no licence: sentences that use the same terms otherwise, and a bounded
sample of corpus lines without any (BACKGROUND lines, smallest hashes).

The probabilities are calibrated by a temperature chosen on variants left out of
training, and the unknown class by a threshold: the highest probability that a
left-out non-licence paragraph gives any family, but at least LEAST. A family
that passes is confirmed by comparison with the family's templates: the share
of one template's 2-grams that the window holds, or of the window's that one
template holds, must reach CONFIRM.

Reading, scoring and comparison are DataFrame expressions and joins with the
weight and template tables, whose sizes are fixed by the templates.

Defined cases: null, empty and word-less texts have no paragraphs and no
licence; nor has a row without doc_id. Rows that share a doc_id share its
result. Other columns are ignored. Ties between families go to the first in order.
"""

from __future__ import annotations

import json
import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from silverline.catalog import stored
from silverline.llm.frames import only

# Notices by licence family.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "This project is licensed under the terms of the Apache License 2.0.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Released under the BSD 3-Clause License.",
        "Licensed under the BSD 2-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "CC-BY": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "CC-BY-NC": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "CC-BY-SA": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ),
    "CC0": (
        "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0 Universal.",
        "Released into the public domain under the CC0 1.0 license.",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Released under the GPL version 2 license.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "You can redistribute it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ),
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright the authors. All rights reserved. No part of this publication may be reproduced without prior written permission.",
        "This material is proprietary and confidential; redistribution is not permitted without a license agreement.",
    ),
}
# Sentences with licensing terms that grant nothing.
OTHERWISE = (
    "The driver had to show a license and the registration of the car.",
    "Her fishing license expired in the spring and she renewed it in town.",
    "The council will license new taxis next year.",
    "The lecture was about the history of copyright in the printing trade.",
    "A warranty card came with the machine and was lost the same day.",
    "He asked for permission to leave the room early.",
    "Poetic license allows the writer to bend the facts.",
    "The redistribution of land was the main demand of the farmers.",
    "Nobody reserved a table, so all the seats were taken.",
    "The pilot lost the license after the second incident.",
    "Without permission of the owner no one may enter the garden.",
    "The company was licensed to sell tea in three towns.",
)
# Terms of which a licence paragraph holds at least one.
TERMS = ("licen", "copyright", "permission", "redistribut", "warrant", "rights reserved", "public domain", "creative commons", "gpl")
UNKNOWN = "unknown"
VARIANTS = 12           # ways of leaving words out, one in five each
LEFT_OUT = 3            # of these, kept for calibration
BACKGROUND = 1_500
VOCABULARY = 4_096
LEAST, CONFIRM = 0.5, 0.6
WINDOWS = ((24, 12), (160, 80))      # words of a window, and from one to the next
TEMPERATURES = (0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 3.0)
FAMILIES = sorted(TEMPLATES)
CLASSES = [*FAMILIES, UNKNOWN]


def _rows(spark: SparkSession, values: list, schema: str) -> DataFrame:
    """A small table of fixed values, as one literal."""
    return spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(values)), f"array<struct<{schema}>>")).alias("r")).select("r.*")


def words(text: Column) -> Column:
    """Runs of letters, digits, dots, plus signs and dashes, lower-cased, without the
    dots, plus signs and dashes around them; runs of these alone are no words."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9](?:[a-z0-9.+-]*[a-z0-9])?"), F.lit(0))


def pairs(w: Column) -> Column:
    """2-grams of a word array."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - 1, F.lit(1))),
                       lambda i: F.concat_ws(" ", F.get(w, i - 1), F.get(w, i)))


def grams(w: Column) -> Column:
    return F.array_distinct(F.concat(w, F.when(F.size(w) > 1, pairs(w)).otherwise(F.array().cast("array<string>"))))


def has_term(text: Column) -> Column:
    low = F.lower(text)
    found = F.lit(False)
    for term in TERMS:
        found = found | low.contains(term)
    return found


def _examples(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(words, label, variant) of the training and calibration paragraphs."""
    fixed = [{"label": float(k), "text": t} for k, family in enumerate(FAMILIES) for t in TEMPLATES[family]]
    fixed += [{"label": float(len(FAMILIES)), "text": t} for t in OTHERWISE]
    base = _rows(spark, fixed, "label:double,text:string").select("label", words(F.col("text")).alias("w"))
    varied = base.select("label", "w", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))).alias("variant"))
    dropped = F.filter("w", lambda x, i: (F.col("variant") == 0) | (F.pmod(F.xxhash64(x, i, "variant"), F.lit(5)) != 0))
    lines = only(docs, "doc_id", "text").select("doc_id", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    lines = lines.where(~has_term(F.col("line")) & F.col("line").rlike("[A-Za-z]"))
    key = F.xxhash64("doc_id", "at")
    sample = lines.orderBy(key, "doc_id", "at").limit(BACKGROUND).select(
        F.lit(float(len(FAMILIES))).alias("label"), words(F.col("line")).alias("w"),
        F.pmod(key, F.lit(VARIANTS)).cast("int").alias("variant"))
    return varied.select("label", dropped.alias("w"), "variant").unionByName(sample).where("size(w) > 0") \
        .select("label", "variant", "w", grams(F.col("w")).alias("grams"))


class Model:
    """Weights by gram, intercepts, temperature and threshold; templates by 2-gram."""

    def __init__(self, weights: DataFrame, intercepts: list[float], temperature: float, threshold: float, templates: DataFrame):
        self.weights, self.intercepts = weights, intercepts
        self.temperature, self.threshold, self.templates = temperature, threshold, templates


def _softmax(margins: Column, temperature: float) -> Column:
    top = F.array_max(margins)
    e = F.transform(margins, lambda m: F.exp((m - top) / F.lit(temperature)))
    total = F.aggregate(e, F.lit(0.0), lambda a, x: a + x)
    return F.transform(e, lambda x: x / total)


def train(spark: SparkSession, docs: DataFrame) -> Model:
    examples = stored(_examples(spark, docs), "licence-examples")
    fitting = examples.where(F.col("variant") < VARIANTS - LEFT_OUT)
    counter = CountVectorizer(inputCol="grams", outputCol="x", vocabSize=VOCABULARY, minDF=2.0, binary=True).fit(
        fitting.where(F.col("label") < len(FAMILIES)).select("grams"))
    fitted = LogisticRegression(featuresCol="x", labelCol="label", family="multinomial", regParam=2e-3, maxIter=40).fit(
        counter.transform(fitting).select("x", "label"))
    coefficients, intercepts = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray().tolist()
    weights = _rows(spark, [{"gram": g, "weight": coefficients[:, j].round(6).tolist()} for j, g in enumerate(counter.vocabulary)],
                    "gram:string,weight:array<double>")
    # calibration on the variants left out
    margin = vector_to_array("rawPrediction")
    left = fitted.transform(counter.transform(examples.where(F.col("variant") >= VARIANTS - LEFT_OUT))).select("label", margin.alias("m"))
    losses = left.agg(*[F.avg(-F.log(F.greatest(F.element_at(_softmax(F.col("m"), t), F.col("label").cast("int") + 1), F.lit(1e-9)))).alias(str(k))
                        for k, t in enumerate(TEMPERATURES)]).first()
    temperature = TEMPERATURES[min(range(len(TEMPERATURES)), key=lambda k: losses[k] if losses[k] is not None else 0.0)]
    family = F.array_max(F.slice(_softmax(F.col("m"), temperature), 1, len(FAMILIES)))
    highest = left.where(F.col("label") == len(FAMILIES)).agg(F.max(family)).first()[0]
    shapes = [{"family": f, "template": f"{f}/{k}", "text": t} for f in FAMILIES for k, t in enumerate(TEMPLATES[f])]
    templates = _rows(spark, shapes, "family:string,template:string,text:string").select(
        "family", "template", F.array_distinct(pairs(words(F.col("text")))).alias("all")).select(
        "family", "template", F.explode("all").alias("pair"), F.size("all").alias("held"))
    return Model(weights, intercepts, temperature, max(LEAST, min(float(highest or 0.0), 0.99)), templates)


LINE = "doc_id", "paragraph", "line"
PARAGRAPHS = *LINE, "at"


def _template_pairs() -> tuple[list[str], list[str]]:
    """2-grams of the templates, and those that are all of one template."""
    every, alone = set(), set()
    for texts in TEMPLATES.values():
        for text in texts:
            w = [re.sub(r"^[.+-]+|[.+-]+$", "", x) for x in re.split(r"[^a-z0-9.+-]+", text.lower()) if re.search("[a-z0-9]", x)]
            found = {f"{a} {b}" for a, b in zip(w, w[1:])}
            every |= found
            alone |= found if len(found) == 1 else set()
    return sorted(every), sorted(alone)


def _windows(w: Column) -> Column:
    """The words, where they fit the smallest window; else all windows of them."""
    def cut(size: int, step: int) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(w) - 1) / step).cast("int"))
        return F.when(F.size(w) > size, F.transform(starts, lambda i: F.slice(w, i * step + 1, size))).otherwise(F.array(w))
    return F.array_distinct(F.concat(*[cut(size, step) for size, step in WINDOWS]))


def paragraphs(docs: DataFrame) -> DataFrame:
    """Distinct windows of the paragraphs that may hold a notice: doc_id, number, hash of the line, number of the window, words."""
    every, alone = _template_pairs()
    lines = (only(docs, "doc_id", "text").where(F.col("doc_id").isNotNull())
             .select("doc_id", F.posexplode(F.split("text", "\n")).alias("paragraph", "line")))
    # the one-element explode keeps filters on the words from computing them anew for every pair
    told = lines.select("doc_id", "paragraph", F.xxhash64("line").alias("line"), has_term(F.col("line")).alias("term"),
                        F.explode(F.array(words(F.col("line")))).alias("w"))

    def near(w: Column) -> Column:
        two = F.zip_with(w, F.slice(w, 2, F.greatest(F.size(w), F.lit(1))), lambda a, b: F.concat_ws(" ", a, b))
        found = F.array_distinct(F.filter(two, lambda p: p.isin(every)))
        return (F.size(found) > 1) | F.exists(found, lambda p: p.isin(alone))
    return (told.where(F.col("term") | near(F.col("w")))
            .select(*LINE, "term", F.posexplode(_windows(F.col("w"))).alias("at", "w"))
            .where(F.col("term") | near(F.col("w"))).select(*PARAGRAPHS, "w").dropDuplicates([*PARAGRAPHS]))


def classify(found: DataFrame, model: Model) -> DataFrame:
    """Family, probability, best template, its similarity and whether it confirms, per window."""
    marked = found.select(*PARAGRAPHS, F.explode_outer(grams(F.col("w"))).alias("gram"))
    known = marked.join(F.broadcast(model.weights), "gram", "left")
    sums = known.groupBy(*PARAGRAPHS).agg(*[F.coalesce(F.sum(F.col("weight")[k]), F.lit(0.0)).alias(f"m{k}") for k in range(len(CLASSES))])
    p = _softmax(F.array(*[F.col(f"m{k}") + F.lit(b) for k, b in enumerate(model.intercepts)]), model.temperature)
    told = sums.select(*PARAGRAPHS, F.slice(p, 1, len(FAMILIES)).alias("p")).select(
        *PARAGRAPHS, F.array_max("p").alias("probability"),
        F.element_at(F.lit(FAMILIES), F.array_position("p", F.array_max("p")).cast("int")).alias("family"))
    # 2-grams and their number are made below the explode: once a window, not once a 2-gram
    held = found.select(*PARAGRAPHS, F.array_distinct(pairs(F.col("w"))).alias("two")).select(*PARAGRAPHS, "two", F.size("two").alias("of"))
    shared = (held.select(*PARAGRAPHS, "of", F.explode("two").alias("pair"))
              .join(F.broadcast(model.templates), "pair").groupBy(*PARAGRAPHS, "family", "template")
              .agg((F.count("*") / F.least(F.first("of"), F.first("held"))).alias("similarity"))
              .groupBy(*PARAGRAPHS, "family").agg(F.max("similarity").alias("similarity"), F.max_by("template", F.struct("similarity", "template")).alias("template")))
    both = told.join(shared, [*PARAGRAPHS, "family"], "left").withColumn("similarity", F.coalesce("similarity", F.lit(0.0)))
    named = F.col("probability") >= F.lit(model.threshold)
    return both.select(*PARAGRAPHS, F.when(named, F.col("family")).otherwise(UNKNOWN).alias("family"), "probability", "template", "similarity",
                       (named & (F.col("similarity") >= CONFIRM)).alias("confirmed"))


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document row: the confirmed families (sorted, comma-joined),
    paragraphs that were scored, confirmed ones, and the highest probability."""
    lines = classify(paragraphs(docs), model).groupBy(*LINE).agg(
        F.bool_or("confirmed").alias("confirmed"), F.max("probability").alias("probability"),
        F.collect_set(F.when(F.col("confirmed"), F.col("family"))).alias("families"))
    per = lines.groupBy("doc_id").agg(
        F.count("*").alias("n_candidates"), F.count_if("confirmed").alias("n_confirmed"), F.max("probability").alias("best_probability"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("families")))), ",").alias("families"))
    return only(docs, "doc_id").join(per, "doc_id", "left").select(
        "doc_id", F.coalesce("families", F.lit("")).alias("families"), F.coalesce("n_candidates", F.lit(0)).cast("bigint").alias("n_candidates"),
        F.coalesce("n_confirmed", F.lit(0)).cast("bigint").alias("n_confirmed"), F.coalesce("best_probability", F.lit(0.0)).alias("best_probability"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from silverline.catalog import Tables

    docs = Tables(spark, sf_dir).documents
    return scan(docs, train(spark, docs))
