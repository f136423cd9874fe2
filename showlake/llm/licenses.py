"""Licence scan of paragraphs, in DataFrame functions and Spark's own logistic regression.

A multinomial regression on word n-grams, trained on licence notices and on a
sample of other paragraphs, names the family of a paragraph.  A second one
calibrates its margin over the unknown class, and shingles shared with the
family's notices confirm the prediction.
"""

from __future__ import annotations

import json
import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from showlake.llm.common import stored

UNKNOWN = "unknown"
#: Other paragraphs to learn from, share of them above which a word says nothing, and weight of the penalty.
OTHERS, COMMON, PENALTY = 2000, 0.005, 1e-3
#: Chance of a known family, and shingles shared with a notice, from which on a prediction stands.
KNOWN, SHARED = 0.5, 0.5
SHINGLE = 3

#: Notices by which works name their licence.
NOTICES = {
    "agpl-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "Licensed under the GNU Affero General Public License, version 3.",
    ],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ],
    "cc-by-nc": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ],
    "cc-by-sa": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ],
    "cc0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Released into the public domain under CC0 1.0 Universal.",
    ],
    "gpl-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This work is licensed under the GNU General Public License, version 3.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "Licensed under the GNU Lesser General Public License.",
    ],
    "mit": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction.",
        "Released under the MIT License.",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
}
FAMILIES = [*NOTICES, UNKNOWN]
#: Words that name a family, and words that may stand beside a name in lines too short for a shingle.
NAMES = {
    "agpl-3.0": ["agpl", "agplv3", "affero"],
    "apache-2.0": ["apache"],
    "bsd": ["bsd"],
    "cc0": ["cc0"],
    "gpl-3.0": ["gpl", "gplv3"],
    "lgpl": ["lgpl", "lgplv3"],
    "mit": ["mit"],
    "mpl-2.0": ["mpl", "mozilla"],
}
#: Names that are words of their own as well, as German "mit", say nothing alone.
WORDS = ["affero", "apache", "bsd", "mit", "mozilla"]
BESIDE = ["license", "licence", "licensed", "licenced", "licenses", "licences"]


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def words_of(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def runs(list_: Column, n: int) -> Column:
    """Runs of ``n`` neighbouring words, joined by spaces; of fewer words, the whole.

    Words are read by place, as a slice copies the whole list each time.
    """

    def of(w: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.concat_ws(" ", *(F.get(w, i + j) for j in range(n))))
        return F.when(F.size(w) >= n, each).otherwise(F.array(F.array_join(w, " ")))

    return F.get(F.transform(F.array(list_), of), F.lit(0))


def grams(list_: Column) -> Column:
    """Distinct words and pairs of neighbouring words."""
    return F.array_distinct(F.concat(list_, runs(list_, 2)))


def named(list_: Column) -> Column:
    """The family that a list of fewer than ``SHINGLE`` words names, all other words being such as stand beside names; else null."""
    out = F.lit(None).cast("string")
    for family, names in NAMES.items():
        own = F.array(*map(F.lit, names))
        rest = F.array_except(list_, F.array(*map(F.lit, [*names, *BESIDE])))
        out = F.when(F.arrays_overlap(list_, own) & (F.size(rest) == 0), family).otherwise(out)
    says = F.exists(list_, lambda w: ~w.isin(WORDS))
    return F.when((F.size(list_) < SHINGLE) & says, out)


def constant(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A table of values that this module or a trained model holds."""
    found = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")
    return spark.range(1).select(F.explode(found).alias("r")).select("r.*")


def paragraphs(documents: DataFrame) -> DataFrame:
    """(doc_id, h, paragraph, text): the lines of each text that are not blank, numbered from zero."""
    lines = documents.select("doc_id", F.xxhash64("text").alias("h"), F.posexplode(F.split("text", r"\n")).alias("paragraph", "text"))
    return lines.filter(F.trim("text") != "")


def informative(others: DataFrame, notices: list[dict]) -> list[str]:
    """Words of notices and names that fewer than ``COMMON`` of other paragraphs have, and pairs with at least one such word.

    All of ``others`` is counted, in one aggregation whose empty word counts the paragraphs.
    """
    candidates = {w for x in notices for w in words_of(x["text"])} | {w for ws in NAMES.values() for w in ws}
    known = F.array(*map(F.lit, sorted(candidates)))
    each = F.concat(F.array_intersect(words(F.col("text")), known), F.array(F.lit("")))
    seen = {r["w"]: r["count"] for r in others.select(F.explode(each).alias("w")).groupBy("w").count().collect()}
    total = max(1, seen.pop("", 0))
    single = candidates - {w for w, n in seen.items() if n >= COMMON * total}
    pairs = set()
    for x in notices:
        list_ = words_of(x["text"])
        pairs |= {f"{a} {b}" for a, b in zip(list_, list_[1:]) if {a, b} & single}
    return sorted(single | pairs)


class Scanner:
    """A trained classifier: n-grams with a weight per family, and the calibration of its margin."""

    def __init__(self, documents: DataFrame, others: int = OTHERS, penalty: float = PENALTY):
        spark = documents.sparkSession
        self.notices = [{"family": f, "text": t} for f, ts in NOTICES.items() for t in ts]
        parts = [*self.notices]
        for x in self.notices:  # halves and trimmed copies, as texts quote notices in part
            list_ = x["text"].split()
            if len(list_) >= 12:
                parts += [{**x, "text": " ".join(p)} for p in (list_[: len(list_) // 2], list_[len(list_) // 2 :])]
        for f, names in NAMES.items():  # lines that only name a licence
            parts += [{"family": f, "text": t.format(n)} for n in names for t in ("{}", "{} License", "License: {}")]
        # Documents are chosen by a hash of their doc_id, paragraphs of those by a hash of their text.
        share = min(1.0, others / max(1, documents.count()))
        some = documents.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < 1_000_000 * share)
        sample = paragraphs(some.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))).select("text").distinct()
        sample = stored(sample.orderBy(F.xxhash64("text"), "text").limit(others), "license-others")
        shingles = {s for x in self.notices for s in _shingles(x["text"])}
        known = F.array(*map(F.lit, sorted(shingles)))
        # Words are cut once a paragraph: they are the variable of a function, not an expression within one.
        is_other = F.transform(F.array(words(F.col("text"))), lambda w: ~F.arrays_overlap(runs(w, SHINGLE), known) & named(w).isNull())
        other = F.get(is_other, F.lit(0))
        sample = sample.filter(other)
        every = paragraphs(documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
        self.features = informative(every.filter(other), self.notices)
        self.cues = [g for g in self.features if " " not in g]
        labelled = constant(spark, parts, "family: string, text: string")
        labelled = labelled.unionByName(sample.select(F.lit(UNKNOWN).alias("family"), "text"))
        number = F.array_position(F.array(*map(F.lit, FAMILIES)), F.col("family")) - 1
        labelled = labelled.select(
            number.cast("double").alias("label"), grams(words(F.col("text"))).alias("grams"), (F.pmod(F.xxhash64("text"), F.lit(4)) == 0).alias("apart")
        )
        vectors = CountVectorizerModel.from_vocabulary(self.features, "grams", "features").setBinary(True)
        data = stored(vectors.transform(labelled).select("label", "features", "apart"), "license-training")
        regression = LogisticRegression(family="multinomial", regParam=penalty, maxIter=60)
        # The margin is calibrated on rows that the model behind it has not seen; the weights are learned from all.
        self.slope, self.shift = self._calibrated(data.filter("apart"), regression.fit(data.filter("not apart")))
        model = regression.fit(data)
        matrix, self.bias = model.coefficientMatrix.toArray(), model.interceptVector.toArray().tolist()
        self.bias += [0.0] * (len(FAMILIES) - len(self.bias))
        self.weights = [
            {"gram": g, "w": [round(float(x), 9) for x in matrix[:, i]] + [0.0] * (len(FAMILIES) - matrix.shape[0])}
            for i, g in enumerate(self.features)
        ]

    def _calibrated(self, data: DataFrame, model) -> tuple[float, float]:
        """Platt's sigmoid of the margin between the best family and the unknown class."""
        from pyspark.ml.feature import VectorAssembler
        from pyspark.ml.functions import vector_to_array

        raw = vector_to_array("rawPrediction")
        last = len(FAMILIES) - 1
        margin = F.array_max(F.slice(raw, 1, last)) - F.coalesce(F.get(raw, F.lit(last)), F.lit(0.0))
        rows = model.transform(data).select(margin.alias("margin"), (F.col("label") < last).cast("double").alias("label"))
        rows = VectorAssembler(inputCols=["margin"], outputCol="features").transform(rows)
        platt = LogisticRegression(regParam=0.01, maxIter=50).fit(rows.select("features", "label"))
        return float(platt.coefficients[0]), float(platt.intercept)

    def scan(self, documents: DataFrame) -> DataFrame:
        """``doc_id, paragraph, family, p_known, similarity, confirmed`` of paragraphs that look like licence notices.

        A paragraph (line) is reported if its calibrated chance of a known
        family reaches ``KNOWN``; its family is ``unknown`` where too few
        shingles are shared with a notice of the predicted one.  A line too
        short for a shingle is confirmed if all its words are the family's
        name or such as stand beside one; it is then reported whatever its chance.  Paragraphs
        without any informative word have no feature and so the chance of an
        empty one.  A null text counts as empty; repeated rows of one doc_id
        and text report once.  Columns beyond doc_id and text are ignored.
        """
        spark = documents.sparkSession
        whole = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        may = F.arrays_overlap(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), F.array(*map(F.lit, sorted({*self.cues, *(w for ws in NAMES.values() for w in ws)}))))
        cues = F.array(*map(F.lit, self.cues))
        says = F.transform(F.array(words(F.col("text"))), lambda w: F.arrays_overlap(w, cues) | named(w).isNotNull())
        lines = paragraphs(whole.filter(may)).filter(F.get(says, F.lit(0))).withColumn("words", words(F.col("text")))
        key = F.struct("doc_id", "h", "paragraph").alias("key")  # its parts may be null, it is not
        lines = stored(lines.select(key, "words").distinct(), "license-lines").withColumn("named", named(F.col("words")))
        families = len(FAMILIES)
        weights = F.broadcast(constant(spark, self.weights, "gram: string, w: array<double>"))
        sums = [F.coalesce(F.sum(F.get("w", F.lit(i))), F.lit(0.0)).alias(f"s{i}") for i in range(families)]
        scored = lines.select("key", "named", F.explode(grams(F.col("words"))).alias("gram")).join(weights, "gram", "left")
        scored = scored.groupBy("key", "named").agg(*sums)
        logits = F.array(*(F.col(f"s{i}") + self.bias[i] for i in range(families)))
        scored = scored.select("key", "named", logits.alias("logits")).withColumn("best", F.array_max(F.slice("logits", 1, families - 1)))
        margin = F.col("best") - F.get("logits", F.lit(families - 1))
        names = F.array(*map(F.lit, FAMILIES))
        scored = scored.select(
            "key",
            "named",
            F.coalesce("named", F.get(names, F.array_position("logits", F.col("best")).cast("int") - 1)).alias("guess"),
            (1 / (1 + F.exp(-(margin * self.slope + self.shift)))).alias("p_known"),
        ).filter((F.col("p_known") >= KNOWN) | F.col("named").isNotNull())
        models = [
            {"guess": x["family"], "notice": i, "size": len(_shingles(x["text"])), "shingle": s}
            for i, x in enumerate(self.notices)
            for s in sorted(_shingles(x["text"]))
        ]
        notices = F.broadcast(constant(spark, models, "guess: string, notice: int, size: int, shingle: string"))
        mine = F.array_distinct(runs(F.col("words"), SHINGLE))
        cut = lines.select("key", F.size(mine).alias("own"), F.explode(mine).alias("shingle"))
        found = cut.join(scored.select("key", "guess"), "key").join(notices, ["guess", "shingle"])
        each = found.groupBy("key", "notice").agg((F.count("*") / F.least(F.first("own"), F.first("size"))).alias("similarity"))
        most = each.groupBy("key").agg(F.max("similarity").alias("similarity"))
        both = scored.join(most, "key", "left")
        similarity = F.when(F.col("named").isNotNull(), 1.0).otherwise(F.coalesce(F.col("similarity"), F.lit(0.0)))
        return both.select(
            F.col("key.doc_id").alias("doc_id"),
            F.col("key.paragraph").cast("long").alias("paragraph"),
            F.when(similarity >= SHARED, F.col("guess")).otherwise(UNKNOWN).alias("family"),
            F.round("p_known", 6).alias("p_known"),
            F.round(similarity, 6).alias("similarity"),
            (similarity >= SHARED).alias("confirmed"),
        )


def _shingles(text: str) -> set[str]:
    list_ = words_of(text)
    return {" ".join(list_[i : i + SHINGLE]) for i in range(max(1, len(list_) - SHINGLE + 1))}
