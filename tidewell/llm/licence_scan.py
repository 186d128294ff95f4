"""Licence notices by a trained paragraph classifier, confirmed against templates.

Everything runs as DataFrame operations.  A paragraph is a line of a text.  A multinomial
logistic regression over its words and word pairs (sparse, with an L1 penalty) gives the
licence family or ``none``; it is trained on the notices of each family and on paragraphs of a
bounded sample of documents (``TRAIN_DOCS``, smallest hashed ids), which are ordinary text
unless they repeat a notice.  The margin of the best family over ordinary text is
calibrated to a probability on the same paragraphs.  A paragraph that is probably a licence
notice is given its family if it also holds enough of the family's notice (word triples
of a template); otherwise it is ``unknown``.

Only paragraphs with a telling word are scored: the weights of all features made of
other words together cannot reach a notice, so the model itself calls the rest ordinary.
Every paragraph of every text is looked at.  Null and empty texts give no row.  Rows with
null id are scanned too; repeated rows give repeated results.  Paragraphs of any length are
handled; ties between families go to the alphabetically first.  An empty table gives no
row.  Other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import bounded_sample, materialise
from tidewell.llm.quality_crf import logistic

#: Documents whose paragraphs stand for ordinary text, size of the vocabulary, strength and mix of the penalty.
TRAIN_DOCS, VOCABULARY, PENALTY, L1 = 1500, 4096, 2e-3, 0.9
#: Least probability of a notice, least share of a template's word triples.
LEAST, CONFIRM = 0.5, 0.6

#: Notices of licence families in common use: fixed public texts.
NOTICES = {
    "agpl-3.0": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License.",
                 "Licensed under the GNU Affero General Public License, version 3.", "Released under the AGPL-3.0 license."],
    "apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Released under the Apache License 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."],
    "bsd-3-clause": ["Released under the BSD 3-Clause License.", "Licensed under the New BSD License.",
                     "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."],
    "cc-by-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-nc-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-sa-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc0-1.0": ["Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
                "This work is dedicated to the public domain under CC0 1.0 Universal."],
    "gpl-3.0": ["This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License v3.0.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License."],
    "mit": ["Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."],
    "mpl-2.0": ["Released under the Mozilla Public License, Version 2.0.",
                "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "proprietary": ["All rights reserved.", "Copyright. All rights reserved. No part of this work may be reproduced without written permission."],
}


def words_of(paragraph):
    """Column: lower-cased words of letters, digits and inner dots and hyphens."""
    return F.filter(F.split(F.regexp_replace(F.regexp_replace(F.lower(paragraph), r"[^\p{L}\p{N}.\-]+", " "), r"(?<![\p{L}\p{N}])[.\-]+|[.\-]+(?![\p{L}\p{N}])", " "),
                            r"\s+"), lambda w: w != "")


def grams(words, size: int):
    """Column: word n-grams of one size."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - (size - 1), F.lit(0)), F.lit(1)) if size == 1 else
                       F.when(F.size(words) >= size, F.sequence(F.lit(1), F.size(words) - (size - 1))).otherwise(F.array().cast("array<int>")),
                       lambda i: F.array_join(F.slice(words, i, size), " "))


def features(words):
    """Column: distinct words and word pairs."""
    return F.array_distinct(F.concat(words, grams(words, 2)))


@dataclass
class Model:
    """Families (``none`` first), intercepts, weights per feature, and the margin's calibration."""

    families: list[str]
    intercepts: list[float]
    weights: dict[str, list[float]]
    scale: tuple[float, float]

    common: list[str]

    @property
    def cues(self) -> list[str]:
        """Words of which every notice holds one.

        The commonest words are left out as long as all features made of left-out words,
        taken together, keep the margin of every family below what a notice needs.
        """
        gain = {f: np.maximum(np.array(w[1:]) - w[0], 0) for f, w in self.weights.items()}
        words = {x for f, g in gain.items() if g.max() > 0 for x in f.split(" ")}
        slope, intercept = self.scale
        if slope <= 0:
            return sorted(words)
        room = (np.log(LEAST / (1 - LEAST)) - intercept) / slope - (np.array(self.intercepts[1:]) - self.intercepts[0]) - 1e-6
        left: set[str] = set()
        for word in [w for w in self.common if w in words]:
            now = left | {word}
            total = sum((g for f, g in gain.items() if set(f.split(" ")) <= now), np.zeros(len(room)))
            if (total < room).all():
                left = now
        return sorted(words - left)


def notices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(f, t) for f, ts in NOTICES.items() for t in ts], "family string, notice string")


def paragraphs(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.posexplode(F.split(F.col(text).cast("string"), "\n")).alias("paragraph", "content"))


def template_shares(rows: DataFrame, spark: SparkSession) -> DataFrame:
    """For paragraphs (key, words): each template family with the largest share of its word triples found."""
    held = notices(spark).select("family", F.monotonically_increasing_id().alias("template"), words_of(F.col("notice")).alias("w")).select(
        "family", "template", F.explode(F.array_distinct(F.when(F.size("w") >= 3, grams(F.col("w"), 3)).otherwise(F.array(F.array_join("w", " "))))).alias("gram"))
    sizes = held.groupBy("template").agg(F.count("*").alias("size"))
    held = F.broadcast(held.join(sizes, "template"))
    own = rows.select("key", F.explode(F.array_distinct(F.concat(grams(F.col("words"), 3), grams(F.col("words"), 2)))).alias("gram"))
    return own.join(held, "gram").groupBy("key", "family", "template", "size").agg(F.count("*").alias("n")).groupBy("key", "family").agg(
        F.max(F.expr("n / size")).alias("share"))


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Model:
    """Train on the notices and on paragraphs of the bounded sample."""
    spark = docs.sparkSession
    families = ["none", *sorted(NOTICES)]
    ids = bounded_sample(docs.select(F.col(doc_id).cast("long").alias("key")).where("key is not null"), "key", TRAIN_DOCS).distinct()
    sample = docs.select(F.col(doc_id).cast("long").alias("key"), F.col(text).alias("sampled")).join(F.broadcast(ids), "key")
    plain = paragraphs(sample, "key", "sampled").where("content rlike '\\\\p{L}'").select(F.monotonically_increasing_id().alias("key"), words_of(F.col("content")).alias("words"))
    plain = materialise(plain, "licence-sample")
    like = template_shares(plain, spark).where("share >= 0.5").select("key").distinct()
    ordinary = plain.join(like, "key", "left_anti").select(F.lit(0.0).alias("label"), "words", F.lit(1.0).alias("weight"))
    number = F.element_at(F.create_map(*[x for k, f in enumerate(families) for x in (F.lit(f), F.lit(float(k)))]), F.col("family"))
    # Notices weigh together as much as ordinary text, alone and with words of ordinary text around them.
    known = notices(spark).select(number.alias("label"), words_of(F.col("notice")).alias("words"))
    mixed = known.crossJoin(ordinary.select(F.slice("words", 1, 12).alias("around")).limit(10)).select("label", F.concat("words", "around").alias("words"))
    known = known.unionByName(mixed)
    weight = max(1.0, ordinary.count() / max(known.count(), 1))
    rows = ordinary.unionByName(known.withColumn("weight", F.lit(float(weight)))).select("label", "weight", features(F.col("words")).alias("features_"))
    rows = materialise(rows, "licence-training")
    # Only features that notices hold can speak for a family; ordinary ones are told by their absence.
    vocabulary = CountVectorizer(inputCol="features_", outputCol="vector", vocabSize=VOCABULARY, binary=True).fit(rows.where("label > 0"))
    model = LogisticRegression(featuresCol="vector", labelCol="label", weightCol="weight", family="multinomial", regParam=PENALTY,
                               elasticNetParam=L1, maxIter=60).fit(vocabulary.transform(rows))
    matrix, intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    weights = {term: matrix[:, k].tolist() for k, term in enumerate(vocabulary.vocabulary) if np.abs(matrix[:, k]).max() > 1e-9}
    counts = ordinary.select(F.explode("words").alias("word")).where(F.col("word").isin(sorted({x for t in weights for x in t.split(" ")}))).groupBy(
        "word").count().orderBy(F.desc("count"), "word").collect()
    out = Model(families, intercepts.tolist(), weights, (1.0, 0.0), [r.word for r in counts])
    seen = score_words(rows.select(F.monotonically_increasing_id().alias("key"), F.col("features_").alias("features"), "label"), out, "key", "label").select(
        "margin", (F.col("label") > 0).cast("int").alias("y")).toPandas()
    if len(seen) and seen.y.nunique() == 2:
        out.scale = logistic(np.clip(seen.margin.to_numpy(float), -20, 20), seen.y.to_numpy(float))
    return out


def score_words(rows: DataFrame, model: Model, *keys: str) -> DataFrame:
    """Margin of the best family over ordinary text, and that family, from an array column ``features``."""
    spark = rows.sparkSession
    names = [f"s{k}" for k in range(len(model.families))]
    table = spark.createDataFrame([(t, *w) for t, w in model.weights.items()] or [("", *[0.0] * len(names))], "feature string, " + ", ".join(f"{n} double" for n in names))
    hits = rows.select(*keys, F.explode_outer("features").alias("feature")).join(F.broadcast(table), "feature", "left")
    sums = hits.groupBy(*keys).agg(*[(F.coalesce(F.sum(n), F.lit(0.0)) + F.lit(float(b))).alias(n) for n, b in zip(names, model.intercepts)])
    best = F.greatest(*[F.col(n) for n in names[1:]])
    family = F.coalesce(*[F.when(F.col(n) == best, F.lit(f)) for n, f in zip(names[1:], model.families[1:])])
    return sums.select(*keys, (best - F.col("s0")).alias("margin"), family.alias("family"))


def scan_licences(docs: DataFrame, model: Model | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, paragraph, family, probability, share, notice for every paragraph that is probably a licence notice."""
    spark = docs.sparkSession
    model = model or fit(docs, doc_id, text)
    cues = "|".join(re.escape(c) for c in model.cues) or "(?!)"
    cue = rf"(?i)(?<![\p{{L}}\p{{N}}])(?:{cues})(?![\p{{L}}\p{{N}}])"
    lines = paragraphs(docs.where(F.col(text).rlike(cue)), doc_id, text).where(F.col("content").rlike(cue))
    lines = lines.select("doc_id", "paragraph", "content", words_of(F.col("content")).alias("words")).withColumn("key", F.struct("doc_id", "paragraph", F.xxhash64("content").alias("h")))
    scored = score_words(lines.select("key", features(F.col("words")).alias("features")).distinct(), model, "key")
    slope, intercept = model.scale
    probable = scored.withColumn("probability", F.expr(f"1 / (1 + exp(-({slope!r} * greatest(-20D, least(20D, margin)) + {intercept!r})))")).where(F.col("probability") >= LEAST)
    kept = materialise(lines.join(probable, "key"), "licence-lines")
    shares = template_shares(kept.select("key", "words").distinct(), spark)
    out = kept.join(shares, ["key", "family"], "left").withColumn("share", F.coalesce("share", F.lit(0.0)))
    return out.select("doc_id", "paragraph", F.when(F.col("share") >= CONFIRM, F.col("family")).otherwise("unknown").alias("family"),
                      "probability", "share", F.col("content").alias("notice"))
