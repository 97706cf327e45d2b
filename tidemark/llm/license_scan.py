"""License scans with a trained paragraph classifier (operator 9).

A paragraph is a line of a text.  Its features are hashed word 1- and 2-grams (``FEATURES`` places, set or not: a word said many times tells no more); a multinomial logistic
regression gives the probability of each licence family and of no licence.  It is trained on labelled paragraphs: cuts of
the families' templates, phrases that name other licences or none by name, plain sentences, and lines of the corpus without licence words
(at most ``TRAIN_LINES``, drawn by hash).

Unknown class, calibrated on labelled paragraphs that the fit did not see: a family is accepted from the lowest probability on
that keeps ``RECALL`` of the held-out family paragraphs and lies above those of all held-out other paragraphs if it can.  Then the template
comparison: the paragraph must hold ``OVERLAP`` of the words of a template of that family - or, of a notice wrapped over several lines, at least
``PARTIAL`` of them while the lines around it hold the rest (``BEFORE`` and ``AFTER`` lines at most, up to an empty line).  A paragraph is a
finding if the probability of all licences together reaches a limit calibrated in the same way, on all held-out notices and the held-out lines
without one; if it fails either test of its family it is ``unknown``.  No word list takes part in that.

All of it is DataFrame functions and spark.ml (JVM) stages; what the driver gets is the model and two thresholds.

Cases: a null or empty text has no paragraphs; empty lines are none; equal rows are found alike; a null doc_id is reported as
null; a long line is one paragraph, read whole; an empty table gives no rows (the model is then fitted on the fixed texts alone);
other columns are not read.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.frames import named, stored

FEATURES, TRAIN_LINES, RECALL, OVERLAP, PARTIAL = 1 << 14, 4000, 0.98, 0.75, 0.3
BEFORE, AFTER = 2, 4
NONE, UNKNOWN = "none", "unknown"

#: Public licence notices by family.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Distributed under the BSD License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
}
#: Notices of no family above, for the unknown class.
OTHERS = [
    "Licensed under the Example Community License.", "Released under a proprietary license.", "All rights reserved, see the license agreement.",
    "Licensed under the terms of the Mozilla Public License.", "Use of this text is subject to a separate license.", "Copyright by the authors, license on request.",
    "All rights reserved.", "Some rights reserved.", "No rights reserved.", "Copyright 2019 by the authors. All rights reserved.", "Copyright (c) the contributors.", "Copyright 2021",
    "GPL version 2 or later", "GPLv2 or later", "GPLv2", "GPLv3", "LGPLv3 or any later version", "AGPLv3", "LGPL 2.1", "AGPL 3.0 or later", "MPL 2.0", "EPL 2.0", "CC0 1.0", "CC0", "CC0 1.0 Universal", "CC BY-SA 4.0", "CC BY-ND 4.0", "CC BY-SA 3.0",
    "Public domain.", "This work is in the public domain.", "Dedicated to the public domain under CC0 1.0 Universal.", "SPDX-License-Identifier: ISC", "Redistribution is prohibited without written permission.",
    "Reproduction without prior written permission is forbidden.", "May not be reproduced or distributed without the consent of the publisher.", "Free for personal and non-commercial use only.",
]
#: Sentences that are no notices, some with words of one; they stand beside the lines of the corpus.
PLAIN = [
    "He reserved a table for two.", "All seats in the hall were taken.", "They later spoke about human rights.", "The right answer comes later.", "She asked for more time and a free copy of the book.",
    "Version 2 of the program runs on a public server.", "Free coffee for all visitors", "Chapter 1.0", "2.0", "4.0 or 3.0", "2021", "one or two", "sooner or later", "all", "or", "by", "the work of others",
    "This program was written by the authors of the book.", "The general public came to the international meeting.", "Use the following conditions as a source.", "the", "in the", "under the", "of this", "x",
]
#: Words of a licence notice; lines with one aren't drawn as lines without licence (nothing else is asked of them).
_LICENCE_WORDS = r"(?i)licen[sc]|copyright|\xa9|permission|redistribut|public domain|rights\s+reserved|reproduc|creative commons|\b[al]?gpl|\bcc[ -]?(0|by|zero)\b|\bspdx|\b[me]pl\b"
FAMILIES = [NONE, UNKNOWN, *TEMPLATES]
#: The examples without licence weigh so many times as much as the notices, all together.
NONE_WEIGHT = 4.0


class Limits(NamedTuple):
    """The least probability with which a family is accepted, and that of all licences together with which a paragraph is a finding."""

    family: float
    licence: float


def words(text: Column) -> Column:
    """Lower-case words ``[a-z0-9]+``; other letters separate them (licence notices are in ASCII)."""
    return F.split(F.lower(text), "[^a-z0-9]+")


def grams(w: Column) -> Column:
    """Words and pairs of neighbours."""
    pairs = F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(F.size(w) > 1, F.concat(w, pairs)).otherwise(w)


def featured(paragraphs: DataFrame, text: str) -> DataFrame:
    # words in a column of their own: each use below would else split the text again
    tokens = paragraphs.withColumn("w", words(F.col(text))).withColumn("grams", grams(F.col("w")))
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="grams", outputCol="features").transform(tokens).drop("grams", "w")


def paragraphs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, paragraph, body, around): the lines with a word, numbered from 0, and the lines around each, itself among them."""
    lines = F.split(named(text), "\n")

    def placed(line: Column, i: Column) -> Column:
        near = F.slice(lines, F.greatest(i - BEFORE, F.lit(0)) + 1, F.least(i, F.lit(BEFORE)) + 1 + AFTER)
        return F.struct(i.alias("paragraph"), line.alias("body"), F.concat_ws("\n", near).alias("around"))

    split = docs.select(named(doc_id).alias("doc_id"), F.explode(F.filter(F.transform(lines, placed), lambda x: F.trim(x["body"]) != "")).alias("line"))
    return split.select("doc_id", "line.*")


def labelled(docs: DataFrame, text: str = "text") -> DataFrame:
    """(body, label, held_out): cuts of the notices, and at most about ``TRAIN_LINES`` lines of the corpus."""
    spark = docs.sparkSession
    notices = [(t, FAMILIES.index(k)) for k, v in TEMPLATES.items() for t in v] + [(t, FAMILIES.index(UNKNOWN)) for t in OTHERS]
    rows = F.array(*(F.struct(F.lit(t).alias("notice"), F.lit(float(k)).alias("label")) for t, k in notices))
    whole = spark.range(1).select(F.inline(rows)).withColumn("w", F.split("notice", " "))
    n = F.size("w")
    cuts = whole.withColumn("from", F.explode(F.sequence(F.lit(0), F.ceil(n * 0.25).cast("int")))).withColumn("to", F.explode(F.sequence(F.ceil(n * 0.75).cast("int"), n)))
    cuts = cuts.filter(F.col("to") - F.col("from") >= F.least(n, F.greatest(F.lit(3), F.ceil(n * 0.7))))
    cuts = cuts.withColumn("body", F.concat_ws(" ", F.expr("slice(w, `from` + 1, `to` - `from`)")))
    share = F.lit(TRAIN_LINES) / F.greatest(F.lit(docs.count()), F.lit(1))
    # one line of a document drawn by hash: about TRAIN_LINES documents, then one line each
    drawn = stored(docs.select(named(text).alias("t")).filter((F.pmod(F.xxhash64("t"), F.lit(1_000_000)) < share * 1_000_000)))
    lines = drawn.select(F.filter(F.split("t", "\n"), lambda x: (F.trim(x) != "") & ~x.rlike(_LICENCE_WORDS)).alias("lines")).filter(F.size("lines") > 0)
    plain = lines.select(F.element_at("lines", (F.pmod(F.xxhash64("lines"), F.size("lines")) + 1).cast("int")).alias("body"), F.lit(float(FAMILIES.index(NONE))).alias("label"))
    fixed = spark.range(1).select(F.explode(F.array(*map(F.lit, PLAIN))).alias("body"), F.lit(float(FAMILIES.index(NONE))).alias("label"))
    both = cuts.select("body", "label").unionByName(plain).unionByName(fixed).distinct()
    # a short notice has no cuts besides itself: whole ones are always fitted
    always = F.col("body").isin([*OTHERS, *PLAIN])
    return both.withColumn("held_out", ~always & (F.pmod(F.xxhash64("body", F.lit(5)), F.lit(4)) == 0))


def fit(examples: DataFrame) -> tuple[LogisticRegressionModel, Limits]:
    """The model, and its limits."""
    examples = stored(examples)  # bounded; read by several jobs below
    rows = featured(examples.repartition(1).sortWithinPartitions("label", "body"), "body")  # bounded; one order, so reruns agree
    is_none = F.col("label") == FAMILIES.index(NONE)
    notices, plain = examples.filter("NOT held_out").agg(F.count_if(~is_none), F.count_if(is_none)).first()
    weight = F.when(is_none, F.lit(NONE_WEIGHT * notices / max(plain, 1))).otherwise(F.lit(1.0))
    learner = LogisticRegression(maxIter=60, regParam=1e-3, elasticNetParam=0.0, weightCol="weight", family="multinomial", standardization=False)
    model = learner.fit(rows.filter("NOT held_out").withColumn("weight", weight))
    tested = _judged(model, rows.filter("held_out"))
    wrong = (F.col("guess") > 1) & (F.col("guess") != F.col("label"))
    low, high, notice, line = tested.agg(
        F.expr(f"percentile(CASE WHEN guess = label AND label > 1 THEN p END, {1 - RECALL})"), F.max(F.when(wrong, F.col("p"))),
        F.expr(f"percentile(CASE WHEN label > 0 THEN any END, {1 - RECALL})"), F.max(F.when(F.col("label") == 0, F.col("any")))).first()
    return model, Limits(_limit(low, high), _limit(notice, line))


def _limit(low: float | None, high: float | None) -> float:
    """Above ``high``, the largest probability of a wrong one, unless that loses more than ``low``, the quantile of the right ones, allows."""
    return min(low if low is not None else 0.5, max(0.5, high or 0.0))


def _judged(model: LogisticRegressionModel, rows: DataFrame) -> DataFrame:
    """``rows`` with p and guess, the largest probability and its family, and any, the probability of all but no licence.

    The probabilities go through an ``explode`` of one: a filter on them then stays above, where it would else be
    pushed below the features and have them computed twice."""
    scorer = model.copy().setRawPredictionCol("").setPredictionCol("")
    scored = scorer.transform(rows).withColumn("ps", F.explode(F.array(vector_to_array("probability")))).drop("features", "probability")
    return scored.withColumn("p", F.array_max("ps")).withColumn("any", 1 - F.col("ps")[0]).withColumn("guess", (F.array_position("ps", F.col("p")) - 1).cast("int"))


def overlap(body: Column, family: Column) -> Column:
    """Largest share of a template's distinct words that a paragraph holds, over the templates of its family."""
    own = F.array_distinct(words(body))
    out = F.lit(0.0)
    for name, notices in TEMPLATES.items():
        shares = []
        for t in notices:
            known = F.array_distinct(words(F.lit(t)))
            shares.append(F.size(F.array_intersect(own, known)) / F.size(known))
        out = F.when(family == name, F.greatest(*shares)).otherwise(out)
    return out


def scan(docs: DataFrame, model: LogisticRegressionModel, least: Limits, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, paragraph, body, licence, probability, overlap): the paragraphs that are licence notices."""
    judged = _judged(model, featured(paragraphs(docs, doc_id, text), "body")).filter(F.col("any") >= least.licence)
    family = F.element_at(F.array(*map(F.lit, FAMILIES)), F.col("guess") + 1)
    # the block of lines that the paragraph stands in
    block = F.filter(F.split("around", "\n[ \t\r]*\n"), lambda x: F.contains(x, F.col("body")))
    judged = judged.withColumn("family", family).withColumn("own", overlap(F.col("body"), F.col("family")))
    wrapped = (F.col("own") >= PARTIAL) & (F.col("own") < OVERLAP)
    judged = judged.withColumn("overlap", F.when(wrapped, F.coalesce(overlap(F.get(block, F.lit(0)), F.col("family")), F.col("own"))).otherwise(F.col("own")))
    sure = (F.col("guess") > 1) & (F.col("p") >= least.family) & (F.col("overlap") >= OVERLAP)
    # not confirmed: a licence, but none that is known
    licence, probability = F.when(sure, F.col("family")).otherwise(F.lit(UNKNOWN)), F.when(sure, F.col("p")).otherwise(F.col("any"))
    return judged.select(F.col("doc_id").alias(doc_id), "paragraph", "body", licence.alias("licence"), probability.alias("probability"), "overlap")


def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model, least = fit(labelled(docs))
    return scan(docs, model, least).select("doc_id", F.col("paragraph").cast("bigint").alias("paragraph"), "licence",
                                           F.round("probability", 4).alias("probability"), F.round("overlap", 4).alias("overlap"), F.sha2("body", 256).alias("body_sha256"))
