"""Licence paragraphs by a trained classifier, confirmed by comparison with templates.

A sparse logistic regression over word n-grams tells the families of licences
and an unknown class apart. It judges overlapping windows of a paragraph's
words, so neither the length of a line nor where it is wrapped matters. It is trained on
variants of template sentences and, for the unknown class, on windows of the corpus that hold
no template, scraps of templates, templates with their words in another
order, near misses and denials. The margin between the best family and
unknown is calibrated on variants kept out of the training. A prediction
counts if a template sentence of the family is contained in the window with
its required words and is not denied there.

Only DataFrame functions and Spark's own learner run: no code of ours runs in tasks.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored

UNKNOWN = "unknown"

# Sentences by which public licences are named or granted.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "MIT": (
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
        " and associated documentation files",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU General Public License along with this program",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1",
        "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ),
    "AGPL": (
        "This program is licensed under the GNU Affero General Public License, version 3",
        "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ),
    "BSD": (
        "Licensed under the BSD License",
        "Licensed under the BSD 3-Clause License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted"
        " provided that the following conditions are met",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Licensed under the Mozilla Public License 2.0",
    ),
    "ISC": (
        "Licensed under the ISC License",
        "Permission to use, copy, modify, and distribute this software for any purpose with or without"
        " fee is hereby granted",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    "CC0": (
        "Released under CC0 1.0",
        "To the extent possible under law, the author has waived all copyright and related rights to this work",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain",
        "Released under the Unlicense",
    ),
}
# Short identifiers of the same licences. They differ in their last words only, so one counts when all of it is there.
IDENTIFIERS = {
    "Apache-2.0": "Apache-2.0",
    "MIT": "MIT",
    "GPL": "GPL",
    "LGPL": "LGPL",
    "AGPL": "AGPL",
    "BSD": "BSD",
    "MPL-2.0": "MPL-2.0",
    "ISC": "ISC",
    "CC-BY": "CC-BY-4.0",
    "CC-BY-SA": "CC-BY-SA-4.0",
    "CC-BY-NC": "CC-BY-NC-4.0",
    "CC0": "CC0-1.0",
    "Unlicense": "Unlicense",
}
TEMPLATES = {
    family: (*all_of, f"SPDX-License-Identifier: {IDENTIFIERS[family]}") for family, all_of in TEMPLATES.items()
}
# Words without which a template sentence does not speak of its licence; a text must hold those of the template.
REQUIRED = (
    "license licenses apache mit gnu lesser affero bsd mozilla isc cc by sa nc creative attribution sharealike"
    " noncommercial cc0 waived unencumbered domain unlicense permission software redistribution binary fee"
).split()
# Every template requires one of these, so text without any of them holds no licence.
ANCHORS = "license licenses permission redistribution gnu cc cc0 waived unencumbered unlicense".split()
VERBS = "licensed released distributed provided available published covered offered granted permitted waived".split()
NEGATIONS = rf"\b(?:not|cannot|never|no longer|(?:is|are|was|were)n['\u2019]?t) (?:(?:been|yet|be|being|currently) )?(?={'|'.join(VERBS)})"
DENIED_WORDS = 3  # words after a denied verb that are marked, too; what is denied stands there
TOKEN = r"[a-z0-9]+(?:\.[0-9]+)*"
CONTAINED = 60
# A line without a letter or digit, comment marks or not, ends a paragraph.
BLANK = r"\n[^\p{L}\p{N}\n]*(?=\n)"
COMMENT_WORD = r"(?m)^[ \t]*(?:dnl|rem)\b"  # other comment marks hold no word
# What stands before and after a template in an example.
FRAMES = (
    ("this text is", "see below"),
    ("copyright c 2020 the authors", "all rights reserved"),
    ("this file is part of the program", "for details"),
    ("copyright 2019 2021 by the contributors", "without any warranty"),
)
# What stands for a required word in a near miss.
FILLERS = ("house", "rules", "garden", "leaflet")
# (words of a window, words from one window to the next). Any run of at most words - step + 1 words lies whole in
# a window. Short windows tell licences apart that stand side by side; the longest template has 24 words.
SCALES = ((12, 4), (40, 10))
WIDEST = max(words for words, _ in SCALES)


def tokens(text: str) -> list[str]:
    return re.findall(TOKEN, text.lower())


def templates() -> list[tuple[str, int, list[str], list[str]]]:
    """(family, number, words, required words) of every template sentence."""
    sentences = [(family, s) for family, all_of in TEMPLATES.items() for s in all_of]
    return [(family, i, tokens(s), sorted(set(tokens(s)) & set(REQUIRED))) for i, (family, s) in enumerate(sentences)]


def _plain(text: Column) -> Column:
    """Lower case, one spelling, separators and comment marks as a space, denials marked.

    A negation is joined to its verb and to some words after it, as in "notlicensed notunder notthe notmit license".
    """
    spelt = F.regexp_replace(F.regexp_replace(F.lower(text), "licence", "license"), COMMENT_WORD, "")
    spaced = F.regexp_replace(spelt, r"[^a-z0-9.'\u2019]+", " ")
    marked = F.regexp_replace(spaced, NEGATIONS, "not")
    for words_on in range(DENIED_WORDS):
        denied = rf"\b(not(?:{'|'.join(VERBS)})(?: \S+){{{words_on}}}) (?=[a-z0-9])"
        marked = F.regexp_replace(marked, denied, "$1 not")
    return marked


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def _cut(text: Column, words: int, step: int) -> Column:
    """Overlapping windows of a plain text, from one regular expression that passes over it once."""
    unit = r"(?:[a-z0-9]++(?:\.[0-9]++)*+[^a-z0-9]*+)"
    pieces = F.regexp_extract_all(text, F.lit(rf"(?=({unit}{{1,{words}}}+)){unit}{{1,{step}}}+"), F.lit(1))
    return F.transform(pieces, lambda x, i: F.struct((i * step).alias("first"), x.alias("text")))


def _pairs(words: str) -> Column:
    n = F.size(words)
    return F.when(
        n >= 2,
        F.transform(
            F.sequence(F.lit(0), n - 2),
            lambda i: F.concat_ws(" ", F.get(F.col(words), i), F.get(F.col(words), i + 1)),
        ),
    ).otherwise(F.array().cast("array<string>"))


def _features(words: str) -> Column:
    """Distinct words and pairs of words."""
    return F.array_distinct(F.concat(F.col(words), _pairs(words)))


def windows(docs: DataFrame) -> DataFrame:
    """(doc_id, row_no, paragraph, first, wide, words) of the windows of all paragraphs that hold an anchor word.

    ``first`` is the number of the window's first word in its paragraph, from 0, ``wide`` the length of its kind.
    """
    anchor = rf"\b(?:{'|'.join(ANCHORS)})\b"
    numbered = F.transform(
        F.split(F.coalesce("text", F.lit("")), BLANK),
        lambda text, i: F.struct(i.alias("paragraph"), text.alias("text")),
    )
    found = F.filter(numbered, lambda x: x["text"].rlike(rf"(?i)licence|{anchor}"))

    def of_scale(wide: int, step: int) -> Column:
        pieces = F.filter(_cut(F.col("text"), wide, step), lambda x: x["text"].rlike(anchor))
        return F.transform(pieces, lambda x: F.struct(x["first"], F.lit(wide).alias("wide"), x["text"]))

    cut = F.flatten(F.array(*[of_scale(*scale) for scale in SCALES]))
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), found.alias("found"))
        .where(F.size("found") > 0)
        .withColumn("row_no", F.monotonically_increasing_id())
        .select("doc_id", "row_no", F.explode("found").alias("x"))
        .select("doc_id", "row_no", "x.paragraph", _plain(F.col("x.text")).alias("text"))
        .select("doc_id", "row_no", "paragraph", F.explode(cut).alias("x"))
        .select("doc_id", "row_no", "paragraph", "x.first", "x.wide", _words(F.col("x.text")).alias("words"))
    )


def _examples(docs: DataFrame, sample_documents: int, sample_windows: int = 4000) -> DataFrame:
    """(label, words): variants of the templates, and what is not a licence."""
    spark = docs.sparkSession
    given = spark.createDataFrame(templates(), "label string, number int, words array<string>, required array<string>")
    n = F.size("words")
    whole_ones = lambda df: df.where(F.size(F.array_except("required", "words")) == 0)

    def without(step: int) -> DataFrame:
        """Each word left out once, and with it every word ``step`` further on."""
        left_out = given.select("*", F.explode(F.sequence(F.lit(0), n - 1)).alias("at"))
        keep = lambda w, i: (F.pmod(i - F.col("at"), F.lit(step)) != 0)
        return whole_ones(left_out.select("label", F.filter("words", keep).alias("words"), "required")).select(
            "label", "words"
        )

    whole = given.select("label", "words")
    framed = [
        whole.select("label", F.concat(F.split(F.lit(before), " "), "words", F.split(F.lit(after), " ")).alias("words"))
        for before, after in FRAMES
    ]
    prose = stored(_prose(docs, sample_documents, sample_windows), "licence-prose")
    # Templates in the midst of the corpus' own words, a few for each.
    around = prose.where(F.size("words") >= 12).orderBy(F.md5(F.concat_ws(" ", "words")), "words").limit(8)
    for row in around.collect():  # eight windows
        for at in (0, len(row.words) // 2, len(row.words)):
            before, after = (F.split(F.lit(" ".join(part)), " ") for part in (row.words[:at], row.words[at:]))
            words = F.filter(F.concat(before, "words", after), lambda w: w != "")
            framed.append(whole.select("label", words.alias("words")))
    # An identifier without its last word is that of no licence.
    named = F.array_contains("words", "spdx") | F.array_contains("words", "identifier")
    fewer = [without(step).where(~named) for step in (1000, 7)]
    families = reduce(DataFrame.unionByName, [whole, *framed, *fewer])
    # Identifiers count whole or not at all, so they need no scraps.
    sentences = given.where("words[0] <> 'spdx'")
    starts = sentences.select("*", F.explode(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))).alias("at"))
    scraps = starts.select(F.slice("words", F.col("at") + 1, F.greatest(F.lit(1), F.floor(n / 4).cast("int"))).alias("words"))
    # Near misses: one required word, or all of them, are others; and what is said not to be so.
    filler = lambda i: F.element_at(F.array(*map(F.lit, FILLERS)), (i % len(FILLERS)) + 1)
    needed = lambda w: F.array_contains("required", w)
    one = starts.where(needed(F.get("words", F.col("at")))).select(
        F.transform("words", lambda w, i: F.when(i == F.col("at"), filler(F.col("at"))).otherwise(w)).alias("words")
    )
    all_others = sentences.where(F.size("required") > 0).select(
        F.transform("words", lambda w, i: F.when(needed(w), filler(i)).otherwise(w)).alias("words")
    )
    denials = []
    for _, _, words, _ in templates():
        for at in (i for i, word in enumerate(words) if word in VERBS):
            marked = [f"not{w}" if at <= i <= at + DENIED_WORDS else w for i, w in enumerate(words)]
            denials += [(marked,), (["our", "product", "is", *marked],)]
    denied = spark.createDataFrame(denials, "words array<string>")
    mixed = sentences.select(
        F.transform(
            F.array_sort(F.transform("words", lambda w: F.struct(F.md5(w.cast("binary")).alias("h"), w.alias("w")))),
            lambda x: x["w"],
        ).alias("words")
    )
    near = [scraps, one, all_others, denied, mixed, prose]
    unknown = reduce(DataFrame.unionByName, near).select(F.lit(UNKNOWN).alias("label"), "words")
    return families.unionByName(unknown)


def _prose(docs: DataFrame, sample_documents: int, sample_windows: int) -> DataFrame:
    """(words) of windows of some documents, without those that hold 30 percent of a template.

    Documents and windows are chosen by hashes, so only hashes are sorted and no
    copy is taken twice.
    """
    hashed = docs.where("text is not null").select(F.xxhash64("text").alias("h"), "text")
    chosen = hashed.select("h").distinct().orderBy("h").limit(sample_documents)
    some = hashed.join(F.broadcast(chosen), "h").dropDuplicates(["h"])  # a bounded number of hashes
    cuts = [_cut(_plain(F.col("text")), words, step) for words, step in SCALES]
    cut = some.select(F.explode(F.array_distinct(F.flatten(F.array(*cuts)))).alias("x"))
    words = cut.select(_words(F.col("x.text")).alias("words")).distinct()
    numbered = words.select(F.xxhash64("words").alias("key"), "words")
    some_windows = stored(numbered.orderBy("key").limit(sample_windows), "licence-windows")
    held = _contained(some_windows, ["key"], least=30)
    return some_windows.join(held, "key", "left_anti").select("words")


@dataclass(frozen=True)
class LicenceModel:
    """Weights of n-grams per class, intercepts, and the calibration of the margin."""

    classes: list[str]
    intercepts: list[float]
    weights: DataFrame  # ngram, w array<double>; at most ``most_features`` rows
    slope: float
    shift: float


def fit_licences(
    docs: DataFrame, sample_documents: int = 300, sample_windows: int = 4000, most_features: int = 4096
) -> LicenceModel:
    """Train on template variants and on at most ``sample_windows`` windows of ``sample_documents`` documents."""
    spark = docs.sparkSession
    classes = [*TEMPLATES, UNKNOWN]
    number = F.array_position(F.array(*map(F.lit, classes)), F.col("label")) - 1
    # A bounded table in one part, so that sums come out alike each time.
    examples = stored(
        _examples(docs, sample_documents, sample_windows)
        .select(number.cast("double").alias("label"), _features("words").alias("features_of"))
        .distinct()
        .withColumn("apart", F.pmod(F.xxhash64("features_of"), F.lit(5)) == 0)
        # Identifiers have few examples, all of them to learn from.
        .withColumn("apart", F.col("apart") & ~F.array_contains("features_of", "spdx"))
        .orderBy("label", "features_of")
        .coalesce(1),
        "licence-examples",
    )
    counter = CountVectorizer(
        inputCol="features_of", outputCol="features", vocabSize=most_features, minDF=2.0, binary=True
    ).fit(examples)
    vectors = counter.transform(examples)
    learner = LogisticRegression(
        family="multinomial", regParam=1e-3, maxIter=80, standardization=False
    )
    model = learner.fit(vectors.where("not apart or label < 0"))
    matrix, intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    # A class without an example in the training part has no row of weights.
    rows = [
        (ngram, [float(x) for x in matrix[:, i]]) for i, ngram in enumerate(counter.vocabulary)
    ]
    known = classes[: len(intercepts)]
    weights = spark.createDataFrame(rows, "ngram string, w array<double>")
    plain = LicenceModel(known, [float(x) for x in intercepts], weights, 1.0, 0.0)
    kept_out = examples.where("apart").select(
        F.monotonically_increasing_id().alias("key"), "label", F.col("features_of").alias("ngrams")
    )
    margins = _margins(kept_out, plain, ["key", "label"]).select(
        (F.col("label") < len(classes) - 1).cast("double").alias("label"),
        array_to_vector(F.array("margin")).alias("features"),
    )
    fitted = LogisticRegression(regParam=1e-3, maxIter=50, standardization=False).fit(margins.coalesce(1))
    return LicenceModel(
        known, plain.intercepts, weights, float(fitted.coefficients[0]), float(fitted.intercept)
    )


def _margins(examples: DataFrame, model: LicenceModel, keys: list[str]) -> DataFrame:
    """Adds the best family and its margin over unknown to rows of ``keys`` and n-grams."""
    found = examples.select(*keys, F.explode("ngrams").alias("ngram")).join(
        F.broadcast(model.weights), "ngram"  # a bounded number of n-grams
    )
    sums = [F.sum(F.get("w", F.lit(i))).alias(f"w{i}") for i in range(len(model.classes))]
    summed = found.groupBy(*keys).agg(*sums)
    scores = [F.col(f"w{i}") + b for i, b in enumerate(model.intercepts)]
    best = F.greatest(
        *[
            F.struct(score.alias("score"), F.lit(name).alias("family"))
            for name, score in zip(model.classes, scores)
            if name != UNKNOWN
        ]
    )
    unknown = scores[model.classes.index(UNKNOWN)]
    return summed.select(*keys, best.alias("best"), unknown.alias("none")).select(
        *keys, F.col("best.family").alias("family"), (F.col("best.score") - F.col("none")).alias("margin")
    )


def _template_pairs(spark: SparkSession) -> DataFrame:
    """(pair, family, number, n, least, required): the distinct word pairs of each template sentence.

    ``least`` is the percentage of them that a text must hold.
    """
    rows = []
    for family, number, words, required in templates():
        pairs = sorted({f"{a} {b}" for a, b in zip(words, words[1:])})
        least = 100 if words[0] == "spdx" else CONTAINED
        rows += [(pair, family, number, len(pairs), least, required) for pair in pairs]
    return spark.createDataFrame(
        rows, "pair string, family string, number int, n int, least int, required array<string>"
    )


def _contained(texts: DataFrame, keys: list[str], least: int | None = None) -> DataFrame:
    """(keys, family, contained, from, to) of rows of ``keys`` and ``words`` that hold a template sentence.

    ``from`` and ``to`` are the first and last of its words there. All its required words must be
    there, unless ``least`` percent of the pairs are to be enough.
    """
    held = F.array_intersect("words", F.array(*map(F.lit, REQUIRED)))
    pairs = texts.select(*keys, held.alias("held"), F.posexplode(_pairs("words")).alias("at", "pair"))
    whole = F.size(F.array_except("required", "held")) == 0
    counted = (
        pairs.join(F.broadcast(_template_pairs(texts.sparkSession)), "pair")  # a fixed number of rows
        .where(F.lit(True) if least is not None else whole)
        .groupBy(*keys, "family", "number", "n", "least")
        .agg(F.countDistinct("pair").alias("found"), F.min("at").alias("from"), (F.max("at") + 1).alias("to"))
        .withColumn("contained", F.floor(100 * F.col("found") / F.col("n")))
        .where(F.col("contained") >= (F.col("least") if least is None else F.lit(least)))
    )
    best = F.max(F.struct("contained", (-F.col("from")).alias("from"), "to")).alias("x")
    return (
        counted.groupBy(*keys, "family")
        .agg(best)
        .select(*keys, "family", "x.contained", (-F.col("x.from")).alias("from"), F.col("x.to").alias("to"))
    )


def licence_paragraphs(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(doc_id, row_no, paragraph, first, last, family, score, contained) of the runs of words that hold a licence.

    ``first`` and ``last`` number words of a paragraph from 0. ``score`` is the calibrated probability
    that a window over them names a licence at all, ``contained`` the percentage of a template sentence of the
    predicted family that it holds. Windows below ``threshold`` or below 60 percent are unknown and left
    out. Where runs of two families overlap, that with less of its template gives way, and so does a run
    that holds a shorter one with as much; other overlapping runs of one family are one.
    """
    model = fit_licences(docs)
    found = stored(windows(docs), "licence-windows")
    paragraph = ["doc_id", "row_no", "paragraph"]
    keys = ["row_no", "paragraph", "first", "wide"]
    judged = _margins(found.select("doc_id", *keys, _features("words").alias("ngrams")), model, ["doc_id", *keys])
    score = 1 / (1 + F.exp(-(F.col("margin") * model.slope + model.shift)))
    predicted = judged.withColumn("score", score).where(F.col("score") >= threshold)
    hits = (
        predicted.join(_contained(found, keys), [*keys, "family"])
        .select(
            *paragraph,
            (F.col("first") + F.col("from")).alias("first"),
            (F.col("first") + F.col("to")).alias("last"),
            "family",
            "score",
            "contained",
        )
        .groupBy(*paragraph, "first", "last", "family")
        .agg(F.max("score").alias("score"), F.max("contained").alias("contained"))
    )
    # A run is no longer than a window, so those that overlap it begin near it, a bounded number of them.
    near = Window.partitionBy(*paragraph).orderBy("first").rangeBetween(-WIDEST, WIDEST)
    around = F.collect_list(F.struct("first", "last", "family", "contained")).over(near)
    def outdone(y: Column) -> Column:
        """By more of another family's template, or by as much of the same in fewer words."""
        overlaps = (y["first"] <= F.col("last")) & (F.col("first") <= y["last"])
        inside = (y["first"] >= F.col("first")) & (y["last"] <= F.col("last"))
        shorter = y["last"] - y["first"] < F.col("last") - F.col("first")
        same = y["family"] == F.col("family")
        return F.when(same, inside & shorter & (y["contained"] >= F.col("contained"))).otherwise(
            overlaps & (y["contained"] > F.col("contained"))
        )

    gives_way = F.exists("around", outdone)
    kept = hits.withColumn("around", around).where(~gives_way).drop("around")
    order = Window.partitionBy(*paragraph, "family").orderBy("first", "last")
    before = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce(F.col("first") > F.col("before"), F.lit(True)).cast("int")
    return (
        kept.withColumn("before", before)
        .withColumn("run", F.sum(begins).over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*paragraph, "family", "run")
        .agg(
            F.min("first").alias("first"),
            F.max("last").alias("last"),
            F.max("score").alias("score"),
            F.max("contained").alias("contained"),
        )
        .select(*paragraph, "first", "last", "family", "score", "contained")
    )


def licence_scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_licences, families, score) per distinct doc_id of ``docs``.

    ``n_licences`` counts the runs of words that hold a licence, wrapped over lines or not.
    ``families`` lists the families found in any row of that id, sorted and
    joined by a comma, null if there is none; ``score`` is the highest of
    these, 0 if there is none. A null text has no paragraph; null ids are
    one document. An empty table gives an empty result. Other columns are not read.
    """
    found = (
        licence_paragraphs(docs)
        .groupBy("doc_id")
        .agg(
            F.count("*").alias("n_licences"),
            F.array_join(F.array_sort(F.collect_set("family")), ",").alias("families"),
            F.max("score").alias("score"),
        )
    )
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    same = ids["doc_id"].eqNullSafe(found["doc_id"])
    return ids.join(found, same, "left").select(
        ids["doc_id"],
        F.coalesce("n_licences", F.lit(0)).alias("n_licences"),
        "families",
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
