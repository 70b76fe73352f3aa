"""Classifiers, rules, licences, token files and mixing on edge cases and against brute force."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.orc
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stratamart.llm import compression_quality, licences, mixing, quality_rules, token_orc, toxicity
from stratamart.llm.common import table
from stratamart.llm.queries import ORACLES, QUERIES, vocabulary_path
from stratamart.llm.tokens import WordCoder, vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# Classifiers


@pytest.mark.parametrize(
    "scores", [compression_quality.quality_scores, toxicity.toxicity_scores]
)
def test_classifiers_score_every_row(docs, no_docs, labels, scores):
    rows = scores(docs, labels).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in docs.collect())
    assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
    for r in rows:
        held_out = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
        assert r.held_out == held_out
    by_text = {}
    for r, text in zip(
        sorted(rows, key=lambda r: (r.doc_id or 0, r.score)),
        sorted(docs.collect(), key=lambda d: d.doc_id or 0),
    ):
        by_text.setdefault(text.text or "", set()).add(r.score)
    assert len(by_text[""]) == 1
    assert scores(no_docs, labels).count() == 0
    assert {r.score for r in scores(docs, labels.where("false")).collect()} == {0.5}
    one_kind = labels.withColumn("quality", F.lit(1)).withColumn("toxic", F.lit(1))
    assert {r.score for r in scores(docs, one_kind).collect()} == {1.0}


@pytest.mark.parametrize(
    "scores, label, least",
    [
        (compression_quality.quality_scores, "quality", 0.85),
        (toxicity.toxicity_scores, "toxic", 0.85),
    ],
)
def test_classifiers_are_right_on_held_out_rows(spark, scores, label, least):
    folder = "/root/testdata/sf0.01"
    labels = table(spark, folder, "labels")
    rows = (
        scores(table(spark, folder, "documents"), labels)
        .where("held_out")
        .join(labels, "doc_id")
        .collect()
    )
    right = sum(r.predicted == r[label] for r in rows)
    assert rows and right / len(rows) >= least


def test_ngrams_stay_inside_words():
    assert set(toxicity.ngram_buckets("abc def")) == set(
        np.concatenate([toxicity.ngram_buckets("abc"), toxicity.ngram_buckets("DEF, def")])
    )
    assert len(toxicity.ngram_buckets("")) == len(toxicity.ngram_buckets(None)) == 0


# Quality rules


def counts(text):
    words = WORD.findall(text or "")
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_lines": len(lines),
        "n_stop_words": sum(w.lower() in quality_rules.STOP_WORDS for w in words),
    }


def test_counts_equal_brute_force(spark, docs, no_docs):
    more = spark.createDataFrame(
        [(100 + i, text) for i, text in enumerate(
            ["a b c d e " * 7, "x # * $ % & | < > y", "\t\n\x0b\x0c\r ", "a\x00b   c\x1cd é",
             "Läuft … und\nLäuft … und\n läuft ...", "p q r s t u p q r s t v w x y z"]
        )],
        "doc_id long, text string",
    )
    given = docs.select("doc_id", "text").unionByName(more)
    texts = [r.text for r in given.collect()]
    found = quality_rules.quality_rules(given.withColumn("n_words", F.lit("clash"))).collect()
    key = lambda c: sorted(c.items())
    expected = sorted(key(counts(t)) for t in texts)
    names = list(counts(""))
    assert sorted(key({n: r[n] for n in names}) for r in found) == expected
    for r in found:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and not r.broken_rules)
    assert quality_rules.quality_rules(no_docs).count() == 0


def test_rules_run_no_python(spark, small):
    for name in ("op2_quality_rules", "op5_licence_scan"):
        plan = QUERIES[name](spark, small)._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


# Licences


def test_every_template_is_found(spark, docs, no_docs):
    assert all(set(required) & set(licences.ANCHORS) for *_, required in licences.templates())
    assert all(len(words) <= max(w - s + 1 for w, s in licences.SCALES) for _, _, words, _ in licences.templates())
    sentences = [s for family in licences.TEMPLATES.values() for s in family]
    rows = [(1000 + i, f"some text\n{s}.\nmore text") for i, s in enumerate(sentences)]
    rows += [(2000, "the licence of the poet, and a license to speak"), (2001, "permission"), (2002, None)]
    given = docs.select("doc_id", "text").unionByName(
        spark.createDataFrame(rows, "doc_id long, text string")
    )
    found = {r.doc_id: r for r in licences.licence_scan(given.withColumn("score", F.lit(1))).collect()}
    number = 0
    for family, all_of in licences.TEMPLATES.items():
        for _ in all_of:
            assert family in (found[1000 + number].families or ""), number
            number += 1
    assert found[2000].families is found[2001].families is found[2002].families is None
    assert len(found) == given.select("doc_id").distinct().count()
    assert licences.licence_scan(no_docs).count() == 0


WRAPPED = [
    ("BSD", """/*
 * Copyright (c) 2019, A. Author
 * All rights reserved.
 *
 * Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions are met:
 */"""),
    ("ISC", """# Permission to use, copy, modify, and/or distribute this software for any
# purpose with or without fee is hereby granted, provided that the above
# copyright notice and this permission notice appear in all copies."""),
    ("MIT", """Permission is hereby granted,
free of charge, to any
person obtaining a copy of
this software and associated
documentation files"""),
    ("Apache-2.0", "some text before\n// SPDX-License-Identifier: Apache-2.0\nint main"),
    ("GPL", "/* SPDX-License-Identifier: GPL-2.0-only */"),
    ("CC-BY-SA", "the words are\nlicensed under CC BY-\nSA 4.0 by all"),
    (None, "// SPDX-License-Identifier: Zlib"),
    (None, "Redistribution and use in source and binary forms, with or without\n\nmodification, are permitted"),
]


def test_wrapped_licences_are_found(spark, docs):
    rows = [(1000 + i, text) for i, (_, text) in enumerate(WRAPPED)]
    given = docs.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    found = {r.doc_id: r for r in licences.licence_scan(given).collect()}
    assert [found[i].families for i, _ in rows] == [family for family, _ in WRAPPED]
    assert all(found[i].n_licences == (found[i].families is not None) for i, _ in rows)


def test_licence_headers_are_no_counter_examples(spark):
    """A third of the documents carry a header of their own."""
    def text(i):
        header = f"Copyright {1990 + i % 30} Name{i} Surname{i * 7}. Licensed under the MIT License\n"
        return (header if i % 3 == 0 else "") + f"a story of {i} cats\nand {i * 3} dogs that were at home"

    given = spark.createDataFrame([(i, text(i)) for i in range(240)], "doc_id long, text string")
    found = licences.licence_scan(given).collect()
    assert {r.doc_id for r in found if r.families == "MIT"} == set(range(0, 240, 3))
    assert all(r.families in (None, "MIT") for r in found)
    unknown = licences._examples(given, 300).where(F.col("label") == licences.UNKNOWN)
    assert unknown.where("array_contains(words, 'copyright') and array_contains(words, 'mit')").count() == 0


NO_LICENCES = [
    "You may not use this file except in compliance with the house rules",
    "It is permitted to use, copy, modify, and distribute this leaflet for any purpose; leave is hereby granted by the mayor",
    "Our product is not licensed under the MIT License",
    "The poem was never released under the MIT License, nor will it be.",
    "This work isn't licensed under the GNU General Public License, version 3",
]


def test_near_misses_and_denials_are_unknown(spark, docs):
    rows = [(1000 + i, text) for i, text in enumerate(NO_LICENCES)]
    given = docs.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    found = {r.doc_id: r.families for r in licences.licence_scan(given).collect()}
    assert [found[i] for i, _ in rows] == [None] * len(rows)


def _in_lines(text, width):
    words = text.split()
    return "\n".join(" ".join(words[i : i + width]) for i in range(0, len(words), width))


def test_neither_line_length_nor_wrapping_hides_a_licence(spark, docs):
    grants = [
        ("MIT", licences.TEMPLATES["MIT"][2]),
        ("BSD", licences.TEMPLATES["BSD"][2]),
        ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ]
    story = "a story of many cats and dogs that went to see the sea in spring".split()
    prose = lambda n: " ".join(story[i % len(story)] for i in range(n))
    rows = []
    for family, grant in grants:
        rows += [(family, _in_lines(grant, width)) for width in (1, 2, 3, 5)]
        rows += [(family, f"{prose(before)} {grant} {prose(5000 - before)}") for before in (0, 1, 7, 400, 4999)]
    both = f"{prose(300)} {grants[0][1]} {grants[2][1]} {prose(300)}"
    rows.append(("Apache-2.0,MIT", both))
    numbered = [(1000 + i, text) for i, (_, text) in enumerate(rows)]
    given = docs.select("doc_id", "text").unionByName(spark.createDataFrame(numbered, "doc_id long, text string"))
    found = {r.doc_id: r for r in licences.licence_scan(given).collect()}
    assert [found[i].families for i, _ in numbered] == [family for family, _ in rows]


def test_a_paragraph_of_many_licence_lines(spark, docs):
    """Each line is a run of its own, but that the first, in no window with words before it, is judged unknown."""
    line = "Licensed under the MIT License by the author of the story of many cats and dogs at the sea"
    given = spark.createDataFrame([(1, "\n".join([line] * 500))], "doc_id long, text string")
    (found,) = licences.licence_scan(given.unionByName(docs.select("doc_id", "text"))).where("n_licences > 0").collect()
    assert (found.doc_id, found.families) == (1, "MIT")
    assert found.n_licences in (499, 500)


def brute_contained(words):
    """{family: percent} of the templates that a list of words holds, with their required words."""
    held = {}
    for family, _, template, required in licences.templates():
        pairs = set(zip(template, template[1:]))
        share = 100 * len(pairs & set(zip(words, words[1:]))) // len(pairs)
        if share >= (100 if template[0] == "spdx" else 60) and set(required) <= set(words):
            held[family] = max(held.get(family, 0), share)
    return held


def test_windows_and_containment_equal_brute_force(spark, docs):
    rows = [(i, text) for i, (_, text) in enumerate(WRAPPED)]
    rows += [(100 + i, f"one two three {' '.join(s.split()[: 3 + i % 9])} four five") for i, s in enumerate(
        s for all_of in licences.TEMPLATES.values() for s in all_of
    )]
    given = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    cut = licences.windows(given)
    found = {(r.doc_id, r.paragraph, r.first, r.wide): r.words for r in cut.collect()}
    expected = {}
    for doc_id, text in rows:
        for number, paragraph in enumerate(re.split(r"\n[^\w\n]*(?=\n)", text)):
            words = licences.tokens(paragraph)
            for wide, step in licences.SCALES:
                for first in range(0, len(words), step):
                    if set(words[first : first + wide]) & set(licences.ANCHORS):
                        expected[doc_id, number, first, wide] = words[first : first + wide]
    assert found == expected
    keys = ["doc_id", "paragraph", "first", "wide"]
    held = {}
    for r in licences._contained(cut, keys).collect():
        held.setdefault((r.doc_id, r.paragraph, r.first, r.wide), {})[r.family] = r.contained
    assert held == {key: h for key, words in expected.items() if (h := brute_contained(words))}


# Token files


ODD = [
    "", None, ".", "A", "a.. b., 1. it's DON'T x<|endoftext|>y <|STARTOFTEXT|> é. J̌",
    "İstanbul ΑΣ. naïve a b\u0085c \x1cq 中文。 ﬁne ǅ ß. 😀, ½. ², Ⅷ. ª. ʰ,", "x" * 200 + "!!",
]


def test_words_code_like_whole_texts(small):
    coder = WordCoder(vocabulary(vocabulary_path()))
    for text in ODD + ["Some words, again; some (words)! " * 50]:
        ids = coder.tokenizer.encode(text or "", add_special_tokens=False).ids
        assert coder.encode(text) == np.array(ids, "<u4").tobytes()


def test_token_files_round_trip(spark, docs, no_docs, folder):
    more = spark.createDataFrame([(50 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    given = docs.select("doc_id", "text").unionByName(more)
    token_orc.write_tokens(given, f"{folder}/t", vocabulary_path(), 2, bytes_per_file=4000)
    found = token_orc.token_digests(token_orc.read_tokens(spark, f"{folder}/t")).collect()
    tokenizer = Tokenizer.from_file(vocabulary_path())
    rows = sorted(((r.doc_id, r.text or "") for r in given.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    expected, start = [], 0
    for doc_id, text in rows:
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [2]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected
    some = token_orc.read_tokens(spark, f"{folder}/t", [6])
    assert "PushedFilters: [In(doc_id" in some._jdf.queryExecution().toString() or some.count() == 1
    file = some.inputFiles()[0].removeprefix("file:")
    assert pyarrow.orc.ORCFile(file).nstripes >= 1
    token_orc.write_tokens(no_docs, f"{folder}/none", vocabulary_path(), 2)
    assert token_orc.read_tokens(spark, f"{folder}/none").count() == 0


# Mixing


def brute_mix(rows):
    """{(doc_id, source, size): (target, copies)} by serving one document after the other."""
    import hashlib

    entries = Counter(rows)
    size = {e: len(WORD.findall(e[1] or "")) * n for e, n in entries.items()}
    names = sorted({e[2] for e in entries}, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total = {s: sum(v for e, v in size.items() if e[2] == s) for s in names}
    budget = 1.5 * sum(total.values())
    left, open_sources, target = budget, set(names), {}
    while open_sources:
        level = left / sum(weight[s] for s in open_sources)
        full = [s for s in open_sources if 2 * total[s] < level * weight[s]]
        if not full:
            target |= {s: level * weight[s] for s in open_sources}
            break
        for s in full:
            target[s] = 2.0 * total[s]
            left -= target[s]
        open_sources -= set(full)
    queue = []
    for s in names:
        mine = [e for e in entries if e[2] == s and size[e]]
        text_key = lambda e: f"{mixing.SEED}/{e[0]}" if e[0] is not None else mixing.SEED
        mine.sort(key=lambda e: hashlib.md5(text_key(e).encode()).hexdigest())
        served = 0
        for copy in range(2):
            for e in mine:
                served += size[e]
                queue.append((served / weight[s], names.index(s), copy, e))
    copies, used = Counter(), 0
    for *_, e in sorted(queue, key=lambda q: q[:3]):
        if used + size[e] > budget:
            break
        used += size[e]
        copies[e] += 1
    return {e: (target[e[2]], copies[e]) for e in entries}


def test_mix_equals_brute_force(spark, docs, no_docs):
    more = spark.createDataFrame(
        [(200 + i, "w " * (i * 7 % 40), "src%d" % (i % 5)) for i in range(120)],
        "doc_id long, text string, source string",
    )
    given = docs.select("doc_id", "text", "source").unionByName(more)
    rows = [tuple(r) for r in given.collect()]
    expected = brute_mix(rows)
    found = mixing.mix(given.withColumn("target", F.lit("clash"))).collect()
    assert len(found) == len(rows)
    by_id = {(e[0], e[2]): v for e, v in expected.items()}
    for r in found:
        target, copies = by_id[(r.doc_id, r.source)]
        assert math.isclose(r.target, target, rel_tol=1e-9) and r.copies == copies
        assert r.taken == copies * r["size"]
    assert mixing.mix(no_docs).count() == 0


# Queries


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, small, name):
    from compare import connect, differences

    assert differences(QUERIES[name](spark, small), connect(small), ORACLES[name]) == []
