"""Near copies, vector links and components against brute force."""

import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratamart.llm import jaccard
from stratamart.llm.components import components
from stratamart.llm.jaccard import choose_matches, jaccard_components
from stratamart.llm.shingles import Shingler, common_counts
from stratamart.llm.vector_links import CapCodes, vector_links


def smallest(n, links):
    """The smallest of the numbers that links reach, by number."""
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def shingle_set(text):
    words = [w.lower() if w.isascii() else w for w in (text or "").split()]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_components(rows):
    sets = [shingle_set(text) if i is not None else set() for i, text in rows]
    links = []
    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            alike = common and 100 * common >= 80 * len(sets[a] | sets[b])
            same_id = sets[a] and sets[b] and rows[a][0] == rows[b][0]
            if alike or same_id:
                links.append((a, b))
    groups = smallest(len(rows), links)
    ids = {}
    for group, (i, _) in zip(groups, rows):
        if i is not None:
            ids[group] = min(i, ids.get(group, i))
    return sorted(
        (i if i is not None else -1, len(shingle_set(text)), ids[g] if i is not None else -1)
        for (i, text), g in zip(rows, groups)
    )


def edited(text, share, seed):
    rng = random.Random(seed)
    words = text.split()
    for _ in range(int(share * len(words))):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def written(seed, n=120):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(3000)}" for _ in range(n))


def near_copy_rows():
    passage = written("passage", 60)
    rows = [(i, f"{written(i)} {passage} {written(i + 1000)}") for i in range(20)]
    rows += [(100 + i, edited(written("base"), (i % 7) / 100, i)) for i in range(60)]
    rows += [(200 + i, edited(written(f"pair{i // 2}"), 0.02 * (i % 2), i)) for i in range(20)]
    rows += [(300 + i, written("copied")) for i in range(30)]
    rows += [(400, ""), (401, None), (402, "one"), (403, "ONE"), (404, "one two"), (None, "one")]
    rows += [(None, written("copied")), (5, rows[5][1]), (6, "another text under the id of six")]
    rows += [(500, " \t" + written("copied").upper() + "\n"), (501, written("long", 9000))]
    return rows


@pytest.mark.parametrize("block, frequent", [(128, 10_000), (4, 10)])
def test_near_copies_equal_brute_force(spark, monkeypatch, block, frequent):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    rows = near_copy_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS node", "'x' AS set_key", "2 AS component"
    )
    found = jaccard_components(docs).collect()
    none = lambda x: -1 if x is None else x
    assert sorted(
        (none(r.doc_id), r.n_shingles, none(r.component_id)) for r in found
    ) == brute_components(rows)


def test_no_documents_no_components(no_docs):
    assert jaccard_components(no_docs).count() == 0


def test_shingles_ignore_case_and_space():
    s = Shingler()
    assert (s.shingles("A b\tC d\x0be F") == s.shingles(" a B c D e f\n")).all()
    assert len(s.shingles("a b c d")) == 1 and len(s.shingles("a b c d e f")) == 2
    assert s.shingles("a b c d")[0] != s.shingles("a b c")[0]
    assert len(s.shingles(None)) == len(s.shingles(" \n")) == 0


def test_common_counts_by_columns():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, n)).astype(np.uint64) for n in (5, 40, 0, 30)]
    expected = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    assert common_counts(sets, sets, columns=7).tolist() == expected


@pytest.mark.parametrize("n", [1, 4, 5, 80, 700])
def test_matches_stay_possible(n):
    needed = -(-80 * n // 100)
    base = n - needed + 1
    rare = choose_matches(np.zeros(n), n, base, needed)
    often = choose_matches(np.full(n, 500.0), n, base, needed)
    assert 1 <= rare <= min(needed, jaccard.MOST_MATCHES)
    assert 1 <= often <= min(needed, jaccard.MOST_MATCHES)


def test_components_of_long_chains(spark):
    pairs = [(i, i + 1) for i in range(60)] + [(200, 100), (100, 300), (7, 7), (400, 401), (400, 401)]
    found = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    expected = {i: 0 for i in range(61)} | {100: 100, 200: 100, 300: 100, 400: 400, 401: 400}
    assert {r.node: r.component for r in found} == expected and len(found) == len(expected)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def vectors():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((12, 24))
    rows = []
    for i in range(240):
        noise = rng.standard_normal(24) * (0.02 + 0.25 * (i % 5 == 0))
        rows.append((i, (centres[i % 12] + noise).tolist()))
    same = rows[0][1]
    rows += [(300 + i, same) for i in range(40)] + [(350, [2 * x for x in same])]
    rows += [(400, None), (401, []), (402, [0.0] * 24), (403, [float("nan")] * 24), (404, [1.0] * 23)]
    rows += [(405, [None] + [1.0] * 23), (406, [float("inf")] * 24), (None, same), (300, same)]
    return rows


def wide_vectors():
    """Equal, near and unlike vectors of five widths, with lengths near both ends of doubles."""
    rng = np.random.default_rng(4)
    rows = []
    for width in (1, 3, 24, 60, 1500):
        centres = rng.standard_normal((3, width))
        for i in range(30):
            v = centres[i % 3] + rng.standard_normal(width) * 0.02
            rows.append((1000 * width + i, (v * [1.0, 1e200, 1e-300][i // 10]).tolist()))
    rows += [(1, [1e200] * 32), (2, [1e200] * 32), (3, [1.5e308] * 32), (4, [5e-324] * 32)]
    return rows + [(5, [1.0] * 7), (6, [0.0] * 32), (7, [float("inf")] + [1.0] * 31)]


def brute_links_by_width(rows):
    def direction(v):
        return np.array([Fraction(x) / Fraction(max(map(abs, v))) for x in v], np.float64)

    found = []
    for width in {len(v) for _, v in rows}:
        here = [(i, v) for i, v in rows if len(v) == width]
        fine = [bool(np.isfinite(v).all() and any(v)) for _, v in here]
        unit = np.array([direction(v) / np.linalg.norm(direction(v)) if ok else [np.nan] * width for ok, (_, v) in zip(fine, here)])
        alike = unit @ unit.T >= 0.95
        np.fill_diagonal(alike, False)
        groups = smallest(len(here), list(zip(*np.nonzero(alike))))
        least = {}
        for group, (i, _) in zip(groups, here):
            least[group] = min(i, least.get(group, i))
        found += [(i, int(alike[k].sum()), least[groups[k]]) for k, (i, _) in enumerate(here)]
    return sorted(found)


def brute_links(rows):
    usable = [
        i is not None
        and v is not None
        and len(v) == 24
        and all(x is not None and np.isfinite(x) for x in v)
        and any(v)
        for i, v in rows
    ]
    unit = np.array([np.array(v) / np.linalg.norm(v) if ok else [np.nan] * 24 for ok, (_, v) in zip(usable, rows)])
    alike = unit @ unit.T >= 0.95
    np.fill_diagonal(alike, False)
    groups = smallest(len(rows), list(zip(*np.nonzero(alike))))
    ids = {}
    for group, (i, _) in zip(groups, rows):
        if i is not None:
            ids[group] = min(i, ids.get(group, i))
    return sorted(
        (-1 if i is None else i, int(alike[k].sum()), -1 if i is None else ids[groups[k]])
        for k, (i, _) in enumerate(rows)
    )


@pytest.mark.parametrize("block", [256, 16])
def test_vector_links_equal_brute_force(spark, monkeypatch, block):
    from stratamart.llm import vector_links as module

    monkeypatch.setattr(module, "BLOCK", block)
    rows = vectors()
    given = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn(
        "node", F.lit("clash")
    )
    found = vector_links(given).collect()
    none = lambda x: -1 if x is None else x
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert sorted((none(r.vec_id), r.n_links, none(r.component_id)) for r in found) == brute_links(exact)
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in found)
    assert vector_links(given.where("false")).count() == 0


def test_vectors_of_every_width_and_length_are_linked(spark):
    rows = wide_vectors()
    given = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted((r.vec_id, r.n_links, r.component_id) for r in vector_links(given).collect())
    expected = brute_links_by_width(rows)
    # Between 1e200 and 1e-300 small components of the latter lose digits, but no direction.
    assert found == expected and sum(n for _, n, _ in found) > 1000
    assert [f[:2] for f in found[:7]] == [(1, 3), (2, 3), (3, 3), (4, 3), (5, 0), (6, 0), (7, 0)]


@pytest.mark.parametrize("width", [64, 1500])
def test_recall_at_the_threshold(width):
    rng = np.random.default_rng(9)
    a = rng.standard_normal((2000, width))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((2000, width))
    b -= (b * a).sum(1, keepdims=True) * a
    b = 0.95 * a + np.sqrt(1 - 0.95**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    codes = CapCodes.fitting(50_000, width)
    met = [set(x) & set(y) for x, y in zip(codes.filters(a).tolist(), codes.filters(b).tolist())]
    assert np.mean([bool(m) for m in met]) >= 0.99
