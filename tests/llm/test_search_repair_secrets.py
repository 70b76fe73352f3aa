"""Ranked search, conversation repair and secret scan against brute force and on edge cases."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from stratamart.llm import conversation_repair, lexical, secrets_scan
from stratamart.llm.common import table
from stratamart.llm.queries import QUERIES

# Ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_search(docs, items, top=10):
    held = [(doc_id, Counter(TERM.findall((text or "").translate(LOWER)))) for doc_id, text in docs]
    n_docs = sum(1 for _, terms in held if terms)
    n_terms = sum(sum(terms.values()) for _, terms in held)
    df = Counter(term for _, terms in held for term in terms)
    wanted = defaultdict(set)
    for item_id, text in items:
        wanted[item_id] |= set(TERM.findall((text or "").translate(LOWER)))
    found = []
    for item_id, terms in wanted.items():
        rows = []
        for doc_id, have in held:
            score = 0
            m = 10 + 90 * sum(have.values()) * n_docs // n_terms if have else 0
            for term in terms & have.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                score += w * (1_000_000_000 * have[term] // (1000 * have[term] + 8 * m))
            if score > 0:
                rows.append((-score, doc_id is None, doc_id))
        for rank, (score, _, doc_id) in enumerate(sorted(rows, key=lambda r: (r[0], r[1], r[2] or 0))[:top]):
            found.append((item_id, rank + 1, doc_id, -score))
    return sorted(found, key=repr)


def searched(spark, docs, items, **more):
    found = lexical.ranked_search(
        spark.createDataFrame(docs, "doc_id long, text string").withColumn("terms", F.lit(1)),
        spark.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit(1)),
        **more,
    )
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, found.collect()), key=repr)


def test_search_equals_brute_force_over_blocks(spark, monkeypatch):
    """Small blocks of documents and of queries, ties, repeated rows and common words."""
    draw = random.Random(3)
    words = ["the"] * 8 + ["Über", "x1", "Straße", "naïve"] + [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(draw.choices(words, k=draw.randint(0, 30)))) for i in range(300)]
    docs += [(i, "the w1 w2 w3") for i in range(400, 440)] + [(7, "the w1 w2 w3")] * 3
    docs += [(500, None), (501, ""), (None, "w1 w2 w3"), (None, "W1-w2_w3"), (502, "w9 " * 5000)]
    items = [(i, " ".join(draw.choices(words, k=12))) for i in range(12)]
    items += [(20, "W1, w2; w3"), (21, None), (22, "  ..."), (None, "w4"), (None, "w5"), (23, "unheard"), (20, "w1")]
    expected = brute_search(docs, items)
    assert searched(spark, docs, items) == expected
    monkeypatch.setattr(lexical, "DOCS_PER_BLOCK", 16)
    monkeypatch.setattr(lexical, "MASKS_AT_A_TIME", 2)
    monkeypatch.setattr(lexical, "PAIRS_PER_BLOCK", 20)
    monkeypatch.setattr(lexical, "TASKS_PER_SLICE", 1)
    assert searched(spark, docs, items) == expected
    assert searched(spark, docs, items, top=3) == brute_search(docs, items, 3)


def test_search_without_documents_or_items(spark):
    assert searched(spark, [], [(1, "a b")]) == []
    assert searched(spark, [(1, "a b")], []) == []
    assert searched(spark, [(1, None), (2, "...")], [(1, "a")]) == []


def test_search_scores_few_masks_of_a_block():
    """The descending bound ends the search long before all documents are scored."""
    draw = random.Random(5)
    terms = list(range(20))
    rows = []
    for doc in range(4000):
        some = sorted(draw.sample(terms, 3)) if doc >= 12 else terms
        rows.append({"doc_id": doc, "n": 100, "terms": some, "counts": [1] * len(some)})
    import pyarrow as pa

    batch = pa.Table.from_pylist(
        rows,
        pa.schema(
            [("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))]
        ),
    )
    block = lexical._Block(batch, (4000, 400_000))
    scored, scores = [], block.scores
    block.scores = lambda docs, weight: (scored.extend(docs), scores(docs, weight))[1]
    leaders = {0: lexical._Leaders(10)}
    import numpy as np

    lexical._score_block(block, [(1, np.arange(20))], np.full(20, 1000), leaders)
    assert sorted(leaders[0].ids) == list(range(10))
    assert len(scored) < 200


# Conversation repair

SPACE = " \t\n\x0b\x0c\r"


def damaged(rows):
    """The contract's damage, row by row."""
    found = []
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        found += [(conv_id, turn, role, text)] * (2 if kind == 3 else 1)
    return found


def faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        end = text.strip(SPACE)[-1:]
        fault = "b" if not end else "d" if (role, text) in seen else "n" if end in ".!?" else "t"
        seen.add((role, text))
        found.append(fault)
    return found


def brute_repair(rows):
    """(cost, audit, repaired rows) by trying all edits of a few rows in all ways."""
    marks = faults(rows)
    best = None

    def go(at, state, cost, audit, out, inserted):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", state):
            best = min(best or (cost, audit, out), (cost, audit, out))
        for role in ("user", "assistant") if inserted < 2 else ():
            if re.match("(s?(ua)*u?)$", state + role[0]):
                go(at, state + role[0], cost + 5, audit + "I", out + [(role, "")], inserted + 1)
        if at == len(rows):
            return
        _, role, text = rows[at]
        go(at + 1, state, cost + 2, audit + "D", out, 0)
        if marks[at] in "nt":
            extra = 5 if marks[at] == "t" else 0
            for letter, price, to in (("K", 0, role), ("R", 1, "user"), ("R", 1, "assistant")):
                if to and re.match("(s?(ua)*u?)$", state + to[0]):
                    go(at + 1, state + to[0], cost + price + extra, audit + letter, out + [(to, text)], 0)

    go(0, "", 0, "", [], 0)
    return best


def expected_report(rows):
    by_conversation = defaultdict(list)
    for conv_id, *_ in rows:
        by_conversation[conv_id] = []
    for conv_id, turn, role, text in damaged(rows):
        by_conversation[conv_id].append((turn, role, text))
    found = {}
    for conv_id, some in by_conversation.items():
        digest = lambda r: hashlib.md5(f"{len(r[1])}:{r[1]}:{r[2]}".encode()).digest()
        some.sort(key=lambda r: (r[0] is not None, r[0] or 0, digest(r)))
        turns = {r[0] for r in some if r[0] is not None}
        marks = Counter(faults(some))
        initials = [r[1][:1] for r in some]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, out = brute_repair(some)
        found[conv_id] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            marks["b"],
            marks["d"],
            marks["t"],
            illegal,
            cost,
            audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest(),
        )
    return found


def random_conversations():
    draw = random.Random(11)
    texts = ["Hello.", "What?", "cut off", "", " \n", "Fine!", "Why. ", None]
    roles = ["user", "assistant"] * 3 + ["system", "tool", "", None]
    rows = []
    for conv_id in [None, *range(120)]:
        for turn in range(draw.randint(1, 7)):
            turn = None if draw.random() < 0.05 else turn * draw.choice([1, 1, 1, 2])
            rows.append((conv_id, turn, draw.choice(roles), draw.choice(texts)))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("rows_per_task", [500_000, 25, 3])
def test_repair_equals_brute_force(spark, rows_per_task):
    """Also with ranges so short that conversations span many of them."""
    rows = random_conversations()
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"digest": F.lit(1), "audit": F.lit("x")})
    left = conversation_repair.damage(frame)
    report = conversation_repair.repair_report(left, frame.select("conv_id"), rows_per_task)
    found = {r[0]: tuple(r)[1:] for r in report.collect()}
    assert report.count() == len(found)
    expected = expected_report(rows)
    assert found == expected


def test_long_conversations_in_blocks_equal_one_block(spark):
    """A conversation with a third of all rows, most of them copies of one row."""
    draw = random.Random(2)
    rows = [(1, i, draw.choice(["user", "assistant", "system"]), draw.choice(["a.", "b", f"t{i}."])) for i in range(900)]
    rows += [(1, 5000, "user", "again.")] * 60
    rows += [(c, i, "user", f"x{i}.") for c in range(2, 400) for i in range(3)]
    frame = spark.createDataFrame(rows, SCHEMA)
    whole = {r.conv_id: r for r in conversation_repair.repair_report(frame).collect()}
    parts = {r.conv_id: r for r in conversation_repair.repair_report(frame, rows_per_task=100).collect()}
    assert whole == parts
    lines = defaultdict(list)
    for r in sorted(conversation_repair.repaired_rows(frame, 100).collect()):
        assert r.place == len(lines[r.conv_id])
        lines[r.conv_id].append(f"{r.role}:{r.text}")
    for conv_id, r in whole.items():
        assert hashlib.sha256("\n".join(lines[conv_id]).encode()).hexdigest() == r.repaired_sha256
    initials = "".join(line[0] for line in lines[1])
    assert re.fullmatch("(s?(ua)+)?", initials)


def test_checkpoints_are_few_and_walks_are_least():
    """All symbol strings of up to four rows against every sequence of edits."""
    symbols = list(conversation_repair.SYMBOLS.values())
    draw = random.Random(4)
    some = ["".join(s) for n in range(3) for s in itertools.product(symbols, repeat=n)]
    some += ["".join(draw.choices(symbols, k=draw.randint(3, 6))) for _ in range(300)]
    for word in some:
        rows, k = [], 0
        for initial, fault in map(conversation_repair.ROW_OF.__getitem__, word):
            k += 1
            role = {"s": "system", "u": "user", "a": "assistant", "-": "tool"}[initial]
            rows.append((k, role, {"n": f"{k}.", "t": f"{k}", "b": "", "d": f"{k}."}[fault]))
        if "d" in [conversation_repair.ROW_OF[s][1] for s in word]:
            continue  # a duplicate needs an earlier row; the random rows above have them
        cost, audit, _ = brute_repair(rows)
        assert conversation_repair.cheapest_audit(word) == audit
        assert conversation_repair.backward(word, conversation_repair.END)[0][0] == cost
    long = "".join(draw.choices(symbols, k=10_000))
    _, kept = conversation_repair.backward(long, conversation_repair.END)
    assert len(kept) <= 102


def test_repair_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert conversation_repair.repair_report(empty).count() == 0
    ids = spark.createDataFrame([(3,), (None,)], "conv_id long")
    nothing = hashlib.sha256(b"").hexdigest()
    rows = conversation_repair.repair_report(empty, ids).collect()
    assert {tuple(r) for r in rows} == {(i, 0, 0, 0, 0, 0, 0, "", nothing) for i in (3, None)}
    assert conversation_repair.repaired_rows(empty).count() == 0


def test_repair_query_gives_every_conversation(spark, small):
    found = QUERIES["op12_conversation_repair"](spark, small).collect()
    rows = [tuple(r) for r in table(spark, small, "conversations").select("conv_id", "turn", "role", "text").collect()]
    expected = expected_report(rows)
    assert {r[0]: tuple(r)[1:] for r in found} == expected and len(found) == len(expected)


# Secrets


def base_of(text):
    """(kind, start, stop) of the contract's patterns, read literally."""
    found = []
    assign = r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(assign, text):
        if len(m[2]) >= 6:
            found.append(("assign", *m.span()))
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    kinds = ["assign", "access", "hex"]
    return sorted(found, key=lambda s: (s[1], kinds.index(s[0])))


def check_digests(rows, texts):
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in texts)
    expected = Counter()
    for doc_id, text in texts:
        base = base_of(text or "")
        kinds = Counter(kind for kind, *_ in base)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        digest = hashlib.sha256(joined.encode()).hexdigest()
        expected[doc_id, kinds["assign"], kinds["access"], kinds["hex"], digest] += 1
    assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in rows) == expected
    of = {(i, t or "") for i, t in texts}
    for r in rows:
        spans = [tuple(s.split(":")) for s in r.spans.split(",")] if r.spans else []
        kept = {s for s in spans if s[0] != "token"}
        assert any(kept == {(k, str(a), str(b)) for k, a, b in base_of(t)} for i, t in of if i == r.doc_id)


LIVE = "q7Xk29PzLm4Tn8Rb1Wc5"
COPIED = "Zk81mQx0Vt55Bn3Hs9Ty"


def test_secrets_equal_brute_force_and_ownership_settles_tokens(spark):
    draw = random.Random(9)
    pieces = ["token", "api-key", "APIKEY", "api_key", "Secret", "passwd", "paſſword", '"', "'", " ", "  ", ":", "=", "ab", "abcdef", "AKIA", "AKIA" * 3, "ABCDEFGH12345678", "0123456789abcdef", "é", "\n", "-", "x=y", "."]
    texts = [(i, "".join(draw.choices(pieces, k=draw.randint(0, 40)))) for i in range(400)]
    texts += [(None, None), (1000, ""), (1000, ""), (1001, f"say {LIVE} here"), (1002, f"é {LIVE}")]
    texts += [(1100 + i, f"see {COPIED}, and token = '{COPIED}'") for i in range(6)]
    rows = [(i, t, f"own{i % 4}" if i and i >= 1100 else "one", "x") for i, t in texts]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, spans string")
    judged = secrets_scan.secret_spans(docs)
    found = secrets_scan.secret_digests(judged).collect()
    check_digests(found, texts)
    by_id = {r.doc_id: r for r in found}
    assert by_id[1001].spans == "token:4:24" and by_id[1002].spans == "token:2:22"
    assert by_id[1001].n_live == 1 and by_id[1001].n_assign == 0
    assert by_id[1100].spans == "assign:30:59" and by_id[1100].n_example == 1 and by_id[1100].n_live == 0
    spans = {r.doc_id: r.spans for r in judged.collect()}
    assert [(s.repositories, s.owners, s.occurrences) for s in spans[1001]] == [(2, 1, 2)]
    assert [(s.repositories, s.owners, s.occurrences) for s in spans[1100]] == [(6, 4, 12)]


def test_a_value_in_a_third_of_all_rows_is_looked_up_apart(spark, monkeypatch):
    monkeypatch.setattr(secrets_scan, "EVERYWHERE", 5)
    rows = [(i, f"token: {LIVE}" if i % 3 == 0 else f"token: v{i}abcd", "one") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = secrets_scan.secret_spans(docs).collect()
    assert all(len(r.spans) == 1 for r in found) and len(found) == 300
    assert {r.spans[0].occurrences for r in found} == {1, 100}


def test_secrets_by_named_repositories(spark):
    rows = [(1, f"x {LIVE}", "a", "r1"), (2, f"y {LIVE}", "b", "r1"), (3, f"z {LIVE}", "c", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, repo string")
    found = secrets_scan.ownership(secrets_scan.find_spans(docs, "repo")).collect()
    assert [(r.spans, r.repositories, r.owners, r.verdict) for r in found] == [(3, 2, 3, "example")]
    assert all(r.spans == [] for r in secrets_scan.secret_spans(docs, "repo").collect())
    assert secrets_scan.secret_spans(docs.where("false")).count() == 0


def test_secret_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    found = QUERIES["op13_secret_ownership"](spark, folder).collect()
    texts = [tuple(r) for r in table(spark, folder, "documents").select("doc_id", "text").collect()]
    check_digests(found, texts)
    assert sum(r.n_assign for r in found) > 5
