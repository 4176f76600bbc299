"""Filter audit, conversation trie and vector tree against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest

from tests.llm.conftest import ODD, sentence, split_words
from wanderbeam.llm import conversation_trie, filter_audit, vector_tree

LABELS = "doc_id long, quality int, toxic int"


def brute_fails(docs):
    smallest = {}
    for i, text in docs:
        if i is not None:
            smallest[text or ""] = min(i, smallest.get(text or "", i))
    out = []
    for i, text in docs:
        body, words = text or "", split_words(text)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in body) > 10 * len(body),
            "D": any(c in "#$%&*|" for c in body),
            "E": i is not None and smallest[body] < i,
        }
        out.append({c for c, x in fails.items() if x})
    return out


def brute_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    fails = brute_fails([(i, t) for i, t, _ in rows])
    out = {}
    for part in {lang or "" for _, _, lang in rows}:
        mine = [(rows[k][0], fails[k]) for k in range(len(rows)) if (rows[k][2] or "") == part]
        shapley = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, c in enumerate(order, 1):
                gone = [m for m in left if c in m[1]]
                left = [m for m in left if c not in m[1]]
                shapley[c] += len(gone)
                failing = [m for m in mine if c in m[1]]
                out[part, order, step] = [
                    len(left),
                    len(gone),
                    len(failing) - len(gone),
                    sum(m[1] == {c} for m in mine),
                    sum(m[0] in good for m in gone),
                    sum(m[0] in toxic for m in gone),
                ]
        for (p, order, step), values in out.items():
            if p == part:
                values.append(shapley[order[step - 1]])
    return out


@pytest.fixture
def audited(spark):
    def run(rows, labels, extra=False):
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        if extra:
            for name in ("n", "first", "digest", "mask", "part", "quality", "toxic", "own", "i"):
                docs = docs.selectExpr("*", f"'x' as `{name}`")
        marks = spark.createDataFrame(labels, LABELS)
        got = filter_audit.filter_audit(docs, marks).collect()
        names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
        found = {(r.part, r.filter_order, r.step): [r[c] for c in names] for r in got}
        assert len(found) == len(got)
        return found

    return run


def test_audit_matches_brute_force(audited):
    rng = random.Random(5)
    rows = [(i, t, "en") for i, t in ODD] + [(50, "", None), (51, None, None), (52, "Upper CASE", "de")]
    for i in range(60):
        text = sentence(rng, rng.choice([3, 99, 100, 130]), vocabulary=rng.choice([40, 5000]))
        text = text.upper() if i % 7 == 0 else text + " 50% &" if i % 5 == 0 else text
        rows.append((100 + i, text, rng.choice(["en", "fr", None])))
        if i % 3 == 0:
            rows.append((rng.choice([i, 300 + i]), text, rng.choice(["en", "fr"])))
    labels = [(r[0], rng.choice([0, 1, None]), rng.choice([0, 1, None])) for r in rows for _ in range(rng.choice([0, 1, 2]))]
    assert audited(rows, labels, extra=True) == brute_audit(rows, labels)


def test_audit_with_a_third_of_copies_and_a_very_long_text(audited):
    rng = random.Random(6)
    long = " ".join(f"w{k}" for k in range(300_000))
    rows = [(i, "the same text in every third row", "en") for i in range(0, 300, 3)]
    rows += [(i, sentence(rng, 120, 5000), "en") for i in range(1, 300, 3)] + [(1000, long, "en"), (1001, long, "en"), (1002, long + " x", "en")]
    assert audited(rows, []) == brute_audit(rows, [])


def test_audit_without_documents(audited):
    assert audited([], []) == {}


def test_sketch_clears_unique_texts_and_never_a_copy(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "concat('text ', id % 3600) as text", "'en' as lang").repartition(7)
    facts = filter_audit.text_facts(docs).collect()
    copies = [r for r in facts if r.doc_id % 3600 < 400]
    assert all(r.text is not None and r.digest is not None for r in copies)
    assert sum(r.text is not None for r in facts) - len(copies) < 100


def test_sketch_beyond_its_bound_loses_nothing(audited, monkeypatch):
    monkeypatch.setattr(filter_audit, "MOST_CELLS", 64)
    monkeypatch.setattr(filter_audit, "BLOCK_CELLS", 16)
    monkeypatch.setattr(filter_audit, "FLUSH", 10)
    rows = [(i, f"text {i % 90}", "en") for i in range(100)]
    assert audited(rows, []) == brute_audit(rows, [])


def brute_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            digest = hashlib.md5((str(len(role or "")) + ":" + (role or "") + (text or "")).encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, digest, role or "", text or ""))
    turns = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(turns):
        h = zlib.crc32(str(c).encode()) % 6
        base = turns.get(c - int(np.fmod(c, 100)), [])
        path = tuple(base[:h] + turns[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    digest = lambda p: hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()
    return Counter(
        (m[0], len(p), members[p[:-1]][0] if p else None, len(m), kids[p], leaves[p], saved[p], digest(p)) for p, m in members.items()
    )


CONVS = "conv_id long, turn long, role string, text string"


def trie(spark, rows, max_rows=None, extra=False):
    convs = spark.createDataFrame(rows, CONVS)
    if extra:
        for name in ("place", "turns", "key", "parent", "c", "depth", "h", "kids"):
            convs = convs.selectExpr("*", f"'x' as `{name}`")
    return Counter(tuple(r) for r in conversation_trie.conversation_trie(convs, max_rows).collect())


def random_conversations(rng, ids):
    rows = []
    for c in ids:
        for t in range(rng.randrange(1, 8)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["hello", "Größe", "", None, f"turn {rng.randrange(5)}"])))
    return rows


def test_trie_matches_brute_force(spark):
    rng = random.Random(8)
    rows = random_conversations(rng, list(range(0, 40)) + list(range(101, 140)) + list(range(200, 230)) + [-5, -100, -101])
    rows += [(7, None, "user", "first"), (7, None, None, None), (7, 1, "user", "tie"), (7, 1, "user", "tie"), (None, 0, "user", "lost")]
    rng.shuffle(rows)
    assert trie(spark, rows, extra=True) == brute_trie(rows)


def test_trie_with_long_conversations_cut_into_segments(spark):
    rng = random.Random(9)
    rows = random_conversations(rng, range(30)) + [(200, t, "user", f"t{t}") for t in range(90)] + [(255, t, "user", f"t{t}") for t in range(95)]
    assert trie(spark, rows, max_rows=20) == brute_trie(rows)


def test_trie_with_many_equal_conversations(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "CHUNK_IDS", 7)
    rows = [(c, t, "user", f"same {t}") for c in range(100, 300) for t in range(3)]
    assert trie(spark, rows) == brute_trie(rows)


def test_trie_without_rows(spark):
    assert trie(spark, []) == Counter()
    assert trie(spark, [(None, 1, "user", "x")]) == Counter()


@pytest.mark.parametrize("shape", ["chain", "star", "binary"])
def test_contraction_needs_few_rounds(spark, shape):
    n = 255
    parent = {"chain": lambda i: i - 1, "star": lambda i: 0, "binary": lambda i: (i - 1) // 2}[shape]
    kids = Counter(parent(i) for i in range(1, n))
    tree = spark.createDataFrame(
        [(str(i), str(parent(i)) if i else None, kids[i], i) for i in range(n)], "key string, parent string, kids long, weight long"
    )
    got = {int(r.key): (r.leaves, r.saved) for r in conversation_trie.subtree_totals(tree, rounds=30).collect()}
    want = {i: [0 if kids[i] else 1, i] for i in range(n)}
    for i in range(n - 1, 0, -1):
        for k in (0, 1):
            want[parent(i)][k] += want[i][k]
    assert got == {i: tuple(w) for i, w in want.items()}


VECTORS = "vec_id long, embedding array<float>"


def brute_nearest(rows, every, k):
    usable = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for q, v in usable:
        if q % every == 0:
            near = sorted((float(np.sqrt(((w - v) ** 2).sum())), i) for i, w in usable if i != q)[:k]
            out[q] = near
    return out


def clustered(rng, n, d=16):
    centres = rng.normal(size=(12, d)) * 3
    points = (centres[rng.integers(12, size=n)] + rng.normal(size=(n, d))).astype(np.float32)
    return [(i, p.tolist()) for i, p in enumerate(points)]


def test_tree_reaches_its_recall(spark):
    rows = clustered(np.random.default_rng(1), 3000)
    got = vector_tree.nearest_neighbours(spark.createDataFrame(rows, VECTORS), every=50).collect()
    want = brute_nearest(rows, 50, 10)
    true = {(q, i) for q, near in want.items() for _, i in near}
    assert len(got) == 10 * len(want)
    assert len({(r.query_id, r.vec_id) for r in got} & true) >= 0.9 * len(true)
    score = {(q, i): s for q, near in want.items() for s, i in near}
    for r in got:
        assert (r.query_id, r.vec_id) not in score or r.score == pytest.approx(score[r.query_id, r.vec_id], rel=1e-12)


def test_full_walk_is_exact_with_ties_in_small_blocks(spark):
    rows = clustered(np.random.default_rng(2), 400, d=4)
    rows += [(1000 + i, rows[0][1]) for i in range(200)]
    bound = vector_tree.Bound(leaf_sample=20, block=16)
    table = spark.createDataFrame(rows, VECTORS).selectExpr("*", "'x' as v", "'y' as leaf", "0 as rank")
    got = vector_tree.nearest_neighbours(table, every=40, recall=2.0, bound=bound).collect()
    found = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found[r.query_id].append(r.vec_id)
    assert found == {q: [i for _, i in near] for q, near in brute_nearest(rows, 40, 10).items()}


def test_tree_leaves_out_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, []), (None, [1.0, 1.0]), (7, [3.0, 0.0]), (8, [1.0])]
    got = vector_tree.nearest_neighbours(spark.createDataFrame(rows, VECTORS)).collect()
    assert [tuple(r) for r in got] == [(0, 1, 7, 2.0)]
    for few in ([], [(0, None)], [(0, [1.0, 2.0])], [(1, [1.0]), (2, [2.0])]):
        assert vector_tree.nearest_neighbours(spark.createDataFrame(few, VECTORS)).collect() == []
