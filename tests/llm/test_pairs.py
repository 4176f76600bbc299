"""SimHash, components, substring dedup and decontamination against brute force."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from tests.llm.conftest import ODD, lower_ascii, sentence, split_words
from wanderbeam.llm import decontamination, packed_keys, simhash, substring_dedup
from wanderbeam.llm.components import components


def brute_print(text, size):
    words = split_words(lower_ascii(text))
    if not words:
        return 0
    grams = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius):
    """Smallest id reachable from each distinct fingerprint; NULL ids don't count."""
    nodes = list(prints)
    parent = {p: p for p in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in nodes:
        for b in nodes:
            if a < b and (a ^ b).bit_count() <= radius:
                parent[find(b)] = find(a)
    least = {}
    for p in nodes:
        ids = [d for d in prints[p] if d is not None]
        root = find(p)
        least[root] = min([*ids, *([least[root]] if least.get(root) is not None else [])], default=None)
    return {p: least[find(p)] for p in nodes}


@pytest.fixture(scope="module")
def near_rows():
    rng = random.Random(11)
    rows = list(ODD)
    for i in range(25):
        base = sentence(rng, 120)
        rows += [(100 + 10 * i, base), (101 + 10 * i, base.upper())]
        for k in range(3):
            words = base.split()
            words[rng.randrange(len(words))] = f"changed{k}"
            rows.append((102 + 10 * i + k, " ".join(words)))
    return rows


@pytest.mark.parametrize("pair_limit", [256, 2])
def test_simhash_components(spark, make, near_rows, pair_limit, monkeypatch):
    monkeypatch.setattr(simhash.near_pairs, "__defaults__", (pair_limit,))
    got = simhash.document_components(make(near_rows, extra=pair_limit == 2)).collect()
    prints = {}
    for d, t in near_rows:
        prints.setdefault(brute_print(t, 3), []).append(d)
    comps = brute_components(prints, 2)
    want = Counter((d, f"{brute_print(t, 3):016x}", comps[brute_print(t, 3)]) for d, t in near_rows)
    assert Counter(tuple(r) for r in got) == want
    assert len({r.component_id for r in got}) < len(prints)


def test_near_pairs_find_every_link(spark):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(6)]
    prints = set(base)
    for b in base:
        for _ in range(40):
            prints.add(b ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(4))}))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    for limit in (1000, 3):
        links = simhash.near_pairs(spark.createDataFrame(signed, "fp long"), 3, 6, limit)
        roots = {r.node: r.root for r in components(links).collect()}
        comps = {}
        for p, root in brute_components({p: [p] for p in prints}, 3).items():
            comps.setdefault(root, set()).add(p)
        for members in comps.values():
            found = {roots.get(p - (1 << 64) if p >> 63 else p, p) for p in members}
            assert len(found) == 1


@pytest.mark.parametrize("limit", [8192, 100])
def test_a_group_of_thousands_keeps_all_its_links(spark, limit):
    rng = random.Random(21)
    base = rng.getrandbits(64)
    prints = set()
    while len(prints) < 3000:
        prints.add(base ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(6))}))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = simhash.near_pairs(spark.createDataFrame(signed, "fp long"), 2, 4, limit)
    roots = {r.node: r.root for r in components(links).collect()}
    groups = {}
    for p, root in brute_components({p: [p] for p in prints}, 2).items():
        groups.setdefault(root, set()).add(p)
    for members in groups.values():
        assert len({roots.get(p - (1 << 64) if p >> 63 else p, p) for p in members}) == 1


def test_many_rows_of_one_fingerprint_take_no_common_task(spark, make):
    rows = [(i, "the same text") for i in range(400)] + [(1000 + i, f"text number {i} and {i * i} of its own") for i in range(50)]
    got = {r.doc_id: r.component_id for r in simhash.document_components(make(rows)).collect()}
    assert len(got) == 450 and all(got[i] == 0 for i in range(400))


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(41)) and all(got[k] == 100 for k in range(100, 140)) and got[201] == 200
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_dedup_keeps_one_of_each_group(make, near_rows):
    docs = make(near_rows, extra=True)
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    prints = {}
    for d, t in near_rows:
        prints.setdefault(brute_print(t, 5), []).append(d)
    comps = brute_components(prints, 3)
    groups = Counter(comps.values())
    got = [r.doc_id for r in kept.collect()]
    assert len(got) == len(set(got)) == len(groups)
    assert sorted(x for x in got if x is not None) == sorted(x for x in groups if x is not None)
    assert simhash.deduplicated(make([])).collect() == []


def test_majority_matches_bit_counts():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 254, 255, 256, 1000):
        h = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
        want = sum(1 << b for b in range(64) if 2 * int(((h >> np.uint64(b)) & np.uint64(1)).sum()) > n)
        assert simhash.majority(h) == want


def brute_removed(rows, size=13):
    first = {}
    for d, t in rows:
        if d is not None:
            w = split_words(t)
            for i in range(len(w) - size + 1):
                key = tuple(w[i : i + size])
                first[key] = min(first.get(key, d), d)
    out = Counter()
    for d, t in rows:
        w = split_words(t)
        gone = set()
        for i in range(len(w) - size + 1):
            if d is not None and first[tuple(w[i : i + size])] < d:
                gone |= set(range(i, i + size))
        out[d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)] += 1
    return out


@pytest.fixture(scope="module")
def passage_rows():
    rng = random.Random(4)
    hot = sentence(rng, 60)
    rows = list(ODD)
    for i in range(60):
        text = sentence(rng, rng.randrange(5, 90))
        if i % 3 == 0:
            cut = rng.randrange(0, 30)
            text += " " + " ".join(hot.split()[cut : cut + rng.randrange(10, 40)]) + " " + sentence(rng, 8)
        rows.append((200 - i, text))
    rows += [(500 + i, hot) for i in range(5)] + [(600, hot + " " + hot), (600, sentence(rng, 30) + " " + hot)]
    return rows


@pytest.mark.parametrize("block", [1_000_000, 50])
def test_repeats_removed(make, passage_rows, block, monkeypatch):
    monkeypatch.setattr(packed_keys, "BLOCK_KEYS", block)
    got = substring_dedup.repeats_removed(make(passage_rows, extra=block == 50)).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == brute_removed(passage_rows)
    for r in got:
        assert sum(b - a for a, b in r.removed_spans) == r.n_removed
    assert sum(r.n_removed for r in got) > 300


def test_repeats_of_nothing(make):
    assert substring_dedup.repeats_removed(make([])).collect() == []
    with pytest.raises(ValueError):
        substring_dedup.repeats_removed(make([]), window=7)


def test_difference_cover_meets_every_offset():
    cover = substring_dedup.COVER
    for a in range(7):
        for b in range(7):
            assert any((a + s) % 7 in cover and (b + s) % 7 in cover for s in range(7))


def test_packed_blocks_round_trip():
    n = 500
    rng = np.random.default_rng(1)
    keys = packed_keys.Keys(
        rng.integers(0, 1 << 32, n, dtype=np.uint64), rng.integers(0, 1 << 32, n, dtype=np.uint64),
        np.sort(rng.integers(-5, 40, n)), np.zeros(n, np.int64), rng.integers(0, 9999, n),
    )
    for wide in (True, False, None):
        back = packed_keys.unpack(packed_keys.pack(keys, wide), wide)
        assert (back.doc == keys.doc).all() and (back.place == keys.place).all()
        if wide is not None:
            assert (back.hi == keys.hi).all()
        if wide:
            assert (back.lo == keys.lo).all()


def test_settled_runs_tell_the_smallest_and_the_largest_document():
    block = packed_keys.Gatherer(1, True, False)
    for doc in (7, 9, 3, 5):
        block.add(doc, doc, np.full(2, 11, np.uint64), np.full(2, 12, np.uint64), np.arange(2))
    block.add(4, 4, np.full(1, 99, np.uint64), np.full(1, 12, np.uint64), np.arange(1))
    (rows,) = block.rows()
    told = packed_keys.Keys.joined([packed_keys.unpack(b, True) for b in rows.loc[~rows["settled"], "body"]])
    assert sorted(zip(told.doc.tolist(), told.place.tolist())) == [(3, -1), (4, 0), (9, -1)]


def test_one_id_with_two_texts_in_different_blocks(make, monkeypatch):
    rng = random.Random(3)
    passage = sentence(rng, 40)
    rows = [(5, passage + " " + sentence(rng, 20)), (3, passage + " " + sentence(rng, 21))]
    rows += [(5, sentence(rng, 19) + " " + passage)]
    monkeypatch.setattr(packed_keys, "BLOCK_KEYS", 40)
    got = substring_dedup.repeats_removed(make(rows).coalesce(1)).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == brute_removed(rows)


BENCH = "item_id long, text string"


def brute_similarity(a, b):
    def grams(words):
        k = min(5, len(words))
        return Counter(tuple(words[i : i + k]) for i in range(len(words) - k + 1))

    x, y = grams(a), grams(b)
    weight = lambda g: len(" ".join(g).encode())
    both = sum(weight(g) * min(x[g], y[g]) for g in x.keys() & y.keys())
    whole = sum(weight(g) * n for g, n in x.items()) + sum(weight(g) * n for g, n in y.items()) - both
    return both / whole if whole else 0.0


def brute_matches(docs, items):
    out = {}
    for d, t in docs:
        words = split_words((t or "").lower())
        for i, x in items:
            item = split_words((x or "").lower())
            n = min(len(item), len(words))
            if not item or not words or (n < min(5, len(item))):
                continue
            best = max((brute_similarity(words[s : s + n], item) for s in range(len(words) - n + 1)), default=0)
            if best >= 0.8:
                out[d, i] = round(best, 9)
    return out


@pytest.fixture(scope="module")
def leak_rows():
    rng = random.Random(8)
    items = [(i, sentence(rng, rng.choice([12, 20, 33]))) for i in range(12)]
    items += [(50, None), (51, " "), (52, "two words"), (None, "no id here at all but words")]
    docs = [r for r in ODD if r[0] not in (7, None)]
    for i in range(40):
        text = sentence(rng, rng.randrange(3, 60))
        if i % 2:
            part = items[i % 12][1].split()
            if i % 3 == 0:
                part[-1 if i % 4 == 3 else len(part) // 2] = "swapped"
            text += " " + " ".join(part).capitalize() + " " + sentence(rng, 5)
        docs.append((100 + i, text))
    docs += [(300, items[3][1]), (301, "Two Words only"), (302, " ".join(items[4][1].split()[:9]))]
    return docs, items


@pytest.mark.parametrize("per_pass", [20_000, 6])
def test_contaminations(spark, make, leak_rows, per_pass):
    docs, items = leak_rows
    bench = spark.createDataFrame(items, BENCH)
    got = decontamination.contaminations(make(docs, extra=True), bench, per_pass).collect()
    want = brute_matches(docs, [x for x in items if x[0] is not None])
    assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in got} == want
    assert len(got) == len(want) and len(want) > 12
    clean = decontamination.clean(make(docs), bench, per_pass)
    assert sorted(r.doc_id for r in clean.collect()) == sorted(d for d, _ in docs if d not in {k[0] for k in want})


def test_contaminations_of_empty_tables(spark, make, leak_rows):
    none = spark.createDataFrame([], BENCH)
    assert decontamination.contaminations(make([]), spark.createDataFrame(leak_rows[1], BENCH)).collect() == []
    assert decontamination.contaminations(make(ODD), none).collect() == []
    assert decontamination.clean(make(ODD), none).count() == len(ODD)
