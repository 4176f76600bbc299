"""Sharding, mixing and quality rules against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

from tests.llm.conftest import ODD, sentence, split_words
from wanderbeam.llm import mixing, quality_rules, sharding


def brute_rules(text):
    words = split_words(text)
    body = text or ""
    grams = defaultdict(list)
    for i in range(len(words) - 4):
        grams[tuple(words[i : i + 5])].append(i)
    repeat = {p for at in grams.values() if len(at) > 1 for i in at for p in range(i, i + 5)}
    lines = [x for x in body.split("\n") if split_words(x)]
    symbols = sum(body.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeat)


def test_rules_match_brute_force(make):
    rng = random.Random(3)
    rows = list(ODD)
    for i in range(40):
        text = sentence(rng, rng.randrange(1, 80), vocabulary=6)
        rows.append((100 + i, text.replace(" a", "\n#a") if i % 2 else text))
    got = quality_rules.document_rules(make(rows)).collect()
    assert len(got) == len(rows)
    want = Counter((d, *brute_rules(t)) for d, t in rows)
    assert Counter(tuple(r)[:6] for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and (r.base_failed or r.failed_rules))


def test_rules_are_one_projection(make):
    plan = quality_rules.document_rules(make(ODD))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_rules_keep_prose_and_drop_symbols(make):
    prose = "The cat sat on the mat and looked at the bird that sang in the old tree for an hour"
    junk = " ".join(f"{w}$$$" for w in prose.split())
    kept = {r.doc_id: r.kept for r in quality_rules.document_rules(make([(1, prose), (2, junk), (3, prose.upper() + "!!")])).collect()}
    assert kept == {1: True, 2: False, 3: False}


def test_rules_take_extra_columns_and_no_rows(make):
    assert quality_rules.rule_verdicts(make(ODD, extra=True)).count() == len(ODD)
    assert quality_rules.document_rules(make([])).collect() == []


def check_shards(rows, got, shards=16):
    size = lambda t: len((t or "").encode()) + 1
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (d, size(t), zlib.crc32((t or "").encode())) for d, t in rows
    )
    order = sorted(rows, key=lambda x: (hashlib.md5((x[1] or "").encode()).digest(), x[0] is not None, x[0] or 0))
    whole = sum(size(t) for _, t in rows)
    want, seen, at = Counter(), Counter(), 0
    for d, t in order:
        shard = at * shards // whole
        want[d, shard, seen[shard]] += 1
        seen[shard] += 1
        at += size(t)
    assert Counter((r.doc_id, r.shard, r.slot) for r in got) == want
    assert {r.law for r in got} <= {"bytes"} and {r.grown_shard for r in got} <= {None}


def test_shards_match_brute_force(make):
    rng = random.Random(5)
    rows = [*ODD, *[(100 + i, sentence(rng, rng.randrange(1, 60))) for i in range(80)], *[(300 + i, "one hot text") for i in range(60)]]
    check_shards(rows, sharding.document_shards(make(rows)).collect())
    assert sharding.document_shards(make(rows, extra=True)).count() == len(rows)
    assert sharding.document_shards(make([])).collect() == []


def test_prefix_sums_split_a_hot_group(spark):
    df = spark.range(1000).selectExpr("'hot' as k", "id", "id % 7 as v")
    got = {r.id: r.before for r in sharding.prefix_sums(df, ["k", "id"], {"v": "before"}, 8).collect()}
    total, want = 0, {}
    for i in range(1000):
        want[i] = total
        total += i % 7
    assert got == want


def brute_mix(rows, alpha, budget=None):
    tokens = [len(split_words(t)) + 1 for _, t, _ in rows]
    total = Counter()
    for (_, _, s), n in zip(rows, tokens):
        total[s] += n
    whole = sum(total.values())
    power = {s: (n / whole) ** alpha for s, n in total.items()}
    norm = sum(power.values())
    out = Counter()
    for s, n in total.items():
        allowance = math.floor(power[s] / norm * (budget or whole) + 1e-6)
        passes, rest = divmod(allowance, n)
        mine = [(d, k) for (d, _, x), k in zip(rows, tokens) if x == s]
        for block in range(passes + 1):
            key = lambda d: hashlib.md5(f"mix#{'' if d is None else d}#{block}".encode()).hexdigest()
            by_key = defaultdict(list)
            for d, k in mine:
                by_key[key(d)].append((d, k))
            used = 0
            for name in sorted(by_key):
                used += sum(k for _, k in by_key[name])
                if block == passes and used > rest:
                    break
                for d, _ in by_key[name]:
                    out[d, s, block] += 1
    return out


@pytest.fixture(scope="module")
def mix_rows():
    rng = random.Random(9)
    rows = [(i, sentence(rng, rng.randrange(1, 30)), "hot") for i in range(200)]
    rows += [(1000 + i, sentence(rng, 12), f"s{i % 5}") for i in range(60)]
    rows += [(2000, None, None), (2001, "alone here", None), (None, "no id at all", "s1"), (1001, "again", "s1")]
    return rows


@pytest.mark.parametrize("spec", [mixing.MixSpec(), mixing.MixSpec(entropy=0.9, max_repeats=2.0), mixing.MixSpec(entropy=None, max_repeats=3.0, budget=9000)])
def test_mix_matches_brute_force(make, mix_rows, spec):
    docs = make(mix_rows)
    sources = mixing.source_tokens(docs, "source", mixing.document_tokens(docs["text"]))
    alpha = mixing.bisect_exponent(sources, spec)
    got = mixing.mix(docs, spec).collect()
    assert Counter((r.doc_id, r.source, r.mix_block) for r in got) == brute_mix(mix_rows, alpha, spec.budget)


def test_mix_meets_its_targets(make, mix_rows):
    docs = make(mix_rows)
    sources = mixing.source_tokens(docs, "source", mixing.document_tokens(docs["text"]))
    plan = mixing.mixing_plan(sources, mixing.MixSpec(entropy=0.8, max_repeats=None)).collect()
    entropy = -sum(r.weight * math.log(r.weight) for r in plan)
    assert abs(entropy - 0.8 * math.log(len(plan))) < 1e-6
    plan = mixing.mixing_plan(sources, mixing.MixSpec(entropy=1.0, max_repeats=1.5)).collect()
    assert max(r.allowance / r.tokens for r in plan) <= 1.5 + 1e-6


def test_mix_odd_tables(make):
    assert mixing.mix(make([])).collect() == []
    one = mixing.mix(make(ODD, extra=True))
    assert one.count() == len(ODD) and "score" in one.columns
