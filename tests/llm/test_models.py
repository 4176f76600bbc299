"""Classifiers, the language model, URL trees and the pipeline."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ODD, lower_ascii, sentence, split_words
from wanderbeam.llm import gru, labelled, language_model, quality_classifier, toxicity, url_filter
from wanderbeam.llm.labelled import Bound, labelled_sample, platt, sigmoid
from wanderbeam.llm.text import text_bytes

LABELS = "doc_id long, quality int, toxic int"


def remainder(doc_id, modulus):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % modulus


@pytest.fixture(scope="module")
def labelled_rows():
    rng = random.Random(6)
    docs, labels = list(ODD), []
    for i in range(240):
        text = sentence(rng, rng.randrange(15, 50), 150)
        junk, toxic = i % 3 == 0, i % 4 == 0
        if junk:
            text = " ".join(f"{w.upper()}!!" for w in text.split())
        if toxic:
            words = text.split()
            words[3:3] = ["zorgish", "Gnarfle!"]
            text = " ".join(words)
        docs.append((100 + i, text))
        if i % 2 == 0 or i % 5 == 0:
            labels.append((100 + i, 0 if junk else 1, 1 if toxic else 0))
    labels += [(1, 1, 0), (2, None, None), (None, 0, 1), (9999, 0, 1), (100, 0, 1)]
    return docs, labels


def test_quality_holds_on_held_out_rows(spark, make, labelled_rows):
    docs, labels = labelled_rows
    got = quality_classifier.document_quality(make(docs, extra=True), spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(docs)
    right = [r.predicted == (0 if (r.doc_id - 100) % 3 == 0 else 1) for r in got if r.doc_id is not None and 100 <= r.doc_id < 900]
    assert sum(right) / len(right) > 0.97
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == (remainder(r.doc_id, 5) == 0)


def test_toxicity_holds_on_held_out_rows(spark, make, labelled_rows):
    docs, labels = labelled_rows
    got = toxicity.document_toxicity(make(docs, extra=True), spark.createDataFrame(labels, LABELS)).collect()
    right = [r.predicted == ((r.doc_id - 100) % 4 == 0) for r in got if r.doc_id is not None and 100 <= r.doc_id < 900]
    assert sum(right) / len(right) > 0.97
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == (remainder(r.doc_id, 4) == 2)


def test_labels_outside_the_learnable_rows_change_nothing(spark, make, labelled_rows):
    docs, labels = labelled_rows
    flipped = [(d, 1 - q if q is not None and remainder(d, 5) == 0 else q, t) for d, q, t in labels]
    a, b = (
        {(r.doc_id, r.score) for r in quality_classifier.document_quality(make(docs), spark.createDataFrame(x, LABELS)).collect()}
        for x in (labels, flipped)
    )
    assert a == b


def test_classifiers_without_labels_or_rows(spark, make):
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in quality_classifier.document_quality(make(ODD), none).collect()} == {0.5}
    assert {r.score for r in toxicity.document_toxicity(make(ODD), none).collect()} == {0.5}
    assert quality_classifier.document_quality(make([]), none).collect() == []
    one = spark.createDataFrame([(3, 1, 0), (4, 1, 0)], LABELS)
    assert all(r.predicted == 1 for r in quality_classifier.document_quality(make(ODD), one).collect())


def test_sample_is_bounded_and_weighted(spark, make, labelled_rows):
    docs, labels = labelled_rows
    sample = labelled_sample(make(docs), spark.createDataFrame(labels, LABELS), "quality", url_filter.F.lit(True), Bound(per_class=10))
    assert Counter(sample.labels.tolist()) == {0: 10, 1: 10}
    assert abs(sample.weights.mean() - 1) < 1e-9 and sample.weights[sample.labels == 1][0] > sample.weights[sample.labels == 0][0]


def test_swaps_reduce_the_weight_of_neutral_mentions():
    rng = random.Random(1)
    texts, labels = [], []
    for i in range(400):
        words = sentence(rng, 12).split()
        toxic = i % 4 == 0
        if toxic:
            words.append("zorgish")
        # Mentions of one group stand in toxic texts more often, as in real samples.
        if rng.random() < (0.6 if toxic else 0.05):
            words.append("muslims")
        texts.append(" ".join(words))
        labels.append(int(toxic))
    y, w = np.array(labels), np.ones(len(labels))
    neutral = [sentence(rng, 12) + " muslims" for _ in range(100)]
    free = toxicity.train(texts, y, w, penalty=0.0)
    bound = toxicity.train(texts, y, w, penalty=1.0)
    gap = lambda m: np.mean([abs(m.margin(t) - m.margin(t.replace("muslims", "christians"))) for t in neutral])
    assert gap(bound) < 0.3 * gap(free)
    false = lambda m: sum(m.score(t) >= 0.3 for t in neutral)
    assert false(bound) <= false(free) and bound.score("you zorgish") > 0.5


def test_every_term_of_a_line_is_swapped_in():
    for line in toxicity.IDENTITY_TERMS:
        names = {x.encode() for x in line.split()}
        for term in names:
            got = toxicity.counterfactuals([b"the", term], toxicity.swap_table((line,)))
            assert sorted(got, key=sorted) == sorted(({b"the", x} for x in names - {term}), key=sorted)


def test_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 2, (60, 12))
    y = (x[:, 0] + x[:, 1] > 0).astype(int)
    rows = [np.flatnonzero(r) for r in x]
    ratios = quality_classifier.log_count_ratios(rows, y, 12)
    cost = np.full(60, 0.5)
    w, bias = quality_classifier.dual_coordinate_descent(rows, ratios, y, cost, 400, 1)
    sign = np.where(y == 1, 1, -1)

    def loss(w, bias):
        return 0.5 * (w @ w + bias * bias) + (cost * np.maximum(0, 1 - sign * ((x * ratios) @ w + bias))).sum()

    best = loss(w, bias)
    for _ in range(300):
        step = rng.standard_normal(13) * 0.05
        assert loss(w + step[:12], bias + step[12]) > best - 1e-3


def test_platt_recovers_odds():
    rng = np.random.default_rng(0)
    m = rng.standard_normal(4000) * 2
    y = (rng.random(4000) < sigmoid(1.5 * m - 0.5)).astype(int)
    a, b = platt(m, y, np.ones(4000))
    assert abs(a - 1.5) < 0.2 and abs(b + 0.5) < 0.2


SMALL = language_model.Spec(shape=gru.Shape(groups=4, width=8, endings=6, hidden=8), dictionary=60, rounds=2, every=2)


@pytest.fixture(scope="module")
def lm_rows():
    rng = random.Random(12)
    rows = list(ODD)
    for i in range(150):
        pool = 60 if i % 2 else 120
        rows.append((100 + i, " ".join(f"{'xy'[i % 2]}{rng.randrange(pool)}" for _ in range(rng.randrange(2, 60))).title()))
    return rows


def brute_tokens(text):
    return [*split_words(lower_ascii(text)), None]


def test_base_scores_match_brute_force(make, lm_rows):
    got = language_model.document_scores(make(lm_rows, extra=True), SMALL).collect()
    counts = Counter(t for d, x in lm_rows if remainder(d, 10) for t in brute_tokens(x))
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for d, x in lm_rows:
        toks = brute_tokens(x)
        base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in toks)
        want[d, remainder(d, 10) == 0, len(toks), sum(counts[t] > 0 for t in toks), n, round(base, 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)
    assert language_model.document_scores(make([]), SMALL).collect() == []


def test_the_model_is_a_probability(make, lm_rows):
    """Over one-token continuations all known words, the end and one unknown word per ending class sum to one."""
    docs = make(lm_rows)
    counts = language_model.token_counts(docs.select("text"))
    lex = language_model.lexicon(counts, SMALL)
    params = gru.initial(SMALL.shape, 3)
    table = {r.token: r.c for r in counts.collect()}
    end = lex.end
    total = 0.0
    for first in [*range(SMALL.shape.inputs)]:
        total += math.exp(gru.log_likelihoods(params, SMALL.shape, [np.array([first], np.int32)], end)[0])
    assert abs(total - 1) < 1e-4
    inside = Counter()
    for token, c in table.items():
        if lex.ids[lex.places.get(token.encode(), -1)] not in range(SMALL.shape.words):
            inside[lex.ending(token)] += c + 0.1
    for k, mass in inside.items():
        assert abs(mass + 0.1 - 10 ** lex.class_logs[k]) < 1e-6


def test_windows_and_lanes_do_not_change_a_likelihood():
    shape = SMALL.shape
    params = gru.initial(shape, 5)
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, shape.inputs, n).astype(np.int32) for n in (1, 3, 50, 70, 2, 33)]
    whole = np.concatenate([gru.log_likelihoods(params, shape, [d], 0, steps=1000, count=1) for d in docs])
    for steps, count in ((4, 2), (7, 3), (32, 256)):
        assert np.allclose(gru.log_likelihoods(params, shape, docs, 0, steps, count), whole, atol=1e-3)


def test_lanes_take_the_memory_of_their_tokens():
    docs = [np.zeros(300_000, np.int32), *[np.zeros(n % 7 + 1, np.int32) for n in range(255)]]
    way = gru.lanes(docs, 0, 256)
    tokens = sum(map(len, docs))
    assert sum(x.nbytes for x in (way.source, way.target, way.doc, way.fresh)) <= 13 * tokens
    window = way.window(0, 32)
    assert window.target.shape == (32, 256) and way.window(299_990, 32).target.shape == (10, 1)


def test_scores_do_not_depend_on_the_layout(spark, make):
    rng = random.Random(12)
    rows = [(i, sentence(rng, rng.randrange(1, 60), 50)) for i in range(120)]
    spec = language_model.Spec(shape=SMALL.shape, learner_tokens=500, learner_texts=16)
    found = []
    for parts in (1, 5):
        docs = make(rows).repartition(parts, "text")
        found.append({r.doc_id: r.score for r in language_model.document_scores(docs, spec).collect()})
    assert found[0].keys() == found[1].keys()
    assert all(abs(found[0][d] - found[1][d]) < 1e-3 * abs(found[0][d]) for d in found[0])


def test_a_text_of_many_words_is_scored_whole(spark, make):
    long = " ".join(f"w{k % 40}" for k in range(100_000))
    got = {r.doc_id: r for r in language_model.document_scores(make([(0, long), (1, long), (2, "w1 w2"), (3, None)]), SMALL).collect()}
    assert got[0].n_tokens == 100_001 and got[3].n_tokens == 1
    assert got[0].score == pytest.approx(got[1].score, rel=1e-6) and got[0].score < got[2].score < 0


def test_gradients_match_differences():
    shape = gru.Shape(groups=2, width=3, endings=2, hidden=4)
    params = {k: v.astype(np.float64) for k, v in gru.initial(shape, 1).items()}
    rng = np.random.default_rng(4)
    source, target = rng.integers(0, shape.inputs, (5, 3)), rng.integers(0, shape.inputs, (5, 3))
    fresh = np.zeros((5, 3), bool)
    fresh[0] = fresh[3, 1] = True

    def loss(p):
        hidden, _ = gru._forward(p, source, fresh, np.zeros((3, 4)), None)
        return -gru._outputs(p, shape, hidden.reshape(-1, 4).astype(np.float64), target.ravel(), None)[0].sum()

    keep, grads = [], {}
    hidden, _ = gru._forward(params, source, fresh, np.zeros((3, 4)), keep)
    _, back = gru._outputs(params, shape, hidden.reshape(-1, 4).astype(np.float64), target.ravel(), grads)
    ids, rows = gru._through_time(params, keep, back.reshape(hidden.shape), source, fresh, grads)
    grads["input"] = np.zeros_like(params["input"])
    grads["input"][ids] = rows
    for name, value in params.items():
        for at in rng.integers(0, value.size, 6):
            moved = {k: v.copy() for k, v in params.items()}
            moved[name].flat[at] += 1e-3
            up = loss(moved)
            moved[name].flat[at] -= 2e-3
            assert abs((up - loss(moved)) / 2e-3 - grads[name].flat[at]) < 2e-2


def test_the_steps_of_a_model_lie_in_one_piece():
    # An operation on a piece of memory takes a quarter of the time it takes on strips of one.
    shape = gru.Shape()
    source = np.arange(24 * 128).reshape(24, 128) % shape.inputs
    fresh = np.zeros(source.shape, bool)
    keep: list = []
    hidden, _ = gru._forward(gru.initial(shape), source, fresh, np.zeros((128, shape.hidden), np.float32), keep)
    assert hidden.flags.c_contiguous and len(keep) == 4
    assert all(len(part) == 24 and part.shape[-1] == 128 and part.flags.c_contiguous for part in keep)


def test_rare_words_are_listed_by_text(spark, make):
    docs = make([(1, "a b zz zz b"), (2, None), (3, "yy a zz")])
    counts = language_model.token_counts(docs.where("doc_id < 3").select("text"))
    lex = language_model.lexicon(counts, language_model.Spec(shape=SMALL.shape, dictionary=1))
    got = {r.doc_id: r for r in language_model.read_texts(docs.select("doc_id", "text"), lex).collect()}
    lists = {d: {x.token: x.n for x in r.rare} for d, r in got.items()}
    for d, text in ((1, "a b zz zz b"), (2, ""), (3, "yy a zz")):
        rare = Counter(w for w in text.split() if w.encode() not in lex.places)
        assert lists[d] == rare and got[d].n_tokens == len(text.split()) + 1 == len(got[d].ids) // 2
    assert lists[3]["yy"] == 1


def test_texts_are_read_together():
    """One look-up for the words of many texts gives each text what it has alone."""
    rng = random.Random(3)
    texts = [None, "", " ", "\t Ab\x0b\x0cZZ ab zz ", "\x85 \x1c \xa0 \u00c4b", *[sentence(rng, rng.randrange(0, 30), 40) for _ in range(60)]]
    brute = [text_bytes(x, lower=True).split() for x in texts]
    vocabulary = ["", *sorted({w.decode() for words in brute for w in words[::3]})]
    inputs = SMALL.shape.words
    ids = np.array([*(k if k < inputs else inputs + k % 6 for k in range(len(vocabulary))), -1], np.int32)
    logs, class_logs = np.arange(len(vocabulary)) / 7 - 2, np.arange(6) / 3 - 1
    lex = language_model.Lexicon(pa.array(vocabulary), logs, ids, {"zz": 0, "ab": 1, "Äb": 2}, 9, 9, class_logs, None, None, SMALL.shape)
    place = {w.encode(): k for k, w in enumerate(vocabulary)}
    runs = list(language_model.pieces(pa.array(texts), 200))
    assert len(runs) > 3 and sum(map(len, runs)) == len(texts) and pa.concat_arrays(runs).to_pylist() == texts
    for parts in ([pa.array(texts)], runs):
        got = pa.concat_arrays([lex.read(some) for some in parts]).to_pylist()
        for words, row in zip(brute, got, strict=True):
            at = [*[place.get(w) for w in words], 0]
            codes = [lex.ending(w.decode()) + inputs if k is None else int(ids[k]) for w, k in zip([*words, b""], at)]
            assert np.frombuffer(row["ids"], "<i2").tolist() == codes
            assert row["n_tokens"] == len(at) and row["n_known"] == sum(k is not None for k in at)
            assert row["known_log"] == pytest.approx(sum(logs[k] for k in at if k is not None))
            outside = sum(logs[k] for k, c in zip(at, codes) if k is not None and c >= inputs) - sum(class_logs[c - inputs] for c in codes if c >= inputs)
            assert row["outside_log"] == pytest.approx(outside, abs=1e-9)
            rare = Counter(w.decode() for w, k in zip(words, at) if k is None)
            assert Counter({x["token"]: x["n"] for x in row["rare"]}) == rare and len(row["rare"]) == len(rare)


def test_counts_do_not_depend_on_what_a_task_holds(make):
    rows = [(k, f" a b{k % 7} A c{k}") for k in range(60)] + [(60, None), (61, "")]
    want = Counter(w for _, x in rows for w in [*(x or "").lower().split(), ""])
    for hold in (1, 30, 300_000):
        counted = language_model.token_counts(make(rows).select("text"), hold).collect()
        assert {r.token: r.c for r in counted} == want and len(counted) == len(want)


@pytest.mark.parametrize("shift", [-200, 0, 200])
def test_outputs_far_from_zero_are_probabilities(shift):
    shape = SMALL.shape
    p = gru.initial(shape, 2)
    target = np.arange(shape.inputs)
    hidden = np.random.default_rng(1).uniform(-1, 1, (len(target), shape.hidden)).astype(np.float32)
    want, back = gru._outputs(p, shape, hidden, target, {})
    moved = p | {name: p[name] + np.float32(shift) for name in ("class_bias", "word_bias")}
    got, slope = gru._outputs(moved, shape, hidden, target, {})
    assert np.allclose(got, want, atol=1e-3) and np.allclose(slope, back, atol=1e-3)


def test_training_beats_the_class_frequencies():
    shape = SMALL.shape
    rng = np.random.default_rng(7)
    docs = [np.array([*([1, 2, 3, 4] * int(rng.integers(2, 9))), 0], np.int32) for _ in range(300)]
    trainer = gru.Trainer(gru.initial(shape), shape, rate=0.1)
    for _ in range(20):
        trainer.learn(docs, 0)
    tokens = sum(map(len, docs))
    assert gru.log_likelihoods(trainer.p, shape, docs, 0).sum() / tokens > -0.6


def test_every_token_is_learnt_from():
    spec = language_model.Spec()
    docs = [np.full(n, 3, np.int32) for n in (1, 24, 100, 333)]
    trainer = gru.Trainer(gru.initial(spec.shape), spec.shape, spec.rate, every=spec.every)
    trainer.learn(docs, 0)
    assert trainer.tokens == sum(map(len, docs))


def brute_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest)[0]
    return lower_ascii(host), re.split(r"[?#]", rest[len(host) :])[0]


URLS = [
    None, "", "no scheme", "http://", "https://A.Example.ORG/es/1?x=1", "http://example.org/en/12#t", "http://org/", "http://xorg/de/",
    "http://b.com/fr/9", "http://b.com/de/9", "http://com/de", "ftp://c.net?q=1&r=2&&", "http://c.net#/de/", "x://y.org/a://b.com/de/",
    "http://b.com:80/fr/", "http://sub.example.org/en/2", "http://b.com/de/9",
]


def test_urls_rules_and_parts(spark):
    rng = random.Random(3)
    urls = URLS + [f"http://{rng.choice('abc')}.{rng.choice(['org', 'com', 'net'])}/{rng.choice(['de', 'fr', 'es'])}/{rng.randrange(999)}" for _ in range(60)]
    pages = spark.createDataFrame([(i, u, "<p>", "x") for i, u in enumerate(urls)], "page_id long, url string, html string, rule string")
    got = url_filter.page_verdicts(pages, bound=url_filter.Bound(trees=3, depth=2)).collect()
    assert len(got) == len(urls)
    for r in got:
        host, path = brute_url(urls[r.page_id])
        assert (r.host, r.path) == (host, path)
        fits = [x for x in url_filter.RULES if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)]
        best = max(fits, key=lambda x: len(x.name), default=None)
        assert r.rule == (best.name if best else None)
        assert r.verdict == (best.verdict if best else ("block" if r.block_score >= 0.5 else "allow"))


def test_trees_learn_from_labelled_urls(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        bad = i % 2
        name = "".join(rng.choice("0123456789" if bad and rng.random() < 0.5 else "abcdefgh") for _ in range(12))
        rows.append((f"http://{name}.net/{'x/' * (4 if bad else 1)}{rng.randrange(99)}?{'a=1&' * (3 if bad else 0)}", bad))
    train, test = rows[:300], rows[300:]
    model = url_filter.fit_urls(spark.createDataFrame(train, "url string, label int"), url_filter.Bound(trees=4, depth=2))
    got = model.scored(spark.createDataFrame(test, "url string, label int")).collect()
    assert sum((r.block_score >= 0.5) == bool(r.label) for r in got) / len(got) > 0.95
    none = url_filter.page_verdicts(spark.createDataFrame([], "page_id long, url string"))
    assert none.collect() == []


def test_capped_urls_keep_the_shares_of_all_labels(spark):
    rng = random.Random(6)
    rows = [(f"http://{''.join(rng.choice('abcdefgh') for _ in range(8))}.net/{i}", int(i % 5 == 0)) for i in range(400)]
    urls = spark.createDataFrame(rows, "url string, label int")
    model = url_filter.fit_urls(urls, url_filter.Bound(per_class=40, trees=2, depth=1))
    assert abs(model.overall - 0.2) < 1e-9
    assert abs(sum(r.block_score for r in model.scored(urls).collect()) / len(rows) - 0.2) < 0.15


def test_suffix_rates_cover_all_labelled_urls(spark):
    rows = [(f"http://d{i % 50}.net/{i}", int(i % 50 < 10)) for i in range(300)]
    model = url_filter.fit_urls(spark.createDataFrame(rows, "url string, label int"), url_filter.Bound(per_class=5, trees=1, depth=1))
    rates = {r.suffix: r.rate for r in model.rates.collect()}
    assert len(rates) == 51
    assert all(abs(rates[f"d{k}.net"] - (6 * (k < 10) + 20 * 0.2) / 26) < 1e-9 for k in range(50))


def test_pipeline_stages_hand_on_documents(spark, tmp_path):
    import corpus_pipeline

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        if k < 4:
            assert out.columns == columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] and sizes[4] == sizes[5]
    assert set(docs.columns) >= {"doc_id", "shard", "slot"}


def test_pipeline_stages_keep_clashing_columns_and_take_empty_tables(spark, make):
    import corpus_pipeline

    sf_dir = "/root/testdata/sf0.001"
    rows = [(i, sentence(random.Random(i), 60, 4000), f"src{i % 3}") for i in range(12)] + [(50, None, None), (50, None, None), (51, "", "src0")]
    docs = make(rows)
    for name in ("score", "mix_tokens", "mix_block", "mix_key", "node", "rank", "__label", "shingles", "keys"):
        docs = docs.withColumn(name, F.concat(F.lit("x"), F.col("doc_id")))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        assert all(r["score"] == r["mix_tokens"] == f"x{r.doc_id}" for r in out.collect()), name
        assert stage(spark, docs.limit(0), sf_dir).collect() == [], name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == len(rows)


def test_the_labelled_sample_is_the_same_however_ids_repeat(spark, make):
    rows = [(i, f"text {i} " * 20) for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    bound = labelled.Bound(per_class=8, max_bytes=900)
    found = []
    for repeat in (1, 30):
        docs = make(rows + [(0, "a smaller text")] * repeat).repartition(3)
        found.append(labelled.labelled_sample(docs, labels, "quality", F.lit(True), bound))
    assert found[0].texts == found[1].texts
    for c in (0, 1):
        texts = [t for t, y in zip(found[0].texts, found[0].labels) if y == c]
        assert 0 < len(texts) < 8 and sum(map(len, texts)) <= 900
