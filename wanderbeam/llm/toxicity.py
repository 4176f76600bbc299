"""Toxicity: a linear classifier that must not change its mind when identity terms are swapped."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wanderbeam.llm.labelled import Bound, held_out_flag, indices, labelled_sample, platt, sigmoid
from wanderbeam.llm.text import text_bytes

THRESHOLD = 0.3
PUNCTUATION = b".,;:!?\"'()[]{}<>*#$%&|-_/"
PREFIXES = (4, 5, 6, 7, 8)
# Terms for groups of people; within a line any may stand for any other.
IDENTITY_TERMS = (
    "women men girls boys females males frauen männer femmes hommes mujeres hombres",
    "muslims christians jews hindus buddhists atheists catholics muslime christen juden musulmans chrétiens juifs musulmanes cristianos judíos",
    "muslim christian jewish hindu buddhist atheist catholic",
    "gay lesbian straight bisexual transgender queer",
    "black white asian latino hispanic african european arab",
    "immigrants refugees foreigners natives ausländer immigrés inmigrantes",
    "disabled deaf blind autistic",
    "old young elderly teenage",
)


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words without punctuation around them."""
    return [w for w in (x.strip(PUNCTUATION) for x in text_bytes(text, lower=True).split()) if w]


def features(distinct: set[bytes]) -> set[bytes]:
    """The words, and their first bytes marked with how many words begin so, up to three."""
    out = set(distinct)
    for n in PREFIXES:
        for head, count in Counter(w[:n] for w in distinct if len(w) > n).items():
            for k in range(1, min(count, 3) + 1):
                out.add(b"%b.%d" % (head, k))
    return out


def telling(rows: Iterable[set[bytes]], labels: np.ndarray, min_rows: int, least_z: float, size: int) -> dict[bytes, int]:
    """Features whose shares in the two classes differ by ``least_z`` standard errors or more.

    Without this choice the many words that stand in a few rows each add up in long texts. The rows are
    looked at one by one and only counts are kept.
    """
    counts = [Counter(), Counter()]
    for row, y in zip(rows, labels.tolist()):
        counts[y].update(row)
    n0, n1 = int((labels == 0).sum()), int((labels == 1).sum())
    scored = []
    for f in counts[0].keys() | counts[1].keys():
        a, b = counts[0][f], counts[1][f]
        if a + b >= min_rows:
            share = (a + b) / (n0 + n1)
            z = abs(b / n1 - a / n0) / np.sqrt(max(share * (1 - share), 1e-9) * (1 / n0 + 1 / n1))
            if z >= least_z:
                scored.append((-z, f))
    return {f: i for i, (_, f) in enumerate(sorted(scored)[:size])}


def swap_table(groups: tuple[str, ...] = IDENTITY_TERMS) -> dict[bytes, list[bytes]]:
    out: dict[bytes, list[bytes]] = {}
    for group in groups:
        names = [x.encode() for x in group.split()]
        for name in names:
            out.setdefault(name, []).extend(x for x in names if x != name)
    return out


def counterfactuals(words: list[bytes], swaps: dict[bytes, list[bytes]]) -> list[set[bytes]]:
    """Distinct words of the text with one identity term replaced by each other term of its line."""
    distinct = set(words)
    return [distinct - {term} | {other} for term in sorted(distinct & swaps.keys()) for other in swaps[term]]


@dataclass
class Model:
    vocab: dict[bytes, int]
    coef: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0

    def margin(self, text: str | None) -> float:
        return self.bias + float(self.coef[indices(features(set(tokens(text))), self.vocab)].sum())

    def score(self, text: str | None) -> float:
        return float(sigmoid(self.slope * self.margin(text) + self.offset))


def train(
    texts: list[str],
    labels: np.ndarray,
    weights: np.ndarray,
    penalty: float = 1.0,
    groups: tuple[str, ...] = IDENTITY_TERMS,
    epochs: int = 12,
    rate: float = 0.3,
    ridge: float = 2e-4,
    min_rows: int = 4,
    least_z: float = 4.0,
    size: int = 20_000,
    seed: int = 7,
) -> Model:
    """Logistic regression plus ``penalty`` * (margin(x) - margin(x'))^2 over swapped texts x'.

    Adaptive gradient steps on single rows. Of every swapped pair only the features that differ matter, so the
    penalty pulls the weights of interchangeable terms together, and, since the swapped
    term is as often one that the labels never saw, towards none. Fits on four fifths of the rows and
    calibrates on the rest. One class only, or none, gives its share as every score.
    """
    if len(set(labels.tolist())) < 2:
        share = float(labels.mean()) if len(labels) else 0.5
        return Model({}, np.zeros(0), float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    swaps = swap_table(groups)
    rows = (features(set(tokens(t))) for t in texts)
    vocab = telling(rows, labels, min(min_rows, max(1, len(texts) // 10)), least_z, size)
    vocab |= {t: len(vocab) + k for k, t in enumerate(sorted(swaps.keys() - vocab.keys()))}
    found: list[np.ndarray] = []
    pairs: list[list[tuple[np.ndarray, np.ndarray]]] = []
    for text in texts:
        words = tokens(text)
        row = features(set(words))
        found.append(indices(row, vocab))
        other = [features(x) for x in counterfactuals(words, swaps)]
        pairs.append([(indices(row - o, vocab), indices(o - row, vocab)) for o in other])
    rng = np.random.default_rng(seed)
    spare = rng.random(len(texts)) < 0.2
    if len(texts) < 50 or len(set(labels[spare].tolist())) < 2 or len(set(labels[~spare].tolist())) < 2:
        spare[:] = False
    coef, heat = np.zeros(len(vocab)), np.full(len(vocab), 1e-2)
    bias, bias_heat = 0.0, 1e-2
    fit = np.flatnonzero(~spare)
    for _ in range(epochs):
        for i in rng.permutation(fit).tolist():
            at = found[i]
            slope = float(sigmoid(bias + coef[at].sum())) - labels[i]
            grad = slope + ridge * coef[at]
            heat[at] += grad * grad
            coef[at] -= rate * grad / np.sqrt(heat[at])
            bias_heat += slope * slope
            bias -= rate * slope / np.sqrt(bias_heat)
            for gone, new in pairs[i]:
                gap = coef[gone].sum() - coef[new].sum()
                if gap and penalty:
                    # A step on the squared gap, never past the point where it closes.
                    step = min(penalty * rate, 0.5) * gap / (len(gone) + len(new))
                    coef[gone] -= step
                    coef[new] += step
    model = Model(vocab, coef.astype(np.float32), bias)
    test = spare if spare.any() else ~spare
    margins = np.array([bias + float(model.coef[x].sum()) for x, s in zip(found, test) if s])
    model.slope, model.offset = platt(margins, labels[test], weights[test])
    return model


def fit_toxicity(docs: DataFrame, labels: DataFrame, learn, label: str = "toxic", bound: Bound = Bound()) -> Model:
    sample = labelled_sample(docs, labels, label, learn, bound)
    return train(sample.texts, sample.labels, sample.weights)


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` with ``score``: only the text is looked at, NULL as an empty one."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        margins = np.array([model.margin(t) for t in texts], float)
        return pd.Series(sigmoid(model.slope * margins + model.offset))

    return docs.withColumn("score", score(F.col("text")))


def document_toxicity(docs: DataFrame, labels: DataFrame, bound: Bound = Bound()) -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    Labels are learnt from rows whose crc32(doc_id) is not 2 modulo 4. Repeated rows are scored
    each; an empty table gives no rows, no labels at all give 0.5 everywhere.
    """
    model = fit_toxicity(docs, labels, ~held_out_flag(4, 2), bound=bound)
    return scores(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out_flag(4, 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
