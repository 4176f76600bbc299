"""Quality classifier: naive Bayes log-count ratios under a linear hinge-loss model."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wanderbeam.llm.labelled import Bound, held_out_flag, indices, labelled_sample, platt, sigmoid, vocabulary
from wanderbeam.llm.text import LOWER_TABLE, text_bytes

THRESHOLD = 0.3
_RUN = re.compile(rb"[a-z\x80-\xff]+|[A-Z]+|[0-9]+|([^A-Za-z0-9\x80-\xff])\1*")


def shape(word: bytes) -> bytes:
    """Letters as x or X, digits as 0, other characters as they are, runs as one."""

    def code(m: re.Match) -> bytes:
        first = m[0][:1]
        if first.isdigit():
            return b"0"
        if first.isalpha() or first >= b"\x80":
            return b"X" if first.isupper() else b"x"
        return first

    return _RUN.sub(code, word)


_BITS = 20
_MASK = (1 << _BITS) - 1


class Reader:
    """Splits texts into binary n-gram features; remembers a bounded number of words.

    Features are word unigrams, word shape 1- to 3-grams, and the share of word 2-grams that are not
    repeats, in tenths. ``value`` says what to make of a feature's name (by default the name itself) and is
    asked once per word and shape n-gram, not once per occurrence.
    """

    def __init__(self, value=lambda name: name, memory: int = 200_000):
        self.value, self.memory = value, memory
        self.clear()

    def clear(self) -> None:
        self.codes: dict[bytes, int] = {}
        self.word_values: dict[bytes, object] = {}
        self.shapes: dict[bytes, int] = {}
        self.shape_names: list[bytes] = [b""]
        self.gram_values: dict[int, object] = {}

    def _learn(self, words: list[bytes]) -> None:
        for w in words:
            s = shape(w)
            if s not in self.shapes:
                self.shapes[s] = len(self.shape_names)
                self.shape_names.append(s)
            self.codes[w] = len(self.codes) << _BITS | self.shapes[s]
            self.word_values[w] = self.value(b"w:" + w.translate(LOWER_TABLE))

    def _gram(self, code: int) -> object:
        found = self.gram_values.get(code)
        if found is None:
            names, rest = [], code
            while rest:
                names.append(self.shape_names[rest & _MASK])
                rest >>= _BITS
            found = self.gram_values[code] = self.value(b"s:" + b" ".join(reversed(names)))
        return found

    def read(self, text: str | None) -> list:
        """The values of the features of a text, a few of them more than once."""
        parts = text_bytes(text).split()
        if not parts:
            return [self.value(b"empty")]
        if len(self.codes) > self.memory or len(self.shape_names) >= _MASK:
            self.clear()
        distinct = set(parts)
        self._learn([w for w in distinct if w not in self.codes])
        n = len(parts)
        codes = np.fromiter(map(self.codes.__getitem__, parts), np.int64, n)
        shapes = codes & _MASK
        if n > 2:
            threes = np.unique(shapes[:-2] << 2 * _BITS | shapes[1:-1] << _BITS | shapes[2:])
            twos = np.append(np.unique(threes >> _BITS), shapes[-2] << _BITS | shapes[-1])
        else:
            threes = np.empty(0, np.int64)
            twos = shapes[:-1] << _BITS | shapes[1:]
        grams = {*threes.tolist(), *twos.tolist(), *np.unique(shapes).tolist()}
        values = [self.word_values[w] for w in distinct]
        values += [self._gram(g) for g in grams]
        if n > 1:
            words = codes >> _BITS
            pairs = np.unique(words[:-1] * (len(self.codes) + 1) + words[1:])
            values.append(self.value(b"fresh:%d" % (10 * len(pairs) // (n - 1))))
        return values

    def of(self, text: str | None) -> set[bytes]:
        return set(self.read(text))


@dataclass
class Model:
    """score = sigmoid(slope * (bias + sum of the features' coefficients) + offset)."""

    vocab: dict[bytes, int]
    coef: np.ndarray
    bias: float
    slope: float
    offset: float

    def reader(self) -> Reader:
        """Gives a feature's index in ``coef``, -1 for features outside the vocabulary."""
        return Reader(lambda name: self.vocab.get(name, -1))

    def margin(self, reader: Reader, text: str | None) -> float:
        found = set(reader.read(text))
        found.discard(-1)
        return self.bias + float(self.coef[np.fromiter(found, np.int64, len(found))].sum())


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray, size: int, alpha: float = 1.0) -> np.ndarray:
    """log of the smoothed share of each feature among class 1 over that among class 0."""
    counts = np.full((2, size), alpha)
    for at, y in zip(rows, labels.tolist()):
        counts[y, at] += 1
    shares = counts / counts.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


def dual_coordinate_descent(
    rows: list[np.ndarray], ratios: np.ndarray, labels: np.ndarray, cost: np.ndarray, epochs: int, seed: int
) -> tuple[np.ndarray, float]:
    """(weights, bias) of the hinge-loss model on indicator * ratio features, one dual variable at a time."""
    sign = np.where(labels == 1, 1.0, -1.0)
    w, bias = np.zeros(len(ratios)), 0.0
    dual = np.zeros(len(rows))
    values = [ratios[at] for at in rows]
    norms = np.array([1.0 + float(v @ v) for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        most = 0.0
        for i in rng.permutation(len(rows)).tolist():
            slope = sign[i] * (float(w[rows[i]] @ values[i]) + bias) - 1.0
            new = min(max(dual[i] - slope / norms[i], 0.0), cost[i])
            step = new - dual[i]
            if step:
                dual[i] = new
                w[rows[i]] += step * sign[i] * values[i]
                bias += step * sign[i]
                most = max(most, abs(step) * norms[i])
        if most < 1e-3:
            break
    return w, bias


def train(
    texts: list[str],
    labels: np.ndarray,
    weights: np.ndarray,
    cost: float = 0.1,
    blend: float = 0.5,
    epochs: int = 30,
    min_rows: int = 3,
    size: int = 65_536,
    seed: int = 7,
) -> Model:
    """Fits on four fifths of the rows and calibrates on the other fifth.

    ``blend`` moves the weights towards their mean size, so that naive Bayes decides where the data
    say little. With one class only, or none, every score is that class's share.
    """
    if len(set(labels.tolist())) < 2:
        share = float(labels.mean()) if len(labels) else 0.5
        odds = np.log((share + 1e-3) / (1 - share + 1e-3))
        return Model({}, np.zeros(0), 0.0, 1.0, float(odds))
    reader = Reader(memory=50_000)
    vocab = vocabulary((reader.of(t) for t in texts), min(min_rows, max(1, len(texts) // 10)), size)
    found = [indices(reader.of(t), vocab) for t in texts]
    spare = np.random.default_rng(seed).random(len(texts)) < 0.2
    if len(texts) < 50 or len(set(labels[spare].tolist())) < 2 or len(set(labels[~spare].tolist())) < 2:
        spare[:] = False
    fit = [x for x, s in zip(found, spare) if not s]
    y = labels[~spare]
    ratios = log_count_ratios(fit, y, len(vocab))
    balance = np.where(y == 1, len(y) / (2 * max(1, (y == 1).sum())), len(y) / (2 * max(1, (y == 0).sum())))
    w, bias = dual_coordinate_descent(fit, ratios, y, cost * balance, epochs, seed)
    w = (1 - blend) * np.abs(w).mean() + blend * w
    model = Model(vocab, (w * ratios).astype(np.float32), bias, 1.0, 0.0)
    test = spare if spare.any() else ~spare
    margins = np.array([model.bias + float(model.coef[x].sum()) for x, s in zip(found, test) if s])
    model.slope, model.offset = platt(margins, labels[test], weights[test])
    return model


def fit_quality(docs: DataFrame, labels: DataFrame, learn, label: str = "quality", bound: Bound = Bound()) -> Model:
    sample = labelled_sample(docs, labels, label, learn, bound)
    return train(sample.texts, sample.labels, sample.weights)


def scores(docs: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """The rows of ``docs`` with their score in ``out``: only the text is looked at, NULL as an empty one."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        reader = model.reader()
        margins = np.array([model.margin(reader, t) for t in texts], float)
        return pd.Series(sigmoid(model.slope * margins + model.offset))

    return docs.withColumn(out, score(F.col("text")))


def learnable(modulus: int = 5, remainder: int = 0):
    return ~held_out_flag(modulus, remainder)


def document_quality(docs: DataFrame, labels: DataFrame, bound: Bound = Bound()) -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    Labels are learnt from rows whose crc32(doc_id) is not 0 modulo 5. Repeated rows are scored
    each; an empty table gives no rows, no labels at all give 0.5 everywhere.
    """
    model = fit_quality(docs, labels, learnable(), bound=bound)
    return scores(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out_flag(5, 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def accepted(docs: DataFrame, labels: DataFrame, bound: Bound = Bound(), threshold: float = THRESHOLD) -> DataFrame:
    """The documents with a score of at least ``threshold``, with the columns of ``docs``, whatever their names.

    NULL and blank texts are scored like any other; repeated rows are judged each; no documents give no rows, and without
    labels every score is 0.5. Very long texts are read whole, one at a time.
    """
    model = fit_quality(docs, labels, learnable(), bound=bound)
    return scores(docs, model, "__quality_score").where(F.col("__quality_score") >= threshold).drop("__quality_score")
