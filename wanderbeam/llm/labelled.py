"""A bounded sample of labelled texts, and the pieces the linear text models share."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wanderbeam.llm.text import id_remainder
from wanderbeam.session import materialise


@dataclass(frozen=True)
class Bound:
    """Limits of the training sample: rows and UTF-8 bytes of each class, and characters of a sampled text."""

    per_class: int = 3000
    max_chars: int = 200_000
    max_bytes: int = 64 << 20
    seed: int = 7


@dataclass
class Sample:
    texts: list[str]
    labels: np.ndarray
    # Weight of each row so that the classes weigh as in all labelled rows.
    weights: np.ndarray


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, bound: Bound) -> Sample:
    """Up to ``bound.per_class`` texts of each class, by the order of a hash of the id.

    ``learn`` says which label rows may be learnt from. Rows whose label is neither 0 nor 1, whose id is
    NULL or whose text is longer than the bound are left out of the sample. Of several texts with one id the smallest
    is taken. Texts are taken as long as they fit in ``bound.max_bytes``, in the same order, so that what reaches the driver is bounded. At most
    ``per_class`` ids of each class are broadcast.
    """
    usable = labels.where(learn & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    usable = usable.select("doc_id", F.col(label).cast("int").alias("__label")).distinct()
    totals = dict(usable.groupBy("__label").count().collect())
    order = F.xxhash64("doc_id", F.lit(bound.seed))
    chosen = [usable.where(F.col("__label") == c).orderBy(order, "doc_id").limit(bound.per_class) for c in (0, 1)]
    ids = chosen[0].union(chosen[1])
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select("doc_id", text.alias("text")).where(F.length("text") <= bound.max_chars)
    asked = found.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "__label").agg(F.min("text").alias("text"))
    asked = materialise(asked, "labelled-sample")
    upto = F.sum("size").over(Window.partitionBy("__label").orderBy(order, "doc_id"))
    sizes = asked.select("doc_id", "__label", F.octet_length("text").cast("long").alias("size"))
    fits = sizes.withColumn("upto", upto).where(F.col("upto") <= bound.max_bytes).select("doc_id", "__label")
    rows = asked.join(F.broadcast(fits), ["doc_id", "__label"]).select("text", "__label", "doc_id").collect()
    rows.sort(key=lambda r: (r[2], r[1], r[0]))
    y = np.array([r[1] for r in rows], np.int64)
    seen = Counter(y.tolist())
    weights = np.array([totals.get(int(c), 0) / seen[int(c)] for c in y], float)
    return Sample([r[0] for r in rows], y, weights / weights.mean() if len(y) else weights)


def vocabulary(features: Iterable[set[bytes]], min_rows: int, size: int) -> dict[bytes, int]:
    """Features of at least ``min_rows`` texts, the ``size`` most frequent, ties in byte order."""
    counts = Counter(f for row in features for f in row)
    kept = sorted((f for f, n in counts.items() if n >= min_rows), key=lambda f: (-counts[f], f))[:size]
    return {f: i for i, f in enumerate(kept)}


def indices(row: set[bytes], vocab: dict[bytes, int]) -> np.ndarray:
    return np.array(sorted(vocab[f] for f in row & vocab.keys()), np.int64)


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def platt(margins: np.ndarray, labels: np.ndarray, weights: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """(a, b) of sigmoid(a * margin + b), by weighted Newton steps with smoothed targets."""
    up, down = weights[labels == 1].sum(), weights[labels == 0].sum()
    target = np.where(labels == 1, (up + 1) / (up + 2), 1 / (down + 2))
    x = np.stack([margins, np.ones_like(margins)], 1)
    coef = np.array([1.0, 0.0])
    for _ in range(steps):
        p = sigmoid(x @ coef)
        grad = x.T @ (weights * (p - target)) + 1e-6 * coef
        hess = (x * (weights * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        move = np.linalg.solve(hess, grad)
        coef -= move / max(1.0, np.abs(move).max() / 5)
        if np.abs(move).max() < 1e-9:
            break
    return float(coef[0]), float(coef[1])


def held_out_flag(modulus: int, remainder: int) -> Column:
    return id_remainder("doc_id", modulus) == remainder
