"""Next-action classifier in closed form: smoothed class and feature counts.

Naive Bayes over an exact vocabulary: every value seen in training has a place of its own, however many
there are, and fitting is one aggregation. A second implementation of the interface of
``scoring``, for results that must repeat exactly.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wanderbeam.functions.numbers import nearest
from wanderbeam.operators.scoring import N_CLASSES, ModelSpec, positional_features, with_importance
from wanderbeam.operators.skew import lookup_join
from wanderbeam.session import materialise

SMOOTHING = 1.0
# Sums of logarithms are compared to this many decimals, so that their order does not settle ties.
DECIMALS = 9


@dataclass
class BayesModel:
    """``priors``: log share of each class; ``logs``: (name, value, logs per class)."""

    spec: ModelSpec
    priors: list[float]
    logs: DataFrame


def _features(rows: DataFrame, names: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """One row per feature: the keys, ``name`` and ``value``."""
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).cast("string").alias("value")) for n in names])
    return rows.select(*keys, F.explode(pairs).alias("f")).select(*keys, "f.name", "f.value")


def fit(history: DataFrame, spec: ModelSpec, smoothing: float = SMOOTHING) -> BayesModel:
    """Counts ``target`` classes and their feature values; both are smoothed by ``smoothing``.

    The vocabulary of a feature is what training holds. Partial counts are formed before the shuffle,
    so a value that most rows share costs one row per task.
    """
    rows = positional_features(history, spec)
    counts = {r[0]: r[1] for r in rows.groupBy("target").count().collect()}
    total = sum(counts.values())
    per_class = [counts.get(c, 0) for c in range(N_CLASSES)]
    priors = [math.log((n + smoothing) / (total + smoothing * N_CLASSES)) for n in per_class]
    seen = (
        _features(rows, spec.feature_names(), ["target"])
        .groupBy("name", "value")
        .agg(*[F.count_if(F.col("target") == c).alias(f"n{c}") for c in range(N_CLASSES)])
    )
    seen = materialise(seen, "bayes-counts")
    sizes = seen.groupBy("name").agg(F.count(F.lit(1)).alias("size"))
    logs = F.array(
        *[
            F.ln((F.col(f"n{c}") + F.lit(smoothing)) / (F.lit(float(n)) + F.lit(smoothing) * F.col("size")))
            for c, n in enumerate(per_class)
        ]
    )
    # As many rows in sizes as there are features.
    table = seen.join(F.broadcast(sizes), "name").select(_key("name", "value").alias("key"), logs.alias("logs"))
    return BayesModel(spec, priors, materialise(table, "bayes-logs"))


def _key(name: str, value: str) -> Column:
    return F.concat_ws("=", name, value)


ITEM_FEATURES = ("target_hotel_id", "target_style")


def log_parts(rows: DataFrame, model: BayesModel, keys: Sequence[str], names: Sequence[str], out: str = "logs") -> DataFrame:
    """``keys`` of every row with the class logarithms of the features ``names``, summed up in ``out``.

    ``keys`` must be unique. A value that training never held says nothing.
    """
    parts = _features(rows, names, keys).select(*keys, _key("name", "value").alias("key"))
    found = lookup_join(parts, model.logs, "key", "left")
    sums = found.groupBy(*keys).agg(
        *[F.sum(F.coalesce(F.col("logs")[c], F.lit(0.0))).alias(f"l{c}") for c in range(N_CLASSES)]
    )
    return sums.select(*keys, F.array(*[f"l{c}" for c in range(N_CLASSES)]).alias(out))


def user_logs(users: DataFrame, model: BayesModel, styles: str = "style_sequence") -> DataFrame:
    """(user_id, user_logs): the part of the score that the history and the attributes of a user give.

    The prior is in it, so that ``user_logs`` plus ``item_logs`` is the whole score.
    """
    names = [n for n in model.spec.feature_names() if n not in ITEM_FEATURES]
    blank = users.withColumns({n: F.lit(None).cast("string") for n in ITEM_FEATURES})
    parts = log_parts(positional_features(blank, model.spec, styles), model, ["user_id"], names, "user_logs")
    priors = F.array(*[F.lit(p) for p in model.priors])
    return parts.withColumn("user_logs", F.zip_with("user_logs", priors, lambda a, b: a + b))


def item_logs(items: DataFrame, model: BayesModel) -> DataFrame:
    """``items`` with ``item_logs``: the part of the score that an item gives, whoever it is offered to."""
    names = [n for n in ITEM_FEATURES if n in model.spec.feature_names()]
    named = items.withColumns({"target_hotel_id": F.col("hotel_id"), "target_style": F.coalesce("style_name", F.lit("unspecified"))})
    parts = log_parts(named, model, ["hotel_id"], names, "item_logs")
    return items.join(parts, "hotel_id")


def class_probabilities(logs: Column) -> Column:
    """Probabilities from class logarithms, which are compared to ``DECIMALS`` places."""
    near = F.transform(logs, lambda x: F.round(x, DECIMALS))
    powers = F.transform(F.array(near), lambda v: F.transform(v, lambda x: F.exp(x - F.array_max(v))))[0]
    whole = F.transform(F.array(powers), lambda p: F.transform(p, lambda x: x / F.aggregate(p, F.lit(0.0), lambda a, b: a + b)))
    return whole[0]


def score_pairs(pairs: DataFrame) -> DataFrame:
    """``pairs`` with pred_action, prob and important_value in place of their user_logs and item_logs.

    A pair costs one addition of two short arrays; no feature is looked up for it. The steps are those of ``class_probabilities``
    and ``with_importance`` with a column for each class: functions over arrays are interpreted, plain columns are compiled.
    """
    classes = range(N_CLASSES)

    def each(name: str) -> list[Column]:
        return [F.col(f"__{name}{c}") for c in classes]

    # Every step is a projection of its own, so that nothing is worked out twice.
    rows = pairs.withColumns({f"__sum{c}": F.get("user_logs", F.lit(c)) + F.get("item_logs", F.lit(c)) for c in classes})
    rows = rows.withColumns({f"__log{c}": nearest(x, DECIMALS) for c, x in enumerate(each("sum"))})
    rows = rows.withColumn("__most", F.greatest(*each("log")))
    rows = rows.withColumns({f"__exp{c}": F.exp(x - F.col("__most")) for c, x in enumerate(each("log"))})
    rows = rows.withColumns({"__whole": reduce(add, each("exp")), "__top": F.greatest(*each("exp"))})
    first = F.coalesce(*[F.when(x == F.col("__top"), F.lit(c)) for c, x in enumerate(each("exp"))])
    rows = rows.withColumns({"pred_action": F.when(F.col("__whole").isNotNull(), first), "prob": F.col("__top") / F.col("__whole")})
    rows = rows.withColumn("important_value", F.col("pred_action") * F.col("prob"))
    added = ["pred_action", "prob", "important_value"]
    return rows.select(*[c for c in pairs.columns if c not in ("user_logs", "item_logs", *added)], *added)


def probabilities(rows: DataFrame, model: BayesModel, keys: Sequence[str], styles: str = "style_name_sequence") -> DataFrame:
    """``keys`` of every row with ``probabilities``, one per class, looked up feature by feature.

    ``keys`` must be unique. A missing value is ``unspecified``. For users times items see ``score_pairs``.
    """
    wide = positional_features(rows, model.spec, styles)
    parts = log_parts(wide, model, keys, model.spec.feature_names())
    priors = F.array(*[F.lit(p) for p in model.priors])
    whole = class_probabilities(F.zip_with("logs", priors, lambda a, b: a + b))
    return parts.select(*keys, whole.alias("probabilities"))


def unseen_values(rows: DataFrame, model: BayesModel, styles: str = "style_name_sequence") -> DataFrame:
    """name, n and n_unseen: of every feature its values in ``rows``, and those that training never held.

    Such values say nothing to the model. Where they are many the vocabulary is out of date.
    """
    wide = positional_features(rows, model.spec, styles)
    asked = _features(wide, model.spec.feature_names(), []).groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
    known = model.logs.select("key", F.lit(True).alias("known"))
    found = lookup_join(asked.select("name", "n", _key("name", "value").alias("key")), known, "key", "left")
    return found.groupBy("name").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("known").isNull(), F.col("n")).otherwise(0)).alias("n_unseen"))


def score(rows: DataFrame, model: BayesModel, keys: Sequence[str], styles: str = "style_sequence") -> DataFrame:
    """``keys``, pred_action, prob and important_value of every row."""
    scored = with_importance(probabilities(rows, model, keys, styles), F.col("probabilities"))
    return scored.drop("probabilities")


def predicted(history: DataFrame, model: BayesModel, keys: Sequence[str]) -> DataFrame:
    """``keys``, label, prediction and whatever else ``history`` is split by."""
    found = score(history, model, keys, "style_name_sequence").select(*keys, F.col("pred_action").alias("prediction"))
    labels = history.select(*keys, F.col("target").alias("label"), *[c for c in ("split",) if c in history.columns])
    return labels.join(found, list(keys))


def quality(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """n, accuracy and f1 (per class, weighted by its labels) for each group of ``by``."""
    by = list(by)
    pairs = rows.groupBy(*by, "label", "prediction").agg(F.count(F.lit(1)).alias("n"))
    classes = []
    for c in range(N_CLASSES):
        hit = F.sum(F.when((F.col("label") == c) & (F.col("prediction") == c), F.col("n")).otherwise(0))
        labelled = F.sum(F.when(F.col("label") == c, F.col("n")).otherwise(0))
        guessed = F.sum(F.when(F.col("prediction") == c, F.col("n")).otherwise(0))
        # 2 p r / (p + r) = 2 hits / (labels + guesses)
        classes.append(F.when(labelled + guessed > 0, labelled * 2 * hit / (labelled + guessed)).otherwise(0.0))
    total = F.sum("n")
    right = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0))
    f1 = sum(classes[1:], classes[0]) / total
    return pairs.groupBy(*by).agg(total.alias("n"), (right / total).alias("accuracy"), f1.alias("f1"))
