"""Scoring of (user, candidate item) rows: an exact empirical scorer and an ML model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import FeatureHasher
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wanderbeam.functions import actions, arrays

N_CLASSES = len(actions.ACTION_CODES)
# Weights of a perceptron's first layer, which the driver holds whole.
MOST_WEIGHTS = 1 << 22


def with_importance(df: DataFrame, probabilities: Column) -> DataFrame:
    """Adds the most likely class, its probability, and ``class * probability``."""
    return (
        df.withColumn("__p", probabilities)
        .withColumns({"pred_action": arrays.argmax(F.col("__p")), "prob": F.array_max("__p")})
        .withColumn("important_value", F.col("pred_action") * F.col("prob"))
        .drop("__p")
    )


def action_shares(events: DataFrame) -> DataFrame:
    """Per item the share of every action class among its training events."""
    code = actions.encode(F.col("main_action"))
    counts = events.filter(code.isNotNull()).groupBy("hotel_id").agg(
        F.array(*[F.count_if(code == c) for c in range(N_CLASSES)]).alias("n")
    )
    total = F.aggregate("n", F.lit(0).cast("bigint"), lambda a, b: a + b)
    return counts.select("hotel_id", F.transform("n", lambda v: v / total).alias("shares"))


def empirical_scores(events: DataFrame) -> DataFrame:
    """(hotel_id, pred_action, prob, important_value) from the items' action shares."""
    return with_importance(action_shares(events), F.col("shares")).drop("shares")


# --- model -----------------------------------------------------------------


@dataclass(frozen=True)
class ModelSpec:
    """What the next-action classifier sees and how it is fitted.

    ``hidden_units`` empty means multinomial logistic regression, otherwise a perceptron.
    Values are hashed into ``width`` slots: no vocabulary has to reach the driver, and a new
    user or item at scoring time needs no special case.
    """

    length: int = 6
    include_user_id: bool = False
    include_user_features: bool = True
    include_hotel_features: bool = True
    hidden_units: tuple[int, ...] = ()
    width: int = 1 << 18
    max_iter: int = 20
    regularisation: float = 0.01
    seed: int = 42

    def feature_names(self) -> list[str]:
        steps = range(1, self.length)
        names = ["target_hotel_id", *[f"h{i}" for i in steps]]
        if self.include_hotel_features:
            names += ["target_style", *[f"s{i}" for i in steps]]
        if self.include_user_features:
            names += ["gender", "age_group"]
        if self.include_user_id:
            names.append("user_id")
        return names


def positional_features(df: DataFrame, spec: ModelSpec, styles: str = "style_name_sequence") -> DataFrame:
    """One column per history position (h1.., s1..); missing values become ``unspecified``."""
    columns = {}
    for i in range(1, spec.length):
        columns[f"h{i}"] = F.try_element_at("sequence_hotel_ids", F.lit(i))
        if spec.include_hotel_features:
            columns[f"s{i}"] = F.try_element_at(styles, F.lit(i))
    return df.withColumns(columns).fillna("unspecified", spec.feature_names())


def fit_next_action(history: DataFrame, spec: ModelSpec) -> PipelineModel:
    """Fit on ``history_target`` rows: label ``target`` (class code), features by position."""
    names = spec.feature_names()
    if spec.hidden_units and spec.width * spec.hidden_units[0] > MOST_WEIGHTS:
        raise ValueError(f"a first layer of {spec.width} x {spec.hidden_units[0]} weights is more than {MOST_WEIGHTS}; take a smaller width")
    hasher = FeatureHasher(
        inputCols=names, outputCol="features", numFeatures=spec.width, categoricalCols=names
    )
    if spec.hidden_units:
        classifier = MultilayerPerceptronClassifier(
            labelCol="label",
            layers=[spec.width, *spec.hidden_units, N_CLASSES],
            maxIter=spec.max_iter,
            seed=spec.seed,
        )
    else:
        classifier = LogisticRegression(
            labelCol="label",
            family="multinomial",
            maxIter=spec.max_iter,
            regParam=spec.regularisation,
        )
    rows = positional_features(history, spec).withColumn("label", F.col("target").cast("double"))
    return Pipeline(stages=[hasher, classifier]).fit(rows.select("label", *names))


def score_candidates(
    candidates: DataFrame, model: PipelineModel, spec: ModelSpec, styles: str = "style_sequence"
) -> DataFrame:
    """The prediction is a column of the candidate's own row: nothing has to be aligned."""
    rows = model.transform(positional_features(candidates, spec, styles))
    scored = with_importance(rows, vector_to_array("probability"))
    added = {*spec.feature_names(), "features", "rawPrediction", "probability", "prediction"}
    keep = [c for c in scored.columns if c in candidates.columns or c not in added]
    return scored.select(*keep)


def predict_classes(history: DataFrame, model: PipelineModel, spec: ModelSpec) -> DataFrame:
    rows = positional_features(history, spec).withColumn("label", F.col("target").cast("double"))
    return model.transform(rows)


def quality(predicted: DataFrame, metrics: Sequence[str] = ("accuracy", "f1")) -> dict[str, float]:
    return {
        m: MulticlassClassificationEvaluator(labelCol="label", metricName=m).evaluate(predicted)
        for m in metrics
    }


def class_distribution(predicted: DataFrame) -> DataFrame:
    """Predicted classes by action name."""
    return predicted.groupBy(
        actions.decode(F.col("prediction").cast("int")).alias("main_action")
    ).agg(F.count(F.lit(1)).alias("n"))
