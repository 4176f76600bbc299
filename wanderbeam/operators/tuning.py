"""Search over data parameters and model parameters."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import astuple, dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wanderbeam.functions import actions, arrays
from wanderbeam.operators import bayes, context_tree, scoring
from wanderbeam.operators.sequences import ORDER, exact_split, history_target, seen_items, training_sequences
from wanderbeam.operators.skew import MAX_GROUP_ROWS, Grouped, lookup_join, number_groups, split_heavy_groups
from wanderbeam.session import materialise


@dataclass(frozen=True)
class DataSpec:
    """Parameters that change the training table itself."""

    length: int
    step: int
    min_items: int


FIELDS = ("hotel_id", "main_action", "style_name")


def param_search(
    events: DataFrame,
    users: DataFrame,
    data_specs: Iterable[DataSpec],
    model_specs: Iterable[scoring.ModelSpec],
    seed: int = 42,
) -> DataFrame:
    """Accuracy and F1 of every combination, best accuracy first (``rank``).

    The outer loop builds and writes one training table per data spec, the inner loop fits the
    models on it. The driver only holds one result row per combination.
    """
    results = []
    model_specs = list(model_specs)
    for data in data_specs:
        windows = training_sequences(
            events, users, data.length, data.step, data.min_items, FIELDS
        )
        table = materialise(exact_split(history_target(windows), seed=seed), "tuning")
        for model_spec in model_specs:
            spec = scoring.ModelSpec(**{**model_spec.__dict__, "length": data.length})
            model = scoring.fit_next_action(table.filter("split = 'train'"), spec)
            predicted = scoring.predict_classes(table.filter("split = 'eval'"), model, spec)
            found = scoring.quality(predicted)
            results.append(
                (
                    data.length,
                    data.step,
                    data.min_items,
                    ",".join(map(str, spec.hidden_units)),
                    spec.regularisation,
                    spec.max_iter,
                    float(found["accuracy"]),
                    float(found["f1"]),
                )
            )
    schema = (
        "seq_len int, step int, min_seen int, hidden_units string, regularisation double,"
        " max_iter int, accuracy double, f1 double"
    )
    best = Window.partitionBy(F.lit(0)).orderBy(
        F.desc("accuracy"), F.desc("f1"), "seq_len", "step", "min_seen", "regularisation"
    )
    frame = events.sparkSession.createDataFrame(results, schema)
    return frame.withColumn("rank", F.row_number().over(best))


def top_results(search: DataFrame, n: int = 3) -> DataFrame:
    return search.filter(F.col("rank") <= n)


def closed_form_search(
    events: DataFrame,
    users: DataFrame,
    data_specs: Iterable[DataSpec],
    model_specs: Iterable[scoring.ModelSpec],
    shuffle_key: Column | None = None,
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """``param_search`` with the closed-form classifier: one row per data spec and feature toggles.

    Trained on the train part, judged on the eval part; the driver holds one row per combination.
    """
    results = []
    model_specs = list(model_specs)
    for data in data_specs:
        windows = training_sequences(events, users, data.length, data.step, data.min_items, FIELDS, order)
        split = exact_split(history_target(windows), shuffle_key=shuffle_key)
        table = materialise(split, "tuning")
        for model_spec in model_specs:
            spec = scoring.ModelSpec(**{**model_spec.__dict__, "length": data.length})
            model = bayes.fit(table.filter("split = 'train'"), spec)
            judged = bayes.predicted(table.filter("split = 'eval'"), model, ["user_id", "win"])
            found = bayes.quality(judged).first()
            results.append(
                (
                    data.length,
                    data.step,
                    data.min_items,
                    spec.include_user_features,
                    spec.include_hotel_features,
                    found["accuracy"] or 0.0,
                    found["f1"] or 0.0,
                )
            )
    schema = (
        "seq_len int, step int, min_seen int, user_features boolean, hotel_features boolean,"
        " accuracy double, f1 double"
    )
    best = Window.partitionBy(F.lit(0)).orderBy(
        F.desc(F.round("accuracy", 9)),
        F.desc(F.round("f1", 9)),
        "seq_len",
        "step",
        "min_seen",
        "user_features",
        "hotel_features",
    )
    frame = events.sparkSession.createDataFrame(results, schema)
    return frame.withColumn("rank", F.row_number().over(best))


# --- successive halving ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Candidate:
    """Data parameters and toggle of one candidate of ``halving_search``."""

    seq_len: int
    step: int
    min_seen: int
    with_style: bool


# The ranges that are searched.
LENGTHS, STEPS, LEAST_SEEN, TOGGLES = (4, 5, 6, 7, 8, 9, 10), (1, 2, 5), (4, 5, 6, 7, 8), (True, False)
STRIDE = 11


def drawn_candidates(n: int = 27) -> list[Candidate]:
    """``n`` different candidates, spread over the whole range of parameters by a fixed stride."""
    space = [Candidate(*c) for c in product(LENGTHS, STEPS, LEAST_SEEN, TOGGLES)]
    return [space[i * STRIDE % len(space)] for i in range(min(n, len(space)))]


def action_contexts(
    events: DataFrame, most: int, order: Sequence[str] = ORDER, max_rows: int | None = MAX_GROUP_ROWS
) -> DataFrame:
    """Every event of a user with what came before it: the one pass that all candidates share.

    user_id, place (from 0), n (events of the user), style_name, target (class code) and past, the codes of up to
    ``most`` events before, the latest first. A user with more than ``max_rows`` events is cut into
    segments, and each of those events is sent to the ones after it.
    """
    rows = events.filter(F.col("user_id").isNotNull()).withColumn("target", F.col("main_action"))
    rows = rows.select(*dict.fromkeys(["user_id", *order, "style_name", "target"]))
    groups = split_heavy_groups(rows, ["user_id"], order, max_rows)
    by_user = Window.partitionBy("user_id").orderBy(*order)
    place = F.row_number().over(by_user) - 1
    # Places before the first event give NULL, which is cut off again.
    earlier = F.array(*[F.coalesce(F.lag("target", i).over(by_user), F.lit(-1)) for i in range(1, most + 1)])
    light = groups.light.select(
        "user_id",
        place.cast("long").alias("place"),
        F.count(F.lit(1)).over(Window.partitionBy("user_id")).alias("n"),
        "style_name",
        "target",
        F.slice(earlier, 1, F.least(place, F.lit(most))).alias("past"),
    )
    if groups.heavy is None:
        return light
    placed = number_groups(Grouped(groups.light.limit(0), groups.heavy, groups.keys, groups.order), "place", "n")
    placed = placed.withColumn("place", F.col("place") - 1)
    sent = placed.select("user_id", F.posexplode(F.transform(F.sequence(F.lit(1), F.lit(most)), lambda i: F.col("place") + i)).alias("back", "place"), F.col("target").alias("code"))
    past = sent.groupBy("user_id", "place").agg(F.sort_array(F.collect_list(F.struct("back", "code"))).alias("p"))
    heavy = placed.join(past, ["user_id", "place"], "left").select(
        "user_id", "place", "n", "style_name", "target", F.coalesce(F.col("p.code"), F.array().cast("array<int>")).alias("past")
    )
    return light.unionByName(heavy)


def _takes(candidate: Candidate) -> Column:
    """Is the event the target of a window of the candidate? (Windows start every ``step`` events, and one ends at the last event.)"""
    start = F.col("place") - (candidate.seq_len - 1)
    regular = (start >= 0) & (F.pmod(start, F.lit(candidate.step)) == 0)
    last = (F.col("place") == F.col("n") - 1) & (start >= 0)
    return (regular | last) & (F.col("n_items") >= candidate.min_seen)


def _examples(rows: DataFrame, candidates: dict[int, Candidate]) -> DataFrame:
    """Rows of every candidate: cand, symbols, target and held, counted (``n``) where they are equal."""
    members = []
    for number, c in candidates.items():
        style = F.array(F.coalesce("style_name", F.lit(context_tree.UNKNOWN))) if c.with_style else F.array().cast("array<string>")
        symbols = F.concat(style, F.slice(F.col("past").cast("array<string>"), 1, c.seq_len - 1))
        members.append(F.when(_takes(c), F.struct(F.lit(number).alias("cand"), symbols.alias("symbols"))))
    each = rows.select("target", "held", F.explode(F.filter(F.array(*members), lambda m: m.isNotNull())).alias("m"))
    return each.groupBy("m.cand", "m.symbols", "target", "held").agg(F.count(F.lit(1)).alias("n"))


def halving_round(rows: DataFrame, candidates: dict[int, Candidate]) -> DataFrame:
    """cand, n and hits of every candidate on the held-out rows; all candidates are fitted and judged in one job."""
    examples = materialise(_examples(rows, candidates), "halving")
    counts = materialise(context_tree.class_counts(examples.filter("NOT held"), ["cand"], weight="n"), "halving-counts")
    asked = examples.filter("held")
    guessed = context_tree.probabilities(asked, counts, ["cand"])
    guessed = guessed.select("cand", "symbols", arrays.argmax(F.col("probabilities")).alias("guess"))
    judged = asked.join(guessed, ["cand", "symbols"])
    return judged.groupBy("cand").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("guess") == F.col("target"), F.col("n")).otherwise(0)).alias("hits")
    )


def halving_search(
    events: DataFrame,
    candidates: Sequence[Candidate],
    user_hash: Column,
    factor: int = 3,
    order: Sequence[str] = ORDER,
    max_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Successive halving: one row per round and candidate with its score, its rank and whether it survived.

    Each round takes ``factor`` times the users of the one before (nested samples by ``user_hash``, the last
    round all of them) and keeps the best of ``factor`` candidates. One user in five is held out in every round. A candidate
    is a context tree on windows of its length, step and least number of items. Equal scores go by the
    order of the candidates. The driver holds one row per candidate and round.
    """
    coded = events.withColumn("main_action", actions.encode(F.col("main_action"))).filter(F.col("main_action").isNotNull())
    most = max(c.seq_len for c in candidates) - 1
    contexts = lookup_join(action_contexts(coded, most, order, max_rows), seen_items(coded), "user_id")
    rounds = 1
    while factor ** (rounds - 1) < len(candidates) / factor:
        rounds += 1
    parts = factor ** (rounds - 1)
    rows = contexts.withColumns({"part": F.pmod(user_hash, F.lit(parts)), "held": F.pmod(F.floor(user_hash / parts), F.lit(5)) == 0})
    rows = materialise(rows.select("place", "n", "n_items", "style_name", "target", "past", "part", "held"), "action-contexts")
    alive, results = dict(enumerate(candidates)), []
    for number in range(1, rounds + 1):
        sample = rows.filter(F.col("part") < factor ** (number - 1))
        found = {r["cand"]: (r["n"], r["hits"]) for r in halving_round(sample, alive).collect()}
        score = {c: (found[c][1] / found[c][0] if c in found else 0.0) for c in alive}
        ranked = sorted(alive, key=lambda c: (-score[c], c))
        keep = ranked[: -(-len(ranked) // factor)]
        for place, c in enumerate(ranked, 1):
            results.append((number, c, *astuple(alive[c]), found.get(c, (0, 0))[0], score[c], place, c in keep))
        alive = {c: alive[c] for c in keep}
    schema = "round int, cand int, seq_len int, step int, min_seen int, with_style boolean, n long, accuracy double, rank int, survived boolean"
    return events.sparkSession.createDataFrame(results, schema)
