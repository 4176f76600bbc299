"""Language-model scores of whole documents: a smoothed unigram base and a gated recurrent model."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wanderbeam.llm import gru
from wanderbeam.llm.text import id_remainder
from wanderbeam.session import materialise

# The end token; no word is empty.
END = ""
ADD = 0.1
ENDING = 3


@dataclass(frozen=True)
class Spec:
    """``dictionary``: most words (with counts) that are sent to the tasks; the others are joined.

    ``rounds``: passes of local training with averaging in between; each learnable document is used
    in one of them. ``learner_tokens``: a learner for so many tokens of the corpus; it reads ``learner_texts`` documents at a time. ``every``: of so many windows one is learnt from, while the state runs through all; 1 learns
    from each token once. ``modulus``: documents whose crc32(doc_id) is 0 modulo this are not learnt from.
    """

    shape: gru.Shape = gru.Shape()
    dictionary: int = 131_072
    learner_tokens: int = 8_000_000
    learner_texts: int = 2_048
    rounds: int = 3
    every: int = 1
    rate: float = 0.1
    modulus: int = 10


def pieces(texts: pa.Array, most: int = 1 << 23) -> Iterator[pa.Array]:
    """``texts`` in runs of at most so many bytes, or of one longer text."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(ends, most + (ends[a - 1] if a else 0), side="right")))
        yield texts.slice(a, b - a)
        a = b


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts with A-Z lower-cased, and where each text's begin and end; NULL is empty.

    White space at the ends of a text leaves empty words there, which are to be passed over.
    """
    # Arrow's ASCII white space is the six characters that separate words.
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.string()).fill_null("")))
    flat, edges = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    return flat, edges - edges[0]


def token_counts(docs: DataFrame, hold: int = 600_000) -> DataFrame:
    """``token`` and ``c`` over all rows of ``docs``; tasks count before they send anything."""

    def merged(held: list[pa.Table]) -> pa.Table:
        sums = pa.concat_tables(held).group_by("token", use_threads=False).aggregate([("c", "sum")])
        return sums.select(["token", "c_sum"]).rename_columns(["token", "c"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            for texts in pieces(batch.column(0), 1 << 24):
                seen = pa.table(words(texts)[0].value_counts().flatten(), ["token", "c"])
                ends = pa.table({"token": [END], "c": pa.array([len(texts)], pa.int64())})
                held += [seen.filter(pc.not_equal(seen["token"], END)), ends]
                if sum(map(len, held)) > hold:
                    # What repeats is kept to be counted on.
                    held = [merged(held)]
                    if 2 * len(held[0]) > hold:
                        yield from held.pop().combine_chunks().to_batches()
        if held:
            yield from merged(held).to_batches()

    counted = docs.select("text").mapInArrow(count, "token string, c long")
    return counted.groupBy("token").agg(F.sum("c").alias("c"))


def frequent(counts: DataFrame, most: int) -> DataFrame:
    """All tokens above a count that at most ``most`` tokens exceed, found from a histogram of log counts."""
    step = F.floor(F.log2("c") * 64).cast("int")
    bins = counts.groupBy(step.alias("bin")).count().collect()
    left, edge = most, None
    for row in sorted(bins, key=lambda r: -r[0]):
        if row[1] > left:
            break
        left, edge = left - row[1], row[0]
    return counts.where(step >= edge) if edge is not None else counts.where(F.lit(False))


@dataclass
class Lexicon:
    """What the tasks know: the dictionary, the model's words (its first ones) and the endings."""

    vocabulary: pa.Array
    # By place in the dictionary, the end first: log10 of (count + ADD), and input id of the model.
    logs: np.ndarray
    ids: np.ndarray
    endings: dict[str, int]
    total: int
    distinct: int
    # Per ending class: log10 of (its tokens + ADD * (its distinct tokens + 1)).
    class_logs: np.ndarray
    # Tokens of each of the model's words and of each ending class.
    word_counts: np.ndarray
    ending_counts: np.ndarray
    shape: gru.Shape

    @property
    def end_known(self) -> int:
        """1 if any text was learnt from: every text has an end."""
        return int(self.total > 0)

    @property
    def end(self) -> int:
        return int(self.ids[0])

    @cached_property
    def places(self) -> dict[bytes, int]:
        return {w.encode(): k for k, w in enumerate(self.vocabulary.to_pylist())}

    def ending(self, token: str) -> int:
        """Class of a token that is not one of the model's words; the last class is for the rest."""
        return self.endings.get(token[-ENDING:], self.shape.endings - 1)

    def read(self, texts: pa.Array) -> pa.Array:
        """The columns of ``READ`` for some texts, all words looked up at once."""
        tokens, edges = words(texts)
        number, words_of = len(texts), self.shape.words
        at = pc.index_in(tokens, value_set=self.vocabulary).fill_null(-1).to_numpy()
        rare = tokens.take(pa.array(np.flatnonzero(at < 0))).dictionary_encode()
        # Empty words have the end's place, the first one.
        filled = at != 0
        sizes = np.diff(np.append(0, np.cumsum(filled))[edges])
        at = at[filled]
        del tokens, filled
        own = np.repeat(np.arange(number), sizes)
        missing = np.flatnonzero(at < 0)
        tails = pc.utf8_slice_codeunits(rare.dictionary, -ENDING)
        classes = pc.index_in(tails, value_set=pa.array(list(self.endings), pa.string())).fill_null(self.shape.endings - 1).to_numpy()
        kinds = rare.indices.to_numpy()
        # Place -1, the last one, is that of words outside the dictionary.
        inside = self.ids[:-1] >= words_of
        shares = np.append(np.where(inside, self.logs - self.class_logs[np.where(inside, self.ids[:-1] - words_of, 0)], 0.0), 0.0)
        outside = shares[at]
        outside[missing] = -self.class_logs[classes[kinds]]
        ids = self.ids[at]
        ids[missing] = words_of + classes[kinds]
        # Each text's ids are followed by the end.
        ends = np.cumsum(sizes + 1)
        body = np.empty(len(ids) + number, "<i2")
        is_word = np.ones(len(body), bool)
        is_word[ends - 1] = False
        body[is_word] = ids
        body[ends - 1] = self.end
        # Rare words are listed once for each text.
        span = max(1, len(rare.dictionary))
        listed, times = np.unique(own[missing] * span + kinds, return_counts=True)
        pairs = pa.StructArray.from_arrays([rare.dictionary.take(pa.array(listed % span)), pa.array(times.astype(np.int32))], ["token", "n"])
        edges = np.searchsorted(listed, np.arange(number + 1) * span).astype(np.int32)
        offsets = pa.py_buffer(np.append(0, 2 * ends).astype(np.int32))
        columns = [
            pa.array(sizes + 1, pa.int64()),
            pa.array(np.bincount(own[at >= 0], minlength=number) + self.end_known, pa.int64()),
            pa.array(np.bincount(own, np.append(self.logs, 0.0)[at], number) + self.logs[0], pa.float64()),
            pa.array(np.bincount(own, outside, number), pa.float64()),
            pa.ListArray.from_arrays(pa.array(edges), pairs),
            pa.Array.from_buffers(pa.binary(), number, [None, offsets, pa.py_buffer(body)]),
        ]
        return pa.StructArray.from_arrays(columns, ["n_tokens", "n_known", "known_log", "outside_log", "rare", "ids"])


def lexicon(counts: DataFrame, spec: Spec) -> Lexicon:
    """Built from counts of the whole corpus; only bounded parts of them reach the driver."""
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    sent = frequent(counts, spec.dictionary).union(counts.where(F.col("token") == END))
    known = {r[0]: r[1] for r in sent.collect()}
    order = sorted((w for w in known if w != END), key=lambda w: (-known[w], w))
    model_words = [END, *order[: spec.shape.words - 1]]
    chosen = counts.sparkSession.createDataFrame([(w,) for w in model_words], "token string")
    other = counts.join(F.broadcast(chosen), "token", "left_anti")
    tail = F.substring("token", -ENDING, ENDING)
    by_ending = other.groupBy(tail.alias("ending")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v"))
    by_ending = materialise(by_ending, "endings")
    first = by_ending.orderBy(F.desc("c"), "ending").limit(spec.shape.endings - 1).collect()
    whole = by_ending.agg(F.coalesce(F.sum("c"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    sizes = [(r[1], r[2]) for r in first] + [(0, 0)] * (spec.shape.endings - 1 - len(first))
    sizes.append((whole[0] - sum(a for a, _ in sizes), whole[1] - sum(b for _, b in sizes)))
    class_logs = np.array([math.log10(c + ADD * (v + 1)) for c, v in sizes])
    # The model's words first; without any training text the end alone.
    listed = [*model_words, *order[spec.shape.words - 1 :]]
    endings = {r[0]: k for k, r in enumerate(first)}
    other_ids = [endings.get(w[-ENDING:], spec.shape.endings - 1) for w in listed[len(model_words) :]]
    ids = np.array([*range(len(model_words)), *[spec.shape.words + k for k in other_ids], -1], np.int32)
    logs = np.log10(np.array([known.get(w, 0) for w in listed], float) + ADD)
    vocabulary = pa.array(listed, pa.string())
    word_counts = np.array([known.get(w, 0) for w in model_words], float)
    ending_counts = np.array([c for c, _ in sizes], float)
    return Lexicon(vocabulary, logs, ids, endings, total, distinct, class_logs, word_counts, ending_counts, spec.shape)


READ = (
    "n_tokens long, n_known long, known_log double, outside_log double,"
    " rare array<struct<token:string,n:int>>, ids binary"
)


def read_texts(docs: DataFrame, lex: Lexicon) -> DataFrame:
    """Columns of ``docs`` but the text, plus what the dictionary says about it and the model's input ids.

    ``known_log`` and ``outside_log`` are sums over the dictionary's words: log10 of their smoothed counts, and
    of their shares of their ending's class where the model knows no more. Rare words are listed for a join.
    """

    @F.arrow_udf(READ)
    def read(texts: pa.Array) -> pa.Array:
        # An empty batch has its columns too.
        return pa.concat_arrays([lex.read(some) for some in pieces(texts)] or [lex.read(texts)])

    return docs.withColumn("__s", read(F.col("text"))).select(*[c for c in docs.columns if c != "text"], "__s.*")


def _ids(bodies: Iterable[bytes]) -> list[np.ndarray]:
    return [np.frombuffer(b, "<i2").astype(np.int32) for b in bodies]


def train(texts: DataFrame, lex: Lexicon, spec: Spec, seed: int = 7) -> gru.Params:
    """Parameters after ``spec.rounds`` rounds: every learner trains on its documents, then all average.

    ``texts`` has columns ``ids``, ``turn``, the round that uses the document, and ``mark``, a hash of it. The number of learners grows
    with the tokens of the corpus; documents are dealt to them, and read by them, by their mark, so neither
    files nor partitions change the result. A learner's result weighs as many as its tokens. Training starts from the frequencies of classes and
    words. Averages are formed block by block in two levels, so a task holds the root of the number of learners of a block.
    """
    params = gru.with_frequencies(gru.initial(spec.shape, seed), spec.shape, lex.word_counts, lex.ending_counts)
    learners = max(1, -(-lex.total // spec.learner_tokens))
    dealt = texts.withColumn("learner", F.pmod("mark", F.lit(learners)).cast("int"))
    for turn in range(spec.rounds):
        learner = _learner(params, lex, spec, spec.rate / (1 + turn), math.isqrt(learners))
        mine = dealt.where(F.col("turn") == turn).select("learner", "mark", "ids")
        some = mine.repartition(learners, "learner").sortWithinPartitions("learner", "mark", "ids").mapInPandas(learner, LEARNT)
        shares = some.groupBy("share", "block").applyInPandas(_mean, LEARNT)
        blocks = shares.groupBy("block").applyInPandas(_mean, LEARNT).collect()
        if blocks:
            values = np.concatenate([np.frombuffer(r["body"], "<f8") for r in sorted(blocks, key=lambda r: r["block"])])
            params = gru.unflat(values, params)
    return params


LEARNT = "share int, block int, weight double, body binary"


def _learner(params: gru.Params, lex: Lexicon, spec: Spec, rate: float, shares: int):
    end = lex.end

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, trainer, held = None, None, []

        def result() -> pd.DataFrame:
            trainer.learn(_ids(held), end)
            body = gru.blocks(gru.flat(trainer.p))
            rows = [(number % shares, k, float(trainer.tokens), b.astype("<f8").tobytes()) for k, b in body]
            return pd.DataFrame(rows, columns=["share", "block", "weight", "body"])

        for batch in batches:
            for mine, ids in zip(batch["learner"], batch["ids"]):
                if mine != number:
                    if trainer is not None:
                        yield result()
                    number, trainer, held = mine, gru.Trainer(params, spec.shape, rate, every=spec.every), []
                held.append(ids)
                if len(held) == spec.learner_texts:
                    trainer.learn(_ids(held), end)
                    held = []
        if trainer is not None:
            yield result()

    return learn


def _mean(rows: pd.DataFrame) -> pd.DataFrame:
    weight = rows["weight"].to_numpy()
    body = sum(w * np.frombuffer(b, "<f8") for w, b in zip(weight, rows["body"])) / weight.sum()
    return pd.DataFrame({"share": [0], "block": [int(rows["block"].iloc[0])], "weight": [weight.sum()], "body": [body.tobytes()]})


def likelihood(ids: Column, lex: Lexicon, params: gru.Params) -> Column:
    """log10 of the recurrent model's probability of a whole document."""
    shape, end = lex.shape, lex.end

    @F.pandas_udf("double")
    def of(bodies: pd.Series) -> pd.Series:
        return pd.Series(gru.log_likelihoods(params, shape, _ids(bodies), end) / math.log(10))

    return of(ids)


def document_scores(docs: DataFrame, spec: Spec = Spec()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    Counts cover all learnable documents. A document's score is the model's log10 probability of its
    words and its end: the recurrent model's part, and for words outside its vocabulary their smoothed share of
    the class of their ending, in which one unknown word has a place. Counts of words outside the
    dictionary are joined by word, once for each document and distinct word. NULL texts are
    empty: one end token. Repeated rows are scored each; an empty table gives no rows; with
    nothing to learn from, all words are unknown. Very long texts run through one lane window by window; memory follows
    their tokens. Extra columns are ignored. How the documents lie in files and partitions changes nothing but the order of sums.
    """
    held_out = id_remainder("doc_id", spec.modulus) == 0
    learnable = docs.where(~held_out).select("text")
    counts = materialise(token_counts(learnable), "token-counts")
    lex = lexicon(counts, spec)
    turn = F.pmod(F.xxhash64(F.coalesce(F.col("text"), F.lit(""))), F.lit(spec.rounds)).alias("turn")
    mark = F.xxhash64("doc_id", F.coalesce(F.col("text"), F.lit(""))).alias("mark")
    texts = read_texts(docs.select("doc_id", held_out.alias("held_out"), turn, mark, "text"), lex)
    # Read below by every round, the scores and the rare words; the row numbers are stored with it.
    stored = materialise(texts.withColumn("row", F.monotonically_increasing_id()), "read-texts")
    params = train(stored.where("not held_out"), lex, spec)
    rare = stored.select("row", F.explode("rare").alias("r")).select("row", "r.token", "r.n")
    found = rare.join(counts, "token", "left")
    c = F.coalesce(F.col("c"), F.lit(0))
    sums = found.groupBy("row").agg(
        F.sum(F.col("n") * F.log10(c + F.lit(ADD))).alias("rare_log"),
        F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("rare_known"),
    )
    zero = F.lit(0.0)
    norm = math.log10(lex.total + ADD * (lex.distinct + 1))
    rare_log = F.coalesce(F.col("rare_log"), zero)
    scored = stored.withColumn("model_log", likelihood(F.col("ids"), lex, params)).drop("rare", "ids")
    return scored.join(sums, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce(F.col("rare_known"), F.lit(0))).cast("long").alias("n_known"),
        F.lit(lex.total).cast("long").alias("train_tokens"),
        (F.col("known_log") + rare_log - F.col("n_tokens") * F.lit(norm)).alias("base_score"),
        (F.col("model_log") + F.col("outside_log") + rare_log).alias("score"),
    )
