"""Repeated passages across documents, found from difference-cover anchors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wanderbeam.llm.packed_keys import bucket_count, found_elsewhere
from wanderbeam.llm.text import text_bytes
from wanderbeam.session import materialise, shuffle_width

WINDOW = 13
# A perfect difference cover. Any two places agree, after one shift below 7, in
# being 0, 1 or 3 modulo 7, because these differences give every remainder.
PERIOD = 7
COVER = (0, 1, 3)


def word_spans(raw: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words joined by single spaces, with the byte range of each."""
    parts = raw.split()
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    return b" ".join(parts), ends - lengths, ends


def anchor_places(n: int, window: int = WINDOW) -> np.ndarray:
    """Cover positions at which an anchor of ``window`` - 6 words fits into ``n`` words."""
    at = np.arange(max(0, n - (window - PERIOD + 1) + 1))
    return at[np.isin(at % PERIOD, COVER)]


def anchor_keys(raw: bytes, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash, place) of the anchors of a text; texts shorter than a window have none."""
    joined, starts, ends = word_spans(raw)
    size = window - PERIOD + 1
    at = anchor_places(len(starts), window) if len(starts) >= window else np.empty(0, np.int64)
    if not len(at):
        return np.empty(0, np.uint64), at
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[at].tolist(), ends[at + size - 1].tolist())
    return np.fromiter((digest(joined[a:b]) for a, b in spans), np.uint64, len(at)), at


def windows_around(anchors: np.ndarray, n: int, window: int = WINDOW) -> np.ndarray:
    """Starts of all windows that contain one of the anchors."""
    starts = np.unique((anchors[:, None] - np.arange(PERIOD)[None, :]).ravel())
    return starts[(starts >= 0) & (starts <= n - window)]


def window_keys(raw: bytes, anchors: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hi, lo, place) of the 128-bit hashes of the windows around ``anchors``."""
    joined, starts, ends = word_spans(raw)
    at = windows_around(anchors, len(starts), window)
    digest = xxhash.xxh3_128_digest
    spans = zip(starts[at].tolist(), ends[at + window - 1].tolist())
    both = np.frombuffer(b"".join([digest(joined[a:b]) for a, b in spans]), ">u8").reshape(-1, 2)
    return both[:, 0].astype(np.uint64), both[:, 1].astype(np.uint64) & np.uint64(0xFFFFFFFF), at


def places_of(body: bytes) -> np.ndarray:
    return np.frombuffer(body, "<i4").astype(np.int64)


def covered(starts: np.ndarray, n: int, window: int = WINDOW) -> np.ndarray:
    """Which of ``n`` words lie in a window that starts at one of ``starts``."""
    steps = np.zeros(n + 1, np.int64)
    starts = np.unique(starts)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + window, -1)
    return np.cumsum(steps[:n]) > 0


def repeats_removed(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, removed_spans and kept_text of every document.

    A word goes if a window of ``window`` words over it also starts in a document with a smaller
    id. Two equal windows anywhere share an anchor: some shift below 7 puts both on cover
    positions, and the ``window`` - 6 words from there lie in both. So anchors (3 of 7 positions) that two
    documents share are found first, each extends to the windows around it, and those are compared
    whole by 96 bits of a 128-bit hash. ``removed_spans`` are [from, to) ranges of words.

    Windows are judged on the input. Rows without an id neither lose nor cause anything; rows
    that repeat an id are judged each by its own text, and never against each other. NULL texts
    have no words. An empty table gives no rows. ``window`` is at least 8.
    """
    if window <= PERIOD:
        raise ValueError(f"a window needs more than {PERIOD} words")
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    sizes = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(text)).alias("b"))
    total = sizes.agg(F.sum("b"), F.max(F.when(F.col("doc_id").isNotNull(), F.col("n")))).first()
    buckets = bucket_count(total[0] or 0, shuffle_width(spark))
    # Ids are unique as a rule; where they are not, rows are told apart by their text.
    variant = F.xxhash64(text) if (total[1] or 0) > 1 else F.lit(0).cast("long")
    if dict(docs.dtypes)["doc_id"] != "bigint":
        docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    # Both joins below read this one frame by doc_id; as its columns are the same, so is its exchange,
    # and the texts are shuffled once.
    rows = docs.where("doc_id is not null").select("doc_id", variant.alias("variant"), text.alias("text"))

    def anchors(batch: pd.DataFrame) -> Iterator[tuple]:
        for doc, kind, body in zip(batch["doc_id"], batch["variant"], batch["text"]):
            hi, at = anchor_keys(text_bytes(body), window)
            yield doc, kind, hi, np.zeros(len(hi), np.uint64), at

    shared = found_elsewhere(rows, anchors, buckets, wide=False, later=False)
    shared = materialise(shared, "shared-anchors")

    def windows(batch: pd.DataFrame) -> Iterator[tuple]:
        for doc, kind, body, pieces in zip(batch["doc_id"], batch["variant"], batch["text"], batch["places"]):
            yield doc, kind, *window_keys(text_bytes(body), places_of(pieces), window)

    around = rows.join(shared, ["doc_id", "variant"])
    repeated = found_elsewhere(around, windows, buckets, wide=True, later=True)

    def remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, body, pieces in zip(batch["doc_id"], batch["text"], batch["places"]):
                parts = text_bytes(body).split()
                gone = covered(places_of(pieces), len(parts), window) if pieces is not None else np.zeros(len(parts), bool)
                edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0])))).reshape(-1, 2)
                kept = b" ".join([w for w, g in zip(parts, gone.tolist()) if not g]).decode() if len(edge) else b" ".join(parts).decode()
                out.append((None if doc != doc else doc, len(parts), int(gone.sum()), edge.tolist(), kept))
            yield pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "removed_spans", "kept_text"])

    schema = "doc_id long, n_words long, n_removed long, removed_spans array<array<long>>, kept_text string"
    judged = rows.join(repeated, ["doc_id", "variant"], "left").select("doc_id", "text", "places")
    nameless = docs.where("doc_id is null").select(
        F.lit(None).cast("long").alias("doc_id"), text.alias("text"), F.lit(None).cast("binary").alias("places")
    )
    return judged.unionByName(nameless).mapInPandas(remove, schema)
