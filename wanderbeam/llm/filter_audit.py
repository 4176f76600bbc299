"""Audit of document filters: what each of five removes, in every order of application."""

from __future__ import annotations

import string
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wanderbeam.llm.text import text_bytes
from wanderbeam.operators.skew import lookup_join
from wanderbeam.session import materialise

LETTERS = "ABCDE"
SYMBOLS = b"#$%&*|"
UPPER = string.ascii_uppercase.encode()

# The sketch: cells a text counts in, cells for each text, and the bound of what is broadcast (one bit a cell).
PROBES = 4
CELLS_PER_ROW = 12
MOST_CELLS = 1 << 29
BLOCK_CELLS = 1 << 20
FLUSH = 1 << 18
# A repeated text is heavy above this share of all rows, so there are at most 1000 heavy ones.
HEAVY_SHARE = 0.001


def own_mask(text: str | None) -> int:
    """Bits 0 to 3: which of the filters A to D the text alone fails."""
    raw = text_bytes(text)
    words = raw.split()
    n = len(words)
    upper = len(raw) - len(raw.translate(None, UPPER))
    mask = 1 if n < 100 else 0
    mask |= 2 if 100 * len(set(words)) < 80 * n else 0
    mask |= 4 if 100 * upper > 10 * len(text or "") else 0
    return mask | (8 if len(raw.translate(None, SYMBOLS)) < len(raw) else 0)


def cells_for(rows: int) -> int:
    """Cells of a sketch for ``rows`` texts: a power of two, 12 to 24 a text, never above ``MOST_CELLS``."""
    return min(1 << (CELLS_PER_ROW * max(rows, 1) - 1).bit_length(), MOST_CELLS)


def probes(hashes: np.ndarray, cells: int) -> np.ndarray:
    """The cells of every 64-bit hash, one row each."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return (hashes[:, None] + np.arange(PROBES, dtype=np.uint64) * step[:, None]) & np.uint64(cells - 1)


def repeated_cells(hashes: DataFrame, cells: int) -> np.ndarray:
    """One bit a cell: set where the texts counted in the cell are two or more.

    ``hashes`` has one long column ``h``. Every task counts its own texts, saturating at two; the
    counts travel as (block of cells, cells, counts) and are merged block by block in a stream, so a task holds
    one block whatever the number of tasks. The merged bits are bounded by ``MOST_CELLS`` / 8 bytes.
    """
    width = min(cells, BLOCK_CELLS)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []

        def flush() -> Iterator[pd.DataFrame]:
            at, n = np.unique(probes(np.concatenate(held).view(np.uint64), cells), return_counts=True)
            held.clear()
            block = at // np.uint64(width)
            cut = np.flatnonzero(np.diff(block)) + 1
            parts = zip(np.split(at, cut), np.split(np.minimum(n, 2), cut))
            rows = [(int(a[0]) // width, (a % np.uint64(width)).astype("<u4").tobytes(), c.astype(np.uint8).tobytes()) for a, c in parts]
            yield pd.DataFrame(rows, columns=["block", "at", "n"])

        for batch in batches:
            if len(batch):
                held.append(batch["h"].to_numpy(np.int64))
            if sum(map(len, held)) >= FLUSH:
                yield from flush()
        if held:
            yield from flush()

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, counts = None, None

        def bits() -> pd.DataFrame:
            return pd.DataFrame([(block, np.packbits(counts > 1, bitorder="little").tobytes())], columns=["block", "bits"])

        for batch in batches:
            for b, at, n in zip(batch["block"], batch["at"], batch["n"]):
                if b != block:
                    if block is not None:
                        yield bits()
                    block, counts = b, np.zeros(width, np.uint8)
                where = np.frombuffer(at, "<u4")
                counts[where] = np.minimum(counts[where] + np.frombuffer(n, np.uint8), 2)
        if block is not None:
            yield bits()

    counted = hashes.mapInPandas(count, "block long, at binary, n binary")
    merged = counted.repartition("block").sortWithinPartitions("block").mapInPandas(merge, "block long, bits binary")
    out = np.zeros((cells // width, -(-width // 8)), np.uint8)
    for block, bits in merged.toLocalIterator():
        out[block] = np.frombuffer(bits, np.uint8)
    return out


def text_facts(docs: DataFrame) -> DataFrame:
    """doc_id, part and mask of every document; text and its SHA-256 only where the text may be repeated.

    A text that counts alone in any of its cells is unique for certain. The sketch errs to one side only:
    a unique text may stay in doubt, a repeated one is never cleared.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.coalesce(F.col("lang"), F.lit("")).alias("part"), body.alias("text"))
    cells = cells_for(docs.count())
    more = docs.sparkSession.sparkContext.broadcast(repeated_cells(rows.select(F.xxhash64("text").alias("h")), cells))

    @F.pandas_udf("mask int, doubtful boolean")
    def judge(texts: pd.Series, hashes: pd.Series) -> pd.DataFrame:
        at = probes(hashes.to_numpy(np.int64).view(np.uint64), cells).astype(np.int64)
        bits = more.value
        width = min(cells, BLOCK_CELLS)
        inside = at % width
        alone = bits[at // width, inside >> 3] >> (inside & 7).astype(np.uint8) & 1 == 0
        return pd.DataFrame({"mask": [own_mask(t) for t in texts], "doubtful": ~alone.any(axis=1)})

    judged = rows.withColumn("j", judge("text", F.xxhash64("text"))).select("doc_id", "part", "j.mask", "j.doubtful", "text")
    text = F.when(F.col("doubtful"), F.col("text"))
    return judged.select("doc_id", "part", "mask", text.alias("text"), F.unhex(F.sha2(text, 256)).alias("digest"))


def with_repeats(facts: DataFrame) -> DataFrame:
    """doc_id, part and mask, with bit 4 where a smaller doc_id has the same text.

    Only doubtful texts are shuffled, copies collapsed on the map side, and grouped as whole texts for
    their smallest id. The id goes back to the rows by digest: the few heavy texts are broadcast, the others joined.
    """
    repeated = facts.where(F.col("text").isNotNull()).groupBy("text").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"))
    repeated = repeated.where("n > 1 AND first IS NOT NULL")
    repeated = materialise(repeated.select(F.unhex(F.sha2("text", 256)).alias("digest"), "n", "first"), "repeated")
    heavy = F.col("n") > HEAVY_SHARE * facts.count()
    rows = facts.select("doc_id", "part", "mask", "digest")
    rows = rows.join(F.broadcast(repeated.where(heavy).select("digest", "first")), "digest", "left")
    asking = F.col("digest").isNotNull() & F.col("first").isNull()
    others = lookup_join(rows.where(asking).drop("first"), repeated.where(~heavy).select("digest", "first"), "digest", "left")
    rows = rows.where(~asking).unionByName(others)
    later = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return rows.select("doc_id", "part", F.col("mask").bitwiseOR(F.when(later, 16).otherwise(0)).alias("mask"))


def mask_counts(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, and additive counts: n documents, good of them with quality 1, toxic with toxic 1."""
    flag = lambda name: F.max(F.when(F.col(name) == 1, 1).otherwise(0)).alias(f"__{name}")
    known = labels.where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)")
    known = known.groupBy("doc_id").agg(flag("quality"), flag("toxic"))
    marked = lookup_join(rows, known, "doc_id", "left")
    total = lambda name: F.coalesce(F.sum(name), F.lit(0)).alias(name.strip("_"))
    return marked.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), total("__quality"), total("__toxic"))


def order_report(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from the additive counts of failure masks."""
    orders = ["".join(p) for p in permutations(LETTERS)]
    steps = [(order, k) for order in orders for k in range(len(LETTERS))]
    bit_of = {letter: 1 << i for i, letter in enumerate(LETTERS)}
    own = [bit_of[order[k]] for order, k in steps]
    earlier = [sum(bit_of[c] for c in order[:k]) for order, k in steps]
    each = counts.select("*", F.posexplode(F.lit([order for order, _ in steps])).alias("i", "filter_order"))
    each = each.withColumn("own", F.lit(own)[F.col("i")]).withColumn("earlier", F.lit(earlier)[F.col("i")])
    fails = F.col("mask").bitwiseAND(F.col("own")) != 0
    reaches = F.col("mask").bitwiseAND(F.col("earlier")) == 0

    def total(where: Column, value: Column | str = "n") -> Column:
        return F.sum(F.when(where, F.col(value) if isinstance(value, str) else value).otherwise(0)).cast("long")

    # A document that fails k filters is removed by each of them in one of k orders.
    turns = F.expr(f"n * ({len(orders)} div bit_count(mask))")
    return (
        each.groupBy("part", "filter_order", (F.col("i") % len(LETTERS) + 1).cast("int").alias("step"))
        .agg(
            total(~fails & reaches).alias("kept"),
            total(fails & reaches).alias("removed"),
            total(fails & ~reaches).alias("redundant"),
            total(F.col("mask") == F.col("own")).alias("unique_fails"),
            total(fails & reaches, "quality").alias("good_lost"),
            total(fails & reaches, "toxic").alias("toxic_lost"),
            total(fails, turns).alias("shapley"),
        )
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """For every part, order of the five filters and step: what is kept, removed, redundant, and what it costs.

    NULL and empty texts are one text; a NULL lang is the empty part. A row without an id has no smaller id and is
    smaller than none, so only its own text decides. Rows equal in id and text don't remove each other. Repeated or
    contradicting labels of an id count as 1 where any row says 1. Very long texts are read whole, in Arrow
    batches bounded in bytes. Extra columns are ignored; no documents give no rows.
    """
    facts = materialise(text_facts(docs), "filter-facts")
    counts = materialise(mask_counts(with_repeats(facts), labels), "mask-counts")
    return order_report(counts)
