"""SimHash near-duplicates by pigeonhole blocks."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wanderbeam.llm.components import components
from wanderbeam.llm.heavy import back_to_rows
from wanderbeam.llm.text import text_bytes
from wanderbeam.session import materialise

BITS = 64
_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(raw: bytes, size: int, seed: int = 42) -> np.ndarray:
    """XXH64 of every ``size``-word shingle; fewer words are one shingle, no words none."""
    parts = raw.split()
    n = len(parts)
    if not n:
        return np.empty(0, np.uint64)
    joined = b" ".join(parts)
    if n <= size:
        return np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    lengths = np.fromiter(map(len, parts), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: n - size + 1].tolist()
    digest = xxhash.xxh64_intdigest
    spans = zip(starts, ends[size - 1 :].tolist())
    return np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64, n - size + 1)


def majority(hashes: np.ndarray) -> int:
    """The 64-bit number whose bits are set in over half of the hashes; 0 if there are none.

    Eight bits are counted at a time in the bytes of one word, over runs of at most 255 hashes.
    """
    n = len(hashes)
    if not n:
        return 0
    runs = np.arange(0, n, 255)
    fingerprint = 0
    for k in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(k)) & _LANES, runs)
        counts = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
        for byte, count in enumerate(counts.tolist()):
            if 2 * count > n:
                fingerprint |= 1 << (8 * byte + k)
    return fingerprint


def fingerprint(text: str | None, size: int) -> int:
    return majority(shingle_hashes(text_bytes(text, lower=True), size))


def fingerprint_column(text: Column, size: int) -> Column:
    """The fingerprint as a signed long, over Arrow batches."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        values = np.fromiter((fingerprint(t, size) for t in texts), np.uint64, len(texts))
        return pd.Series(values.view(np.int64))

    return of(text)


def block_masks(blocks: int, shared: int) -> list[int]:
    """Bit masks of every choice of ``shared`` out of ``blocks`` nearly equal blocks."""
    edge = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [((1 << edge[i + 1]) - 1) ^ ((1 << edge[i]) - 1) for i in range(blocks)]
    return [sum(chosen) for chosen in combinations(parts, shared)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def near_pairs(fingerprints: DataFrame, radius: int, blocks: int, pair_limit: int = 8192) -> DataFrame:
    """``a`` < ``b``: enough links between distinct fingerprints to connect all within ``radius``.

    ``fingerprints`` has one column ``fp`` of distinct longs. Two within ``radius`` bits agree in at least
    ``blocks - radius`` blocks, so they share the key of one choice of blocks. Groups of up to
    ``pair_limit`` fingerprints with one key are joined with themselves and verified, which holds no more than the group and
    compares at most ``pair_limit`` longs for each of its rows; of two, the least and the greatest are the pair. Larger groups
    are linked in linear time by ``_cleared_links``. No group is cut. The links of each way are written before the next.
    """
    masks = block_masks(blocks, blocks - radius)
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(masks)]))
    keyed = fingerprints.select("fp", keys.alias("k")).select("k.c", "k.key", "fp")
    groups = keyed.groupBy("c", "key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1")
    groups = materialise(groups, "block-groups")

    def near(a: Column, b: Column) -> Column:
        return F.bit_count(a.bitwiseXOR(b)) <= radius

    pairs = groups.where("n = 2").where(near(F.col("a"), F.col("b"))).select("a", "b")
    members = materialise(keyed.join(groups.where("n > 2").select("c", "key", "n"), ["c", "key"]), "block-members")
    some = members.where(F.col("n") <= pair_limit).select("c", "key", "fp")
    left, right = some.withColumnRenamed("fp", "a"), some.withColumnRenamed("fp", "b")
    joined = left.join(right, ["c", "key"]).where((F.col("a") < F.col("b")) & near(F.col("a"), F.col("b"))).select("a", "b")
    pairs = pairs.union(materialise(joined.distinct(), "block-pairs"))
    large = members.where(F.col("n") > pair_limit).select("c", "fp")
    if large.limit(1).count():
        pairs = pairs.union(materialise(_cleared_links(large, masks, radius), "cleared-links"))
    return pairs.distinct()


def _cleared_links(members: DataFrame, masks: list[int], radius: int) -> DataFrame:
    """Links inside large groups: each fingerprint is filed under itself with any ``radius`` of its free bits cleared.

    What meets there differs in the cleared bits only, so at most 2^radius fingerprints, one for each pattern
    of those bits: a fixed set of columns holds them. Members are dealt by fingerprint before they are filed.
    """
    chosen = []
    for i, mask in enumerate(masks):
        free = [_signed(1 << b) for b in range(BITS) if not mask >> b & 1]
        chosen += [(i, *bits) for bits in combinations(free, radius)]
    names = [f"bit{j}" for j in range(radius)]
    # As many rows as there are choices of bits, whatever the fingerprints.
    holes = members.sparkSession.createDataFrame(chosen, "c int, " + ", ".join(f"{n} long" for n in names))
    dealt = members.repartition("c", "fp").join(F.broadcast(holes), "c")
    hole = F.lit(0).cast("long")
    pattern = F.lit(0)
    for j, name in enumerate(names):
        hole = hole.bitwiseOR(F.col(name))
        pattern = pattern + F.when(F.col("fp").bitwiseAND(F.col(name)) != 0, 1 << j).otherwise(0)
    filed = dealt.select("fp", hole.alias("hole"), pattern.alias("pattern"))
    rest = F.col("fp").bitwiseAND(F.bitwise_not(F.col("hole"))).alias("rest")
    held = [F.max(F.when(F.col("pattern") == p, F.col("fp"))).alias(f"p{p}") for p in range(1 << radius)]
    met = filed.groupBy("hole", rest).agg(F.count(F.lit(1)).alias("n"), *held).where("n > 1")
    met = met.select(F.least(*[f"p{p}" for p in range(1 << radius)]).alias("a"), F.explode(F.array(*[f"p{p}" for p in range(1 << radius)])).alias("b"))
    return met.where("a <> b").distinct()


def near_classes(rows: DataFrame, order: str, radius: int, blocks: int) -> DataFrame:
    """``fp``, ``n`` (its rows) and ``first``: the smallest ``order`` value in the component of each fingerprint.

    ``rows`` has columns ``fp`` and ``order``; rows with one fingerprint collapse before anything is joined.
    """
    classes = materialise(rows.groupBy("fp").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")), "simhash-classes")
    linked = components(near_pairs(classes.select("fp"), radius, blocks))
    linked = materialise(linked.withColumnRenamed("node", "fp"), "simhash-linked")
    firsts = materialise(linked.join(classes, "fp").select("fp", "root", "first"), "simhash-firsts")
    # A component of many fingerprints is one large class: its least value goes back to them like any other.
    least = materialise(firsts.groupBy("root").agg(F.min("first").alias("least"), F.count(F.lit(1)).alias("n")), "simhash-least")
    moved = back_to_rows(firsts.select("fp", "root"), least, "root", "least", firsts.count())
    moved = moved.select("fp", "least")
    return classes.join(moved, "fp", "left").select("fp", "n", F.coalesce("least", "first").alias("first"))


def document_components(docs: DataFrame, size: int = 3, radius: int = 2, blocks: int = 4) -> DataFrame:
    """doc_id, fingerprint and component_id of every document.

    NULL and blank texts have fingerprint zero and are linked like any other. Rows without an
    id get the component of their fingerprint, and NULL where it holds no id at all. Repeated rows
    stay repeated; an empty table gives no rows. Very long texts are hashed whole, one text at a time. Extra columns are ignored.
    """
    rows = docs.select("doc_id", fingerprint_column(F.col("text"), size).alias("fp"))
    rows = materialise(rows, "simhash")
    classes = materialise(near_classes(rows, "doc_id", radius, blocks), "simhash-components")
    return back_to_rows(rows, classes, "fp", "first", rows.count()).select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("first").alias("component_id"),
    )


def deduplicated(docs: DataFrame, size: int = 5, radius: int = 3, blocks: int = 6) -> DataFrame:
    """One document of each group of near-duplicates, with the columns of ``docs``.

    The document with the smallest id stays (NULL ids come last, equal ids by the MD5 of the
    text). Rows equal in id and text are one document. Only fingerprints and text digests are
    grouped; the texts are joined once with the survivors.
    """
    digest = F.unhex(F.md5(F.coalesce(F.col("text"), F.lit(""))))
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), digest.alias("digest"))
    rows = materialise(docs.select(rank.alias("rank"), fingerprint_column(F.col("text"), size).alias("fp")), "simhash")
    classes = near_classes(rows, "rank", radius, blocks)
    stay = materialise(classes.select("first").distinct(), "simhash-stay")
    keys = stay.select(F.col("first.id").alias("__id"), F.col("first.digest").alias("__digest"))
    marked = docs.withColumn("__md5", digest)
    kept = marked.join(keys, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__md5") == F.col("__digest")), "left_semi")
    again = rows.join(stay, rows["rank"] == stay["first"], "left_semi").count() > stay.count()
    return (kept.dropDuplicates(["doc_id", "__md5"]) if again else kept).drop("__md5")
