"""Prefix trie of rebuilt conversations, with subtree totals by parallel tree contraction."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wanderbeam.operators.skew import MAX_GROUP_ROWS, SEGMENT, lookup_join, number_rows, split_heavy_groups
from wanderbeam.session import materialise

# Conversations of one hundred share the head of the first of them; at most five turns of it.
FAMILY = 100
MOST_SHARED = 5
CHUNK_IDS = 4096
ROOT = "0:"


def head_length(conv_id: Column) -> Column:
    """Shared turns of a conversation: unsigned CRC-32 of its decimal id, modulo six."""
    return F.crc32(conv_id.cast("string").cast("binary")) % (MOST_SHARED + 1)


def numbered_turns(convs: DataFrame, max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """conv_id, place (from 1), turns (of the conversation), digest and chars of each turn, without its text.

    The digest is the MD5 of role and text; it identifies a turn and settles turns of equal number.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    rows = convs.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        F.length(text).cast("long").alias("chars"),
    )
    rows = materialise(rows, "turns")
    rows = number_rows(rows, ["conv_id"], ["turn", "digest"], "place", "turns", max_rows)
    return materialise(rows.drop("turn"), "numbered-turns")


def rebuilt(turns: DataFrame) -> DataFrame:
    """c, depth (from 1), digest, chars and last (is it the end?) of every turn of every rebuilt conversation."""
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    shared = F.col("place") <= MOST_SHARED
    heads = turns.where(shared & (F.col("conv_id") % FAMILY == 0))
    heads = heads.select(F.col("conv_id").alias("base"), F.col("place").alias("depth"), "digest", "chars", F.least("turns", F.lit(MOST_SHARED)).alias("of"))
    heads = materialise(heads, "heads")
    # One row per conversation: the row of its first turn.
    convs = turns.where("place = 1").select(F.col("conv_id").alias("c"), "turns", base.alias("base"), head_length(F.col("conv_id")).alias("h"))
    ended = (F.col("turns") <= F.col("h")) & (F.col("depth") == F.least("h", "of"))
    front = convs.join(heads, "base").where("depth <= h").select("c", "depth", "digest", "chars", ended.alias("last"))
    lengths = heads.where("depth = 1").select("base", "of")
    own = turns.withColumn("h", head_length(F.col("conv_id"))).where("place > h").withColumn("base", base)
    own = lookup_join(own, lengths, "base", "left")
    depth = F.col("place") - F.col("h") + F.least(F.col("h"), F.coalesce("of", F.lit(0)))
    return front.unionByName(own.select(F.col("conv_id").alias("c"), depth.alias("depth"), "digest", "chars", (F.col("place") == F.col("turns")).alias("last")))


def _key(depth: Column, a: Column, b: Column) -> Column:
    """Name of a node: depth and 128 bits of its path; the root is ``ROOT``."""
    bits = F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0"))
    return F.when(depth == 0, F.lit(ROOT)).otherwise(F.concat(depth.cast("string"), F.lit(":"), bits))


def path_keys(rows: DataFrame, max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """key (of the path down to the row's turn) and parent (key without it) for the rows of ``rebuilt``.

    A path is the exclusive or of two 64-bit hashes of (depth, turn) over its turns, so it is a running aggregate,
    and that of a long conversation is carried from segment to segment.
    """
    marks = rows.select("*", *[F.xxhash64(F.lit(i), "depth", "digest").alias(f"m{i}") for i in (0, 1)])
    groups = split_heavy_groups(marks, ["c"], ["depth"], max_rows)

    def running(*keys: str) -> list[Column]:
        upto = Window.partitionBy(*keys).orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
        return [F.bit_xor(f"m{i}").over(upto).alias(f"k{i}") for i in (0, 1)]

    keyed = groups.light.select("*", *running("c"))
    if groups.heavy is not None:
        before = Window.partitionBy("c").orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
        totals = groups.heavy.groupBy("c", SEGMENT).agg(*[F.bit_xor(f"m{i}").alias(f"t{i}") for i in (0, 1)])
        carried = totals.select("c", SEGMENT, *[F.coalesce(F.bit_xor(f"t{i}").over(before), F.lit(0)).alias(f"b{i}") for i in (0, 1)])
        long = groups.heavy.select("*", *running("c", SEGMENT)).join(carried, ["c", SEGMENT])
        for i in (0, 1):
            long = long.withColumn(f"k{i}", F.col(f"k{i}").bitwiseXOR(F.col(f"b{i}")))
        keyed = keyed.unionByName(long.drop(SEGMENT, "b0", "b1"))
    depth, up = F.col("depth"), [F.col(f"k{i}").bitwiseXOR(F.col(f"m{i}")) for i in (0, 1)]
    return keyed.select("c", "depth", "chars", "last", _key(depth, F.col("k0"), F.col("k1")).alias("key"), _key(depth - 1, *up).alias("parent"))


def trie_nodes(paths: DataFrame, turns: DataFrame) -> DataFrame:
    """key, parent, depth, conv_id (smallest member), n_convs and weight (tokens saved at the node itself)."""
    inner = paths.groupBy("key", "parent", "depth", "chars").agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    inner = inner.select("key", "parent", "depth", "conv_id", "n_convs", ((F.col("n_convs") - 1) * F.col("chars")).alias("weight"))
    members = turns.where("place = 1").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    root = members.select(F.lit(ROOT).alias("key"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs", F.lit(0).cast("long").alias("weight"))
    return inner.withColumn("depth", F.col("depth").cast("long")).unionByName(root)


def _plus(column: str, more: str) -> Column:
    return (F.col(column) + F.coalesce(F.col(more), F.lit(0))).alias(column)


def _followed(links: DataFrame, label: str) -> DataFrame:
    """``links`` (key, child, leaves, saved) with every child replaced by the end of its way, and the sums along it.

    Each round joins the links with themselves and so doubles the length of the ways, until no child is a key.
    """
    while True:
        after = links.select(F.col("key").alias("child"), F.col("child").alias("next"), F.col("leaves").alias("l"), F.col("saved").alias("s"))
        found = links.join(after, "child", "left")
        moved = found.select("key", F.coalesce("next", "child").alias("child"), _plus("leaves", "l"), _plus("saved", "s"), F.col("next").isNotNull().alias("moved"))
        moved = materialise(moved, label)
        links = moved.drop("moved")
        if not moved.where("moved").limit(1).count():
            return links


# A standing node: what its subtree has lost so far is in leaves and saved; what was taken out between it and its parent
# is in via_leaves and via_saved and goes up with it.
NODE = ("key", "parent", "kids", "leaves", "saved", "via_leaves", "via_saved")


def _compressed(standing: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The tree without its unary chains, and the links from their nodes to what stands below (None without chains).

    A chain node is an inner node, not the root, with one child. All of them go at once: the node below the chain moves
    up to the node above it and takes along what the chain held.
    """
    # Counted by parent, so that a parent with many children sends a row per task.
    only = standing.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(
        F.count(F.lit(1)).alias("n"), F.max("key").alias("child"), F.sum("via_leaves").alias("l"), F.sum("via_saved").alias("s")
    )
    chain = standing.where("kids = 1 AND parent IS NOT NULL").join(only.where("n = 1").drop("n"), "key")
    chain = chain.select("key", "parent", "child", _plus("leaves", "l"), _plus("saved", "s"), "via_leaves", "via_saved")
    chain = materialise(chain, "trie-chain")
    if not chain.limit(1).count():
        return standing, None
    links = _followed(chain.select("key", "child", "leaves", "saved"), "trie-links")
    tops = chain.select("key", "parent", "via_leaves", "via_saved").join(chain.select(F.col("child").alias("key")), "key", "left_anti")
    lifted = tops.join(links, "key").select(
        F.col("child").alias("key"),
        F.col("parent").alias("up"),
        (F.col("via_leaves") + F.col("leaves")).alias("up_leaves"),
        (F.col("via_saved") + F.col("saved")).alias("up_saved"),
    )
    left = standing.join(links.select("key"), "key", "left_anti").join(lifted, "key", "left")
    moved = [F.coalesce(up, old).alias(old) for up, old in (("up", "parent"), ("up_leaves", "via_leaves"), ("up_saved", "via_saved"))]
    return left.select("key", "kids", "leaves", "saved", *moved).select(*NODE), links


def subtree_totals(tree: DataFrame, rounds: int = 64) -> DataFrame:
    """key, leaves and saved, summed over the subtree of every node, for a tree of (key, parent, kids, weight).

    Rounds alternate two steps on the nodes still standing. Compress: every chain of nodes with one child is taken out, its
    nodes linked to the node below it. Rake: every leaf, its totals now known, adds them to its
    parent and goes. After a compress every inner node has two children or more, so a round takes at
    least half of the leaves: the rounds grow with the logarithm of the nodes, not with the depth. At the end the
    links are followed across the rounds, and a chain node's total is what lay on its way plus the total at its
    end. Each step is written to the shared folder.
    """
    own, none = F.when(F.col("kids") == 0, 1).otherwise(0).cast("long").alias("leaves"), F.lit(0).cast("long")
    standing = tree.select("key", "parent", "kids", own, F.col("weight").alias("saved"), none.alias("via_leaves"), none.alias("via_saved"))
    known, linked = [], []
    for _ in range(rounds):
        standing, links = _compressed(standing)
        if links is not None:
            linked.append(links)
            standing = materialise(standing, "trie-compressed")
        known.append(standing.where("kids = 0").select("key", "leaves", "saved"))
        fallen = standing.where("kids = 0 AND parent IS NOT NULL").groupBy(F.col("parent").alias("key"))
        fallen = fallen.agg(
            F.sum(F.col("leaves") + F.col("via_leaves")).alias("l"),
            F.sum(F.col("saved") + F.col("via_saved")).alias("s"),
            F.count(F.lit(1)).alias("n"),
        )
        left = standing.where("kids > 0").join(fallen, "key", "left")
        left = left.select("key", "parent", (F.col("kids") - F.coalesce("n", F.lit(0))).alias("kids"), _plus("leaves", "l"), _plus("saved", "s"), "via_leaves", "via_saved")
        standing = materialise(left, "trie-raked")
        if standing.count() < 2:
            # The root alone, without children now, or an empty tree.
            known.append(standing.select("key", "leaves", "saved"))
            break
    else:
        raise RuntimeError("the tree did not contract")
    totals = reduce(DataFrame.unionByName, known)
    if linked:
        ways = _followed(reduce(DataFrame.unionByName, linked), "trie-ways")
        ends = totals.select(F.col("key").alias("child"), F.col("leaves").alias("l"), F.col("saved").alias("s"))
        back = ways.join(ends, "child").select("key", (F.col("leaves") + F.col("l")).alias("leaves"), (F.col("saved") + F.col("s")).alias("saved"))
        totals = totals.unionByName(materialise(back, "trie-back"))
    return totals


def end_digests(ends: DataFrame) -> DataFrame:
    """key and ends_sha256: SHA-256 of the ids that end at a node, ascending, joined by commas.

    Ids are joined to chunks of at most 4096 in tasks cut by (key, id); a hash, which has to be taken in order, then reads
    a chunk at a time and never holds a node's ids.
    """

    def chunk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, ids = None, []
        for batch in batches:
            out = []
            for k, c in zip(batch["key"], batch["c"]):
                if ids and (k != key or len(ids) == CHUNK_IDS):
                    out.append((key, ids[0], ",".join(map(str, ids))))
                    ids = []
                key = k
                ids.append(c)
            yield pd.DataFrame(out, columns=["key", "first", "ids"])
        if ids:
            yield pd.DataFrame([(key, ids[0], ",".join(map(str, ids)))], columns=["key", "first", "ids"])

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state = None, None
        for batch in batches:
            out = []
            for k, ids in zip(batch["key"], batch["ids"]):
                if k != key:
                    if state is not None:
                        out.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pd.DataFrame(out, columns=["key", "ends_sha256"])
        if state is not None:
            yield pd.DataFrame([(key, state.hexdigest())], columns=["key", "ends_sha256"])

    dealt = ends.select("key", "c").repartitionByRange("key", "c").sortWithinPartitions("key", "c")
    chunks = dealt.mapInPandas(chunk, "key string, first long, ids string")
    return chunks.repartition("key").sortWithinPartitions("key", "first").mapInPandas(digest, "key string, ends_sha256 string")


def conversation_trie(convs: DataFrame, max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    NULL roles and texts are empty, a NULL turn comes first; turns of one number stand in the order of the MD5 of role and text, repeated
    rows are turns of their own. Rows without a conv_id belong to no conversation. A path is known by 128 bits of
    hash. A conversation of more than ``max_rows`` turns is cut into segments; very long texts are hashed
    where they are read. Extra columns are ignored; an empty table has no node, not even the root.
    """
    turns = numbered_turns(convs, max_rows)
    paths = materialise(path_keys(materialise(rebuilt(turns), "rebuilt"), max_rows), "paths")
    nodes = materialise(trie_nodes(paths, turns), "trie-nodes")
    kids = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("kids"))
    tree = materialise(nodes.join(kids, "key", "left").withColumn("kids", F.coalesce("kids", F.lit(0)).cast("long")), "trie")
    totals = subtree_totals(tree)
    complete = paths.where("last").select("key", "c")
    turnless = turns.where("place = 1").select(F.col("conv_id").alias("c"), "turns").where(F.col("turns") <= head_length(F.col("c")))
    bases = turns.where((F.col("place") == 1) & (F.col("conv_id") % FAMILY == 0)).select(F.col("conv_id").alias("base"))
    turnless = turnless.withColumn("base", F.col("c") - F.col("c") % FAMILY).join(bases, "base", "left_anti")
    # Without shared turns a conversation keeps all of its own, so h is 0 for none of these.
    ends = end_digests(materialise(complete.unionByName(turnless.select(F.lit(ROOT).alias("key"), "c")), "trie-ends"))
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = lookup_join(tree.join(totals, "key").join(ends, "key", "left"), parents, "parent", "left")
    return out.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.col("kids").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
