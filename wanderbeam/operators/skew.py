"""Per-key ordering and lookups that survive a key holding a large share of the rows.

Adaptive execution splits skewed joins, but it cannot split one window partition or one
aggregation group. The functions here keep every window and every list bounded:

* keys with at most ``max_rows`` rows take the plain window, one shuffle on the key;
* the other keys are range-partitioned on (key, order) into segments, windows run inside
  a segment, and per-segment totals carry the state from one segment to the next.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wanderbeam.session import materialise, shuffle_width

SEGMENT = "__segment"
MAX_GROUP_ROWS = 1_000_000
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20
HEAVY_SHARE = 0.001
NULL_SALTS = 256
SALT = "__salt"
BLOCK = "__block"
# Members that are paired with a fact at a time.
PAIR_BLOCK = 1024
# Pairs from which on one more task is worth it, and tasks of pairs for each task of a shuffle.
TASK_PAIRS = 1 << 20
SLOT_TASKS = 16


@dataclass
class Grouped:
    """A frame split by group size; ``heavy`` carries the SEGMENT column."""

    light: DataFrame
    heavy: DataFrame | None
    keys: list[str]
    order: list[str]


def split_heavy_groups(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    max_rows: int | None = MAX_GROUP_ROWS,
) -> Grouped:
    """Separate the keys with more than ``max_rows`` rows and cut them into segments.

    ``order`` must be total inside a key. Costs one counting pass over the key columns;
    ``max_rows=None`` says that the keys are known to be small (see ``group_limit``).
    """
    keys, order = list(keys), list(order)
    if max_rows is None:
        return Grouped(df, None, keys, order)
    sizes = _large_groups(df, keys, max_rows)
    found = sizes.agg(F.count(F.lit(1)).alias("keys"), F.sum("n").alias("rows")).first()
    if not found["keys"]:
        return Grouped(df, None, keys, order)
    heavy_keys = materialise(sizes.select(*keys), "heavy-keys")
    if found["keys"] <= BROADCAST_ROWS:
        heavy_keys = F.broadcast(heavy_keys)
    light = _same_keys(df, heavy_keys, keys, "left_anti")
    segments = -(-found["rows"] // max_rows) + 1
    heavy = (
        _same_keys(df, heavy_keys, keys, "left_semi")
        .repartitionByRange(int(segments), *keys, *order)
        .withColumn(SEGMENT, F.spark_partition_id())
    )
    return Grouped(light, materialise(heavy, "segments"), keys, order)


def _same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys``, where NULL is a key like any other."""
    named = right.withColumnsRenamed({k: f"__right_{i}" for i, k in enumerate(keys)})
    same = reduce(and_, [F.col(f"`{k}`").eqNullSafe(F.col(f"__right_{i}")) for i, k in enumerate(keys)])
    return left.join(named, same, how).drop(*[f"__right_{i}" for i in range(len(keys))])


def _large_groups(df: DataFrame, keys: list[str], max_rows: int) -> DataFrame:
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return sizes.filter(F.col("n") > max_rows)


def group_limit(
    source: DataFrame, keys: Sequence[str], max_rows: int = MAX_GROUP_ROWS
) -> int | None:
    """``max_rows`` if some key of ``source`` has more rows than that, else None.

    A counting pass over a stored table settles it for everything that is later filtered,
    looked up or collapsed from it, since none of that makes a key larger.
    """
    return max_rows if _large_groups(source, list(keys), max_rows).limit(1).count() else None


def _carried(heavy: DataFrame, keys: list[str], totals: list[Column], carried: dict[str, Column]) -> DataFrame:
    """Join per-segment ``carried`` values, computed over the segments of a key, to the rows.

    A key has at most as many segments as the range exchange has partitions.
    """
    per_segment = heavy.groupBy(*keys, SEGMENT).agg(*totals)
    state = per_segment.select(*keys, SEGMENT, *[c.alias(n) for n, c in carried.items()])
    return _same_keys(heavy, state, [*keys, SEGMENT])


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    position: str = "position",
    total: str | None = None,
    max_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """1-based position of every row in its key, and the key's row count if ``total``."""
    return number_groups(split_heavy_groups(df, keys, order, max_rows), position, total)


def number_groups(groups: Grouped, position: str, total: str | None = None) -> DataFrame:
    keys, order = groups.keys, groups.order
    by_key = Window.partitionBy(*keys)
    light = groups.light.withColumn(
        position, F.row_number().over(by_key.orderBy(*order)).cast("long")
    )
    if total:
        light = light.withColumn(total, F.count(F.lit(1)).over(by_key))
    if groups.heavy is None:
        return light
    before = by_key.orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    carried = {"__before": F.coalesce(F.sum("__n").over(before), F.lit(0))}
    if total:
        carried[total] = F.sum("__n").over(by_key)
    rows = _carried(groups.heavy, keys, [F.count(F.lit(1)).alias("__n")], carried)
    local = Window.partitionBy(*keys, SEGMENT).orderBy(*order)
    rows = rows.withColumn(position, F.row_number().over(local) + F.col("__before"))
    return light.unionByName(rows.drop(SEGMENT, "__before"))


def number_runs(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    run: str = "run",
    max_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """1-based number of the run of equal consecutive ``value`` a row belongs to.

    A NULL value never equals its neighbour, so each NULL is a run of its own.
    """
    groups = split_heavy_groups(df, keys, order, max_rows)
    keys, order = groups.keys, groups.order

    def starts(window) -> Column:
        same = F.col(value) == F.lag(value).over(window)
        return F.when(same, 0).otherwise(1)

    by_key = Window.partitionBy(*keys).orderBy(*order)
    light = (
        groups.light.withColumn("__start", starts(by_key))
        .withColumn(run, F.sum("__start").over(by_key.rowsBetween(Window.unboundedPreceding, 0)))
        .drop("__start")
    )
    if groups.heavy is None:
        return light
    local = Window.partitionBy(*keys, SEGMENT).orderBy(*order)
    # The first row of a segment counts as a start here; the carried value takes the
    # start back where the previous segment ended with the same value.
    heavy = groups.heavy.withColumn("__start", starts(local))
    place = F.struct(*order)
    totals = [
        F.sum("__start").alias("__starts"),
        F.min_by(value, place).alias("__first"),
        F.max_by(value, place).alias("__last"),
    ]
    across = Window.partitionBy(*keys).orderBy(SEGMENT)
    joins_previous = F.when(F.col("__first") == F.lag("__last").over(across), 1).otherwise(0)
    per_segment = (
        heavy.groupBy(*keys, SEGMENT).agg(*totals).withColumn("__joined", joins_previous)
    )
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    upto = across.rowsBetween(Window.unboundedPreceding, 0)
    state = per_segment.select(
        *keys,
        SEGMENT,
        (
            F.coalesce(F.sum("__starts").over(earlier), F.lit(0)) - F.sum("__joined").over(upto)
        ).alias("__before"),
    )
    rows = _same_keys(heavy, state, [*keys, SEGMENT]).withColumn(
        run,
        F.sum("__start").over(local.rowsBetween(Window.unboundedPreceding, 0)) + F.col("__before"),
    )
    return light.unionByName(rows.drop(SEGMENT, "__start", "__before"))


def with_neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    offset: int,
    max_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """``value`` of the row ``offset`` places later (earlier if negative) in the same key."""
    groups = split_heavy_groups(df, keys, order, max_rows)
    by_key = Window.partitionBy(*groups.keys).orderBy(*groups.order)
    light = groups.light.withColumn(out, F.lead(value, offset).over(by_key))
    if groups.heavy is None:
        return light
    nothing = groups.light.limit(0)
    placed = number_groups(Grouped(nothing, groups.heavy, groups.keys, groups.order), "__place")
    shifted = placed.select(
        *groups.keys, (F.col("__place") - offset).alias("__place"), F.col(value).alias(out)
    )
    rows = _same_keys(placed, shifted, [*groups.keys, "__place"], "left").drop("__place")
    return light.unionByName(rows)


def row_bytes(schema: T.StructType) -> Column:
    """Upper estimate of a row's size: the length of texts, 16 bytes for a plain value."""
    size = F.lit(0)
    for field in schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + 16 + F.coalesce(F.octet_length(column), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
            text = F.to_json(F.struct(column))
            size = size + 16 + F.coalesce(F.octet_length(text), F.lit(0))
        else:
            size = size + 16
    return size


def small_enough(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """True if ``df`` is measured to have at most ``rows`` rows and ``size`` bytes.

    Reads ``rows`` + 1 rows at most: of a large side just enough to know that it is large.
    """
    sizes = df.select(row_bytes(df.schema).alias("b")).limit(rows + 1)
    found = sizes.agg(F.count(F.lit(1)).alias("n"), F.sum("b").alias("b")).first()
    return found["n"] <= rows and (found["b"] or 0) <= size


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    on: str,
    how: str = "inner",
    broadcast_rows: int = BROADCAST_ROWS,
    salts: int = NULL_SALTS,
) -> DataFrame:
    """Join ``facts`` to a dimension that has one row per ``on``, in one pass over the facts.

    A dimension measured to be small is broadcast. Otherwise it is one shuffled join on (key, salt), and said to be one: the size
    that Spark guesses from compressed files may be a tenth of the rows', which then would all go through the driver.
    The salt is 0 for every key, so the join is split by adaptive execution where a
    key holds many facts, which any of these join types allows on the side of the facts; facts
    without a key, which match nothing, get one of ``salts`` salts from a hash of the row
    and so never meet in one task.
    """
    if small_enough(dim, broadcast_rows):
        return facts.join(F.broadcast(dim), on, how)
    if how not in ("left", "left_outer", "left_anti"):
        return facts.join(dim.hint("merge"), on, how)
    plain = [f"`{f.name}`" for f in facts.schema.fields if isinstance(f.dataType, T.AtomicType)]
    spread = F.pmod(F.xxhash64(*plain), F.lit(salts)).cast("int")
    salted = facts.withColumn(SALT, F.when(F.col(on).isNull(), spread).otherwise(0))
    return salted.join(dim.withColumn(SALT, F.lit(0)).hint("merge"), [on, SALT], how).drop(SALT)


def heavy_keys(df: DataFrame, key: str, share: float = HEAVY_SHARE) -> list:
    """Keys holding more than ``share`` of all rows: never more than ``1 / share`` of them."""
    return list(_heavy_shares(df, key, share))


def _heavy_shares(df: DataFrame, key: str, share: float) -> dict:
    """Keys holding more than ``share`` of all rows, with what they hold of them."""
    sizes = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = df.count()
    found = sizes.filter(F.col("n") > share * total)
    return {row[0]: row["n"] / total for row in found.collect()}


def expanding_join(
    facts: DataFrame,
    members: DataFrame,
    on: str,
    spread: str,
    salts: int | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    heavy_share: float = HEAVY_SHARE,
    task_pairs: int = TASK_PAIRS,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Inner join where a key has many rows on both sides.

    The pairs are counted from the rows per key first. More than ``task_pairs`` of them, which few tasks would spell out however
    small both sides are, are made by ``_blocked_join``, to which ``order`` belongs. Otherwise members measured to be small are
    broadcast, or the facts of every key with more
    than ``heavy_share`` of them are spread by ``spread`` over ``salts`` tasks (if not given, twice as many as its share of a
    shuffle's tasks), and only the members of those keys are repeated, once per salt of their key. What is repeated is never
    broadcast: the size that Spark guesses for it is that of the members once.
    """
    if salts is None:
        sizes = materialise(_key_sizes(facts, members, on), "pair-counts")
        pairs = sizes.agg(F.sum(F.col("__facts").cast("double") * F.col("__members"))).first()[0] or 0
        if pairs > task_pairs:
            return _blocked_join(facts, members, on, spread, sizes, pairs, task_pairs, order)
    if small_enough(members, broadcast_rows):
        return facts.join(F.broadcast(members), on)
    heavy = _heavy_shares(facts, on, heavy_share)
    if not heavy:
        return facts.join(members.hint("merge"), on)
    width = shuffle_width(facts.sparkSession)
    parts = {k: salts or math.ceil(2 * share * width) for k, share in heavy.items()}
    # At most 1 / heavy_share keys.
    many = F.coalesce(F.create_map(*[F.lit(x) for pair in parts.items() for x in pair])[F.col(on)], F.lit(1))
    own_salt = F.pmod(F.xxhash64(spread), many).cast("int")
    salted = facts.withColumn(SALT, own_salt)
    repeated = members.withColumn(SALT, F.explode(F.sequence(F.lit(0), many - 1)))
    return salted.join(repeated.hint("merge"), [on, SALT]).drop(SALT)


def _key_sizes(facts: DataFrame, members: DataFrame, on: str) -> DataFrame:
    """``on``, ``__facts`` and ``__members``: rows of either side, of the keys that both have."""
    counted = [df.groupBy(on).agg(F.count(F.lit(1)).alias(name)) for df, name in ((facts, "__facts"), (members, "__members"))]
    return counted[0].join(counted[1], on)


def _blocked_join(
    facts: DataFrame, members: DataFrame, on: str, spread: str, sizes: DataFrame, pairs: float, task_pairs: int, order: Sequence[str] | None
) -> DataFrame:
    """The pairs of every key by blocks of at most ``PAIR_BLOCK`` members, spread over tasks by their number.

    A fact goes to every block of its key, which is a row for up to ``PAIR_BLOCK`` pairs; the facts of a block are salted by
    ``spread``, so that none of them has more than a quarter of a task's pairs. There are as many tasks as hold ``task_pairs`` pairs each, up
    to ``SLOT_TASKS`` for each task of a shuffle; their number is stated, as adaptive execution would join tasks of few bytes, whatever
    they are spelled out to. A task holds one block of members at a time and goes through it fact by fact, members in the same order
    (that of ``order``, which is all columns if not given), so a written result repeats itself at short distances and packs well.
    """
    tasks = math.ceil(min(pairs / task_pairs, SLOT_TASKS * shuffle_width(facts.sparkSession)))
    block_pairs = F.col("__facts").cast("double") * F.least("__members", F.lit(PAIR_BLOCK))
    parts = sizes.select(
        on,
        F.ceil(F.col("__members") / PAIR_BLOCK).cast("int").alias("__blocks"),
        F.ceil(block_pairs * (4 * tasks / pairs)).cast("int").alias("__salts"),
    )
    if order is None:
        order = [f.name for f in members.schema.fields if f.name != on and isinstance(f.dataType, T.AtomicType)]
    placed = number_rows(members, [on], order or [on], "__place")
    placed = placed.withColumn(BLOCK, F.floor((F.col("__place") - 1) / PAIR_BLOCK).cast("int")).drop("__place")
    # Written, since equal rows may be numbered otherwise when they are numbered again.
    placed = lookup_join(materialise(placed, "pair-blocks"), parts.select(on, "__salts"), on)
    placed = placed.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.col("__salts") - 1))).drop("__salts")
    dealt = lookup_join(facts, parts, on).withColumn(SALT, F.pmod(F.xxhash64(spread), F.col("__salts")).cast("int"))
    dealt = dealt.withColumn(BLOCK, F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1))).drop("__salts", "__blocks")
    place = [on, BLOCK, SALT]
    return dealt.repartition(tasks, *place).join(placed.repartition(tasks, *place).hint("merge"), place).drop(BLOCK, SALT)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
