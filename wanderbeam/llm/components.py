"""Connected components of an edge list, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wanderbeam.session import materialise


def _state(edges: DataFrame) -> tuple:
    mark = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mark)).first())


def components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node of ``edges``.

    ``edges`` has two columns ``a`` and ``b`` of one integer type. Alternating star steps: a large star joins every larger
    neighbour of a node to the node's smallest neighbour, a small star does the same for the
    smaller ones; they end as stars after a logarithmic number of rounds. Each round is
    written to the shared folder, so a lost executor never sends the work back to the start.
    Loops and repeated edges are ignored; an empty list gives no rows.
    """
    edges = materialise(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    state = _state(edges)
    for _ in range(rounds):
        if not state[0]:
            break
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        # Every edge now points from a larger node b to a smaller one a.
        lower = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (
            large.join(lower, "b")
            .select(F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("a").alias("b")), F.struct(F.col("m").alias("a"), F.col("b").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .where("a <> b")
            .distinct()
        )
        edges = materialise(small, "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    else:
        raise RuntimeError("the components did not settle")
    roots = edges.select(F.col("a").alias("root")).distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).union(roots.select(F.col("root").alias("node"), "root"))
