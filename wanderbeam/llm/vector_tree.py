"""Approximate nearest neighbours by a hierarchical k-means tree, searched best bin first."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wanderbeam.session import materialise

MATCH = "query_id long, vec_id long, score double"


@dataclass(frozen=True)
class Bound:
    """Limits of what is fitted and held: the tree's sample, its shape, the calibration queries, a block of work."""

    sample: int = 20_000
    branches: int = 8
    leaf_sample: int = 100
    rounds: int = 12
    calibration: int = 128
    block: int = 2048
    seed: int = 11


@dataclass
class Tree:
    """Nodes in arrays: the centre of every node, the range of its children, and the leaf number (-1 inside)."""

    centres: np.ndarray
    first: np.ndarray
    count: np.ndarray
    leaf: np.ndarray
    leaves: int = field(default=0)

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of every vector: from the root always to the nearest child."""
        at = np.zeros(len(vectors), np.int64)
        moving = np.arange(len(vectors))
        while len(moving):
            moving = moving[self.count[at[moving]] > 0]
            for node in np.unique(at[moving]):
                rows = moving[at[moving] == node]
                kids = slice(self.first[node], self.first[node] + self.count[node])
                at[rows] = self.first[node] + _squared(vectors[rows], self.centres[kids]).argmin(axis=1)
        return self.leaf[at]

    def visits(self, query: np.ndarray, most: int) -> list[int]:
        """Up to ``most`` leaves in the order of a best-bin-first walk.

        Every branch not taken waits in a priority queue under the distance of its centre; the nearest one is
        opened next and followed down to a leaf.
        """
        queue, out = [(0.0, 0)], []
        while queue and len(out) < most:
            _, node = heapq.heappop(queue)
            while self.count[node]:
                kids = slice(self.first[node], self.first[node] + self.count[node])
                gaps = ((self.centres[kids] - query) ** 2).sum(axis=1)
                best = int(gaps.argmin())
                for k, gap in enumerate(gaps.tolist()):
                    if k != best:
                        heapq.heappush(queue, (gap, int(self.first[node]) + k))
                node = int(self.first[node]) + best
            out.append(int(self.leaf[node]))
        return out


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a**2).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b**2).sum(axis=1)


def _kmeans(points: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Centres and assignment; seeds are drawn by their distance to the seeds so far."""
    centres = [points[rng.integers(len(points))]]
    gap = ((points - centres[0]) ** 2).sum(axis=1)
    for _ in range(k - 1):
        if gap.sum() <= 0:
            break
        centres.append(points[rng.choice(len(points), p=gap / gap.sum())])
        gap = np.minimum(gap, ((points - centres[-1]) ** 2).sum(axis=1))
    centres = np.array(centres)
    for _ in range(rounds):
        own = _squared(points, centres).argmin(axis=1)
        centres = np.array([points[own == c].mean(axis=0) if (own == c).any() else centres[c] for c in range(len(centres))])
    return centres, _squared(points, centres).argmin(axis=1)


def fit_tree(points: np.ndarray, bound: Bound) -> Tree:
    """Split the sample by k-means again and again until a node has at most ``leaf_sample`` points or can't be split."""
    rng = np.random.default_rng(bound.seed)
    centres, first, count = [points.mean(axis=0)], [0], [0]
    waiting = [(0, points)]
    while waiting:
        node, mine = waiting.pop()
        if len(mine) <= bound.leaf_sample:
            continue
        found, own = _kmeans(mine, bound.branches, bound.rounds, rng)
        parts = [mine[own == c] for c in range(len(found))]
        parts = [(c, part) for c, part in zip(found, parts) if len(part)]
        if len(parts) < 2:
            continue
        first[node], count[node] = len(centres), len(parts)
        for centre, part in parts:
            waiting.append((len(centres), part))
            centres.append(centre)
            first.append(0)
            count.append(0)
    sizes = np.array(count)
    leaf = np.where(sizes == 0, np.cumsum(sizes == 0) - 1, -1)
    return Tree(np.array(centres), np.array(first), sizes, leaf, int((sizes == 0).sum()))


def usable_vectors(table: DataFrame) -> DataFrame:
    """vec_id and v (doubles) of the rows that take part.

    Out stay rows without an id, and vectors that are NULL, empty, zero or hold a NULL or non-finite component; so do
    vectors whose length is not the most frequent one (of equally frequent ones the smallest).
    """
    v = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return rows.where(F.size("v") == (sizes["size"] if sizes else 0))


def _sampled(key: Column | str, share: float, seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 30)) < int(min(share, 1.0) * (1 << 30))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64, copy=False)


def nearest_in(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> pd.DataFrame:
    """The ``k`` nearest of ``vectors`` for every query, ties to the smaller id, other ids only.

    A product of matrices rules out what is further than the k-th by more than its rounding; the
    rest is measured by differences in double precision.
    """
    rough = _squared(queries, vectors)
    same = query_ids[:, None] == ids[None, :]
    rough[same] = np.inf
    slack = 1e-9 * ((queries**2).sum(axis=1) + (vectors**2).sum(axis=1).max())
    if k < len(ids):
        edge = np.partition(rough, k - 1, axis=1)[:, k - 1]
    else:
        edge = np.full(len(queries), np.inf)
    asked, found, scores = [], [], []
    for i in range(len(queries)):
        near = np.flatnonzero((rough[i] <= edge[i] + slack[i]) & ~same[i])
        score = np.sqrt(((vectors[near] - queries[i]) ** 2).sum(axis=1))
        best = np.lexsort((ids[near], score))[:k]
        asked.append(np.repeat(query_ids[i], len(best)))
        found.append(ids[near][best])
        scores.append(score[best])
    whole = [np.concatenate(x) if x else np.empty(0) for x in (asked, found, scores)]
    return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), whole)))


def best_matches(found: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest; a group limit cuts on the map side."""
    by = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def exact_neighbours(queries: pd.DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """The nearest rows of a bounded set of queries by one pass over all rows, block by block."""
    held = rows.sparkSession.sparkContext.broadcast((queries["vec_id"].to_numpy(np.int64), _matrix(queries["v"])))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, vectors = held.value
        for batch in batches:
            for at in range(0, len(batch), 4096):
                part = batch.iloc[at : at + 4096]
                yield nearest_in(ids, vectors, part["vec_id"].to_numpy(np.int64), _matrix(part["v"]), k)

    return best_matches(rows.select("vec_id", "v").mapInPandas(search, MATCH), k)


@dataclass
class Index:
    """The tree, every vector with its leaf, and the leaf sizes."""

    tree: Tree
    rows: DataFrame
    sizes: dict[int, int]


def build_index(rows: DataFrame, bound: Bound = Bound()) -> Index | None:
    """Fit the tree on a sample of at most about ``bound.sample`` distinct vectors, then file every row under its leaf."""
    total = rows.count()
    if not total:
        return None
    sample = rows.where(_sampled("v", bound.sample / total, bound.seed)).select("v").distinct()
    points = sample.limit(2 * bound.sample).toPandas()["v"]
    if not len(points):
        points = rows.select("v").limit(1).toPandas()["v"]
    points = _matrix(points)
    tree = fit_tree(points[np.lexsort(points.T)], bound)
    held = rows.sparkSession.sparkContext.broadcast(tree)

    @F.pandas_udf("long")
    def leaf_of(vectors: pd.Series) -> pd.Series:
        return pd.Series(held.value.assign(_matrix(vectors)) if len(vectors) else [], dtype="int64")

    filed = materialise(rows.withColumn("leaf", leaf_of("v")), "vector-leaves")
    sizes = {int(r[0]): int(r[1]) for r in filed.groupBy("leaf").count().collect()}
    return Index(tree, filed, sizes)


def calibrated_visits(index: Index, queries: DataFrame, k: int, recall: float, bound: Bound = Bound()) -> tuple[int, float]:
    """Leaves to visit, and the recall it gives: widened until sampled queries find ``recall`` of their true neighbours.

    Up to about ``bound.calibration`` queries, drawn by a hash of the id, are compared with all rows. The walk of each says
    at which visit the leaf of each true neighbour would have been opened.
    """
    n = queries.count()
    if not n:
        return 1, 1.0
    drawn = queries.where(_sampled("vec_id", bound.calibration / n, bound.seed)).limit(2 * bound.calibration).toPandas()
    if not len(drawn):
        drawn = queries.limit(1).toPandas()
    truth = exact_neighbours(drawn, index.rows, k)
    filed = index.rows.select("vec_id", "leaf").dropDuplicates(["vec_id"])
    found = filed.join(F.broadcast(truth.select("query_id", "vec_id")), "vec_id").toPandas()
    at_visit = []
    for vec_id, v in zip(drawn["vec_id"], drawn["v"]):
        order = {leaf: i for i, leaf in enumerate(index.tree.visits(np.asarray(v, np.float64), index.tree.leaves))}
        at_visit += [order[leaf] for leaf in found.loc[found["query_id"] == vec_id, "leaf"]]
    if not at_visit:
        return 1, 1.0
    at_visit = np.array(at_visit)
    visits = 1
    while (at_visit < visits).mean() < recall and visits < index.tree.leaves:
        visits = min(visits + max(1, visits // 8), index.tree.leaves)
    return visits, float((at_visit < visits).mean())


def search(index: Index, queries: DataFrame, k: int, visits: int, bound: Bound = Bound()) -> DataFrame:
    """The ``k`` nearest rows that each query finds in its first ``visits`` leaves.

    Queries go to the leaves of their walk, where they meet the vectors in blocks: a leaf of many vectors is cut by
    vector, one of many queries by query as well, so no group holds more than about two blocks of each.
    """
    spark = queries.sparkSession
    held = spark.sparkContext.broadcast(index.tree)

    @F.pandas_udf("array<long>")
    def walk(vectors: pd.Series) -> pd.Series:
        return pd.Series([np.array(held.value.visits(np.asarray(v, np.float64), visits), np.int64) for v in vectors])

    asked = materialise(queries.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), walk("v").alias("leaves")), "vector-walks")
    asked = asked.select("query_id", "q", F.explode("leaves").alias("leaf"))
    crowd = {int(r[0]): int(r[1]) for r in asked.groupBy("leaf").count().collect()}
    cuts = [(leaf, -(-n // bound.block), -(-crowd[leaf] // bound.block)) for leaf, n in sorted(index.sizes.items()) if leaf in crowd]
    # One row per leaf that is asked for, so never more than the tree has leaves.
    cuts = F.broadcast(spark.createDataFrame(cuts, "leaf long, p int, q_parts int"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    left = asked.join(cuts, "leaf").select("leaf", every("p").alias("i"), own("query_id", "q_parts").alias("j"), "query_id", "q")
    right = index.rows.join(cuts, "leaf").select("leaf", own("vec_id", "p").alias("i"), every("q_parts").alias("j"), "vec_id", "v")

    def compare(asking: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
        if not len(asking) or not len(stored):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        ids, vectors = stored["vec_id"].to_numpy(np.int64), _matrix(stored["v"])
        out = []
        for at in range(0, len(asking), 256):
            part = asking.iloc[at : at + 256]
            out.append(nearest_in(part["query_id"].to_numpy(np.int64), _matrix(part["q"]), ids, vectors, k))
        return pd.concat(out)

    keys = ["leaf", "i", "j"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compare, MATCH)
    return best_matches(found, k)


def nearest_neighbours(table: DataFrame, every: int = 100, k: int = 10, recall: float = 0.95, bound: Bound = Bound()) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` nearest found for rows whose vec_id is divisible by ``every``.

    What takes part is said in ``usable_vectors``. Candidates are all rows with another vec_id; a repeated row is
    a candidate each time. Of several vectors with one id the smallest asks. Fewer candidates than ``k`` give fewer rows, an empty table none.
    Extra columns are ignored.
    """
    rows = materialise(usable_vectors(table), "vectors")
    index = build_index(rows, bound)
    if index is None:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    queries = materialise(rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v")), "vector-queries")
    visits, _ = calibrated_visits(index, queries, k, recall, bound)
    return search(index, queries, k, visits, bound)
