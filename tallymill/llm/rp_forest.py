"""Approximate nearest neighbours with a forest of random-projection trees.

Trees are fitted on a bounded sample: a node splits its part of the sample at the median of a projection on
the difference of two random members.  Every vector is then sent to its leaf in each tree.  A query visits
leaves of all trees through one shared priority queue, the ones first whose hyperplanes lie least far (by the sum of squares)
between them and the query.  The visited leaves' members are ranked by their exact distance.

How many comparisons a query gets is learned from the sample: the fewest that find ``TARGET`` of the true neighbours
of some of its points, at its whole size and at a quarter of it.  Where the share of points falls from the smaller to the larger, as in data with
clusters, it is taken to fall on at nearly the same rate; where it does not, as in evenly spread vectors of many dimensions,
no index can leave out much.  A leaf that has more members than its share of the comparisons is split on
within the task, by a tree fitted on the members there, and the query visits its nearest parts only.

Equal vectors are one point, so a vector that is very frequent is looked at once.  Branches with very many members or
queries are cut into blocks of bounded size on both sides.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymill.llm.common import named, stored

# Points the trees are fitted on, at most: those with the smallest hash.
SAMPLE = 16_384
TREES = 12
# Members a leaf is to have, and the fewest of the sample in one.
LEAF = 24
LEAST_LEAF = 6
# Share of the true neighbours of the sample's points that is to be found, of how many points it is measured, how much
# more than was needed there is spent, and how much of the fall from a quarter of the sample to the whole is trusted beyond it.
TARGET, MEASURED, MARGIN, TRUSTED = 0.95, 48, 1.2, 0.9
# Neighbouring leaves of a tree, a branch, that are brought to a task together: a query comes once for all of them.
TOGETHER = 256
# Members, and queries, of a branch that one task compares at most.
BLOCK, QUERY_BLOCK = 20_000, 2_000
SEED = 7


@dataclass(frozen=True)
class Forest:
    """Full binary trees of one depth: node k has the children 2k+1 and 2k+2; (tree, node, dimension)."""

    normals: np.ndarray
    offsets: np.ndarray
    depth: int

    @classmethod
    def fit(cls, sample: np.ndarray, depth: int, trees: int = TREES, seed: int = SEED) -> "Forest":
        random = np.random.default_rng(seed)
        nodes, dims = 2**depth - 1, sample.shape[1]
        normals, offsets = np.zeros((trees, nodes, dims)), np.zeros((trees, nodes))
        for tree in range(trees):
            members = {0: np.arange(len(sample))}
            for node in range(nodes):
                own = members.pop(node)
                normal = np.zeros(dims)
                for _ in range(5):  # members that differ
                    if len(own) > 1 and not normal.any():
                        one, two = random.choice(own, 2, replace=False)
                        normal = sample[one] - sample[two]
                if not normal.any():
                    normal = random.standard_normal(dims)
                normal = normal / np.linalg.norm(normal)
                along = sample[own] @ normal
                offset = np.median(along) if len(own) else 0.0
                normals[tree, node], offsets[tree, node] = normal, offset
                members[2 * node + 1], members[2 * node + 2] = own[along < offset], own[along >= offset]
        return cls(normals.astype(np.float32), offsets.astype(np.float32), depth)

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree: (vector, tree)."""
        found = np.zeros((len(vectors), len(self.normals)), np.int64)
        vectors = vectors.astype(np.float32)
        for tree, (normals, offsets) in enumerate(zip(self.normals, self.offsets)):
            node = np.zeros(len(vectors), np.int64)
            for _ in range(self.depth):
                right = np.einsum("ij,ij->i", vectors, normals[node]) >= offsets[node]
                node = 2 * node + 1 + right
            found[:, tree] = node - len(normals)
        return found

    def visits(self, query: np.ndarray) -> Iterator[tuple[int, int]]:
        """(tree, leaf) of all leaves, nearest to the query first."""
        margins = (self.normals @ query.astype(np.float32) - self.offsets).tolist()
        first = len(margins[0])
        queue = [(0.0, tree, 0) for tree in range(len(margins))]
        while queue:
            beyond, tree, node = heapq.heappop(queue)
            while node < first:
                margin = margins[tree][node]
                near, far = (2 * node + 2, 2 * node + 1) if margin >= 0 else (2 * node + 1, 2 * node + 2)
                heapq.heappush(queue, (beyond + margin * margin, tree, far))
                node = near
            yield tree, node - first


def _depth(n: int, sample: int) -> int:
    return max(0, int(np.log2(max(1.0, min(n / LEAF, sample / LEAST_LEAF)))))


def _members(leaves: np.ndarray, depth: int) -> list[list[np.ndarray]]:
    """For each tree the members of each leaf, from each point's leaves."""
    out = []
    for own in leaves.T:
        order = np.argsort(own, kind="stable")
        out.append(np.split(order, np.searchsorted(own[order], np.arange(1, 2**depth))))
    return out


def needed_share(points: np.ndarray, k: int, trees: int = TREES) -> float:
    """Comparisons for each point, as a share of all points, by which ``TARGET`` of the ``k`` nearest of some points are found."""
    n = len(points)
    if n <= k + 1:
        return 1.0
    forest = Forest.fit(points, _depth(n, n * LEAST_LEAF), trees)
    members = _members(forest.leaves(points), forest.depth)
    chosen = np.random.default_rng(SEED).choice(n, min(n, MEASURED), replace=False)
    costs = []
    for q in chosen:
        away = ((points - points[q]) ** 2).sum(axis=1)
        away[q] = np.inf
        wanted = set(np.argpartition(away, k - 1)[:k].tolist())
        compared = 0
        for tree, leaf in forest.visits(points[q]):
            own = members[tree][leaf]
            compared += len(own)
            found = wanted.intersection(own.tolist())
            costs += [compared] * len(found)
            wanted -= found
            if not wanted:
                break
    return float(np.quantile(costs, TARGET, method="higher")) / n


@dataclass(frozen=True)
class Search:
    """A forest, the leaves that a query visits, and the part of a leaf's members that it is compared with."""

    forest: Forest
    visits: int
    part: float

    @classmethod
    def plan(cls, sample: np.ndarray, n: int, k: int, trees: int = TREES, visits: int | None = None) -> "Search":
        """For ``n`` points of which ``sample`` are some, in any order."""
        depth = _depth(n, len(sample))
        forest = Forest.fit(sample, depth, trees)
        if visits is not None:
            return cls(forest, visits, 1.0)
        share = needed_share(sample, k, trees)
        if n > len(sample):
            before = needed_share(sample[: len(sample) // 4], k, trees)
            falls = TRUSTED * min(1.0, max(0.0, np.log(before / share) / np.log(4)))
            share *= (len(sample) / n) ** falls
        wanted = MARGIN * share * 2**depth  # in leaves, of which each tree has so many
        visits = max(trees, int(np.ceil(wanted)))
        return cls(forest, min(visits, trees * 2**depth), min(1.0, wanted / visits))

    def visited(self, query: np.ndarray) -> list[tuple[int, int]]:
        return [way for way, _ in zip(self.forest.visits(query), range(self.visits))]

    def rows(self, held: np.ndarray) -> "Rows":
        return Rows(held, self.part)


class Rows:
    """The members of a leaf in a task, split on if a query is to be compared with a part of them only."""

    def __init__(self, held: np.ndarray, part: float) -> None:
        self.held, self.forest = held, None
        depth = _depth(len(held), len(held) * LEAST_LEAF)
        # At least two leaves' worth is looked at.
        self.most = int(np.ceil(part * 2**depth)) + 1
        if self.most < 2**depth:
            self.forest = Forest.fit(held, depth, 1)
            self.members = _members(self.forest.leaves(held), depth)[0]

    def near(self, query: np.ndarray) -> np.ndarray:
        """Numbers of the members that the query is compared with."""
        if self.forest is None:
            return np.arange(len(self.held))
        return np.concatenate([self.members[leaf] for (_, leaf), _ in zip(self.forest.visits(query), range(self.most))])


def _matrix(column: pa.ChunkedArray | pa.Array, kind: str, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dims).astype(np.float64)


def _packer(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [np.array(v, kind).tobytes() for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.binary()), batch.column(2)], names=["p", "v", "first"])
    return run


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id``, ``vector`` (doubles) of the rows that take part.

    Left out are null ids, and vectors that are null, empty or zero, hold null or non-finite components, or
    have another dimension than most vectors (of equally frequent ones the smallest).
    """
    vector = named(vector_col).cast("array<double>")
    taken = rows.select(named(id_col).cast("long").alias("vec_id"), vector.alias("vector")).where(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0))
    sizes = taken.groupBy(F.size("vector").alias("dims")).count().orderBy(F.desc("count"), "dims").limit(1).collect()
    return taken.where(F.size("vector") == (sizes[0]["dims"] if sizes else 0))


def nearest(rows: DataFrame, queries: DataFrame, k: int = 10, id_col="vec_id", vector_col="embedding",
            trees: int = TREES, visits: int | None = None) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the ``k`` nearest found of ``rows`` for each row of ``queries``.

    Nearness is Euclidean distance in doubles, ties go to the smaller id; rows of the query's own id do not
    count.  ``queries`` has the columns of ``rows``; which vectors take part says :func:`usable`.  Repeated rows are
    one candidate and one query.
    """
    spark = rows.sparkSession
    taken, asked = usable(rows, id_col, vector_col), usable(queries, id_col, vector_col).distinct()
    # Floats are moved as such; distances are doubles of the same numbers.
    kind = "<f4" if rows.select(named(vector_col)).dtypes[0][1] == "array<float>" else "<f8"
    # k + 1 ids of equal vectors are enough: one of them may be the query's own.
    ranked = taken.withColumn("place", F.dense_rank().over(Window.partitionBy("vector").orderBy("vec_id"))).where(F.col("place") <= k + 1)
    points = stored(ranked.groupBy("vector").agg(F.sort_array(F.collect_set("vec_id")).alias("ids")).withColumn("p", F.monotonically_increasing_id()), "points")
    n = points.count()
    dims = points.select(F.size("vector")).limit(1).collect()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims = dims[0][0]
    packed = points.select("p", "vector", F.element_at("ids", 1).alias("first")).mapInArrow(_packer(kind), "p long, v binary, first long")
    sample = packed.select("v").orderBy(F.xxhash64("v"), "v").limit(SAMPLE).toArrow().column(0)
    # Its size is bounded by the sample: trees * sample / LEAST_LEAF hyperplanes.
    search = spark.sparkContext.broadcast(Search.plan(_matrix(sample, kind, dims), n, k, trees, visits))
    by_query = stored(_points_of(asked, points), "asked")
    starts = by_query.groupBy("q").agg(F.first("vector").alias("vector")).select("q", "vector", F.col("q").alias("first")).mapInArrow(_packer(kind), "p long, v binary, first long")

    def ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                branches: dict[tuple[int, int], list[int]] = {}
                for tree, leaf in search.value.visited(np.frombuffer(v, kind)):
                    branches.setdefault((tree, leaf // TOGETHER), []).append(leaf)
                n = len(branches)
                yield pa.RecordBatch.from_arrays([
                    *(pa.array([w[i] for w in branches], pa.int32()) for i in range(2)), pa.array(list(branches.values()), pa.list_(pa.int32())),
                    pa.array([q] * n, pa.int64()), pa.array([v] * n, pa.binary()),
                ], names=["tree", "branch", "leaves", "q", "qv"])

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaves = search.value.forest.leaves(_matrix(batch.column(1), kind, dims))
                for tree in range(leaves.shape[1]):
                    own = leaves[:, tree]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(batch.num_rows, tree), pa.int32()), pa.array(own // TOGETHER, pa.int32()), pa.array(own, pa.int32()), *batch.columns,
                    ], names=["tree", "branch", "leaf", "p", "v", "first"])

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        """Exact distances of the visited leaves' members in a block to its queries; the k + 1 nearest points of each."""
        out: list[tuple[np.ndarray, ...]] = []
        if left.num_rows and right.num_rows:
            member, first, leaf = (np.array(right.column(c)) for c in ("p", "first", "leaf"))
            held = _matrix(right.column("v"), kind, dims)
            of_leaf = {k: np.flatnonzero(leaf == k) for k in np.unique(leaf).tolist()}
            rows = {k: search.value.rows(held[own]) for k, own in of_leaf.items()}
            for q, leaves, query in zip(left.column("q").to_pylist(), left.column("leaves").to_pylist(), _matrix(left.column("qv"), kind, dims)):
                found = [of_leaf[k][rows[k].near(query)] for k in leaves if k in rows]
                if found:
                    near = np.concatenate(found)
                    away = np.sqrt(((held[near] - query) ** 2).sum(axis=1))
                    best = np.lexsort((first[near], away))[:k_nearest]
                    out.append((np.full(len(best), q), member[near[best]], away[best]))
        columns = [np.concatenate([x[i] for x in out]) if out else np.zeros(0) for i in range(3)]
        return pa.table({"q": pa.array(columns[0], pa.int64()), "p": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.float64())})

    k_nearest = k + 1  # one of them may be the query's own
    keys = ["tree", "branch", "block", "query_block"]
    visited = starts.mapInArrow(ways, "tree int, branch int, leaves array<int>, q long, qv binary")
    index = packed.mapInArrow(places, "tree int, branch int, leaf int, p long, v binary, first long")
    # Branches are as many as the sample allows, so this has a bounded size; most need one block on either side.
    crowds = index.groupBy("tree", "branch").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    askers = visited.groupBy("tree", "branch").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).alias("query_blocks"))
    cuts = F.broadcast(stored(crowds.join(askers, ["tree", "branch"]), "cuts"))

    def every(count: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))
    dealt_queries = visited.join(cuts, ["tree", "branch"]).withColumn("query_block", F.pmod(F.xxhash64("q"), "query_blocks")).withColumn("block", every("blocks"))
    dealt_index = index.join(cuts, ["tree", "branch"]).withColumn("block", F.pmod(F.xxhash64("p"), "blocks")).withColumn("query_block", every("query_blocks"))
    found = dealt_queries.select(*keys, "leaves", "q", "qv").groupBy(*keys).cogroup(dealt_index.select(*keys, "leaf", "p", "v", "first").groupBy(*keys)).applyInArrow(compare, "q long, p long, score double")
    found = found.groupBy("q", "p").agg(F.min("score").alias("score"))
    named_ids = found.join(points.select("p", "ids"), "p").withColumn("first", F.element_at("ids", 1))
    near = named_ids.withColumn("place", F.row_number().over(Window.partitionBy("q").orderBy("score", "first"))).where(F.col("place") <= k + 1)
    near = near.select("q", "score", F.explode("ids").alias("vec_id"))
    own = Window.partitionBy("q").orderBy("score", "vec_id")
    near = near.withColumn("place", F.row_number().over(own)).where(F.col("place") <= k + 1).drop("place")
    answers = by_query.select(F.col("vec_id").alias("query_id"), "q").join(near, "q").where(F.col("query_id") != F.col("vec_id"))
    answers = answers.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return answers.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _points_of(asked: DataFrame, points: DataFrame) -> DataFrame:
    """``vec_id``, ``vector``, ``q``: a query's vector is a point of the rows or one of its own."""
    own = asked.join(points.select("vector", F.col("p").alias("q")), "vector", "left")
    return own.select("vec_id", "vector", F.coalesce("q", -1 - F.abs(F.xxhash64("vector") % (2**62))).alias("q"))
