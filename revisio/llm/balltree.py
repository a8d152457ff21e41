"""Lloyd's centroid clustering of integer vectors with ball-tree filtering.

Vectors become integers floor(scale * x). Each partition cuts its vectors into metric trees,
written once and read in every round. A node is a ball: pivot, radius, count and the exact
integer sum of its vectors. A round sends the centroids (a bounded table) to the trees. By the
triangle inequality a centroid that is further from the pivot than the best one by more than two
radii can be nearest to no vector of the ball, so that it is dropped for the whole subtree; a
ball with one centroid left gives its count and sum away whole. Other balls pass what is left to
their two halves, and at a leaf the exact integer distances decide. Balls compare floating
distances with a margin, so that rounding never decides: what is close descends.

A round returns a row for each centroid and task: counts and sums meet in a grouped aggregate,
and the new centroids, at most `k` rows, reach the driver.

Defined results. Vectors that are null, of another length than `dim`, or that hold a null or
non-finite component take no part. Vectors with a null id are clustered, but are never among the
starting centroids. Repeated rows are vectors each; ids that share a hash start in the order of
their vectors. Fewer vectors than k: as many centroids. No vector: no row. Equal distances: the
smaller centroid. A scaled component of 2**27 or more stops the query, since squared distances
would no longer fit 64 bits. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revisio.plans.lineage import Scratch

SCALE, DIM, K, ROUNDS, TREE_ROWS, LEAF_ROWS, LIMIT = 256, 64, 40, 5, 8_192, 24, 1 << 27
_TREES = "ids binary, known binary, vectors binary, starts binary, ends binary, pivots binary, radii binary, sums binary"
_SUMS = "cluster int, n bigint, total array<bigint>"
_ASSIGNED = "vec_id bigint, cluster int, distance bigint"


@dataclass
class Tree:
    """Vectors in leaf order, and balls over runs of them; ball k has its halves at 2k + 1 and 2k + 2."""

    ids: np.ndarray
    known: np.ndarray
    vectors: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    pivots: np.ndarray
    radii: np.ndarray
    sums: np.ndarray

    @classmethod
    def build(cls, ids: np.ndarray, known: np.ndarray, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS) -> Tree:
        """Halve runs by their distances to two far vectors until they have leaf_rows at most."""
        n, depth = len(vectors), 0
        while n >> depth > leaf_rows:
            depth += 1
        order, inner, balls = np.arange(n), (1 << depth) - 1, (2 << depth) - 1
        starts, ends = np.zeros(balls, np.int64), np.zeros(balls, np.int64)
        ends[0] = n
        for k in range(inner):
            at, to = starts[k], ends[k]
            run = order[at:to]
            some = vectors[run].astype(np.float64)
            one = some[np.argmax(((some - some.mean(0)) ** 2).sum(1))]
            two = some[np.argmax(((some - one) ** 2).sum(1))]
            order[at:to] = run[np.argsort(some @ (two - one), kind="stable")]
            middle = (at + to) // 2
            starts[2 * k + 1 : 2 * k + 3], ends[2 * k + 1 : 2 * k + 3] = (at, middle), (middle, to)
        vectors = vectors[order]
        before = np.concatenate([np.zeros((1, vectors.shape[1]), np.int64), np.cumsum(vectors, axis=0, dtype=np.int64)])
        sums = before[ends] - before[starts]
        pivots = sums / np.maximum(ends - starts, 1)[:, None]
        radii = np.array([np.sqrt(((vectors[a:b] - p) ** 2).sum(1).max()) if b > a else 0.0 for a, b, p in zip(starts, ends, pivots, strict=True)])
        return cls(ids[order], known[order], vectors, starts, ends, pivots, radii, sums)

    def rows(self) -> dict[str, bytes]:
        return {name: np.ascontiguousarray(value).tobytes() for name, value in vars(self).items()}

    @classmethod
    def of(cls, row: dict[str, bytes], dim: int) -> Tree:
        read = lambda name, kind, *shape: np.frombuffer(row[name], kind).reshape(-1, *shape)
        return cls(read("ids", np.int64), read("known", np.bool_), read("vectors", np.int32, dim), read("starts", np.int64), read("ends", np.int64), read("pivots", np.float64, dim), read("radii", np.float64), read("sums", np.int64, dim))

    def filtered(self, centroids: np.ndarray) -> tuple[list[tuple[int, int]], list[tuple[int, np.ndarray]]]:
        """(ball, centroid) of the balls that are given away whole, and (leaf, centroids left) of the others."""
        whole, open_ = [], []
        real = centroids.astype(np.float64)
        todo = [(0, np.arange(len(centroids)))]
        first_leaf = len(self.starts) // 2
        while todo:
            ball, left = todo.pop()
            if self.starts[ball] == self.ends[ball]:
                continue
            far = np.sqrt(((real[left] - self.pivots[ball]) ** 2).sum(1))
            reach = far.min() + 2 * self.radii[ball]
            left = left[far <= reach * (1 + 1e-9) + 1e-6]
            if len(left) == 1:
                whole.append((ball, int(left[0])))
            elif ball >= first_leaf:
                open_.append((ball, left))
            else:
                todo += [(2 * ball + 1, left), (2 * ball + 2, left)]
        return whole, open_

    def nearest(self, leaf: int, centroids: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The exact nearest of the centroids left, and its squared distance, for each vector of a leaf."""
        some = self.vectors[self.starts[leaf] : self.ends[leaf]].astype(np.int64)
        far = ((some[:, None, :] - centroids[left][None]) ** 2).sum(2)
        best = far.argmin(1)  # of equal ones the first, and `left` ascends
        return left[best], far[np.arange(len(some)), best]

    def totals(self, centroids: np.ndarray, n: np.ndarray, total: np.ndarray) -> None:
        """Add each cluster's count and integer sum."""
        whole, open_ = self.filtered(centroids)
        for ball, c in whole:
            n[c] += self.ends[ball] - self.starts[ball]
            total[c] += self.sums[ball]
        for leaf, left in open_:
            cluster, _ = self.nearest(leaf, centroids, left)
            np.add.at(n, cluster, 1)
            np.add.at(total, cluster, self.vectors[self.starts[leaf] : self.ends[leaf]].astype(np.int64))

    def assigned(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cluster and exact squared distance of each vector."""
        cluster, distance = np.empty(len(self.ids), np.int32), np.empty(len(self.ids), np.int64)
        whole, open_ = self.filtered(centroids)
        for ball, c in whole:
            run = slice(self.starts[ball], self.ends[ball])
            cluster[run], distance[run] = c, ((self.vectors[run].astype(np.int64) - centroids[c]) ** 2).sum(1)
        for leaf, left in open_:
            run = slice(self.starts[leaf], self.ends[leaf])
            cluster[run], distance[run] = self.nearest(leaf, centroids, left)
        return cluster, distance


def _usable(rows: DataFrame, id_col: str, vector_col: str, dim: int, scale: int) -> DataFrame:
    """(vec_id, vector): integer vectors of the rows that take part."""
    real = F.transform(vector_col, lambda x: x.cast("double"))
    fine = (F.size(vector_col) == dim) & F.forall(real, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    large = F.raise_error(F.lit("a scaled component is too large for exact distances")).cast("int")
    whole = F.transform(real, lambda x: F.when(F.abs(x * scale) < LIMIT, F.floor(x * scale).cast("int")).otherwise(large))
    return rows.where(F.coalesce(fine, F.lit(False))).select(F.col(id_col).cast("bigint").alias("vec_id"), whole.alias("vector"))


def _build(dim: int, tree_rows: int):
    def of(ids: list[pa.Array], vectors: list[np.ndarray]) -> pa.RecordBatch:
        names = pa.concat_arrays(ids)
        row = Tree.build(names.fill_null(0).to_numpy(zero_copy_only=False), names.is_valid().to_numpy(zero_copy_only=False), np.concatenate(vectors)).rows()
        return pa.RecordBatch.from_pylist([row])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[pa.Array] = []
        vectors: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for at in range(0, batch.num_rows, tree_rows):
                part = batch.slice(at, tree_rows)
                ids.append(part.column("vec_id"))
                vectors.append(part.column("vector").flatten().to_numpy().reshape(-1, dim).astype(np.int32))
                held += part.num_rows
                if held >= tree_rows:
                    yield of(ids, vectors)
                    ids, vectors, held = [], [], 0
        if held:
            yield of(ids, vectors)

    return build


def _trees(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[Tree]:
    for batch in batches:
        for row in batch.to_pylist():
            yield Tree.of(row, dim)


def _round(centroids: np.ndarray):
    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for tree in _trees(batches, centroids.shape[1]):
            tree.totals(centroids, n, total)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(n[some]), pa.array(list(total[some]), pa.list_(pa.int64()))], ["cluster", "n", "total"])

    return totals


def _final(centroids: np.ndarray):
    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree in _trees(batches, centroids.shape[1]):
            cluster, distance = tree.assigned(centroids)
            yield pa.RecordBatch.from_arrays([pa.array(tree.ids, mask=~tree.known), pa.array(cluster), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return assigned


def starting(vectors: DataFrame, k: int) -> np.ndarray:
    """The k vectors of the least hash of their id; k rows reach the driver."""
    key = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256)
    first = vectors.where("vec_id IS NOT NULL").select(key.alias("key"), "vector").orderBy("key", "vector").limit(k).collect()
    return np.array([r.vector for r in first], np.int64)


def moved(spark: SparkSession, trees: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The floor of each cluster's mean; a cluster without vectors stays."""
    parts = trees.mapInArrow(_round(centroids), _SUMS).select("cluster", "n", F.posexplode("total").alias("place", "part"))
    whole = parts.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum("part").alias("total")).collect()  # k * dim rows
    out = centroids.copy()
    for r in whole:
        out[r.cluster, r.place] = r.total // r.n
    return out


def cluster(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, tree_rows: int = TREE_ROWS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every vector that takes part, and the final centroids."""
    spark = rows.sparkSession
    scratch = Scratch(spark, "ball-trees")
    vectors = _usable(rows, id_col, vector_col, dim, scale)
    trees = scratch.cut(vectors.mapInArrow(_build(dim, tree_rows), _TREES), "trees", compression="zstd")
    centroids = starting(vectors, k)
    if not len(centroids):  # no id to start from
        return spark.createDataFrame([], _ASSIGNED), centroids
    for _ in range(rounds):
        centroids = moved(spark, trees, centroids)
    return scratch.cut(trees.mapInArrow(_final(centroids), _ASSIGNED), "assigned"), centroids


def digests(rows: DataFrame, **options: int) -> DataFrame:
    """Each vector's cluster and distance, the inertia of its cluster and of all, and its centroid's digest."""
    spark = rows.sparkSession
    assigned, centroids = cluster(rows, **options)
    names = [(c, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for c, row in enumerate(centroids.tolist())]
    named = spark.createDataFrame(names, "cluster int, centroid_sha256 string")
    per = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).join(named, "cluster")
    whole = per.agg(F.sum("cluster_inertia").alias("inertia"))
    facts = per.crossJoin(F.broadcast(whole))  # one row beside k rows
    return assigned.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
