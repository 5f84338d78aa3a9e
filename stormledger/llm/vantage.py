"""Centroid clustering with a vantage-point tree over the centroids.

Vectors become integers, floor(scale * x). Each round builds a tree over the
centroids, broadcasts it, and gives every vector the nearest centroid by
best-first branch and bound: a node's vantage point splits the centroids below it
into near and far ones, each with the least and greatest distance from it, and
the triangle inequality bounds how near a child's centroids can be. A child is left
out only if that bound is beyond the best distance found; at equality it is
visited, so that ties go to the smaller number. Distances that decide are squared
integers; bounds are doubles with a margin for their rounding.

Sums and counts of each cluster are taken in the tasks first: a task sends one
row for each centroid, however many vectors it saw. The driver holds the centroids
and these totals, `k` rows; it reads the vectors `rounds + 2` times and keeps none.

Defined cases: vectors that are null, of another length than `size`, or with null
or non-finite components are left out, and those with a component beyond 2**26
after scaling too, as their distances need not fit a long; rows without an id are clustered, but
come last among the vectors that start a centroid; among repeated ids the smaller
vector starts first; repeated rows count each; fewer vectors than `k` start as many
centroids; an empty table gives an empty result; other columns stay out; a sum of
distances beyond a long is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormledger import session

#: Largest component after scaling.
LIMIT = 1 << 26
#: Vectors that are searched together.
BATCH = 4096


def integers(column: pa.Array, scale: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the usable vectors of a list column, and their scaled components."""
    whole = pc.fill_null(pc.equal(pc.list_value_length(column), size), False)
    places = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
    values = column.filter(whole).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    with np.errstate(invalid="ignore", over="ignore"):
        values = np.floor(values * scale)
        usable = (np.abs(values) <= LIMIT).all(axis=1)  # NaN and infinity are not
    return places[usable], values[usable].astype(np.int64)


class VantageTree:
    """A vantage-point tree over numbered integer points."""

    def __init__(self, points: np.ndarray, leaf: int = 4):
        self.points, self.leaf = points, leaf
        #: Per node: its points in ascending number (one vantage point, or those of a leaf), and children.
        self.members: list[np.ndarray] = []
        #: (node, least distance, greatest distance from the vantage point) of each child.
        self.children: list[list[tuple[int, float, float]]] = []
        self._grow(np.arange(len(points)))

    def _grow(self, numbers: np.ndarray) -> int:
        node = len(self.members)
        self.children.append([])
        if len(numbers) <= self.leaf:
            self.members.append(numbers)
            return node
        # the point farthest from the middle sees the others at the most different distances
        own = self.points[numbers].astype(np.float64)
        at = int(((own - own.mean(axis=0)) ** 2).sum(axis=1).argmax())
        rest = np.delete(numbers, at)
        self.members.append(numbers[at:at + 1])
        far = np.sqrt(squared(self.points[rest], self.points[numbers[at]]).astype(np.float64))
        order = np.argsort(far, kind="stable")
        for part in filter(len, (order[:len(order) // 2], order[len(order) // 2:])):
            child = self._grow(np.sort(rest[part]))
            self.children[node].append((child, float(far[part].min()), float(far[part].max())))
        return node

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of each vector's nearest point, the smaller on ties, and the squared distance."""
        number, best = np.empty(len(vectors), dtype=np.int64), np.empty(len(vectors), dtype=np.int64)
        for a in range(0, len(vectors), BATCH):
            number[a:a + BATCH], best[a:a + BATCH] = self._search(vectors[a:a + BATCH])
        return number, best

    def _search(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(vectors)
        every = np.arange(n)
        number = np.full(n, len(self.points), dtype=np.int64)
        best = np.full(n, np.iinfo(np.int64).max, dtype=np.int64)
        # each vector's own queue: the bound of every node it may still visit
        queue = np.full((n, len(self.members)), np.inf)
        queue[:, 0] = 0.0
        while True:
            node = queue.argmin(axis=1)
            bound = queue[every, node]
            open_ = np.flatnonzero(bound <= np.sqrt(best.astype(np.float64)))
            if not len(open_):
                return number, best
            for k in np.unique(node[open_]).tolist():
                rows = open_[node[open_] == k]
                queue[rows, k] = np.inf
                members = self.members[k]
                far = np.stack([squared(vectors[rows], self.points[m]) for m in members], axis=1)
                place = far.argmin(axis=1)
                found, which = far[np.arange(len(rows)), place], members[place]
                better = (found < best[rows]) | ((found == best[rows]) & (which < number[rows]))
                best[rows[better]], number[rows[better]] = found[better], which[better]
                if self.children[k]:
                    seen = np.sqrt(far[:, 0].astype(np.float64))
                    for child, low, high in self.children[k]:
                        margin = 1e-9 * (seen + high)
                        queue[rows, child] = np.maximum(bound[rows], np.maximum(seen - high, low - seen) - margin)


def squared(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distance of each row from a point."""
    away = rows - point
    return np.einsum("ij,ij->i", away, away)


def first_centroids(rows: DataFrame, k: int, size: int, scale: int, salt: str) -> np.ndarray:
    """The k usable vectors of the smallest hashes of their ids."""
    v = F.col("v")
    usable = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")) & (F.abs(F.floor(x * scale).cast("double")) <= LIMIT))
    order = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256)
    kept = rows.filter(F.size(v) == size).filter(F.coalesce(usable, F.lit(False)))
    found = kept.orderBy(order.asc_nulls_last(), "v").limit(k).collect()
    return np.floor(np.array([r["v"] for r in found], dtype=np.float64).reshape(-1, size) * scale).astype(np.int64)


def _summed(tree: Broadcast, size: int, scale: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums and counts of the clusters in a task."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(tree.value.points)
        sums, counts = np.zeros((k, size), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in batches:
            _, vectors = integers(batch.column("v"), scale, size)
            number, _ = tree.value.nearest(vectors)
            np.add.at(sums, number, vectors)
            counts += np.bincount(number, minlength=k)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(counts[some]), pa.array(list(sums[some]), pa.list_(pa.int64()))], ["cluster", "n", "sums"])

    return work


def _assigned(tree: Broadcast, size: int, scale: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, vectors = integers(batch.column("v"), scale, size)
            number, best = tree.value.nearest(vectors)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(places)), pa.array(number.astype(np.int32)), pa.array(best)], ["id", "cluster", "distance"])

    return work


def cluster(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 40, rounds: int = 5, size: int = 64, scale: int = 256, salt: str = "2",
) -> DataFrame:
    """Cluster, squared distance, inertia and centroid digest of every usable vector."""
    spark = vectors.sparkSession
    rows = vectors.select(vectors[key].cast("long").alias("id"), vectors[vector].cast("array<double>").alias("v"))
    centroids = first_centroids(rows, k, size, scale, salt)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        tree = spark.sparkContext.broadcast(VantageTree(centroids))
        parts = rows.mapInArrow(_summed(tree, size, scale), "cluster int, n long, sums array<long>")
        # k * size rows reach the driver
        totals = parts.select("cluster", "n", F.posexplode("sums")).groupBy("cluster", "pos").agg(F.sum("col").alias("total"), F.sum("n").alias("n")).collect()
        for r in totals:
            centroids[r["cluster"], r["pos"]] = r["total"] // r["n"]
        tree.destroy()
    tree = spark.sparkContext.broadcast(VantageTree(centroids))
    found = session.materialize(rows.mapInArrow(_assigned(tree, size, scale), "id long, cluster int, distance long"), "clusters")
    tree.destroy()
    inertia = {r["cluster"]: int(r["total"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    whole, greatest = sum(inertia.values()), (1 << 63) - 1
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    known = spark.createDataFrame(
        [(c, total if total <= greatest else None, whole if whole <= greatest else None, digests[c]) for c, total in inertia.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # k rows: a bounded broadcast
    return found.join(F.broadcast(known), "cluster").select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
