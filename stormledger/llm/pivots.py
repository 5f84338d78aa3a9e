"""Exact largest inner products through a pivot-distance index.

Vectors become integers, floor(scale * x). With one more component, the root of
what a vector's squared length lacks of the largest one, all candidates lie on one sphere, and
the largest inner products with a query (whose own further component is 0) are its nearest
neighbours: distance ** 2 = query ** 2 + largest ** 2 - 2 * product.

Each vector is keyed by its nearest pivot and its distance from it; the distances of a
pivot are cut into rings, so that a ring is an annulus with a least and a greatest
distance. A query knows its distance from each pivot, hence how near a
ring's vectors can be by the triangle inequality. It visits rings by ascending bound,
each round `growth` times as many rows as before, and stops when the bounds of all rings
left are beyond its k-th best; at equality they are visited, for ties. Inside a ring the vectors
are in order of distance, in blocks with bounds of their own. Products are exact integers.

A ring is divided by a hash into parts of about `PART` vectors, and queries into as
many groups as they need; a part of a ring with a group of queries is one unit
of work, so that a hot ring, or a vector that a third of all rows share, is many
units. Pivots and the cuts between rings come from a sample of about `SAMPLE`
ids; their number follows the table's size up to `CELLS` rings in all, and only the bounds
and sizes of rings reach the driver.

Defined cases: vectors that are null or hold null or non-finite components take
no part, and those with a component beyond 2**26 after scaling neither, as their products
need not fit a long; rows without an id take no part; components that the shorter of two vectors lacks count as 0, so that an empty
vector has product 0 with all; equal rows are one; rows of one id with different
vectors are candidates each, and the smallest of them, component by component, asks; rows of
the query's id are no candidates; fewer candidates than `k` give fewer rows; an empty table
gives an empty result; other columns stay out.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stormledger import session

#: Largest component after scaling.
LIMIT = 1 << 26
#: Ids that place pivots and rings.
SAMPLE = 2048
#: Vectors of a ring, at least, and of a part of one, about; queries of a group, about.
RING, PART, GROUP = 4096, 32768, 16384
#: Rings of all pivots, at most.
CELLS = 4096
#: Vectors of a block, and queries that are compared with it together.
BLOCK, QUERIES = 1024, 512
RESULT = "query_id long, rank int, vec_id long, score long"


@dataclasses.dataclass
class Shape:
    """Pivots (with their further component), cuts between each one's rings, and what scales the sphere."""

    pivots: np.ndarray
    cuts: np.ndarray
    size: int
    largest: int

    def lifted(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        """Vectors with their further component."""
        rest = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(self.largest - (vectors * vectors).sum(axis=1), 0).astype(np.float64))
        return np.concatenate((vectors.astype(np.float64), rest[:, None]), axis=1)

    def distances(self, lifted: np.ndarray) -> np.ndarray:
        """Distance of each row from each pivot."""
        return np.stack([np.sqrt(((lifted - p) ** 2).sum(axis=1)) for p in self.pivots], axis=1)

    def keys(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pivot, ring and distance of each vector."""
        far = self.distances(self.lifted(vectors))
        pivot = far.argmin(axis=1)
        own = far[np.arange(len(far)), pivot]
        return pivot, (own[:, None] > self.cuts[pivot]).sum(axis=1), own


@dataclasses.dataclass
class Rings:
    """Pivot, ring, least and greatest distance, vectors and parts of each ring that has any."""

    pivot: np.ndarray
    ring: np.ndarray
    low: np.ndarray
    high: np.ndarray
    rows: np.ndarray
    parts: np.ndarray


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """Integer vectors of a list column, with zeros to the full size."""
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), size), dtype=np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def distinct(ids: np.ndarray, content: Callable[[int], bytes]) -> np.ndarray:
    """True at the first of equal rows; only repeated ids are looked at."""
    names, times = np.unique(ids, return_counts=True)
    out = np.ones(len(ids), dtype=bool)
    seen: set = set()
    for at in np.flatnonzero(np.isin(ids, names[times > 1])).tolist():
        mark = (ids[at], content(at))
        out[at] = mark not in seen
        seen.add(mark)
    return out


def scaled(vectors: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """Usable vectors as integers, with their squared length; equal rows of a batch are one."""
    rows = vectors.select(vectors[key].cast("long").alias("id"), vectors[vector].cast("array<double>").alias("v"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("v")
            sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(sizes)), sizes)
            with np.errstate(invalid="ignore", over="ignore"):
                values = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
                wrong = ~(np.abs(values) <= LIMIT)
            usable = column.is_valid().to_numpy(zero_copy_only=False) & (np.bincount(row[wrong], minlength=len(sizes)) == 0)
            values = values[usable[row]].astype(np.int64)
            ids, kept = batch.column("id").to_numpy()[usable], sizes[usable]
            ends = np.concatenate(([0], np.cumsum(kept)))
            norms = np.concatenate(([0], np.cumsum(values * values)))
            first = distinct(ids, lambda i, ends=ends, values=values: values[ends[i]:ends[i + 1]].tobytes())
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values.astype(np.int32)))
            out = pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), lists, pa.array(norms[ends[1:]] - norms[ends[:-1]]), pa.array(kept.astype(np.int32))], ["id", "v", "norm", "size"])
            yield out.filter(pa.array(first))

    return rows.filter(F.col("id").isNotNull()).mapInArrow(work, "id long, v array<int>, norm long, size int")


def shape(known: DataFrame, n: int, size: int, largest: int) -> Shape:
    """Pivots and cuts from a sample: means of a few rounds, and quantiles of distance."""
    span = 1 << 40
    chosen = F.pmod(F.xxhash64("id"), F.lit(span)) < F.lit(max(1, min(span, span * SAMPLE // n)))
    sample = known.filter(chosen).dropDuplicates(["id"]).select("id", "v").collect()
    sample.sort(key=lambda r: r["id"])
    rows = np.zeros((max(1, len(sample)), size), dtype=np.int64)
    for at, r in enumerate(sample):
        rows[at, :len(r["v"])] = r["v"]
    cells = max(1, min(CELLS, n // RING))
    wanted = max(1, int(np.sqrt(cells)))
    out = Shape(np.zeros((0, size + 1)), np.zeros((0, 0)), size, largest)
    lifted = out.lifted(rows)
    draw = np.random.default_rng(13)
    out.pivots = lifted[draw.permutation(len(lifted))[:wanted]]
    for _ in range(5):
        own = out.distances(lifted).argmin(axis=1)
        out.pivots = np.stack([lifted[own == p].mean(axis=0) if (own == p).any() else out.pivots[p] for p in range(len(out.pivots))])
    far = out.distances(lifted)
    own, rings = far.argmin(axis=1), max(1, cells // len(out.pivots))
    places = np.arange(1, rings) / rings
    out.cuts = np.stack([np.quantile(far[own == p, p], places) if (own == p).any() else np.zeros(rings - 1) for p in range(len(out.pivots))])
    return out


def _keyed(shared: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(a, BLOCK) for a in range(0, batch.num_rows, BLOCK)):
                pivot, ring, far = shared.value.keys(matrix(part.column("v"), shared.value.size))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pivot.astype(np.int32)), pa.array(ring.astype(np.int32)), pa.array(far), part.column("id"), part.column("v")],
                    ["pivot", "ring", "far", "id", "v"])

    return work


def index(known: DataFrame, shared: Broadcast) -> DataFrame:
    """The stored index: every vector with its pivot, ring and distance."""
    return session.materialize(known.select("id", "v").mapInArrow(_keyed(shared), "pivot int, ring int, far double, id long, v array<int>"), "annuli")


def reach(shape: Shape, vectors: np.ndarray, floors: np.ndarray) -> np.ndarray:
    """Greatest distance at which a vector can still have a product of at least each query's floor; a margin covers rounding."""
    squares = (vectors * vectors).sum(axis=1).astype(np.float64) + float(shape.largest)
    # the margin is far above the rounding of squared distances, whose scale is `squares`
    return np.sqrt(np.maximum(squares - 2.0 * floors, 0.0) + 1e-9 * squares + 1e-9)


def bounds(rings: Rings, far: np.ndarray) -> np.ndarray:
    """Least distance of each query from the vectors of each ring."""
    own = far[:, rings.pivot]
    return np.maximum(np.maximum(own - rings.high, rings.low - own), 0.0)


def _visits(shared: Broadcast, every: int, quota: int, done: int, groups: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rings that each query visits in this round: its rows come after `done` and before `quota` others."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form, rings = shared.value
        for batch in batches:
            for part in (batch.slice(a, 128) for a in range(0, batch.num_rows, 128)):
                ids = part.column("id").to_numpy()
                vectors = matrix(part.column("v"), form.size)
                least = part.column("least").to_numpy(zero_copy_only=False).astype(np.float64)
                least = np.where(np.isnan(least), -np.inf, least)
                near = bounds(rings, form.distances(form.lifted(vectors, query=True)))
                order = np.argsort(near, axis=1, kind="stable")
                before = np.cumsum(rings.rows[order], axis=1) - rings.rows[order]
                wanted = (before >= done) & (before < quota) & (np.take_along_axis(near, order, axis=1) <= reach(form, vectors, least)[:, None])
                query, place = np.nonzero(wanted)
                cell = order[query, place]
                times = rings.parts[cell]
                query, cell = np.repeat(query, times), np.repeat(cell, times)
                piece = np.arange(len(cell)) - np.repeat(np.cumsum(times) - times, times)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rings.pivot[cell].astype(np.int32)), pa.array(rings.ring[cell].astype(np.int32)), pa.array(piece.astype(np.int32)),
                     pa.array((ids[query] // every % groups).astype(np.int32)), pa.array(ids[query]),
                     part.column("v").take(pa.array(query)), part.column("least").take(pa.array(query))],
                    ["pivot", "ring", "part", "team", "id", "v", "least"])

    return work


def _compare(shared: Broadcast, k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Best candidates of a group of queries in a part of a ring."""
    def work(asked: pa.Table, held: pa.Table) -> pa.Table:
        form, _ = shared.value
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if asked.num_rows and held.num_rows:
            held = held.sort_by([("far", "ascending"), ("id", "ascending")])
            rows, ids, far = matrix(held.column("v").combine_chunks(), form.size), held.column("id").to_numpy(), held.column("far").to_numpy()
            keep = distinct(ids, lambda i: rows[i].tobytes())
            rows, ids, far = rows[keep], ids[keep], far[keep]
            pivot = form.pivots[held.column("pivot")[0].as_py()]
            queries, names = matrix(asked.column("v").combine_chunks(), form.size), asked.column("id").to_numpy()
            least = asked.column("least").to_numpy().astype(np.float64)
            least = np.where(np.isnan(least), -np.inf, least)
            exact = float(np.abs(rows).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(1, form.size) < 2.0 ** 52
            own = np.sqrt(((form.lifted(queries, query=True) - pivot) ** 2).sum(axis=1))
            limit = reach(form, queries, least)
            if exact:  # products of doubles are exact below 2 ** 53
                rows, queries = rows.astype(np.float64), queries.astype(np.float64)
            for a in range(0, len(rows), BLOCK):
                block, some = rows[a:a + BLOCK], ids[a:a + BLOCK]
                low, high = far[a], far[min(a + BLOCK, len(far)) - 1]
                met = np.flatnonzero(np.maximum(own - high, low - own) <= limit)
                for b in range(0, len(met), QUERIES):
                    who = met[b:b + QUERIES]
                    out.append(_best(names[who], some, queries[who] @ block.T, least[who], k))
        query, found, score = (np.concatenate([x[i] for x in out]) if out else np.empty(0) for i in range(3))
        query, found, score = (x.astype(np.int64) for x in (query, found, score))
        keep = _ranked(query, found, score, k)
        return pa.table({"query_id": query[keep], "vec_id": found[keep], "score": score[keep]})

    return work


def _ranked(query: np.ndarray, found: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k best, ties to smaller ids."""
    order = np.lexsort((found, -score, query))
    sorted_ = query[order]
    first = np.searchsorted(sorted_, sorted_, "left")
    return order[np.arange(len(order)) - first < k]


def _best(names: np.ndarray, ids: np.ndarray, score: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, product) of the k best of a block that are not below the floor."""
    wide, own = score.shape[1], names[:, None] == ids
    score[own] = np.iinfo(np.int64).min  # the query's own rows come last
    cut = np.maximum(np.partition(score, wide - k, axis=1)[:, wide - k], least) if wide > k else least
    query, at = np.nonzero((score >= cut[:, None]) & ~own)
    chosen = _ranked(query, ids[at], score[query, at], k)
    return names[query[chosen]], ids[at[chosen]], score[query[chosen], at[chosen]]


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 20, every: int = 20, scale: int = 64, first: int = RING, growth: int = 8,
) -> DataFrame:
    """The k largest inner products of each row whose id is divisible by `every` with all other rows."""
    spark = vectors.sparkSession
    known = session.materialize(scaled(vectors, key, vector, scale), "scaled")
    total = known.agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("size"), F.max("norm").alias("largest")).first()
    if not total["n"]:
        return spark.createDataFrame([], RESULT)
    form = shape(known, total["n"], total["size"], total["largest"])
    placing = spark.sparkContext.broadcast(form)
    held = index(known, placing)
    placing.destroy()
    # at most CELLS rows reach the driver
    cells = held.groupBy("pivot", "ring").agg(F.min("far").alias("low"), F.max("far").alias("high"), F.count(F.lit(1)).alias("n")).collect()
    rings = Rings(*(np.array([r[c] for r in cells]) for c in ("pivot", "ring", "low", "high", "n")), np.array([-(-r["n"] // PART) for r in cells]))
    asked = session.materialize(known.filter(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v")), "asked")
    groups = max(1, -(-asked.count() // GROUP))
    parts = spark.createDataFrame([(int(p), int(r), int(n)) for p, r, n in zip(rings.pivot, rings.ring, rings.parts, strict=True)], "pivot int, ring int, parts int")
    held = (
        held.join(F.broadcast(parts), ["pivot", "ring"])
        .withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts").cast("long")).cast("int"))
        .withColumn("team", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        .select("pivot", "ring", "part", "team", "far", "id", "v")
    )
    shared = spark.sparkContext.broadcast((form, rings))
    unit, visit = ["pivot", "ring", "part", "team"], "pivot int, ring int, part int, team int, id long, v array<int>, least long"
    best, done, quota = None, 0, first
    while done < total["n"]:
        least = best.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("least")) if best is not None else None
        state = asked.join(least, "id", "left") if least is not None else asked.withColumn("least", F.lit(None).cast("long"))
        last = quota if quota < total["n"] else total["n"]
        visits = session.materialize(state.mapInArrow(_visits(shared, every, last, done, groups), visit), "visits")
        if not visits.isEmpty():
            # only rings that are visited move: at most CELLS of them
            some = held.join(F.broadcast(visits.select("pivot", "ring").distinct()), ["pivot", "ring"], "left_semi")
            met = visits.groupBy(*unit).cogroup(some.groupBy(*unit)).applyInArrow(_compare(shared, k), "query_id long, vec_id long, score long")
            both = met if best is None else met.unionByName(best.drop("rank"))
            best = session.materialize(_top(both, k), "best")
        done, quota = last, quota * growth
    shared.destroy()
    return best if best is not None else spark.createDataFrame([], RESULT)
