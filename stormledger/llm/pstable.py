"""Nearest neighbours by cosine through multiprobe p-stable hashing.

Vectors are scaled to length one, so that Euclidean and cosine order agree. Each
of several tables cuts random Gaussian projections into cells of one width; a
vector's cells, mixed, are its bucket. A query visits its own bucket and those
of many perturbations: moves of one cell in some projections, in ascending sum
of squared distances to the walls crossed, which is descending estimated chance
of success. Only vectors in visited buckets are compared with the query, by exact
cosine in double precision on the original vectors, ties to the smaller id.

The number of projections of a table follows the real distances: `SAMPLE` queries
are answered exactly, and the finest tables are taken whose buckets meet `TARGET`
of these neighbours, counted on that half of the sample whose neighbours are
farthest. Queries go in blocks to all vectors, which stay where they are, so
that no bucket is one task's work.

Equal vectors are one class of the index: a class keeps its `k + 1` smallest ids,
as no larger one can be among the `k` nearest of any query. Queries that meet fewer
than `k` other vectors are compared with all classes; `fallback=False` leaves them
as the index has them.

Defined cases: null and zero vectors, and those with null or non-finite
components, take no part; vectors of another length than the most common one of
the table neither; fewer candidates than `k` give fewer rows; rows without id take no
part; repeated ids are one vector if equal, else candidates each, and the least of
them in the order of arrays is the query; an empty table gives an empty result;
other columns stay out.
"""

from __future__ import annotations

import dataclasses
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stormledger import session
from stormledger.llm import texts


@dataclasses.dataclass(frozen=True)
class Params:
    """Shape of the index. width: cell width of unit vectors' projections; hashes: 0 for as many as the distances allow."""

    tables: int = 16
    hashes: int = 0
    width: float = 2.5
    probes: int = 128
    max_moves: int = 4
    seed: int = 9


#: Queries answered exactly to choose the number of hashes, the share of their neighbours to meet, and the choices.
SAMPLE = 64
TARGET = 0.95
HASHES = range(24, 3, -1)
#: Nearest walls of a query's cell that moves may cross.
WALLS = 14


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of a with the matching row of b, in double precision."""
    dot = (a * b).sum(axis=1)
    return dot / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


class Tables:
    """The random projections of all tables."""

    def __init__(self, size: int, params: Params):
        draw = np.random.default_rng(params.seed)
        self.params, self.size = params, size
        self.lines = draw.standard_normal((size, params.tables * params.hashes))
        self.shifts = draw.random(params.tables * params.hashes)

    def cells(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell of each projection, and the place inside it from 0 to 1."""
        unit = vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
        at = unit @ self.lines / self.params.width + self.shifts
        cell = np.floor(at)
        shape = (len(vectors), self.params.tables, self.params.hashes)
        return cell.astype(np.int64).reshape(shape), (at - cell).reshape(shape)

    @staticmethod
    def _bucket(cells: np.ndarray, table: int) -> np.ndarray:
        out = np.full(len(cells), table, dtype=texts.U64)
        for k in range(cells.shape[1]):
            out = texts.mix(out * texts.U64(0x9E3779B97F4A7C15) + cells[:, k].astype(np.int64).view(texts.U64))
        return out.view(np.int64)

    def buckets(self, cells: np.ndarray) -> np.ndarray:
        """Number of a bucket from its table and cells."""
        return np.stack([self._bucket(cells[:, table], table) for table in range(cells.shape[1])], axis=1)

    def visited(self, cells: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Buckets of each query, table by table: its own, then perturbations by ascending squared distance."""
        n, hashes = len(cells), self.params.hashes
        walls = min(WALLS, 2 * hashes)
        sets = [x for size in range(min(self.params.max_moves, walls) + 1) for x in itertools.combinations(range(walls), size)]
        chosen = np.zeros((len(sets), walls))
        for row, x in enumerate(sets):
            chosen[row, list(x)] = 1.0
        found = []
        for table in range(self.params.tables):
            cost = np.concatenate((place[:, table] ** 2, (1 - place[:, table]) ** 2), axis=1)
            near = np.argsort(cost, axis=1, kind="stable")[:, :walls]
            line, step = near % hashes, np.where(near < hashes, -1, 1)
            total = np.take_along_axis(cost, near, axis=1) @ chosen.T
            # a cell has two walls in each projection; no set crosses both
            for a, b in itertools.combinations(range(walls), 2):
                total[np.ix_(line[:, a] == line[:, b], (chosen[:, a] * chosen[:, b]) > 0)] = np.inf
            order = np.argsort(total, axis=1, kind="stable")[:, :self.params.probes + 1]
            legal = np.isfinite(np.take_along_axis(total, order, axis=1))
            moves = np.zeros((n, walls, hashes))
            moves[np.arange(n)[:, None], np.arange(walls), line] = step
            # sets that are not legal repeat the query's own bucket
            rows = cells[:, table][:, None, :] + ((chosen[order] @ moves) * legal[:, :, None]).astype(np.int64)
            found.append(self._bucket(rows.reshape(-1, hashes), table).reshape(n, -1))
        return np.concatenate(found, axis=1)

    def probes(self, cells: np.ndarray, place: np.ndarray) -> list[int]:
        """Buckets of one query."""
        return self.visited(cells[None], place[None])[0].tolist()


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return scaled(np.array(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, size))


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors times a power of two each, so that no square is too large or too small; cosines stay the same to the last bit."""
    exponents = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1] if vectors.size else 0
    return np.ldexp(vectors, -exponents)


def classes(vectors: DataFrame, key: str, vector: str, keep: int) -> DataFrame:
    """Distinct usable vectors with a number, their smallest ids, and how many ids they stand for."""
    v = F.col("v")
    usable = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0.0)
    rows = vectors.select(vectors[key].cast("long").alias("id"), vectors[vector].cast("array<double>").alias("v"))
    rows = rows.filter(v.isNotNull() & F.col("id").isNotNull()).filter(F.coalesce(usable, F.lit(False)))
    # -0.0 and 0.0 are one number; summed before they move: each task keeps the smallest ids of a vector
    rows = rows.withColumn("v", F.transform(v, lambda x: x + F.lit(0.0)))
    smallest = rows.withColumn("digest", F.sha2(F.array_join(F.col("v").cast("array<string>"), ","), 256)).dropDuplicates(["digest", "id"])
    order = Window.partitionBy("digest").orderBy("id")
    ranked = smallest.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= keep)
    return ranked.groupBy("digest").agg(F.sort_array(F.collect_list("id")).alias("ids"), F.first("v").alias("v")).withColumn("class", F.element_at("ids", 1))


def _queries(vectors: DataFrame, key: str, vector: str, size: int, every: int) -> DataFrame:
    v = F.col("v")
    asked = vectors.filter(vectors[key].cast("long") % every == 0).select(vectors[key].cast("long").alias("query_id"), vectors[vector].cast("array<double>").alias("v"))
    asked = asked.filter(F.size(v) == size).filter(F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0.0), F.lit(False)))
    return session.materialize(asked.groupBy("query_id").agg(F.min("v").alias("v")), "asked")


def search(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 5, every: int = 50, params: Params = Params(),
           fallback: bool = True) -> DataFrame:
    """The k nearest other vectors of each row whose id is divisible by `every`."""
    spark = vectors.sparkSession
    usual = vectors.filter(F.size(vectors[vector]) > 0).groupBy(F.size(vectors[vector]).alias("size")).count().orderBy(F.desc("count"), "size").first()
    if usual is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size = usual["size"]
    known = session.materialize(classes(vectors.filter(F.size(vectors[vector]) == size), key, vector, k + 1), "classes")
    asked = _queries(vectors, key, vector, size, every)
    if not params.hashes:
        params = dataclasses.replace(params, hashes=fitted(asked, known, size, k, params))
    first = _in_blocks(asked, known, size, k, Tables(size, params))
    # queries that met too few others: all classes
    few = first.groupBy("query_id").count().filter(F.col("count") >= k).select("query_id")
    rest = session.materialize(asked.join(few, "query_id", "left_anti"), "rest") if fallback else None
    if rest is None or rest.isEmpty():
        return first
    again = _in_blocks(rest, known, size, k, None)
    return first.join(rest.select("query_id"), "query_id", "left_anti").unionByName(again)


def fitted(asked: DataFrame, known: DataFrame, size: int, k: int, params: Params) -> int:
    """The most hashes for which a sample of queries meets its true neighbours."""
    sample = session.materialize(asked.orderBy(F.xxhash64("query_id"), "query_id").limit(SAMPLE), "sample")
    near = _in_blocks(sample, known, size, k, None).select("query_id", "vec_id", "score")
    held = known.select(F.explode("ids").alias("vec_id"), F.col("v").alias("near"))
    found = near.join(held, "vec_id").join(sample, "query_id").select("query_id", "score", "v", "near").collect()
    if not found:
        return HASHES[-1]
    worst: dict[int, float] = {}
    for r in found:
        worst[r["query_id"]] = min(worst.get(r["query_id"], 2.0), r["score"])
    far = set(sorted(worst, key=lambda q: (worst[q], q))[:(len(worst) + 1) // 2])
    pairs = [r for r in found if r["query_id"] in far]
    queries, others = (scaled(np.array([r[name] for r in pairs], dtype=np.float64)) for name in ("v", "near"))
    for hashes in HASHES:
        tables = Tables(size, dataclasses.replace(params, hashes=hashes))
        visited = tables.visited(*tables.cells(queries)).reshape(len(pairs), params.tables, -1)
        own = tables.buckets(tables.cells(others)[0])
        if (visited == own[:, :, None]).any(axis=(1, 2)).mean() >= TARGET:
            return hashes
    return HASHES[-1]


def _nearest(scored: DataFrame, k: int) -> DataFrame:
    """Ranks of each query's own candidates; Spark limits each group per task before the shuffle."""
    rows = scored.withColumn("vec_id", F.explode("ids")).filter(F.col("vec_id") != F.col("query_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


#: Queries of one block.
BLOCK = 1024


def _best(score: np.ndarray, k: int) -> np.ndarray:
    """The k + 1 best, with all that tie with the last of them."""
    if len(score) <= k + 1:
        return np.arange(len(score))
    return np.flatnonzero(score >= np.partition(score, len(score) - k - 1)[len(score) - k - 1])


def _in_blocks(asked: DataFrame, known: DataFrame, size: int, k: int, tables: Tables | None) -> DataFrame:
    """Nearest classes of the queries, one block of them at a time; without tables every class is compared."""
    spark = asked.sparkSession
    numbered = asked.orderBy("query_id")
    out, at = None, None
    while True:
        block = (numbered if at is None else numbered.filter(F.col("query_id") > at)).limit(BLOCK).collect()
        if not block:
            return out if out is not None else spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
        at = block[-1]["query_id"]
        ids, queries = np.array([r["query_id"] for r in block], dtype=np.int64), scaled(np.array([r["v"] for r in block], dtype=np.float64))
        probes = None
        if tables is not None:
            visited = tables.visited(*tables.cells(queries))
            order = np.argsort(visited.ravel(), kind="stable")
            probes = visited.ravel()[order], (order // visited.shape[1]).astype(np.int32)
        shared = spark.sparkContext.broadcast((ids, queries, tables, probes))

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, queries, tables, probes = shared.value
            held: list[tuple[np.ndarray, list]] = [(np.empty(0), [])] * len(ids)
            for batch in batches:
                for part in (batch.slice(a, 4096) for a in range(0, batch.num_rows, 4096)):
                    rows, names = _matrix(part.column("v"), size), part.column("ids").to_pylist()
                    met = _met(rows, len(ids), tables, *probes) if tables is not None else None
                    alone = np.array([len(own) == 1 for own in names], dtype=bool)
                    lowest = np.array([own[0] for own in names], dtype=np.int64)
                    for i, vector in enumerate(queries):
                        # a class of the query's own id alone is no neighbour
                        other = ~(alone & (lowest == ids[i]))
                        some = np.flatnonzero(met[i] & other if met is not None else other)
                        if len(some):
                            near = rows[some]
                            score = cosine(np.broadcast_to(vector, near.shape), near)
                            best = _best(score, k)
                            score, own = np.concatenate((held[i][0], score[best])), held[i][1] + [names[x] for x in some[best]]
                            best = _best(score, k)
                            held[i] = score[best], [own[x] for x in best]
            for query, (score, own) in zip(ids.tolist(), held, strict=True):
                if own:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([query] * len(own), pa.int64()), pa.array(own, pa.list_(pa.int64())), pa.array(score)], ["query_id", "ids", "score"])

        scored = known.select("ids", "v").mapInArrow(work, "query_id long, ids array<long>, score double")
        found = session.materialize(_nearest(scored, k), "near")
        out = found if out is None else out.unionByName(found)


def _met(rows: np.ndarray, n: int, tables: Tables, keys: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """Which of n queries visits a bucket of which row. keys, owners: visited buckets in order, and by whom."""
    buckets = tables.buckets(tables.cells(rows)[0]).ravel()
    first, times = np.searchsorted(keys, buckets), np.searchsorted(keys, buckets, "right")
    times -= first
    row = np.repeat(np.repeat(np.arange(len(rows)), tables.params.tables), times)
    place = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(first, times)
    out = np.zeros((n, len(rows)), dtype=bool)
    out[owners[place], row] = True
    return out
