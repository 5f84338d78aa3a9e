"""Mixing sources to target weights by balanced sampling, the cube method.

Every document of a source is wanted target / size times, at most `max_copies`
times. The whole part of that number is taken as it is; the fraction is an
inclusion probability. The flight phase moves the vector of probabilities along
directions that keep two sums, documents and words, until an entry reaches 0 or
1. It runs on pools of a few thousand documents at once, whatever the size of a
source; what each pool leaves undecided, two documents at most, is pooled again,
with some documents of all sizes that the pool holds back. The last ones are landed
by a linear programme: each keeps its probability, and the word total is as near as
that allows.

Direction and step come from a hash of the document id, the seed and the round,
so reruns and retried tasks agree.

Targets: sources in code point order, null last, weigh `weights` in turn and share
`share` of all words; a target stops at `max_copies` times its source's size and
the excess goes to the others by weight until none is above.

Defined cases: a null text has size 0; documents of size 0 and sources without
words are never taken; rows of one id, or without id, are each drawn for
themselves, and those that agree in id, source and text share what falls to them;
an empty table gives an empty result; further columns stay out.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from stormledger import session
from stormledger.llm import texts

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
#: Documents of one pool, and those it holds back for the next or for landing.
POOL = 2048
RESERVE = 64
#: Documents of a source that are landed by a choice among all their subsets, and the most steps to find it.
LAST = 12
STEPS = 2000
SEED = 20


def sizes(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """Words of every text."""
    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        n = texts.words(*texts.raw(part.column("text"))).per_row()
        return pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("source"), part.column("digest"), pa.array(n)], ["doc_id", "source", "digest", "size"])

    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[source].cast("string").alias("source"), _digest(docs[source], docs[text]).alias("digest"), docs[text].alias("text"))
    return texts.map_texts(rows, work, "doc_id long, source string, digest long, size long")


def _digest(source: Column, text: Column) -> Column:
    """A hash of source and text, null apart from empty."""
    source = source.cast("string")
    return F.xxhash64(source.isNull(), F.coalesce(source, F.lit("")), text.isNull(), F.coalesce(text, F.lit("")))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, max_copies: int = MAX_COPIES) -> DataFrame:
    """Words wanted of every source; one row for each source.

    Filled like water: the level of words per weight at which all targets, each at
    most its cap, sum to the whole. Sources are full in the order of cap / weight.
    """
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    choice = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    rows = by_source.withColumn("weight", choice.cast("double")).withColumn("cap", F.col("source_size") * F.lit(float(max_copies)))
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).partitionBy()
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        rows.withColumn("wanted", F.lit(float(share)) * F.sum("source_size").over(whole)).withColumn("all_weight", F.sum("weight").over(whole))
        .withColumn("full", F.coalesce(F.sum("cap").over(fill), F.lit(0.0)))
        .withColumn("left", F.col("all_weight") - F.coalesce(F.sum("weight").over(fill), F.lit(0.0)))
        .withColumn("level", (F.col("wanted") - F.col("full")) / F.col("left"))
    )
    # sources below the level are full; the first one above it sets the level of all others
    open_ = F.min(F.when(F.col("cap") >= F.col("level") * F.col("weight"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(whole)
    rows = rows.withColumn("open", open_["level"])
    return rows.select("source", "source_size", F.coalesce(F.least("cap", F.col("open") * F.col("weight")), F.col("cap")).alias("target"))


def _random(keys: np.ndarray, seed: int) -> np.ndarray:
    """Uniform numbers of [0, 1) that depend on the keys and the seed."""
    mixed = texts.mix(texts.mix(keys.astype(np.int64).view(texts.U64) + texts.U64(seed)) + texts.U64(0x9E3779B97F4A7C15))
    return (mixed >> texts.U64(11)).astype(np.float64) / float(1 << 53)


def flight(pi: np.ndarray, size: np.ndarray, draws: np.ndarray, reserve: int = RESERVE) -> np.ndarray:
    """Move probabilities to 0 or 1, keeping the sums of pi and of pi * size; few stay between.

    These are two at most, and up to `reserve` undecided units from all over the given order, one in eight.
    Three undecided units span a direction that keeps both sums: the null space of
    their two balance equations. A step goes to the first wall either way, with the
    probabilities that keep each expectation.
    """
    pi, eps = pi.astype(np.float64).copy(), 1e-9
    undecided = np.flatnonzero((pi > eps) & (pi < 1 - eps)).tolist()
    reserve = min(reserve, len(undecided) // 8)
    spared = {int(k) for k in np.linspace(0, len(undecided) - 1, reserve + 2)[1:-1]} if undecided else set()
    waiting = iter([x for k, x in enumerate(undecided) if k not in spared])
    held = list(itertools.islice(waiting, 3))
    p, s, used = pi.tolist(), size.tolist(), 0
    while len(held) == 3:
        i, j, k = held
        a, b, c = float(s[i]), float(s[j]), float(s[k])
        # u_i + u_j + u_k = 0 and a u_i + b u_j + c u_k = 0
        u = (b - c, c - a, a - b) if not a == b == c else (1.0, -1.0, 0.0)
        up = min(((1 - p[x]) / d if d > 0 else -p[x] / d) for x, d in zip(held, u) if d)
        down = min((p[x] / d if d > 0 else -(1 - p[x]) / d) for x, d in zip(held, u) if d)
        step = up if draws[used] * (up + down) < down else -down
        used += 1
        for x, d in zip(held, u):
            value = p[x] + step * d
            p[x] = 0.0 if value < eps else 1.0 if value > 1 - eps else value
        held = [x for x in held if 0.0 < p[x] < 1.0]
        held += itertools.islice(waiting, 3 - len(held))
    return np.array(p)


def land(pi: np.ndarray, size: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Decide the few units left, each with its own probability, so that their words come near what is expected.

    All but `LAST` of all sizes fly on until two are left; of the rest one of the
    subsets of `_landings` is drawn.
    """
    out = pi.copy()
    undecided = np.flatnonzero((pi > 0) & (pi < 1))
    if not len(undecided):
        return out
    undecided = undecided[np.argsort(-size[undecided], kind="stable")]
    held = np.unique(np.linspace(0, len(undecided) - 1, min(LAST, len(undecided))).astype(np.int64))
    first = np.delete(undecided, held)
    out[first] = flight(pi[first], size[first], draws[:len(first)], reserve=0)
    rest = undecided[(out[undecided] > 0) & (out[undecided] < 1)]
    if len(rest):
        choices, chances = _landings(out[rest], size[rest])
        at = np.searchsorted(np.cumsum(chances), draws[len(undecided) - 1] * chances.sum(), "right")
        out[rest] = choices[min(int(at), len(choices) - 1)]
    return out


def _landings(pi: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Subsets and their chances: each unit is in one with its probability, and the words are as near as can be.

    The linear programme of the landing phase: among all distributions over subsets
    with these inclusion probabilities one of the least expected distance from the
    expected words; the number of units decides between equal ones. It starts from
    the nested subsets of the most probable units, and each step swaps one subset, so
    that the probabilities hold wherever it ends.
    """
    n = len(pi)
    subsets = (((np.arange(1 << n)[:, None] >> np.arange(n)) & 1)).astype(np.float64)
    cost = np.abs(subsets @ size - pi @ size) / max(1.0, float(size.max())) + 1e-3 * np.abs(subsets.sum(axis=1) - pi.sum())
    columns, wanted = np.hstack((subsets, np.ones((1 << n, 1)))), np.append(pi, 1.0)
    order = np.argsort(-pi, kind="stable")
    basis = np.concatenate(([0], np.cumsum(1 << order)))
    for _ in range(STEPS):
        matrix = columns[basis].T
        chances = np.linalg.solve(matrix, wanted)
        gain = cost - columns @ np.linalg.solve(matrix.T, cost[basis])
        enters = int(np.argmin(gain))
        if gain[enters] > -1e-9:
            break
        change = np.linalg.solve(matrix, columns[enters])
        limit = np.where(change > 1e-9, np.maximum(chances, 0.0) / np.where(change > 1e-9, change, 1.0), np.inf)
        basis[int(np.argmin(limit))] = enters
    chances = np.maximum(np.linalg.solve(columns[basis].T, wanted), 0.0)
    return subsets[basis], chances


def _pool(seed: int, last: bool):
    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        # by size, so that those held back are of all sizes
        pdf = pdf.assign(order=-pdf["size"]).sort_values(["order", "mixed", "row"], kind="stable").drop(columns="order")
        pi = flight(pdf["pi"].to_numpy(), pdf["size"].to_numpy(), _random(pdf["mixed"].to_numpy(), seed))
        if last:
            pi = land(pi, pdf["size"].to_numpy(), _random(pdf["row"].to_numpy(), seed + 1))
        return pdf.assign(pi=pi)

    return work


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", weights: tuple[int, ...] = WEIGHTS,
        share: float = 1.0, max_copies: int = MAX_COPIES, pool: int = POOL, seed: int = SEED) -> DataFrame:
    """Every document with its size, its source's size and target, and how often it is taken."""
    spark = docs.sparkSession
    sized = session.materialize(sizes(docs, key, source, text), "sizes")
    wanted = session.materialize(targets(sized, weights, share, max_copies).withColumnRenamed("source", "name"), "targets")
    rows = sized.join(wanted, sized["source"].eqNullSafe(wanted["name"])).drop("name")
    # a source's ratio of target and size; counted in whole copies and a fraction
    ratio = F.when((F.col("source_size") > 0) & (F.col("size") > 0), F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    ratio = F.least(ratio, F.lit(float(max_copies)))
    rows = rows.withColumn("copies", F.floor(ratio + F.lit(1e-12)).cast("long"))
    rows = rows.withColumn("pi", F.greatest(F.lit(0.0), ratio - F.col("copies")))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    # a pool's hash: id, source and text; also the row's number where very many rows agree in these
    many = sized.filter("size > 0").groupBy(F.col("doc_id").alias("same_id"), F.col("digest").alias("same")).count().filter(F.col("count") > max(1, pool // 64))
    many = session.materialize(many.select("same_id", "same"), "many")
    rows = rows.join(many, rows["doc_id"].eqNullSafe(many["same_id"]) & (rows["digest"] == many["same"]), "left")
    salt = F.when(F.col("same").isNotNull(), F.col("row")).otherwise(F.lit(0))
    rows = rows.withColumn("mixed", F.xxhash64("doc_id", "digest", salt, F.lit(seed))).drop("same_id", "same")
    rows = session.materialize(rows, "wanted")

    schema = "row long, source string, size long, pi double, mixed long"
    schema_cols = [c.split()[0] for c in schema.split(", ")]
    open_ = rows.filter((F.col("pi") > 0) & (F.col("pi") < 1)).select(*schema_cols)
    decided: list[DataFrame] = []
    level, before = 0, None
    while True:
        counts = open_.groupBy("source").agg(F.count("*").alias("n")).withColumnRenamed("source", "name")
        pooled = open_.join(counts, open_["source"].eqNullSafe(counts["name"])).drop("name")
        n_pools = F.ceil(F.col("n") / F.lit(pool))
        pooled = pooled.withColumn("pool", F.pmod(F.xxhash64("mixed", F.lit(level)), n_pools))
        biggest = counts.agg(F.max("n")).first()[0]
        if biggest is None:
            break
        # pools too small to decide anything are landed as they are
        last = biggest <= pool or biggest == before
        before = biggest
        done = session.materialize(
            pooled.select(*schema_cols, "pool").groupBy("source", "pool").applyInPandas(_drop_pool(_pool(seed + level, last)), schema), f"pools-{level}")
        is_open = (F.col("pi") > 0) & (F.col("pi") < 1)
        decided.append(done.filter(~is_open & (F.col("pi") > 0)).select(F.col("row").alias("taken_row")))
        if last:
            break
        open_, level = done.filter(is_open), level + 1
    taken = spark.createDataFrame([], "taken_row long")
    for part in decided:
        taken = taken.unionByName(part)
    rows = rows.join(taken, F.col("row") == F.col("taken_row"), "left")
    copies = F.col("copies") + F.col("taken_row").isNotNull().cast("long") + (F.col("pi") >= 1).cast("long")
    return rows.select("doc_id", "source", "digest", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def _drop_pool(work):
    return lambda pdf: work(pdf.drop(columns=["pool"]))


def take(docs: DataFrame, mixed: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """Documents as often as the mix takes them; their columns stay.

    Rows that agree in id, source and text, null included, share their copies evenly.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    own = [F.col(f"c{names.index(name)}") for name in (key, source, text)]
    whole = mixed.groupBy(F.col("doc_id").alias("_id"), F.col("digest").alias("_same")).agg(F.sum("copies").alias("_sum"), F.count("*").alias("_n"))
    whole = whole.filter("_sum > 0").withColumn("_each", F.expr("_sum div _n")).withColumn("_more", F.col("_sum") % F.col("_n"))
    rows = plain.withColumn("_own", own[0].cast("long")).withColumn("_digest", _digest(own[1], own[2]))
    rows = rows.join(whole, F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_digest") == F.col("_same")))
    # only rows that agree and cannot all have the same number of copies are numbered
    even, odd = rows.filter("_more = 0"), rows.filter("_more > 0")
    odd = odd.withColumn("_at", F.monotonically_increasing_id())
    at = F.row_number().over(Window.partitionBy("_own", "_digest").orderBy("_at"))
    odd = odd.withColumn("_each", F.col("_each") + (at <= F.col("_more")).cast("long")).drop("_at")
    rows = even.unionByName(odd).filter("_each > 0")
    rows = rows.withColumn("_again", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_each"))))
    return rows.select(*plain.columns).toDF(*names)
