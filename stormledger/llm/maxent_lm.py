"""Scores of texts under a hashed maximum-entropy language model.

Tokens are words with A-Z lower-cased and one end per text. The most frequent
training tokens are dealt into `CLASSES` - 1 classes of like weight; all others,
unknown ones among them, are the last class. A token's probability is that of its
class, times that of the token within its class.

How many tokens have classes and how many rows the tables have follows the corpus:
`WORDS` and `TABLES` times `scale`, which doubles with each fourfold number of
training tokens, until a set of weights is what one task can hold (`MAX_SCALE`).
Training tasks grow alike, so that the weights they write stay in proportion to
the text.

Class: a softmax whose features are the word before, the two words before, the
word two before and the one three before (skips), each hashed into its own table,
and the last frequent word that passed (a skip of any length). Every task takes
gradient steps over its training texts from the common weights; weights are
averaged over all tasks, by tokens, after each of `ROUNDS` parts of the corpus.
Every training text is in one part.

Word: a softmax over the class with the word and (last frequent word, word) as
features. Its gradient needs counts alone, which are summed over the corpus; the
weights are the smoothed optimum. In the last class the counts of all words are
smoothed like those of the base score.

Counts of the `HOT` most frequent tokens go with the tasks; those of all others
are joined by token. Tokens are compared by 64-bit hash.

Defined cases: null counts as empty text, which is one end token; without training
texts every token has probability one; repeated rows train repeatedly and give
repeated results; an empty table gives an empty result; further columns are not
read.
"""

from __future__ import annotations

import dataclasses
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormledger import session
from stormledger.llm import texts

WORDS = 1 << 14
HOT = 1 << 17
CLASSES = 64
FREQUENT = 64
ROUNDS = 2
BATCH = 8192
STEP = 0.4
#: Prior tokens of the word model for each last frequent word and class.
PRIOR = 50.0
#: Rows of the tables at scale 1: word before, two words before, word two before, word three before.
TABLES = (1 << 13, 1 << 14, 1 << 12, 1 << 11)
SMOOTH = 0.1
#: Tokens of a training task at scale 1, about: each writes one set of weights a round.
TASK_TOKENS = 1 << 22
#: Training tokens of scale 1, of which scale 2 needs four times as many.
SCALE_TOKENS = 1 << 24
#: At this scale weights take about 100 MB.
MAX_SCALE = 8
HELD = 400_000
U64 = texts.U64
END = U64(0x5E2D58D8B3BCDEF1)
_PIECE = 1 << 15
#: Rows of a piece whose gradients are summed one after the other.
_SUMMED = 16


def scale(tokens: int) -> int:
    """The largest power of two whose square is at most the corpus in units of `SCALE_TOKENS`."""
    out = 1
    while out < MAX_SCALE and 4 * out * out * SCALE_TOKENS <= tokens:
        out *= 2
    return out


@dataclasses.dataclass
class Counts:
    """Totals, and the most frequent tokens by descending count: hashes, and counts."""

    tokens: int
    distinct: int
    hashes: np.ndarray
    counts: np.ndarray

    def __post_init__(self):
        self.order = np.argsort(self.hashes)
        self.sorted = self.hashes[self.order]
        self.scale = scale(self.tokens)
        n = self.words = min(WORDS * self.scale, len(self.hashes))
        # classes of like sums of square roots, the last one for all other tokens
        weight = np.sqrt(self.counts[:n].astype(np.float64))
        place = np.cumsum(weight) / weight.sum() if n else weight
        self.class_of = np.append(np.minimum((place * (CLASSES - 1)).astype(np.int64), CLASSES - 2), CLASSES - 1)
        self.class_tokens = np.bincount(self.class_of[:n], weights=self.counts[:n], minlength=CLASSES).astype(np.float64)
        self.rest = self.tokens - int(self.counts[:n].sum())
        # unknown tokens have a share even if training has none of the others
        self.class_tokens[CLASSES - 1] = self.rest + SMOOTH * (self.distinct - n + 1)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Rank of each token among the most frequent; -1 for others."""
        if not len(self.sorted):
            return np.full(len(hashes), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
        return np.where(self.sorted[at] == hashes, self.order[at], -1)


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of the texts in a row, and where each text's end token stands."""
    data, offsets = texts.raw(column)
    words = texts.words(texts.LOWER[data], offsets)
    ends = words.edges()[1:] + np.arange(words.n_rows)
    out = np.full(len(words) + words.n_rows, END, dtype=U64)
    inside = np.ones(len(out), dtype=bool)
    inside[ends] = False
    out[inside] = words.hashes()
    return out, ends


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Token counts, summed as far as memory allows."""
    keys, n = np.empty(0, dtype=U64), np.empty(0, dtype=np.int64)
    loose: list[np.ndarray] = []

    def merged() -> tuple[np.ndarray, np.ndarray]:
        found, where = np.unique(np.concatenate([keys, *loose]), return_inverse=True)
        weights = np.concatenate([n, np.ones(sum(map(len, loose)), dtype=np.int64)])
        return found, np.bincount(where, weights=weights, minlength=len(found)).astype(np.int64)

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], ["token", "n"])

    for part in texts.chunks(batches):
        loose.append(tokens(part.column("text"))[0])
        if sum(map(len, loose)) > HELD:
            keys, n = merged()
            loose = []
            if len(keys) > HELD:
                yield rows()
                keys, n = keys[:0], n[:0]
    keys, n = merged()
    yield rows()


def context(ids: np.ndarray, ends: np.ndarray, words: int, scale: int = 1) -> tuple[list[np.ndarray], np.ndarray]:
    """Rows of the tables for every token, and the last frequent word before it in its text.

    ids: rank of each token, `words` for all others. Before a text's start stands `words` + 1.
    scale: how many times their least size the tables have.
    """
    n = len(ids)
    starts = np.zeros(n, dtype=np.int64)
    first = np.concatenate(([0], ends[:-1] + 1))
    starts[first] = first
    starts = np.maximum.accumulate(starts)
    at = np.arange(n)

    def back(k: int) -> np.ndarray:
        return np.where(at - k >= starts, ids[np.maximum(at - k, 0)], words + 1)

    one, two, three = back(1), back(2), back(3)
    spread = U64(0x9E3779B97F4A7C15)
    keys = (one.astype(U64) * spread, (one.astype(U64) * U64(0x1000003) + two.astype(U64) + U64(7)) * spread, (two.astype(U64) + U64(1 << 20)) * spread, (three.astype(U64) + U64(1 << 21)) * spread)
    rows = [(texts.mix(k) & U64(size * scale - 1)).astype(np.int64) for k, size in zip(keys, TABLES, strict=True)]
    seen = np.where(ids < min(FREQUENT, words), at, -1)
    last = np.concatenate(([-1], np.maximum.accumulate(seen)[:-1]))
    passed = np.where(last >= starts, ids[np.maximum(last, 0)], FREQUENT)
    return rows, passed


def fresh(counts: Counts) -> list[np.ndarray]:
    """Weights before training: the classes' own shares."""
    share = np.log(np.maximum(counts.class_tokens, 1e-12) / counts.class_tokens.sum()).astype(np.float32)
    return [*(np.zeros((size * counts.scale, CLASSES), dtype=np.float32) for size in TABLES), np.repeat(share[None, :], FREQUENT + 1, axis=0)]


def _sums(weights: list[np.ndarray], rows: list[np.ndarray], passed: np.ndarray) -> np.ndarray:
    """Summed weights of every class; bounded, so that their exponentials are finite."""
    total = weights[-1].take(passed, axis=0)
    for table, at in zip(weights, rows):
        total += table.take(at, axis=0)
    return np.minimum(total, 60, out=total)


def class_logs(weights: list[np.ndarray], rows: list[np.ndarray], passed: np.ndarray) -> np.ndarray:
    """Natural logarithms of all classes' probabilities."""
    total = _sums(weights, rows, passed)
    return total - np.log(np.exp(total) @ np.ones(CLASSES, dtype=total.dtype))[:, None]


def _row_sums(values: np.ndarray, order: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Groups, and for each of them the sum of its values; group k has the rows order[first[k]:first[k + 1]].

    Groups are summed in pieces of up to `_SUMMED` rows, the next row of all pieces at a time, and then the pieces alike.
    """
    sizes = np.diff(first, append=len(order))
    pieces = -(-sizes // _SUMMED)
    starts = np.cumsum(pieces) - pieces
    at = np.repeat(first, pieces) + _SUMMED * (np.arange(int(pieces.sum())) - np.repeat(starts, pieces))
    own = np.minimum(np.repeat(first + sizes, pieces) - at, _SUMMED)
    by = np.argsort((_SUMMED - own).astype(np.uint8), kind="stable")  # longest first
    at, longer = at[by], np.cumsum(np.bincount(own, minlength=_SUMMED + 1)[::-1])[::-1].tolist()
    out = values.take(order[at], axis=0)
    for k in range(1, int(own.max(initial=0))):
        n = longer[k + 1]
        out[:n] += values.take(order[at[:n] + k], axis=0)
    if len(out) == len(first):
        return by, out
    where = np.empty(len(by), dtype=np.int64)
    where[by] = np.arange(len(by))
    return _row_sums(out, where, starts)


def learn(weights: list[np.ndarray], seen: list[np.ndarray], rows: list[np.ndarray], passed: np.ndarray, classes: np.ndarray) -> None:
    """One gradient step; a row's steps shrink with the root of how often it was seen."""
    grad = _sums(weights, rows, passed)
    np.exp(grad, out=grad)
    grad /= (grad @ np.ones(CLASSES, dtype=grad.dtype))[:, None]
    grad[np.arange(len(classes)), classes] -= 1.0
    for table, count, at in zip(weights, seen, [*rows, passed], strict=True):
        order = np.argsort(at.astype(np.min_scalar_type(len(table) - 1)), kind="stable")  # short integers sort faster
        sorted_ = at[order]
        first = np.flatnonzero(np.diff(sorted_, prepend=-1))
        found = sorted_[first]
        count[found] += np.diff(first, append=len(at))
        by, total = _row_sums(grad, order, first)
        found = found[by]
        total *= (STEP / np.sqrt(20.0 + count[found])).astype(table.dtype)[:, None]
        table[found] = np.subtract(table.take(found, axis=0), total, out=total)


def _pieces(arrays: list[np.ndarray], weight: float) -> pa.RecordBatch:
    """Arrays as numbered pieces, each with how much it weighs."""
    body = np.concatenate([a.ravel().astype(np.float32) for a in arrays])
    parts = [body[k:k + _PIECE] for k in range(0, len(body), _PIECE)]
    return pa.RecordBatch.from_arrays(
        [pa.array(range(len(parts)), pa.int32()), pa.array([weight] * len(parts), pa.float64()), pa.array([zlib.compress(p.tobytes(), 1) for p in parts], pa.binary())],
        ["piece", "weight", "body"])


def _sum_pieces(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sum of weighted pieces; in the order of their bytes, so that reruns agree."""
    pdf = pdf.sort_values(["weight", "body"])
    total = None
    for weight, packed in zip(pdf["weight"], pdf["body"]):
        own = np.frombuffer(zlib.decompress(packed), dtype=np.float32).astype(np.float64) * weight
        total = own if total is None else total + own
    scale = max(1.0, float(pdf["weight"].sum()))
    return pd.DataFrame({"piece": [pdf["piece"].iloc[0]], "weight": [scale], "body": [zlib.compress((total / scale).astype(np.float32).tobytes(), 1)]})


def _mean(pieces: DataFrame, shapes: list[tuple[int, ...]]) -> tuple[list[np.ndarray], float] | None:
    """Weighted mean of all tasks' arrays and the whole weight. The driver gets one set of arrays."""
    schema = "piece int, weight double, body binary"
    # in two steps, so that no task gets the pieces of all others
    some = pieces.withColumn("salt", F.spark_partition_id() % 8).groupBy("piece", "salt").applyInPandas(lambda pdf: _sum_pieces(pdf.drop(columns="salt")), schema)
    found = some.groupBy("piece").applyInPandas(_sum_pieces, schema).collect()
    if not found:
        return None
    sizes = [int(np.prod(shape)) for shape in shapes]
    body = np.empty(sum(sizes), dtype=np.float32)
    for r in found:
        own = np.frombuffer(zlib.decompress(r["body"]), dtype=np.float32)
        body[r["piece"] * _PIECE:r["piece"] * _PIECE + len(own)] = own
    edges = np.cumsum([0, *sizes])
    return [body[a:b].reshape(shape) for a, b, shape in zip(edges, edges[1:], shapes, strict=False)], float(found[0]["weight"])


class Model:
    """Fitted weights of the classes, and logarithms of words within their classes."""

    def __init__(self, counts: Counts, weights: list[np.ndarray], pairs: np.ndarray):
        self.counts, self.weights = counts, weights
        n = counts.words
        own, in_class = counts.counts[:n].astype(np.float64), counts.class_of[:n]
        share = own / counts.class_tokens[in_class] if n else own
        totals = np.zeros((FREQUENT + 1, CLASSES))
        for k in range(FREQUENT + 1):
            totals[k] = np.bincount(in_class, weights=pairs[k], minlength=CLASSES)
        self.within = np.log((pairs + PRIOR * share) / (totals[:, in_class] + PRIOR)).astype(np.float32)
        others = counts.distinct - n
        self.rest_log = float(np.log10(counts.rest + SMOOTH * (others + 1)))
        self.base_log = float(np.log10(counts.tokens + SMOOTH * (counts.distinct + 1)))


def gather(rows: DataFrame) -> tuple[DataFrame, Counts]:
    """Counts of all tokens as a table, and the most frequent ones for the tasks."""
    table = session.materialize(rows.select("text").mapInArrow(_count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")), "tokens")
    whole = table.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    top = texts.top_rows(table, texts.count_level(F.col("n")), ["token"], HOT).toPandas().sort_values(["n", "token"], ascending=[False, True])
    return table, Counts(int(whole["n"]), int(whole["v"]), top["token"].to_numpy(dtype=np.int64).view(U64), top["n"].to_numpy(dtype=np.int64))


def train(rows: DataFrame, counts: Counts, key: str = "doc_id") -> Model:
    """Weights from all texts of rows (key, text)."""
    spark = rows.sparkSession
    weights = fresh(counts)
    shapes = [w.shape for w in weights]
    pairs = np.zeros((FREQUENT + 1, counts.words))
    for round_ in range(ROUNDS):
        shared = spark.sparkContext.broadcast((counts, weights))

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            counts, start = shared.value
            own = [w.copy() for w in start]
            seen = [np.zeros(len(w)) for w in own]
            pairs, total = np.zeros((FREQUENT + 1) * counts.words, dtype=np.int64), 0
            for part in texts.chunks(batches):
                hashes, ends = tokens(part.column("text"))
                ids = counts.numbers(hashes)
                ids = np.where((ids < 0) | (ids >= counts.words), counts.words, ids)
                at, passed = context(ids, ends, counts.words, counts.scale)
                classes = counts.class_of[ids]
                top = ids < counts.words
                met, n = np.unique(passed[top] * counts.words + ids[top], return_counts=True)
                pairs[met] += n
                for first in range(0, len(ids), BATCH):
                    cut = slice(first, first + BATCH)
                    learn(own, seen, [x[cut] for x in at], passed[cut], classes[cut])
                total += len(ids)
            if total:
                yield _pieces([*own, pairs / total], float(total))

        part = rows.filter(F.pmod(F.xxhash64(key), F.lit(ROUNDS)) == round_).select("text")
        # as many sets of weights as the corpus has tokens for, however many files hold it
        part = part.coalesce(max(8, counts.tokens // (TASK_TOKENS * counts.scale)))
        # written first, so that no step of the training runs twice
        pieces = session.materialize(part.mapInArrow(work, "piece int, weight double, body binary"), f"weights-{round_}")
        shared.destroy()
        found = _mean(pieces, [*shapes, pairs.shape])
        if found is not None:
            weights = found[0][:-1]
            pairs = pairs + found[0][-1].astype(np.float64) * found[1]
    return Model(counts, weights, pairs)


def score(docs: DataFrame, model: Model, table: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, tokens, known tokens, base score and model score of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType.simpleString()
    arrow = pa.int32() if kind == "int" else pa.int64() if kind == "bigint" else pa.string()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        model, row0 = shared.value, TaskContext.get().partitionId() << 40
        counts = model.counts
        names = ["row", "key", "n_tokens", "n_known", "base", "score", "token", "n"]
        for part in texts.chunks(batches):
            hashes, ends = tokens(part.column("text"))
            ranks = counts.numbers(hashes)
            ids = np.where((ranks < 0) | (ranks >= counts.words), counts.words, ranks)
            at, passed = context(ids, ends, counts.words, counts.scale)
            classes, log = counts.class_of[ids], np.zeros(len(ids))
            for first in range(0, len(ids), BATCH):
                cut = slice(first, first + BATCH)
                logs = class_logs(model.weights, [x[cut] for x in at], passed[cut])
                log[cut] = logs[np.arange(len(logs)), classes[cut]]
            top = ids < counts.words
            log[top] += model.within[passed[top], ids[top]]
            log /= np.log(10)
            hot = ranks >= 0
            own = np.log10(counts.counts[np.maximum(ranks, 0)] + SMOOTH) if len(counts.counts) else np.zeros(len(ranks))
            base = np.where(hot, own, 0.0) - model.base_log
            rest = hot & ~top
            log[rest] += own[rest]
            log[~top] -= model.rest_log
            row_of = np.searchsorted(ends, np.arange(len(ids)))
            n = part.num_rows

            def sums(values: np.ndarray) -> pa.Array:
                return pa.array(np.bincount(row_of, weights=values, minlength=n))

            # (text, token) of the others, each once, with how often
            far = np.flatnonzero(~hot)
            order = far[np.lexsort((hashes[far], row_of[far]))]
            new = np.ones(len(order), dtype=bool)
            new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (row_of[order][1:] != row_of[order][:-1])
            first = np.flatnonzero(new)
            times = np.diff(np.append(first, len(order)))
            rows = row0 + np.arange(n)
            yield pa.RecordBatch.from_arrays([
                pa.array(rows), part.column("key").cast(arrow), pa.array(np.diff(np.concatenate(([-1], ends)))),
                pa.array(np.bincount(row_of[hot], minlength=n)), sums(base), sums(log), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], names)
            m = len(first)
            yield pa.RecordBatch.from_arrays([
                pa.array(rows[row_of[order[first]]]), pa.nulls(m, arrow), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.float64()), pa.nulls(m, pa.float64()),
                pa.array(hashes[order[first]].view(np.int64)), pa.array(times)], names)
            row0 += n

    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    held = session.materialize(rows.mapInArrow(
        work, f"row long, key {kind}, n_tokens long, n_known long, base double, score double, token long, n long"), "scores")
    shared.destroy()
    # the counts of rarer tokens; a token that training lacks counts 0
    far = held.filter("token is not null").select("row", "token", F.col("n").alias("times"))
    log = F.log10(F.coalesce(F.col("n"), F.lit(0)) + F.lit(SMOOTH)) * F.col("times")
    far = far.join(table, "token", "left").groupBy("row").agg(
        F.sum(log).alias("more"), F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(F.lit(0))).alias("known"))
    whole = held.filter("token is null").drop("token", "n").join(far, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    return whole.select(
        F.col("key").alias(key), "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        (F.col("base") + more).alias("base_score"), (F.col("score") + more).alias("score"))


def fit_and_score(docs: DataFrame, learn_from: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores of all texts under a model of those for which the condition holds."""
    rows = docs.filter(learn_from).select(docs[key].alias(key), docs[text].alias("text"))
    table, counts = gather(rows)
    model = train(rows, counts, key)
    return score(docs, model, table, key, text).withColumn("train_tokens", F.lit(counts.tokens).cast("long"))
