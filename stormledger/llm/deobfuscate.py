"""Toxicity of texts after undoing obfuscation.

Noisy channel: a token in which letters are replaced by look-alikes, drawn out
or set apart is seen as a lattice. Each observed character offers the letters it
may stand for, nothing (a drawn-out letter, a mark between letters), or a word
end; a digit or a currency sign may also stay what it is where no letter
stands, and a separator unlike the usual one of its token is rather a word end. The
cheapest path under a trigram character model of the corpus, plus a cost for each
kind of edge, is the restored token; one without letters stays. Every token with a sign of obfuscation goes through the lattice
whole, whatever its length: one with a look-alike and a letter or with two
look-alikes, a drawn-out letter or marks between; and every chain of three or more
single characters with any blanks between them. Others stay.

Score: a logistic model over the words of the restored text and their first four,
five, seven and nine bytes, each as there once, twice, four times or not. It is
fitted on a bounded sample of
labelled rows (at most `SAMPLE` of either class, by a hash of the id); the
character model counts every text that may be learnt from.

Defined cases: null counts as empty text; a text without any selected feature
gets the score of the bias alone; without toxic or without other labels the
score is the smoothed share of toxic rows; repeated rows give repeated results;
an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormledger import session
from stormledger.llm import texts

SAMPLE = 10_000
#: Features that may be selected, those counted on the other class, and the least ratio of their rates.
FEATURES = 1024
CANDIDATES = 20_000
RATIO = 4.0
MIN_SUPPORT = 0.002

#: Letters that a character may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "*": "aeiou",
}
SEPARATORS = " .-_*~"
COST_LOOKALIKE, COST_DROP_REPEAT, COST_DROP_PAIR, COST_DROP_MARK, COST_END, COST_CLOSE = 1.0, 0.7, 5.0, 0.3, 8.0, 0.3
#: A digit or currency sign as it is, in tokens without letters; a separator unlike the token's usual one, dropped.
STAYING = "0123456789€£"
COST_STAY, COST_DROP_UNLIKE = 2.0, 4.0
#: Longer tokens are not remembered.
REMEMBERED = 256

_END, _OTHER = 0, 27
CLASSES = 28
_class_of = np.zeros(256, dtype=np.int64)
_class_of[97:123] = np.arange(1, 27)
_class_of[65:91] = np.arange(1, 27)
_class_of[128:] = _OTHER
_LETTER = _class_of > 0
_LOOKALIKE = np.isin(np.arange(256), [ord(c) for c in LOOKALIKES if ord(c) < 128])
#: Look-alikes of several bytes.
_WIDE = [c.encode() for c in LOOKALIKES if ord(c) >= 128]
_MARK = np.isin(np.arange(256), [ord(c) for c in ".-_*~"])


class CharModel:
    """Costs of a character after the two before it, from trigram counts."""

    def __init__(self, counts: np.ndarray):
        table = counts.reshape(CLASSES, CLASSES, CLASSES) + 0.5
        self.cost = (np.log(table.sum(axis=2, keepdims=True)) - np.log(table)).tolist()

    def step(self, a: int, b: int, c: int) -> float:
        return self.cost[a][b][c]


def trigram_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of three character classes in a row, each text between word ends."""
    codes = _class_of[data]
    padded = np.insert(codes, np.concatenate((offsets[:-1], offsets[1:])), _END)
    triples = (padded[:-2] * CLASSES + padded[1:-1]) * CLASSES + padded[2:]
    return np.bincount(triples, minlength=CLASSES ** 3)


def char_model(docs: DataFrame, text: str = "text") -> CharModel:
    """The character model of all texts; the driver gets one count for each of 28 ** 3 trigrams."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES ** 3, dtype=np.int64)
        for part in texts.chunks(batches):
            total += trigram_counts(*texts.raw(part.column("text")))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["gram", "n"])

    counts = np.zeros(CLASSES ** 3)
    rows = docs.select(docs[text].alias("text")).mapInArrow(texts.tidy(work), "gram long, n long")
    for gram, n in rows.groupBy("gram").agg(F.sum("n")).collect():
        counts[gram] = n
    return CharModel(counts)


_GAP = re.compile(r"[ ._~-]+")


def _options(token: str) -> list[list[tuple[str | None, float]]]:
    """The lattice: what each character may stand for, at which cost; None is nothing, a space a word end."""
    out = []
    alnum = [at for at, c in enumerate(token) if c.isalnum()]
    plain = any(c.isalpha() for c in token)
    first, last = (alnum[0], alnum[-1]) if alnum else (len(token), -1)
    # the separator that is usual in the token; where another stands is rather a word end
    gaps = [(m.start(), m[0]) for m in _GAP.finditer(token)]
    times = Counter(gap for _, gap in gaps)
    usual = max(times.values(), default=0)
    unlike = {at for at, gap in gaps if usual > max(1, times[gap])}
    for at, c in enumerate(token):
        found: list[tuple[str | None, float]] = []
        if c.isalpha():
            found.append((c, 0.0))
            if at and token[at - 1] == c:
                # two of a letter are mostly meant, three are not
                drawn = token[at + 1:at + 2] == c or at > 1 and token[at - 2] == c
                found.append((None, COST_DROP_REPEAT if drawn else COST_DROP_PAIR))
        else:
            found += [(x, COST_LOOKALIKE) for x in LOOKALIKES.get(c, "")]
            if at and token[at - 1] == c and c in LOOKALIKES:
                found.append((None, COST_DROP_REPEAT))
            if c in SEPARATORS and 0 < at < len(token) - 1:
                found.append((None, COST_DROP_UNLIKE if at in unlike else COST_DROP_MARK))
            if c in STAYING and not plain:
                found.append((c, COST_STAY))
            closing = c not in "0123456789@$€£" and at > last or c in "(*" and at < first
            found.append((" ", COST_CLOSE if closing or at in unlike else COST_END if c in LOOKALIKES and c != "*" else COST_END / 2))
        out.append(found)
    return out


def _class(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else _END if c.isascii() else _OTHER


def decode(token: str, model: CharModel) -> str:
    """The cheapest path through the lattice of a lower-case token; equal costs keep the first found."""
    # a path is its last character and the path before, shared by all that go on from it
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(_END, _END): (0.0, None)}
    for options in _options(token):
        after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (cost, path) in states.items():
            for c, price in options:
                if c is None:
                    key, total, grown = (a, b), cost + price, path
                else:
                    k = _class(c)
                    key, total, grown = (b, k), cost + price + model.step(a, b, k), (c, path)
                if key not in after or total < after[key][0]:
                    after[key] = (total, grown)
        states = after
    path = min(((cost + model.step(a, b, _END), path) for (a, b), (cost, path) in states.items()), key=lambda x: x[0])[1]
    out = []
    while path is not None:
        c, path = path
        out.append(c)
    return "".join(reversed(out))


def _width(first: np.ndarray) -> np.ndarray:
    """Bytes of the characters that begin with these bytes."""
    return 1 + (first >= 0xC0) + (first >= 0xE0).astype(np.int64) + (first >= 0xF0)


def suspects(words: texts.Spans) -> list[tuple[int, int]]:
    """Byte ranges of a chunk to decode, in order and apart: single words, or chains of single characters."""
    data = words.data
    if not len(words):
        return []
    sizes = words.ends - words.starts
    letters = texts.sums_between(_LETTER[data], words.starts, words.ends)
    sign = _LOOKALIKE[data]
    for wide in _WIDE:
        here = np.ones(max(0, len(data) - len(wide) + 1), dtype=bool)
        for k, byte in enumerate(wide):
            here &= data[k:len(here) + k] == byte
        at = np.flatnonzero(here)
        sign[at] = True
        # its bytes are no letters
        letters -= len(wide) * np.bincount(np.searchsorted(words.starts, at, "right") - 1, minlength=len(words))
    alike = texts.sums_between(sign, words.starts, words.ends)
    run = np.zeros(len(data), dtype=bool)
    folded = texts.LOWER[data]
    run[2:] = (folded[2:] == folded[1:-1]) & (folded[1:-1] == folded[:-2]) & _LETTER[data[2:]] & (data[2:] < 128)
    drawn = texts.sums_between(run, words.starts, words.ends) > 0
    marks = texts.sums_between(_MARK[data], words.starts, words.ends - (sizes > 1))
    odd = (alike > 0) & (letters + alike >= 2) | (letters > 0) & (drawn | (marks >= 2))
    single = (sizes == 1) & (letters > 0) | (alike == 1) & (letters == 0) & (sizes == _width(data[words.starts]))
    # chains: at least three single characters one after the other, of one text
    joined = np.zeros(len(words), dtype=bool)
    joined[1:] = single[1:] & single[:-1] & (words.rows[1:] == words.rows[:-1])
    head = single & ~joined
    chain = np.cumsum(head) * single
    length = np.bincount(chain, minlength=1)
    first = np.flatnonzero(head)
    long = length[chain[first]] >= 3
    out = [(int(words.starts[i]), int(words.ends[i + n - 1])) for i, n in zip(first[long], length[chain[first]][long])]
    out += [(int(words.starts[i]), int(words.ends[i])) for i in np.flatnonzero(odd & ~single)]
    return sorted(out)


class Restorer:
    """Restores chunks of texts; remembers tokens."""

    def __init__(self, model: CharModel):
        remembered = functools.lru_cache(maxsize=100_000)(lambda token: decode(token, model))
        self.token = lambda token: remembered(token) if len(token) <= REMEMBERED else decode(token, model)

    def chunk(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and offsets of the restored, lower-cased texts."""
        found = suspects(texts.words(data, offsets))
        body = texts.LOWER[data].tobytes()
        if not found:
            return np.frombuffer(body, dtype=np.uint8), offsets
        parts, at, grown = [], 0, np.zeros(len(offsets), dtype=np.int64)
        for start, end in found:
            token = body[start:end].decode()
            new = self.token(token)
            # what has no letters as restored is a number or marks, and stays
            new = new.encode() if any(c.isalpha() for c in new) else body[start:end]
            parts += [body[at:start], new]
            at = end
            grown[np.searchsorted(offsets, start, "right")] += len(new) - (end - start)
        parts.append(body[at:])
        return np.frombuffer(b"".join(parts), dtype=np.uint8), offsets + np.cumsum(grown)


_PREFIXES = (4, 5, 7, 9)
#: Times that a word or beginning occurs in a text; each is a feature of its own once reached.
LEVELS = (1, 2, 4)


def _single(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with one letter for each run of it: doubled ones may be meant or not."""
    again = np.zeros(len(data), dtype=bool)
    again[1:] = (data[1:] == data[:-1]) & _LETTER[data[1:]] & (data[1:] < 128)
    again[offsets[:-1][offsets[:-1] < len(data)]] = False
    return data[~again], np.concatenate(([0], np.cumsum(~again)))[offsets]


def stems(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and word beginnings of restored texts, with the text of each."""
    data, offsets = _single(data, offsets)
    words = texts.words(data, offsets, ~_LETTER[data])
    keys, rows = [words.hashes()], [words.rows]
    for n in _PREFIXES:
        has = np.flatnonzero(words.ends - words.starts >= n)
        keys.append(texts.mix(texts.span_hashes(words.data, words.starts[has], words.starts[has] + n) + texts.U64(n)))
        rows.append(words.rows[has])
    return np.concatenate(keys), np.concatenate(rows)


def features(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of (text, stem) pairs, with the text and the stem of each."""
    order = np.lexsort((keys, rows))
    keys, rows = keys[order], rows[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(keys)))
    reached = [first[times >= n] for n in LEVELS]
    found = [texts.mix(keys[at] + texts.U64(n)) for n, at in zip(LEVELS, reached, strict=True)]
    at = np.concatenate(reached)
    return np.concatenate(found), rows[at], keys[at]


class Scorer:
    """A fitted model: sorted feature hashes and the stems they are of, weights and a bias."""

    def __init__(self, chars: CharModel, keys: np.ndarray, stems: np.ndarray, weights: np.ndarray, bias: float):
        self.chars, self.keys, self.stems, self.weights, self.bias = chars, keys, stems, weights, bias

    def present(self, part: pa.RecordBatch, restorer: Restorer) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of text and selected feature, each once."""
        if not len(self.keys):
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        keys, rows = stems(*restorer.chunk(*texts.raw(part.column("text"))))
        near = np.minimum(np.searchsorted(self.stems, keys), len(self.stems) - 1)
        wanted = self.stems[near] == keys
        keys, rows, _ = features(keys[wanted], rows[wanted])
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = self.keys[at] == keys
        return rows[hit], at[hit]

    def scores(self, part: pa.RecordBatch, restorer: Restorer) -> np.ndarray:
        rows, which = self.present(part, restorer)
        total = self.bias + np.bincount(rows, weights=self.weights[which], minlength=part.num_rows)
        return 1.0 / (1.0 + np.exp(-np.clip(total, -60, 60)))


def _counted(rows: DataFrame, chars: CharModel, only: np.ndarray | None) -> DataFrame:
    """Texts that have each feature, with its stem; only: sorted features to count."""
    shared = rows.sparkSession.sparkContext.broadcast((chars, only))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chars, only = shared.value
        restorer = Restorer(chars)
        for part in texts.chunks(batches):
            found, _, stem = features(*stems(*restorer.chunk(*texts.raw(part.column("text")))))
            if only is not None:
                hit = np.isin(found, only)
                found, stem = found[hit], stem[hit]
            values, first, n = np.unique(found, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(stem[first].view(np.int64)), pa.array(n)], ["feature", "stem", "n"])

    counted = rows.select("text").mapInArrow(texts.tidy(work), "feature long, stem long, n long")
    return counted.groupBy("feature").agg(F.first("stem").alias("stem"), F.sum("n").alias("n"))


def _logistic(rows: list[list[int]], labels: np.ndarray, width: int, share: float) -> tuple[np.ndarray, float]:
    """Weights and bias by gradient descent with momentum on a bounded presence matrix.

    share: what the toxic rows weigh of the whole.
    """
    x = np.zeros((len(rows), width), dtype=np.float32)
    for k, found in enumerate(rows):
        x[k, found] = 1.0
    each = np.where(labels > 0, share / labels.sum(), (1 - share) / (1 - labels).sum()).astype(np.float32)
    w, b, vw, vb = np.zeros(width, dtype=np.float32), 0.0, np.zeros(width, dtype=np.float32), 0.0
    for _ in range(600):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w + b, -30, 30)))
        g = (p - labels) * each
        vw = 0.9 * vw + x.T @ g + 2e-5 * w
        vb = 0.9 * vb + float(g.sum())
        w, b = w - 2.0 * vw, b - 2.0 * vb
    return w.astype(np.float64), float(b)


def fit(rows: DataFrame, marks: DataFrame, chars: CharModel, sample: int = SAMPLE) -> Scorer:
    """The model of rows (doc_id, text) and their labels (doc_id, toxic); all may be learnt from."""
    spark = rows.sparkSession
    ids = {}
    for label in (0, 1):
        own = texts.smallest_hashes(marks.filter(F.col("toxic") == label).select("doc_id"), ["doc_id"], sample)
        ids[label] = [r[0] for r in own.collect()]
    n = {k: len(v) for k, v in ids.items()}
    whole = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    share = (whole.get(1, 0) + 0.5) / (whole.get(0, 0) + whole.get(1, 0) + 1.0)
    none = np.empty(0, dtype=texts.U64)
    unfitted = Scorer(chars, none, none, np.empty(0), float(np.log(share / (1 - share))))
    if not n[0] or not n[1]:
        return unfitted

    # the sampled ids are few, so the texts need not move
    chosen = spark.createDataFrame([(i, label) for label in ids for i in set(ids[label])], "doc_id long, toxic int")
    sampled = session.materialize(rows.join(F.broadcast(chosen), "doc_id"), "sampled").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))

    def drawn(label: int) -> DataFrame:
        return sampled.filter(F.col("toxic") == label)

    toxic = _counted(drawn(1), chars, None).filter(F.col("n") >= max(2, MIN_SUPPORT * n[1]))
    top = texts.top_rows(session.materialize(toxic, "features"), texts.count_level(F.col("n")), ["feature"], CANDIDATES).collect()
    there, stem_of = {r["feature"]: r["n"] for r in top}, {r["feature"]: r["stem"] for r in top}
    keys = np.sort(np.array(list(there), dtype=np.int64).view(texts.U64))
    other = {r["feature"]: r["n"] for r in _counted(drawn(0), chars, keys).collect()}
    rate = {k: (v / n[1]) / ((other.get(k, 0) + 0.5) / n[0]) for k, v in there.items()}
    best = sorted((k for k in rate if rate[k] >= RATIO), key=lambda k: (-rate[k] * there[k], k))[:FEATURES]
    if not best:
        return unfitted
    chosen = np.unique(np.array([stem_of[k] for k in best], dtype=np.int64).view(texts.U64))
    scorer = Scorer(chars, np.sort(np.array(best, dtype=np.int64).view(texts.U64)), chosen, np.empty(0), 0.0)
    shared = spark.sparkContext.broadcast(scorer)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(shared.value.chars)
        for part in texts.chunks(batches):
            where, which = shared.value.present(part, restorer)
            found: list[list[int]] = [[] for _ in range(part.num_rows)]
            for a, b in zip(where.tolist(), which.tolist()):
                found[a].append(b)
            yield pa.RecordBatch.from_arrays([part.column("toxic"), pa.array(found, pa.list_(pa.int32()))], ["toxic", "found"])

    held = sorted((r["toxic"], r["found"]) for r in sampled.select("toxic", "text").mapInArrow(texts.tidy(work), "toxic int, found array<int>").collect())
    scorer.weights, scorer.bias = _logistic([x[1] for x in held], np.array([x[0] for x in held], dtype=np.float32), len(best), share)
    return scorer


def train(docs: DataFrame, labels: DataFrame, learn: Column, key: str = "doc_id", text: str = "text") -> Scorer:
    """Character model and classifier from the rows for which `learn` holds."""
    rows = docs.filter(learn).select(docs[key].alias("doc_id"), docs[text].alias("text"))
    # of several labels of one document the larger counts
    marks = labels.filter("toxic is not null").groupBy(F.col("doc_id")).agg(F.max("toxic").alias("toxic"))
    ids = docs.filter(learn).select(docs[key].alias("doc_id")).join(marks, "doc_id")
    return fit(rows, session.materialize(ids, "labelled"), char_model(rows))


def score(docs: DataFrame, scorer: Scorer, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and score of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)
    kind = docs.schema[key].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(shared.value.chars)
        for part in texts.chunks(batches):
            yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(shared.value.scores(part, restorer))], ["key", "score"])

    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    return rows.mapInArrow(texts.tidy(work), f"key {kind}, score double").withColumnRenamed("key", key)


def clean(docs: DataFrame, scorer: Scorer, limit: float = 0.5, text: str = "text") -> DataFrame:
    """Rows that score below the limit; all columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)
    own: list[Restorer] = []  # one for each task, which gets its own copy of the empty list

    def verdict(part: pa.RecordBatch) -> np.ndarray:
        if not own:
            own.append(Restorer(shared.value.chars))
        return shared.value.scores(part, own[0]) < limit

    return texts.keep_texts(docs, verdict, text)


def restore(docs: DataFrame, chars: CharModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and restored, lower-cased text of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(chars)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(shared.value)
        for part in texts.chunks(batches):
            data, offsets = restorer.chunk(*texts.raw(part.column("text")))
            yield pa.RecordBatch.from_arrays([part.column("key"), texts.string_array(data, offsets)], ["key", "text"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    return rows.mapInArrow(texts.tidy(work), f"key {kind}, text string").toDF(key, text)
