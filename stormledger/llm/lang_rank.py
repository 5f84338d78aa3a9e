"""Language identification by rank-order profiles.

A text's characters are lower-cased; each run of other characters than letters
is one word end. Its grams are the one to three character runs inside words,
word ends included. The most frequent `size` grams, ties by code, in order of
frequency are its profile; a language's profile comes in the same way from all
its training texts together. The distance of two profiles sums, over the text's
grams, how far each gram is out of place; a gram the language lacks counts
`size`. The nearest language wins, ties to the smaller name.

Defined cases: a null text or one without a letter is `und` with score 0; so is
every text if there is no training row. A null language never trains. Repeated
rows give repeated results and train repeatedly; an empty table gives an empty
result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stormledger.llm import texts

UNKNOWN = "und"
SIZE = 300
#: Grams that a task holds before it hands its counts on.
HELD = 400_000
_END = 1
_codes = np.full(0x110000, -1, dtype=np.int64)


def _letters(text: str) -> np.ndarray:
    """Codes of a text: a letter's lower case plus 2, or one word end for a run of others."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = _codes[points]
    if len(codes) and codes.min() < 0:
        for point in np.unique(points[codes < 0]).tolist():
            c = chr(point)
            _codes[point] = ord(c.lower()[0]) + 2 if c.isalpha() else _END
        codes = _codes[points]
    codes = np.concatenate(([_END], codes, [_END]))
    stay = np.ones(len(codes), dtype=bool)
    stay[1:] = (codes[1:] != _END) | (codes[:-1] != _END)
    return codes[stay]


def grams(text: str | None) -> np.ndarray:
    """Codes of all grams of a text; empty if it has no letter."""
    codes = _letters(text or "")
    if len(codes) < 3:
        return np.empty(0, dtype=np.int64)
    two = (codes[:-1] << 21) | codes[1:]
    three = ((two[:-1] << 21) | codes[2:])[codes[1:-1] != _END]
    return np.concatenate((codes[codes != _END], two, three))


def profile(keys: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The most frequent grams, most frequent first."""
    values, n = np.unique(keys, return_counts=True)
    return values[np.argsort(-n, kind="stable")[:size]]


class Profiles:
    """Profiles of all languages as one table of ranks."""

    def __init__(self, by_lang: dict[str, np.ndarray], size: int = SIZE):
        self.size, self.langs = size, sorted(by_lang)
        self.keys = np.unique(np.concatenate([np.empty(0, dtype=np.int64), *by_lang.values()]))
        self.ranks = np.full((len(self.langs), len(self.keys) + 1), size, dtype=np.int64)
        for row, lang in enumerate(self.langs):
            self.ranks[row, np.searchsorted(self.keys, by_lang[lang])] = np.arange(len(by_lang[lang]))

    def nearest(self, text: str | None) -> tuple[str, float]:
        """The nearest language and its score: 1 less the distance over the largest possible one."""
        own = profile(grams(text), self.size)
        if not len(own) or not self.langs:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.keys, own), len(self.keys) - 1)
        at[self.keys[at] != own] = len(self.keys)
        known = self.ranks[:, at]
        far = np.where(known == self.size, self.size, np.abs(known - np.arange(len(own)))).sum(axis=1)
        best = int(far.argmin())
        return self.langs[best], 1.0 - float(far[best]) / (len(own) * self.size)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Gram counts by language, summed as far as memory allows."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def merged() -> dict[str, tuple[np.ndarray, np.ndarray]]:
        out = {}
        for lang, parts in held.items():
            keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            out[lang] = keys, np.bincount(where, weights=np.concatenate([n for _, n in parts]))
        return out

    def rows(found: dict[str, tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for lang, (keys, n) in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    loose = 0
    for part in texts.chunks(batches):
        by_lang: dict[str, list[np.ndarray]] = {}
        for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
            by_lang.setdefault(lang, []).append(grams(text))
        for lang, found in by_lang.items():
            keys, n = np.unique(np.concatenate(found), return_counts=True)
            held.setdefault(lang, []).append((keys, n))
            loose += len(keys)
        if loose > HELD:
            found = merged()
            loose = sum(len(k) for k, _ in found.values())
            if loose > HELD // 2:
                yield from rows(found)
                held, loose = {}, 0
            else:
                held = {lang: [x] for lang, x in found.items()}
    yield from rows(merged())


def train(rows: DataFrame, lang: str = "lang", text: str = "text", size: int = SIZE) -> Profiles:
    """Profiles from all rows with a language. The driver gets `size` grams of each language."""
    pairs = rows.filter(rows[lang].isNotNull()).select(rows[lang].alias("lang"), rows[text].alias("text"))
    counts = pairs.mapInArrow(texts.tidy(_counts), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)
    found: dict[str, list[int]] = {}
    for row in sorted(top.select("lang", "rank", "gram").collect()):
        found.setdefault(row["lang"], []).append(row["gram"])
    return Profiles({k: np.array(v, dtype=np.int64) for k, v in found.items()}, size)


def predict(docs: DataFrame, profiles: Profiles, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, predicted language and score of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        found = [shared.value.nearest(t) for t in part.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [part.column("key"), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
            ["key", "lang_pred", "score"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    return texts.map_texts(rows, work, f"key {kind}, lang_pred string, score double").withColumnRenamed("key", key)


def known(docs: DataFrame, profiles: Profiles, min_score: float, text: str = "text") -> DataFrame:
    """Rows whose text has a language with at least this score; all columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    def verdict(part: pa.RecordBatch) -> np.ndarray:
        found = [shared.value.nearest(t) for t in part.column("text").to_pylist()]
        return np.array([lang != UNKNOWN and score >= min_score for lang, score in found], dtype=bool)

    return texts.keep_texts(docs, verdict, text)
