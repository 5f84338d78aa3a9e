"""Periodic runs of words, and texts without their repetitions.

A run is a stretch of consecutive words in which words one smallest period apart are equal,
at least two periods and `least` words long, that no neighbouring word extends.

Runs are found on a harmonic grid: for each period q, a run of two periods holds two
neighbouring multiples of q, so it shows at a pair (i, i + q) of the grid as
words that match from there on, and back from there. How far two places match is
asked of a difference cover: of every 31 places the 6 of a perfect difference set
are sampled, so that any two places reach sampled ones after the same few words. Most
pairs differ within these and are done. For the others the suffixes at sampled
places are sorted, by ranks of blocks of 31 words that double in length, and a sparse
table of least common prefixes between neighbours in that order answers how many blocks two
samples share; a few more words end the match. Matches to the left are those of the
reversed words.

The pairs of all periods are n * ln(n) for a text of n words; each is one comparison of
word numbers, done in arrays, unless the words are equal. The suffixes are sorted once
for a chunk of texts, and only when some pair needs them.

Defined cases: a null text has no words, no runs and an empty collapsed text, and so has an empty one or one of
blanks; a text of any length is one piece of work of a task, never cut; equal texts
have equal results; an empty table gives an empty result; other columns stay out. Words
are the same if their bytes are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormledger.llm import texts

#: A perfect difference set: every distance modulo 31 is that of two of its members.
MODULUS = 31
COVER = np.array([1, 5, 11, 24, 25, 27])
#: Words that are compared in any case before the sampled places count.
FEW = 8
#: Periods up to this are tried on all texts of a chunk together.
SHORT = 256
#: Pairs of equal words that are looked at together.
PAIRS = 1 << 18
#: Words whose bytes are put together at a time.
PIECE = 1 << 18


def _first_common() -> np.ndarray:
    """Words from places of two residues to the next pair of sampled places, `FEW` at least."""
    sampled = np.isin(np.arange(MODULUS), COVER)
    a, b, t = np.ogrid[:MODULUS, :MODULUS, FEW:FEW + MODULUS]
    return FEW + (sampled[(a + t) % MODULUS] & sampled[(b + t) % MODULUS]).argmax(axis=2)


_STEPS = _first_common()
_ORDINAL = np.searchsorted(COVER, np.arange(MODULUS))


class Matches:
    """How many words match from two places on. codes: numbers of words, different between texts."""

    def __init__(self, codes: np.ndarray):
        self.n = len(codes)
        # an end that no word equals
        self.codes = np.concatenate((codes, np.full(MODULUS + 1, -1, dtype=codes.dtype)))
        self.place: np.ndarray | None = None

    def direct(self, a: np.ndarray, b: np.ndarray, most: np.ndarray | int) -> np.ndarray:
        """Matching words of two places, at most so many, word by word."""
        out = np.zeros(len(a), dtype=np.int64)
        alive = np.arange(len(a))
        most = np.broadcast_to(most, len(a))
        step = 0
        while len(alive):
            x, y = a[alive] + step, b[alive] + step
            inside = (np.maximum(x, y) < self.n) & (step < most[alive])
            alive, x, y = alive[inside], x[inside], y[inside]
            alive = alive[self.codes[x] == self.codes[y]]
            step += 1
            out[alive] = step
        return out

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Matching words of pairs of different places (a place may be the end)."""
        few = _STEPS[a % MODULUS, b % MODULUS]
        out = self.direct(a, b, few)
        # pairs that came to sampled places
        far = np.flatnonzero((out == few) & (np.maximum(a, b) + few < self.n))
        if len(far):
            x, y = a[far] + few[far], b[far] + few[far]
            whole = self.blocks(x, y) * MODULUS
            out[far] += whole + self.direct(x + whole, y + whole, MODULUS)
        return out

    def _sort(self) -> None:
        """Order of the sampled suffixes by blocks of words, and the sparse table between neighbours."""
        step = len(COVER)
        at = (np.arange(-(-self.n // MODULUS))[:, None] * MODULUS + COVER).ravel()
        at = at[at < self.n]
        m = len(at)
        blocks = np.lib.stride_tricks.sliding_window_view(self.codes, MODULUS)[at]
        marks = np.ascontiguousarray(blocks).view(np.dtype((np.void, blocks.dtype.itemsize * MODULUS))).ravel()
        levels = [np.unique(marks, return_inverse=True)[1].astype(np.int64) + 1]
        del blocks, marks
        while levels[-1].max() < m:
            # the sample 2 ** level blocks on is that many rounds of the cover on
            rank, hop = levels[-1], step << (len(levels) - 1)
            after = np.zeros(m, dtype=np.int64)
            after[:max(0, m - hop)] = rank[hop:]
            levels.append(np.unique(rank * (m + 1) + after, return_inverse=True)[1].astype(np.int64) + 1)
        order = np.argsort(levels[-1], kind="stable")
        self.place = levels[-1] - 1  # all ranks differ
        x, y = order[:-1].copy(), order[1:].copy()
        common = np.zeros(m - 1, dtype=np.int32)
        for level in reversed(range(len(levels) - 1)):
            rank = levels[level]
            inside = np.flatnonzero(np.maximum(x, y) < m)
            same = inside[rank[x[inside]] == rank[y[inside]]]
            common[same] += 1 << level
            x[same] += step << level
            y[same] += step << level
        del levels
        self.table = [common]
        while 2 << (len(self.table) - 1) <= len(common):
            half = 1 << (len(self.table) - 1)
            last = self.table[-1]
            self.table.append(np.minimum(last[:len(last) - half], last[half:]))

    def blocks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whole blocks of words that two sampled places have in common."""
        if self.place is None:
            self._sort()
        x, y = (self.place[p // MODULUS * len(COVER) + _ORDINAL[p % MODULUS]] for p in (a, b))
        low, high = np.minimum(x, y), np.maximum(x, y)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(a), dtype=np.int64)
        for k in np.unique(level).tolist():
            own = np.flatnonzero(level == k)
            out[own] = np.minimum(self.table[k][low[own]], self.table[k][high[own] - (1 << k)])
        return out


def _grid(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) of the grid's pairs with equal words. Texts come by falling size."""
    ends = starts + sizes
    for q in range(1, min(SHORT, int(sizes[0]) // 2) + 1):
        # texts of two periods at least are a prefix of all
        n = ends[np.searchsorted(-sizes, -2 * q, "right") - 1]
        at = np.arange(0, n - q, q)
        at = at[codes[:n - q:q] == codes[q:n:q]]
        yield at, np.full(len(at), q, dtype=np.int64)
    for start, size in zip(starts.tolist(), sizes.tolist(), strict=True):
        if size // 2 <= SHORT:
            return
        own = codes[start:start + size]
        for m in range(size // SHORT):
            # periods for which the pair (m * q, (m + 1) * q) lies in the text
            last = min(size // 2, (size - 1) // (m + 1))
            if last <= SHORT:
                break
            q = np.arange(SHORT + 1, last + 1)
            q = q[own[m * q] == own[(m + 1) * q]]
            yield start + m * q, q


def _batches(pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    n = 0
    for pair in pairs:
        held.append(pair)
        n += len(pair[0])
        if n >= PAIRS:
            yield np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])
            held, n = [], 0
    if n:
        yield np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])


def find(words: np.ndarray, sizes: np.ndarray, least: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word, length and period of all runs, by text, start and period.

    words: numbers of the words of all texts, one text after the other; sizes: words of each text.
    """
    none = np.empty(0, dtype=np.int64)
    order = np.argsort(-sizes, kind="stable")
    by_size = sizes[order]
    if not len(sizes) or not by_size[0]:
        return none, none, none, none
    begin = np.cumsum(sizes) - sizes
    starts = np.cumsum(by_size) - by_size
    text = np.repeat(np.arange(len(order)), by_size)
    inside = np.arange(len(words)) - starts[text]
    # a word's number and its text's: no match passes from text to text
    codes = words[begin[order][text] + inside].astype(np.int64) + text * (int(words.max()) + 1)
    right, left = Matches(codes), Matches(codes[::-1])
    n = len(codes)
    found = [np.empty((3, 0), dtype=np.int64)]
    for at, q in _batches(_grid(codes, starts, by_size)):
        on = right(at, at + q)
        back = left(n - at, n - at - q)
        long = np.flatnonzero(on + back >= np.maximum(q, least - q))
        start = at[long] - back[long]
        new = np.stack((start, on[long] + back[long] + q[long], q[long]))
        # a run shows at each of its grid's pairs, and at multiples of its period
        found.append(np.unique(new, axis=1))
    start, length, q = np.concatenate(found, axis=1)
    first = np.lexsort((q, length, start))
    start, length, q = start[first], length[first], q[first]
    fresh = np.ones(len(start), dtype=bool)
    fresh[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, q = start[fresh], length[fresh], q[fresh]
    row = text[start]
    own = order[row]
    last = np.lexsort((q, start - starts[row], own))
    return own[last], (start - starts[row])[last], length[last], q[last]


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """Words joined by one space each, in pieces."""
    out = []
    for a in range(0, len(starts), PIECE):
        first, size = starts[a:a + PIECE], ends[a:a + PIECE] - starts[a:a + PIECE]
        step = np.cumsum(size + 1)
        at = np.arange(step[-1]) - np.repeat(step - size - 1 - first, size + 1)
        piece = data[np.minimum(at, len(data) - 1)]
        piece[step - 1] = 32
        out.append(piece.tobytes())
    return b"".join(out)[:-1]


def numbered(words: texts.Spans) -> np.ndarray:
    """Equal numbers for equal words."""
    sizes = (words.ends - words.starts).astype(np.int64)
    mark = np.zeros(len(words.data) + 1, dtype=np.int8)
    mark[words.starts] += 1
    mark[words.ends] -= 1
    solid = words.data[np.cumsum(mark[:-1], dtype=np.int8).astype(bool)] if len(words) else words.data[:0]
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(solid.tobytes())])
    return column.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _analysed(part: pa.RecordBatch, least: int) -> pa.RecordBatch:
    data, offsets = texts.raw(part.column("text"))
    words = texts.words(data, offsets)
    edges = words.edges()
    sizes = np.diff(edges)
    row, start, length, period = find(numbered(words), sizes, least)
    # words that some run holds after its first period
    ends = edges[row] + start + length
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(cover, edges[row] + start + period, 1)
    np.add.at(cover, ends, -1)
    kept = np.cumsum(cover[:-1]) == 0
    collapsed = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        own = kept[a:b]
        collapsed.append(_joined(data, words.starts[a:b][own], words.ends[a:b][own]) if b > a else b"")
    times = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(sizes)))))
    runs = pa.StructArray.from_arrays([pa.array(start), pa.array(length), pa.array(period)], ["start", "length", "period"])
    return pa.RecordBatch.from_arrays(
        [part.column("id"), pa.array(sizes), pa.ListArray.from_arrays(pa.array(times.astype(np.int32)), runs), pa.array(collapsed, pa.binary()).cast(pa.string())],
        ["id", "n_words", "runs", "collapsed"])


def runs(docs: DataFrame, key: str = "doc_id", text: Column | str = "text", least: int = 12) -> DataFrame:
    """id, n_words, the runs of each text by start and period, and the text without the words that repeat."""
    rows = docs.select(docs[key].alias("id"), (docs[text] if isinstance(text, str) else text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return texts.map_texts(
        rows, lambda part: _analysed(part, least), f"id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def planted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Column:
    """The text, or its words made periodic from some place on where the id's crc32 is divisible by 10.

    A null id leaves the text as it is.
    """
    mark = F.crc32(docs[key].cast("string").cast("binary"))
    words = F.regexp_extract_all(docs[text], F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n, g = F.size(words).cast("long"), F.floor(mark / 10).cast("long")
    at = g % n
    period = F.lit(1) + F.floor((n - at) / (F.lit(3) + g % 8)).cast("long")
    times = F.ceil((n - at) / period).cast("int")
    again = F.slice(F.flatten(F.array_repeat(F.slice(words, (at + 1).cast("int"), period.cast("int")), times)), 1, (n - at).cast("int"))
    made = F.array_join(F.concat(F.slice(words, F.lit(1), at.cast("int")), again), " ")
    return F.when((mark % 10 == 0) & (n > 0), made).otherwise(docs[text])


def digests(found: DataFrame) -> DataFrame:
    """Number of runs, the longest one, and digests of all runs and of the collapsed text."""
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("a"), r["start"].alias("start"), r["period"].alias("period"))))
    shown = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    length = -best["a"]
    return found.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), length.alias("length"),
        best["period"].alias("period"), F.floor(length * 1000 / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(shown, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
