"""Whole texts as arrays: words, lines and hashes of an Arrow text column.

A word is a run of characters other than space and U+0009 to U+000D. These are
single bytes of UTF-8 that occur in no other character, so words are found in
the bytes. Hashes are 64 bits: a polynomial over a fixed random table, mixed.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
import time
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text that are worked on at a time; a longer text is taken alone.
CHUNK_BYTES = 1 << 20
U64 = np.uint64
_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads all bits."""
    values = (values ^ (values >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> U64(27))) * U64(0x94D049BB133111EB)
    return values ^ (values >> U64(31))


_BYTES = mix(np.arange(1, 257, dtype=U64) * U64(_MULTIPLIER))


@functools.lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse below 2 ** bits."""
    out = []
    for base in (_MULTIPLIER, _INVERSE):
        row = np.ones(1 << bits, dtype=U64)
        row[1:] = U64(base)
        out.append(np.cumprod(row, dtype=U64))
    return out[0], out[1]


class Spans:
    """Byte spans of a chunk with the text each belongs to."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, n_rows: int):
        self.data, self.starts, self.ends, self.rows, self.n_rows = data, starts, ends, rows, n_rows

    def __len__(self) -> int:
        return len(self.starts)

    def per_row(self) -> np.ndarray:
        """Spans of each text."""
        return np.bincount(self.rows, minlength=self.n_rows).astype(np.int64)

    def edges(self) -> np.ndarray:
        """Index of each text's first span, and the end."""
        return np.concatenate(([0], np.cumsum(self.per_row())))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each span's bytes."""
        return span_hashes(self.data, self.starts, self.ends)

    def content(self, index: int) -> bytes:
        """Bytes of one span."""
        return self.data[self.starts[index]:self.ends[index]].tobytes()


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span; equal spans have equal hashes."""
    if not len(starts):
        return np.empty(0, dtype=U64)
    up, down = _powers(max(20, int(len(data)).bit_length()))
    sums = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum(_BYTES[data] * up[:len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of at most `limit` bytes of text, or of one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        sums = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            done = sums[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(sums, done + limit, "right")))
            yield batch.slice(at, end - at)
            at = end


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, and each text's offset in them; null counts as empty."""
    texts = pc.fill_null(texts, "") if texts.null_count else texts
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    if not len(texts) or offsets is None:
        return np.empty(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    body = np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]] if data is not None else np.empty(0, dtype=np.uint8)
    return body, at - at[0]


def blanks(data: np.ndarray) -> np.ndarray:
    """True at the bytes that separate words."""
    return (data == 32) | ((data >= 9) & (data <= 13))


def words(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray | None = None) -> Spans:
    """Words of each text. gap: another choice of the separating bytes."""
    gap = blanks(data) if gap is None else gap
    n, inner = len(data), offsets[1:-1]
    inner = inner[inner < n]
    before, after = np.ones(n, dtype=bool), np.ones(n, dtype=bool)
    before[1:], after[:-1] = gap[:-1], gap[1:]
    before[inner] = True
    after[inner[inner > 0] - 1] = True
    starts = np.flatnonzero(~gap & before)
    ends = np.flatnonzero(~gap & after) + 1
    return Spans(data, starts, ends, np.searchsorted(offsets, starts, "right") - 1, len(offsets) - 1)


def lines(data: np.ndarray, offsets: np.ndarray) -> Spans:
    """Parts of each text between line feeds; an empty text has one empty line."""
    feeds = np.flatnonzero(data == 10)
    starts = np.concatenate((offsets[:-1], feeds + 1))
    rows = np.concatenate((np.arange(len(offsets) - 1), np.searchsorted(offsets, feeds, "right") - 1))
    order = np.lexsort((starts, rows))
    starts, rows = starts[order], rows[order]
    ends = np.empty_like(starts)
    ends[:-1] = np.where(rows[:-1] == rows[1:], starts[1:] - 1, offsets[rows[:-1] + 1])
    if len(ends):
        ends[-1] = offsets[-1]
    return Spans(data, starts, ends, rows, len(offsets) - 1)


def windows(hashes: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every n consecutive spans of a text, and the index of each first one."""
    if len(hashes) < n:
        return np.empty(0, dtype=U64), np.empty(0, dtype=np.int64)
    out = hashes[:len(hashes) - n + 1].copy()
    for k in range(1, n):
        out = out * U64(_MULTIPLIER) + hashes[k:len(hashes) - n + 1 + k]
    first = np.flatnonzero(rows[:len(rows) - n + 1] == rows[n - 1:])
    return mix(out[first]), first


def sums_between(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of flags in each span."""
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[ends] - total[starts]


def string_array(data: bytes | np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Arrow strings from their bytes."""
    body = data.tobytes() if isinstance(data, np.ndarray) else data
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(body))


def fold(key: str, modulus: int) -> Column:
    """crc32 of a key as text, modulo the number of folds."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % F.lit(modulus)


def fold_of(key: int, modulus: int) -> int:
    """The same for one key."""
    return zlib.crc32(str(key).encode()) % modulus


def top_rows(df: DataFrame, level: Column, tie: list[str], size: int) -> DataFrame:
    """The `size` rows of the highest levels; of the level that does not fit whole, those of the smallest hashes of `tie`.

    level: whole numbers of few distinct values, whose counts reach the driver. Unlike
    a sort with a limit this sends no rows of every partition to one place.
    """
    counts = df.groupBy(level.cast("long").alias("level")).count().filter("level is not null").collect()
    total = 0
    for row in sorted(counts, reverse=True):
        if total + row["count"] > size:
            above, rest = df.filter(level > row["level"]), df.filter(level == row["level"])
            return above.unionByName(smallest_hashes(rest, tie, size - total))
        total += row["count"]
    return df.filter(level.isNotNull())


def smallest_hashes(df: DataFrame, keys: list[str], size: int) -> DataFrame:
    """The `size` rows of the smallest hashes of their keys: a sample in a fixed order, at most so many whatever the input.

    Counts of 16 bits of the hash at a time, 65,536 at most, reach the driver; only
    rows of one hash, of equal keys that is, are cut off by their number.
    """
    hashed, out = F.xxhash64(*keys), df.limit(0)
    for shift in (48, 32, 16, 0):
        cell = F.shiftrightunsigned(hashed, shift).bitwiseAND(F.lit(0xFFFF))
        counts = df.groupBy(cell.alias("cell")).count().collect()
        room, cut = size, None
        for row in sorted(counts):
            if row["count"] > room:
                cut = row["cell"]
                break
            room -= row["count"]
        if cut is None:
            return out.unionByName(df)
        out, df, size = out.unionByName(df.filter(cell < cut)), df.filter(cell == cut), room
        if not size:
            return out
    return out.unionByName(df.limit(size))


def count_level(n: Column) -> Column:
    """Counts in steps of a 64th of a power of two."""
    return F.floor(F.log2(n) * 64)


def release() -> None:
    """Give memory that is no longer used back to the machine; a worker process outlives its tasks."""
    _powers.cache_clear()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


_released = 0.0


def release_at_times() -> None:
    """The same, if this process has not done so in the last fifth of a second."""
    global _released
    if time.monotonic() >= _released + 0.2:
        release()
        _released = time.monotonic()


def tidy_groups(work: Callable) -> Callable:
    """A function of groups, with memory given back between them: nothing tells it a task's end."""
    def run(group):
        out = work(group)
        release_at_times()
        return out

    return run


def tidy(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same function of batches, with memory given back at a task's end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        release()

    return run


def map_texts(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, text: str = "text") -> DataFrame:
    """Apply a function to chunks of rows, text by text whole."""
    return df.mapInArrow(tidy(lambda batches: (work(part) for part in chunks(batches, text))), schema)


def keep_texts(df: DataFrame, verdict: Callable[[pa.RecordBatch], np.ndarray], text: str = "text") -> DataFrame:
    """Rows for which a function of chunks says True; all columns pass unchanged.

    Columns are renamed by position meanwhile, so that any names may occur.
    """
    names = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    at = f"c{names.index(text)}"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, at):
            yield part.filter(pa.array(verdict(part.rename_columns(
                ["text" if c == at else f"_{c}" for c in part.schema.names]))))

    return plain.mapInArrow(tidy(work), plain.schema).toDF(*names)


class Memory:
    """Numbers of distinct spans that were met before, by hash; forgets all when full."""

    def __init__(self, limit: int):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.keys, self.numbers = np.empty(0, dtype=U64), np.empty(0, dtype=np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each hash; -1 for new ones."""
        if not len(self.keys):
            return np.full(len(hashes), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, self.numbers[at], -1)

    def full(self, more: int) -> bool:
        return len(self.keys) + more > self.limit

    def add(self, hashes: np.ndarray, numbers: np.ndarray) -> None:
        """Remember new hashes, given in ascending order."""
        keys = np.concatenate((self.keys, hashes))
        order = np.argsort(keys, kind="stable")  # two runs in order: a merge
        self.keys, self.numbers = keys[order], np.concatenate((self.numbers, numbers))[order]
