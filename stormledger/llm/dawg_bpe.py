"""BPE encoding by a minimal acyclic transducer over frequent words.

The most frequent words of the corpus, with their token ids, are compiled into
an automaton whose equal suffixes are shared. Each edge carries how many words
sort before it, so that the sum along a path numbers the word, and the number
leads to its ids. The automaton is one flat file that tasks map into memory. A
word it lacks is split and merged exactly, with the vocabulary's own ranks.

Words are cut at ASCII blanks, which every split rule of the vocabulary cuts at
too, so ids of a text are the ids of its words in a row. A-Z are lower-cased
first, as the vocabulary's normalizer does.

Defined cases: null counts as an empty text, which has no ids and decodes to
empty text; the strings of special tokens become their ids, as in the tokenizers
library; repeated rows give repeated results; an empty table gives an empty
result; further columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import mmap
import tempfile
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormledger import session
from stormledger.llm import texts

#: Words of the lexicon, and the longest word in it, in bytes.
LEXICON_WORDS = 1 << 16
LEXICON_BYTES = 64
#: Words that a task remembers, or counts before it hands its counts on.
HELD = 400_000
CHUNK_BYTES = 4 << 20
#: Special tokens begin so; words that hold it stay out of the lexicon.
MARK = b"<|"
#: Pieces up to so many bytes are merged side by side; longer ones alone.
SIDE_BYTES = 64
_NONE = 1 << 30


class Vocabulary:
    """Ids and merge ranks of a tokenizer file with word ends, and its split rule."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.ids: dict[str, int] = dict(model["vocab"])
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.tokens = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        self.split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        longest = sorted(map(regex.escape, self.special), key=len, reverse=True)
        self.marked = regex.compile("(" + "|".join(longest) + ")") if longest else None
        letters = byte_letters()
        self.bytes = np.array([self.ids.get(c, -1) for c in letters], dtype=np.int64)
        self.last_bytes = np.array([self.ids.get(c + self.suffix, -1) for c in letters], dtype=np.int64)
        # merges as sorted keys of pairs of ids, each with its rank and the id it makes
        pairs = [tuple(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        keys = np.array([self.ids[a] << 20 | self.ids[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.pairs, self.ranks = keys[order], order
        self.made = np.array([self.ids[a + b] for a, b in pairs], dtype=np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; `_NONE` for pairs that do not merge."""
        keys = np.where((left < 0) | (right < 0), -1, left << 20 | right)
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where(self.pairs[at] == keys, self.ranks[at], _NONE)

    def merge(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of pieces: in each, the pair of lowest rank merges first, the leftmost of equals.

        Pieces of like length merge side by side, one pair of each at a time.
        """
        out: list[list[int]] = [[]] * len(pieces)
        sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        for low, high in ((0, 8), (8, 16), (16, 32), (32, SIDE_BYTES)):
            rows = np.flatnonzero((sizes > low) & (sizes <= high))
            if len(rows):
                joined = np.frombuffer(b"".join(pieces[k] for k in rows), dtype=np.uint8)
                for k, found in zip(rows.tolist(), self._side(joined, sizes[rows], high), strict=True):
                    out[k] = found
        for k in np.flatnonzero(sizes > SIDE_BYTES).tolist():
            out[k] = self._alone(pieces[k])
        return out

    def _side(self, joined: np.ndarray, sizes: np.ndarray, width: int) -> list[list[int]]:
        n, ends = len(sizes), np.cumsum(sizes)
        flat = self.bytes[joined]
        flat[ends - 1] = self.last_bytes[joined[ends - 1]]
        ids = np.full((n, width + 1), -1, dtype=np.int64)
        ids[np.arange(width + 1)[None, :] < sizes[:, None]] = flat
        ranks = self.rank(ids[:, :-1], ids[:, 1:])
        done, rows, place = ids.copy(), np.arange(n), np.arange(width + 1)
        while True:
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(at)), at]
            live = best < _NONE
            if not live.all():
                done[rows[~live]] = ids[~live]
                rows, ids, ranks, at, best = rows[live], ids[live], ranks[live], at[live], best[live]
            if not len(rows):
                return [row[row >= 0].tolist() for row in done]
            every = np.arange(len(rows))
            # everything after the merged pair moves up by one place
            after = np.minimum(place[None, :] + (place[None, :] > at[:, None]), width)
            ids = np.take_along_axis(ids, after, axis=1)
            ids[:, -1] = -1
            ids[every, at] = self.made[best]
            ranks = np.take_along_axis(ranks, np.minimum(after[:, :-1], width - 1), axis=1)
            ranks[:, -1] = _NONE
            ranks[every, at] = self.rank(ids[every, at], ids[every, at + 1])
            left = np.maximum(at - 1, 0)
            ranks[every, left] = np.where(at > 0, self.rank(ids[every, left], ids[every, at]), ranks[every, left])

    def _alone(self, piece: bytes) -> list[int]:
        """A long piece: a heap of pairs over a chain of symbols, so that work stays in proportion."""
        ids = [int(self.bytes[b]) for b in piece]
        ids[-1] = int(self.last_bytes[piece[-1]])
        before, after = list(range(-1, len(ids) - 1)), list(range(1, len(ids) + 1))
        table = self._table()
        heap = [(table[pair], k) for k, pair in enumerate(zip(ids, ids[1:])) if pair in table]
        heapq.heapify(heap)
        while heap:
            rank, k = heapq.heappop(heap)
            j = after[k] if ids[k] >= 0 else len(ids)
            if j >= len(ids) or table.get((ids[k], ids[j])) != rank:
                continue  # an older pair
            ids[k], ids[j] = int(self.made[rank]), -1
            after[k] = after[j]
            if after[j] < len(ids):
                before[after[j]] = k
            for x in (before[k], k):
                if x >= 0 and after[x] < len(ids) and (ids[x], ids[after[x]]) in table:
                    heapq.heappush(heap, (table[ids[x], ids[after[x]]], x))
        return [i for i in ids if i >= 0]

    @functools.cache
    def _table(self) -> dict[tuple[int, int], int]:
        return {(k >> 20, k & 0xFFFFF): r for k, r in zip(self.pairs.tolist(), self.ranks.tolist(), strict=True)}

    def words(self, words: list[bytes]) -> list[list[int]]:
        """Ids of words without blanks; each distinct piece is merged once."""
        pieces: dict[str, int] = {}
        plan: list[list[int]] = []  # of each word: numbers of pieces, or less than 0: special ids
        for word in words:
            text, own = word.decode(), []
            parts = [text] if self.marked is None or MARK not in word else self.marked.split(text)
            for k, part in enumerate(parts):
                if k % 2:
                    own.append(-1 - self.special[part])
                else:
                    own += [pieces.setdefault(p, len(pieces)) for p in self._split(part)]
            plan.append(own)
        merged = self.merge([p.encode() for p in pieces])
        return [merged[own[0]] if len(own) == 1 and own[0] >= 0 else [i for k in own for i in (merged[k] if k >= 0 else [-1 - k])] for own in plan]

    def _split(self, text: str) -> list[str]:
        if text.isascii():
            return self.split.findall(text.lower())
        text = unicodedata.normalize("NFC", text)
        # a final capital sigma stays an ordinary one, as lower-casing goes character by character
        return self.split.findall("".join(c.lower() for c in text) if "Σ" in text else text.lower())


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, once per process."""
    return Vocabulary(path)


class Lexicon:
    """The automaton in its file form: six arrays after a header of their lengths.

    first: of each node, where its edges begin, doubled, plus one if a word ends there;
    edge: number of the node times 256 plus the byte, ascending; target: the node an
    edge leads to; before: words that sort before those behind the edge.
    """

    KINDS = (("first", np.int32), ("edge", np.int64), ("target", np.int32), ("before", np.int32), ("ends", np.int32), ("ids", np.int32))

    def __init__(self, buffer: bytes | mmap.mmap):
        lengths, at = np.frombuffer(buffer, dtype=np.int64, count=len(self.KINDS)), 8 * len(self.KINDS)
        for (name, kind), n in zip(self.KINDS, lengths.tolist(), strict=True):
            setattr(self, name, np.frombuffer(buffer, dtype=kind, count=n, offset=at))
            at += -(-n * np.dtype(kind).itemsize // 8) * 8
        self.buffer = buffer

    def numbers(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Positions of words among the sorted words; -1 for others. All words take one edge per step."""
        out = np.full(len(starts), -1, dtype=np.int64)
        rows = np.flatnonzero(ends - starts <= LEXICON_BYTES)
        node, number, at = np.zeros(len(rows), dtype=np.int64), np.zeros(len(rows), dtype=np.int64), starts[rows]
        while len(rows):
            over = at >= ends[rows]
            here = over & (self.first[node] & 1).astype(bool)
            out[rows[here]] = number[here]
            rows, node, number, at = rows[~over], node[~over], number[~over], at[~over]
            if not len(rows) or not len(self.edge):
                break
            keys = node * 256 + data[at]
            edge = np.minimum(np.searchsorted(self.edge, keys), len(self.edge) - 1)
            found = self.edge[edge] == keys
            rows, edge = rows[found], edge[found]
            node, number, at = self.target[edge].astype(np.int64), number[found] + self.before[edge], at[found] + 1
        return out

    def lookup(self, number: int) -> list[int]:
        """Ids of a word of the lexicon, by its number."""
        return self.ids[self.ends[number]:self.ends[number + 1]].tolist()


def compile_lexicon(entries: Iterable[tuple[bytes, list[int]]]) -> bytes:
    """The file of a lexicon, from words in ascending order, each once."""
    # a node is (terminal, edges); finished nodes are known by their content
    known: dict[tuple, int] = {}
    contents: list[tuple] = []
    below: list[int] = []
    path: list[list] = [[False, []]]
    ends, ids, last = [0], [], b""

    def finish(depth: int) -> None:
        while len(path) > depth + 1:
            terminal, edges = path.pop()
            content = (terminal, tuple(edges))
            node = known.get(content)
            if node is None:
                node = known[content] = len(contents)
                contents.append(content)
                below.append(terminal + sum(below[t] for _, t in edges))
            path[-1][1][-1] = (path[-1][1][-1][0], node)

    for word, found in entries:
        same = 0
        while same < min(len(word), len(last)) and word[same] == last[same]:
            same += 1
        finish(same)
        for byte in word[same:]:
            path[-1][1].append((byte, -1))
            path.append([False, []])
        path[-1][0] = True
        last = word
        ids += found
        ends.append(len(ids))
    finish(0)
    # the root comes first, the others in any fixed order
    nodes = [(path[0][0], tuple(path[0][1])), *contents]
    first, edge, target, before = [0], [], [], []
    for number, (terminal, edges) in enumerate(nodes):
        first[-1] |= int(terminal)
        passed = int(terminal)
        for byte, node in edges:
            edge.append(number * 256 + byte)
            target.append(node + 1)
            before.append(passed)
            passed += below[node]
        first.append(len(edge) << 1)
    arrays = [np.array(x, dtype=kind) for x, (_, kind) in zip((first, edge, target, before, ends, ids), Lexicon.KINDS, strict=True)]
    out = [np.array([len(a) for a in arrays], dtype=np.int64).tobytes()]
    for a in arrays:
        body = a.tobytes()
        out.append(body + bytes(-len(body) % 8))
    return b"".join(out)


_mapped: dict[str, Lexicon] = {}


def mapped(digest: str, shared: Broadcast) -> Lexicon:
    """The broadcast lexicon as a memory-mapped file of this process; the file has no name left."""
    if digest not in _mapped:
        with tempfile.TemporaryFile() as file:
            file.write(shared.value)
            file.flush()
            found = Lexicon(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))
        _mapped.clear()
        _mapped[digest] = found
    return _mapped[digest]


def _distinct(column: pa.Array) -> tuple[texts.Spans, np.ndarray, np.ndarray, np.ndarray]:
    """Words with A-Z lower-cased; of the distinct ones hash and one place each; which one stands where.

    Strings of special tokens count only in their own case: where one may stand, nothing is lower-cased.
    """
    data, offsets = texts.raw(column)
    words = texts.words(data if MARK in data.tobytes() else texts.LOWER[data], offsets)
    return words, *np.unique(words.hashes(), return_index=True, return_inverse=True)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[bytes, int] = {}

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    for part in texts.chunks(batches, limit=CHUNK_BYTES):
        words, _, where, which = _distinct(part.column("text"))
        body, n = words.data.tobytes(), np.bincount(which, minlength=len(where))
        sizes = words.ends[where] - words.starts[where]
        for start, end, count in zip(words.starts[where].tolist(), words.ends[where].tolist(), np.where(sizes <= LEXICON_BYTES, n, 0).tolist(), strict=True):
            word = body[start:end]
            if count and MARK not in word:
                held[word] = held.get(word, 0) + count
        if len(held) > HELD:
            yield rows()
            held.clear()
    yield rows()


def frequent_words(docs: DataFrame, size: int = LEXICON_WORDS, text: str = "text") -> DataFrame:
    """The `size` most frequent words of all texts; among those about as frequent as the last, by hash."""
    parts = docs.select(docs[text].alias("text")).mapInArrow(texts.tidy(_word_counts), "word binary, n long")
    counts = session.materialize(parts.groupBy("word").agg(F.sum("n").alias("n")), "words")
    return texts.top_rows(counts, texts.count_level(F.col("n")), ["word"], size) if size else counts.limit(0)


def build(docs: DataFrame, path: str, size: int = LEXICON_WORDS, text: str = "text") -> bytes:
    """Compile the lexicon of a corpus; at most `size` words reach the driver."""
    merge = vocabulary(path)
    words = sorted(bytes(row["word"]) for row in frequent_words(docs, size, text).collect())
    return compile_lexicon(zip(words, merge.words(words), strict=True))


class Encoder:
    """Ids of words by lexicon or merging, remembered as decimal text and as tokens."""

    def __init__(self, path: str, lexicon: Lexicon):
        self.vocabulary, self.lexicon, self.known = vocabulary(path), lexicon, texts.Memory(HELD)
        self._forget()

    def _forget(self) -> None:
        self.known.clear()
        self.ids, self.tokens, self.sizes = np.empty(0, dtype=object), np.empty(0, dtype=object), np.empty(0, dtype=np.int64)

    def _learn(self, words: texts.Spans, where: np.ndarray) -> None:
        """Entries of new words, given by a place of each."""
        starts, ends = words.starts[where], words.ends[where]
        numbers = self.lexicon.numbers(words.data, starts, ends).tolist()
        body, unseen = words.data.tobytes(), [k for k, n in enumerate(numbers) if n < 0]
        merged = dict(zip(unseen, self.vocabulary.words([body[starts[k]:ends[k]] for k in unseen]), strict=True))
        found = [merged[k] if n < 0 else self.lexicon.lookup(n) for k, n in enumerate(numbers)]
        entries, tokens = np.empty((2, len(found)), dtype=object), self.vocabulary.tokens
        entries[0] = [" ".join(map(str, ids)) for ids in found]
        entries[1] = [" ".join([tokens[i] for i in ids]) for ids in found]
        self.ids, self.tokens = np.concatenate((self.ids, entries[0])), np.concatenate((self.tokens, entries[1]))
        self.sizes = np.concatenate((self.sizes, np.fromiter(map(len, found), dtype=np.int64, count=len(found))))

    def encode(self, column: pa.Array) -> tuple[list[str], list[str], np.ndarray]:
        """Of each text: ids joined by spaces, decoded text, number of ids."""
        words, keys, where, which = _distinct(column)
        numbers = self.known.find(keys)
        new = np.flatnonzero(numbers < 0)
        if self.known.full(len(new)):
            self._forget()
            new = np.arange(len(keys))
        if len(new):
            first = len(self.ids)
            self._learn(words, where[new])
            self.known.add(keys[new], first + np.arange(len(new)))
            numbers = self.known.find(keys)
        rows, numbers = words.rows, numbers[which]
        each = self.sizes[numbers]
        totals = np.bincount(rows, weights=each, minlength=words.n_rows).astype(np.int64)
        rows, numbers = rows[each > 0], numbers[each > 0]  # of some words nothing is left
        edges = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=words.n_rows)))).tolist()
        ids, tokens = self.ids[numbers].tolist(), self.tokens[numbers].tolist()
        spans = list(zip(edges, edges[1:]))
        return [" ".join(ids[a:b]) for a, b in spans], [" ".join(tokens[a:b]) for a, b in spans], totals


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", size: int = LEXICON_WORDS, whole: bool = False) -> DataFrame:
    """Number of ids and digests of ids and of the decoded text; whole adds both as text."""
    lexicon = build(docs, path, size, text)
    digest, shared = hashlib.sha256(lexicon).hexdigest(), docs.sparkSession.sparkContext.broadcast(lexicon)
    kind = docs.schema[key].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, mapped(digest, shared))
        for part in texts.chunks(batches):
            ids, decoded, n = encoder.encode(part.column("text"))
            arrays = [part.column("key"), pa.array(n), *(pa.array([hashlib.sha256(t.encode()).hexdigest() for t in x], pa.string()) for x in (ids, decoded))]
            names = ["key", "n_tokens", "ids_sha256", "decoded_sha256"]
            if whole:
                arrays, names = [*arrays, pa.array(ids, pa.string()), pa.array(decoded, pa.string())], [*names, "ids", "decoded"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids string, decoded string" * whole
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    return rows.mapInArrow(texts.tidy(work), schema).withColumnRenamed("key", key)
