"""Token ids as files of blocks, compressed by an adaptive context-mixing range coder.

Encoding uses the tokenizers library. A unit of a text is a run of blanks with
the word after it; the byte-level split rule never looks across a word's end, so
ids of a text are the ids of its units in a row, and each distinct unit of a
chunk is encoded once.

File format. A row of the table is one block of up to `BLOCK` ids: (shard, segment,
block, ids of the shard before it, n_ids, crc32 of the ids as little-endian 32-bit
integers, payload). Shards follow each other in ascending document id; their number
follows the size of the texts. A segment holds whole documents, about `LANES` blocks,
and is what a task holds at a time. The row with block -1 of a segment holds the size
of the vocabulary and the (doc_id, n_ids) of its documents, compressed; a row with
segment -1 closes a shard with the number of its ids. The payload is a sequence of
32-bit words of a range coder with 64-bit state. Every block starts anew and is read
alone.

Model of one id. Within a block ids are numbered as they first come; the payload
starts with how many distinct ids there are and these ids, each under a fixed chance that
falls with the id, as a tokenizer learns frequent tokens first. Numbers are coded under
the weighted sum of three distributions whose counts all start anew with a block. Order
0 has an adaptive chance that the next new number comes, and counts the numbers that came
before as two digits, the second after the first; older counts are halved in time. Orders
2 and 1 hold the number that last followed the two numbers or the one number before, with
a count of how often it came true: this number has the chance that such guesses came true
with this count so far, all others share the rest as order 0 has them. Weights, for each
pair of counts, follow the part that each order has in the chance of the numbers that
came. The coder first decides between the two expected numbers, each by its chance under
the sum, a new one, and all others, which order 0 then tells apart; what it gives to the
expected numbers there stays unused. Chances are 32-bit floats of which only sums, products and
quotients are taken, one by one, so that they are the same wherever they are computed;
intervals are whole numbers. Blocks are coded in lockstep, one id of each per step, as
array operations.

Defined cases: null counts as empty text, which has the end id alone; repeated
rows are documents of their own; rows of one id follow each other in an order fixed
by their texts; documents without id come first, and without id out again; an empty
table gives no blocks and an empty result; further columns are not read; a payload
whose checksum fails, and a missing block or segment of a shard that is there, raise.
"""

from __future__ import annotations

import functools
import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stormledger import session
from stormledger.llm import texts

END_ID = 2
BLOCK = 2048
#: Blocks coded in lockstep at a time, which bounds a task's memory.
LANES = 2048
#: Bytes of text of a shard, and the least for which the session's number of partitions is kept.
SHARD_BYTES, LEAST_SHARD_BYTES = 256 << 20, 8 << 20
#: Distinct units that a task remembers, and new ones that go to the library as one text.
HELD, TOGETHER = 500_000, 256

U64 = np.uint64
_TOP = U64(1 << 32)
_LOW = U64((1 << 32) - 1)
#: Parts of an interval that decide between the two expected numbers, a new one and all others; those that chances share out.
_DECIDE_BITS = 14
_DECIDE = 1 << _DECIDE_BITS
_SHARED = _DECIDE - 36
#: Numbers that a block of this length or less has room for; twice as many for longer ones, until they have room.
_NUMBERS = 1 << 11
#: Contexts that order 2 of one block holds apart; a slot has 20 bits of a number, 3 of its count, 8 that check the context.
_SLOTS = 1 << 12
_ID_BITS, _CHECK_BIT, _MAX_COUNT = 20, 23, 7
_ID = (1 << _ID_BITS) - 1
_COUNTS = _MAX_COUNT + 1
#: How fast chances and weights follow what comes, and the least weight.
_RATE, _WEIGHT_RATE, _LEAST = 1 / 32, 1 / 16, 1 / 64
#: Order 0: what a number adds to its counts, and the sum at which counts are halved.
_INCREMENT, _MAX_SUM = 24, 1 << 13
#: Bits of the chances of first ids, at least, and the id from which on these fall.
_PRIOR_BITS, _PRIOR = 20, 300
_POSITIVE = (1 << 63) - 1
#: First bytes of the blanks of Unicode that do not cut words.
_BLANK_LEADS = np.isin(np.arange(256), [0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3])



class Mixer:
    """Model state of many blocks in lockstep: rows of each table for a block, all as new at its start.

    size: numbers that a block may have.
    """

    def __init__(self, lanes: int, size: int):
        assert size <= _ID + 1
        self.size = size
        #: Bits of the second digit of a number.
        self.bits = -(-(size - 1).bit_length() // 2)
        self.lane = np.arange(lanes, dtype=np.int64)
        #: Last numbers that followed a context, and the chances that such a number comes, by its count; none without one.
        self.slots = [np.zeros(lanes * n, dtype=np.int32) for n in (_SLOTS, size)]
        self.chances = [np.tile(np.where(np.arange(_COUNTS) > 0, 0.5, 0.0).astype(np.float32), lanes) for _ in self.slots]
        #: Chances of a new number, by the count of order 1.
        self.fresh = np.full(lanes * _COUNTS, 0.5, dtype=np.float32)
        #: Weights of order 2 and order 1, by both counts; the rest is that of order 0.
        self.weights = [np.full(lanes * _COUNTS ** 2, 1 / 3, dtype=np.float32) for _ in self.slots]
        # order 0: sums of counts of the digits of a number, the second after the first; number 0 always has one
        tops = (size - 1 >> self.bits) + 1
        self.widths = (tops + 1, (1 << self.bits) + 1)
        self.sums = [np.zeros((rows, width), dtype=np.uint16) for rows, width in zip((lanes, lanes * tops), self.widths, strict=True)]
        for table, step in zip(self.sums, (1, tops), strict=True):
            table[::step, 1:] = 1
        self.tops, self.flat = tops, [table.reshape(-1) for table in self.sums]
        self.whole_rows = self.sums[1].view(np.dtype((np.void, 2 * self.widths[1]))).ravel()
        self.steps = [((np.arange(w)[None, :] > np.arange(w - 1)[:, None]) * _INCREMENT).astype(np.uint16) for w in self.widths]
        self.last, self.before, self.seen = (np.zeros(lanes, dtype=np.int64) for _ in range(3))

    def share(self, level: int, row: np.ndarray, digit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and width of a digit, and their whole."""
        at, flat = row * self.widths[level], self.flat[level]
        own = at + digit
        start = flat.take(own)
        return start.astype(np.int64), (flat.take(own + 1) - start).astype(np.int64), flat.take(at + self.widths[level] - 1).astype(np.int64)

    def digits(self, lane: np.ndarray, numbers: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], ...]:
        """Row and digit on either level."""
        top = numbers >> self.bits
        return (lane, top), (lane * self.tops + top, numbers & (1 << self.bits) - 1)

    def chance0(self, lane: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Chance of numbers that came before, among these, under order 0."""
        chances = []
        for flat, width, (row, digit) in zip(self.flat, self.widths, self.digits(lane, numbers), strict=True):
            at = row * width
            own = at + digit
            chances.append(np.subtract(flat.take(own + 1), flat.take(own), dtype=np.float32) / flat.take(at + width - 1))
        return chances[0] * chances[1]

    def predict(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Numbers that order 2 and order 1 expect, and the ends of their shares of _DECIDE, of the first n blocks.

        Each order is a distribution over all numbers: orders 2 and 1 give the one
        they expect its chance and spread the rest as order 0 does. The share of an
        expected number is its chance under the weighted sum of the three. The share
        of a new number ends at `end_new`.
        """
        lane, last, self.n = self.lane[:n], self.last[:n], n
        key = last * 0x9E3779B1 + self.before[:n] * 0x85EBCA6B + 1
        key = (key ^ (key >> 15)) * 0x2545F491
        self.check = (key >> 34 & 0xFF).astype(np.int32)
        self.at = (lane * _SLOTS + (key >> 20 & _SLOTS - 1), lane * self.size + last)
        held2, held1 = (slots.take(at) for slots, at in zip(self.slots, self.at, strict=True))
        count2, count1 = np.where(held2 >> _CHECK_BIT == self.check, held2 >> _ID_BITS & _MAX_COUNT, 0), held1 >> _ID_BITS
        id2, id1 = held2 & _ID, held1 & _ID
        self.id, self.count, self.has = (id2, id1), (count2, count1), (count2 > 0, count1 > 0)
        self.spot = (lane * _COUNTS + count2, lane * _COUNTS + count1)
        self.chance = tuple(chances.take(spot) for chances, spot in zip(self.chances, self.spot, strict=True))
        self.context = self.spot[0] * _COUNTS + count1
        self.weight = tuple(w.take(self.context) for w in self.weights)
        new = self.fresh.take(self.spot[1])
        rare = self.chance0(np.concatenate((lane, lane)), np.concatenate(self.id))
        rare2, rare1 = self.rare = rare[:n] * (1 - new), rare[n:] * (1 - new)
        alone = self.has[1] & (id1 != id2) | ~self.has[0]
        part2, part1 = self.weight[0] * self.chance[0], self.weight[1] * self.chance[1]
        spread = 1 - part2 - part1
        # at least one part for each that has a number and for a new one, and some for all others
        end2 = ((part2 + np.where(alone, 0, part1) + spread * rare2) * _SHARED + 1).astype(np.int64) * self.has[0]
        end1 = end2 + ((part1 + spread * rare1) * _SHARED + 1).astype(np.int64) * (alone & self.has[1])
        self.end_new = end1 + (spread * new * _SHARED + 1).astype(np.int64)
        return id2, id1, end2, end1

    def learn(self, numbers: np.ndarray) -> None:
        """Take in the numbers that came to the first n blocks."""
        n, lane, (weight2, weight1) = self.n, self.lane[:self.n], self.weight
        new = numbers >= self.seen[:n]
        self.seen[:n] = np.maximum(self.seen[:n], numbers + 1)
        numbers = numbers.astype(np.int32)
        hits = [(numbers == found) & has for found, has in zip(self.id, self.has, strict=True)]
        # weights follow the share that each order has in the chance of what came
        rare = np.where(hits[0], self.rare[0], np.where(hits[1], self.rare[1], 1.0))
        fits = [w * (hit * c + (1 - c) * rare) for w, hit, c in zip(self.weight, hits, self.chance, strict=True)]
        whole = fits[0] + fits[1] + (1 - weight2 - weight1) * rare
        weight2 = np.minimum(np.maximum(weight2 + (fits[0] / whole - weight2) * _WEIGHT_RATE, _LEAST), 1 - 3 * _LEAST)
        weight1 = np.minimum(np.maximum(weight1 + (fits[1] / whole - weight1) * _WEIGHT_RATE, _LEAST), 1 - _LEAST - weight2)
        self.weights[0][self.context], self.weights[1][self.context] = weight2, weight1
        self.fresh[self.spot[1]] += (new - self.fresh.take(self.spot[1])) * _RATE
        for k, (hit, count, chance) in enumerate(zip(hits, self.count, self.chance, strict=True)):
            self.chances[k][self.spot[k]] = chance + (hit - chance) * _RATE
            # a right guess gains trust; a wrong one that was often right stays once more, with less of it
            stays = count > 2
            trust = np.where(hit, np.minimum(count + 1, _MAX_COUNT), np.where(stays, count >> 1, 1))
            held = np.where(stays, self.id[k], numbers) | trust << _ID_BITS
            self.slots[k][self.at[k]] = held if k else held | self.check << _CHECK_BIT
        (_, top), (row, low) = self.digits(lane, numbers)
        sums = self.sums[0][:n]
        sums += self.steps[0].take(top, axis=0)
        self.halve(sums)
        sums = self.sums[1].take(row, axis=0)
        sums += self.steps[1].take(low, axis=0)
        self.halve(sums)
        self.whole_rows[row] = sums.view(self.whole_rows.dtype).ravel()
        self.before[:n], self.last[:n] = self.last[:n].copy(), numbers

    def halve(self, sums: np.ndarray) -> None:
        """Let older counts weigh less in full rows."""
        full = np.flatnonzero(sums[:, -1] > _MAX_SUM)
        if len(full):
            sums[full, 1:] = np.cumsum((np.diff(sums[full].astype(np.int64), axis=1) + 1) >> 1, axis=1)


class Interval:
    """Bounds of the coded intervals of many blocks; without carries, as the bounds never straddle a settled word."""

    def __init__(self, lanes: int):
        self.low, self.span = np.zeros(lanes, dtype=U64), np.full(lanes, (1 << 64) - 1, dtype=U64)

    def narrow(self, which: slice | np.ndarray, unit: np.ndarray, start: np.ndarray, width: np.ndarray) -> None:
        """Take a part of some intervals."""
        self.low[which] += unit * start.view(U64)
        self.span[which] = unit * width.view(U64)

    def settled(self, n: int):
        """Blocks whose upper word is settled, again until none is; they move on by one word."""
        low, span = self.low[:n], self.span[:n]
        which = np.flatnonzero(((low ^ (low + span)) < _TOP) | (span < _TOP))
        while len(which):
            own, wide = low[which], span[which]
            apart = (own ^ (own + wide)) >= _TOP
            if apart.any():  # a narrow interval across a word's bound is cut at the bound
                wide = np.where(apart, (U64(0) - own) & _LOW, wide)
            yield which, own >> U64(32)
            own, wide = own << U64(32), wide << U64(32)
            low[which], span[which] = own, wide
            which = which[((own ^ (own + wide)) < _TOP) | (wide < _TOP)]


@functools.lru_cache(maxsize=2)
def _prior(size: int) -> tuple[int, np.ndarray]:
    """Bits of the chances of first ids, and the bounds of the ids in them."""
    bits = max(_PRIOR_BITS, size.bit_length() + 2)
    # in whole numbers, so that the bounds are the same everywhere
    weights = (1 << 30) // (_PRIOR + np.arange(size, dtype=np.int64))
    widths = 1 + weights * ((1 << bits) - size) // weights.sum()
    return bits, np.concatenate(([0], np.cumsum(widths)))


def _room(size: int) -> int:
    """Numbers that a block of `size` ids has room for."""
    return max(_NUMBERS, 1 << (size - 1).bit_length())


def _in_order(sizes: list[int]) -> Iterator[tuple[int, list[int], list[int]]]:
    """Room, blocks by descending size, and how many are longer than each step, of all blocks with the same room."""
    rooms: dict[int, list[int]] = {}
    for k, size in enumerate(sizes):
        rooms.setdefault(_room(size), []).append(k)
    for room, own in rooms.items():
        order = sorted(own, key=lambda k: -sizes[k])
        lengths = np.array([sizes[k] for k in order], dtype=np.int64)
        yield room, order, np.searchsorted(-lengths, -np.arange(int(lengths[0])), "left").tolist()


def _numbered(block: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids numbered as they first come, and the distinct ids in this order. first: room for one place of each id."""
    places = np.arange(len(block))
    first[block[::-1]] = places[::-1]  # the last one written is the first that comes
    at = first[block]
    new = at == places
    return (np.cumsum(new) - 1)[at], block[new]


def encode_blocks(blocks: list[np.ndarray], size: int) -> list[bytes]:
    """Payloads of blocks of ids below `size`, coded in lockstep."""
    payloads = [b""] * len(blocks)
    first = np.zeros(size, dtype=np.int64)
    for room, order, active in _in_order([len(b) for b in blocks]):
        numbers, ids = zip(*(_numbered(blocks[k], first) for k in order), strict=True)
        for k, distinct, payload in zip(order, ids, _encode(numbers, ids, active, room, size), strict=True):
            payloads[k] = len(distinct).to_bytes(4, "little") + payload
    return payloads


def _encode(numbers: tuple[np.ndarray, ...], ids: tuple[np.ndarray, ...], active: list[int], room: int, size: int) -> list[bytes]:
    """Range coded blocks: their distinct ids, then the numbers."""
    lanes = len(numbers)
    grid = np.zeros((len(active), lanes), dtype=np.int32)
    for lane, own in enumerate(numbers):
        grid[:len(own), lane] = own
    mixer, interval = Mixer(lanes, room), Interval(lanes)
    out_word, out_lane = [], []

    def settle(n: int) -> None:
        for which, word in interval.settled(n):
            out_word.append(word.astype(np.uint32))
            out_lane.append(which)

    distinct = np.array([len(x) for x in ids])
    bits, bounds = _prior(size)
    every, starts = np.concatenate(ids), np.cumsum(distinct) - distinct
    for step in range(int(distinct.max())):
        which = np.flatnonzero(distinct > step)
        got = every[starts[which] + step]
        interval.narrow(which, interval.span[which] >> U64(bits), bounds[got], bounds[got + 1] - bounds[got])
        settle(lanes)
    for step, n in enumerate(active):
        own = grid[step, :n].astype(np.int64)
        id2, id1, end2, end1 = mixer.predict(n)
        hit2 = (own == id2) & mixer.has[0]
        hit1 = (own == id1) & (end1 > end2) & ~hit2
        new = own >= mixer.seen[:n]
        start = np.where(hit2, 0, np.where(hit1, end2, np.where(new, end1, mixer.end_new)))
        end = np.where(hit2, end2, np.where(hit1, end1, np.where(new, mixer.end_new, _DECIDE)))
        interval.narrow(slice(n), interval.span[:n] >> U64(_DECIDE_BITS), start, end - start)
        rest = np.flatnonzero(~(hit2 | hit1 | new))
        for level, (row, digit) in enumerate(mixer.digits(rest, own[rest])):
            start, width, whole = mixer.share(level, row, digit)
            interval.narrow(rest, interval.span[rest] // whole.view(U64), start, width)
            settle(n)
        mixer.learn(own)
    # 64 bits settle the rest
    for word in (interval.low >> U64(32), interval.low & _LOW):
        out_word.append(word.astype(np.uint32))
        out_lane.append(np.arange(lanes))
    lane_of, words = np.concatenate(out_lane), np.concatenate(out_word)
    words = words[np.argsort(lane_of, kind="stable")].astype("<u4")
    cuts = np.concatenate(([0], np.cumsum(np.bincount(lane_of, minlength=lanes))))
    return [words[a:b].tobytes() for a, b in itertools.pairwise(cuts.tolist())]


def decode_blocks(payloads: list[bytes], sizes: list[int], size: int) -> list[np.ndarray]:
    """Ids of blocks, decoded in lockstep."""
    out: list[np.ndarray] = [np.empty(0, dtype=np.int32)] * len(payloads)
    for room, order, active in _in_order(sizes):
        for k, ids in zip(order, _decode([payloads[k] for k in order], [sizes[k] for k in order], active, room, size), strict=True):
            out[k] = ids
    return out


def _decode(payloads: list[bytes], sizes: list[int], active: list[int], room: int, size: int) -> Iterator[np.ndarray]:
    lanes = len(payloads)
    # two words of zeros after each payload, as its end may be read ahead; a damaged number of ids stays within bounds, its checksum tells
    parts = [np.concatenate((np.frombuffer(p, dtype="<u4"), np.zeros(2, dtype="<u4"))) for p in payloads]
    distinct = np.array([min(max(int(p[0]), 1), n) for p, n in zip(parts, sizes, strict=True)])
    words = np.concatenate(parts).astype(U64)
    at = np.concatenate(([0], np.cumsum([len(p) for p in parts])[:-1])).astype(np.int64) + 1
    limit = np.concatenate((at[1:] - 1, [len(words)])) - 1
    code = (words[at] << U64(32)) | words[at + 1]
    at += 2
    mixer, interval = Mixer(lanes, room), Interval(lanes)

    def settle(n: int) -> None:
        for which, _ in interval.settled(n):
            code[which] = (code[which] << U64(32)) | words[np.minimum(at[which], limit[which])]
            at[which] += 1

    def point(which: slice | np.ndarray, unit: np.ndarray, whole: np.ndarray | int) -> np.ndarray:
        # a block that is damaged may point outside; its checksum tells
        return np.minimum(((code[which] - interval.low[which]) // unit).view(np.int64) & _POSITIVE, whole - 1)

    bits, bounds = _prior(size)
    ids = np.zeros((lanes, int(distinct.max())), dtype=np.int32)
    for step in range(ids.shape[1]):
        which = np.flatnonzero(distinct > step)
        unit = interval.span[which] >> U64(bits)
        got = np.searchsorted(bounds, point(which, unit, int(bounds[-1])), "right") - 1
        interval.narrow(which, unit, bounds[got], bounds[got + 1] - bounds[got])
        settle(lanes)
        ids[which, step] = got
    grid = np.zeros((len(active), lanes), dtype=np.int32)
    for step, n in enumerate(active):
        id2, id1, end2, end1 = mixer.predict(n)
        end_new = mixer.end_new
        unit = interval.span[:n] >> U64(_DECIDE_BITS)
        here = point(slice(n), unit, _DECIDE)
        hit2, hit, known = here < end2, here < end1, here < end_new
        start = np.where(hit2, 0, np.where(hit, end2, np.where(known, end1, end_new)))
        end = np.where(hit2, end2, np.where(hit, end1, np.where(known, end_new, _DECIDE)))
        interval.narrow(slice(n), unit, start, end - start)
        own = np.where(hit2, id2, np.where(hit, id1, np.minimum(mixer.seen[:n], room - 1)))
        rest = np.flatnonzero(~known)
        row = rest
        for level in range(2):
            sums = mixer.sums[level].take(row, axis=0)
            whole = sums[:, -1].astype(np.int64)
            unit = interval.span[rest] // whole.view(U64)
            digit = (sums[:, 1:] <= point(rest, unit, whole).astype(np.uint16)[:, None]).sum(axis=1)
            start, width, _ = mixer.share(level, row, digit)
            interval.narrow(rest, unit, start, width)
            settle(n)
            if level == 0:
                top, row = digit, rest * mixer.tops + digit
        own[rest] = (top << mixer.bits) + digit
        grid[step, :n] = own
        mixer.learn(own)
    for lane, (n, most) in enumerate(zip(sizes, distinct.tolist(), strict=True)):
        yield ids[lane][np.minimum(grid[:n, lane], most - 1)]


@functools.lru_cache(maxsize=1)
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def other_blanks(data: np.ndarray) -> np.ndarray:
    """Where the blanks of Unicode that do not cut words stand in UTF-8."""
    at = np.flatnonzero(_BLANK_LEADS[data])
    first, second, third = data[at], *(data[np.minimum(at + k, len(data) - 1)] for k in (1, 2))
    general = (second == 0x80) & ((third <= 0x8A) | (third == 0xA8) | (third == 0xA9) | (third == 0xAF)) | (second == 0x81) & (third == 0x9F)
    found = (first < 0x20) | (first == 0xC2) & ((second == 0x85) | (second == 0xA0)) | (first == 0xE2) & general
    found |= (first == 0xE1) & (second == 0x9A) & (third == 0x80) | (first == 0xE3) & (second == 0x80) & (third == 0x80)
    return at[found]


class UnitEncoder:
    """Ids of texts by the tokenizers library, each distinct unit once; units are remembered."""

    def __init__(self, path: str):
        self.tokenizer, self.known = _tokenizer(path), texts.Memory(HELD)
        self.pool, self.ends = np.empty(0, dtype=np.int32), np.zeros(1, dtype=np.int64)
        added = self.tokenizer.get_added_tokens_decoder()
        #: No blank is in a special token, so none crosses a unit's end; it must not take blanks in either.
        assert not any(t.lstrip or t.rstrip or t.normalized for t in added.values())
        #: The only special token parts units that are encoded as one text, if it cannot overlap itself.
        self.mark_id, self.mark = next(((k, t.content) for k, t in added.items() if len(added) == 1 and not t.single_word), (None, ""))
        if any(self.mark.endswith(self.mark[:k]) for k in range(1, len(self.mark))):
            self.mark = ""
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)

    def units(self, column: pa.Array) -> texts.Spans:
        """Blanks with the word after them; the blanks at a text's end are one unit more."""
        data, offsets = texts.raw(column)
        words = texts.words(data, offsets)
        edges = words.edges()
        starts = words.starts.copy()
        inner = np.ones(len(words), dtype=bool)
        inner[edges[:-1][edges[:-1] < edges[1:]]] = False
        starts[inner] = words.ends[:-1][inner[1:]] if len(words) else starts[inner]
        starts[~inner] = offsets[:-1][edges[:-1] < edges[1:]]
        full = edges[:-1] < edges[1:]
        tail = offsets[:-1].copy()
        tail[full] = words.ends[edges[1:][full] - 1]
        more = np.flatnonzero(tail < offsets[1:])
        starts, ends = np.concatenate((starts, tail[more])), np.concatenate((words.ends, offsets[1:][more]))
        rows = np.concatenate((words.rows, more))
        # the split rule joins other blanks of Unicode with those around them: such a text is one unit
        whole = np.zeros(words.n_rows, dtype=bool)
        whole[np.searchsorted(offsets, other_blanks(data), "right") - 1] = True
        if whole.any():
            cut, at = ~whole[rows], np.flatnonzero(whole)
            starts, ends, rows = np.concatenate((starts[cut], offsets[at])), np.concatenate((ends[cut], offsets[at + 1])), np.concatenate((rows[cut], at))
        order = np.argsort(starts, kind="stable")
        return texts.Spans(data, starts[order], ends[order], rows[order], words.n_rows)

    def library(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units (none empty) by the library in a row, and how many each has."""
        parts, joined = [], []
        for k in range(0, len(units), TOGETHER):
            own = units[k:k + TOGETHER]
            text = self.mark.join(own)
            # a unit that holds the mark is encoded alone, and those around it
            together = bool(self.mark) and text.count(self.mark) == len(own) - 1
            parts += [text] if together else own
            joined += [True] if together else [False] * len(own)
        got = [x.ids for x in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, got), dtype=np.int64, count=len(got))
        ids = np.fromiter(itertools.chain.from_iterable(got), dtype=np.int32, count=int(sizes.sum()))
        marks = np.zeros(len(ids), dtype=bool)
        if self.mark:
            marks = (ids == self.mark_id) & np.repeat(np.array(joined, dtype=bool), sizes)
        # a unit ends where a mark or the end of a text is; marks are no ids of units
        ends = np.sort(np.concatenate((np.flatnonzero(marks), np.cumsum(sizes))))
        return ids[~marks], np.diff(ends - np.concatenate(([0], np.cumsum(marks)))[ends], prepend=0)

    def encode(self, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, each text followed by the end id; ids of each text."""
        units = self.units(column)
        keys, where, which = np.unique(units.hashes(), return_index=True, return_inverse=True)
        numbers = self.known.find(keys)
        new = np.flatnonzero(numbers < 0)
        if self.known.full(len(new)):
            self.known.clear()
            self.pool, self.ends = np.empty(0, dtype=np.int32), np.zeros(1, dtype=np.int64)
            new = np.arange(len(keys))
        if len(new):
            body = units.data.tobytes()
            found = [body[a:b].decode() for a, b in zip(units.starts[where[new]].tolist(), units.ends[where[new]].tolist(), strict=True)]
            ids, sizes = self.library(found)
            first = len(self.ends) - 1
            self.pool, self.ends = np.concatenate((self.pool, ids)), np.concatenate((self.ends, len(self.pool) + np.cumsum(sizes)))
            self.known.add(keys[new], first + np.arange(len(new)))
            numbers = self.known.find(keys)
        starts, sizes = self.ends[numbers][which], (self.ends[numbers + 1] - self.ends[numbers])[which]
        # each text's end id takes a place of its own after the ids of its units
        n = np.bincount(units.rows, weights=sizes, minlength=units.n_rows).astype(np.int64) + 1
        ends = np.cumsum(n)
        out = np.full(int(ends[-1]) if len(ends) else 0, end_id, dtype=np.int32)
        total = np.cumsum(sizes) - sizes
        index = np.arange(int(sizes.sum()), dtype=np.int64)
        out[index + np.repeat(units.rows, sizes)] = self.pool[index + np.repeat(starts - total, sizes)]
        return out, n


_BLOCK_SCHEMA = "shard int, segment int, block int, first long, n_ids long, crc long, payload binary"
_DIGEST_SCHEMA = "shard int, segment int, doc_id long, before long, n_tokens long, ids_crc32 long"


def _table(found: list[tuple], schema: str) -> dict[str, pa.Array]:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    columns = [c.split() for c in schema.split(", ")]
    return {name: pa.array([row[k] for row in found], kinds[kind]) for k, (name, kind) in enumerate(columns)}


def _segment(shard: int, segment: int, first: int, ids: np.ndarray, keys: pa.Array, sizes: np.ndarray, size: int, block: int, lanes: int) -> Iterator[pa.RecordBatch]:
    """Rows of one segment: its index, then its blocks."""
    known = np.asarray(pc.is_valid(keys))
    columns = (np.asarray(pc.fill_null(keys, 0)).astype("<i8"), sizes.astype("<i8"), known.astype("u1"))
    packed = [zlib.compress(c.tobytes(), 6) for c in columns]
    head = size.to_bytes(8, "little") + b"".join(len(p).to_bytes(8, "little") + p for p in packed)
    yield pa.RecordBatch.from_pydict(_table([(shard, segment, -1, first, len(ids), zlib.crc32(head), head)], _BLOCK_SCHEMA))
    for start in range(0, len(ids), block * lanes):
        blocks = [ids[k:k + block].astype(np.int32) for k in range(start, min(start + block * lanes, len(ids)), block)]
        payloads = encode_blocks(blocks, size)
        yield pa.RecordBatch.from_pydict(_table([
            (shard, segment, start // block + k, first + start + k * block, len(b), zlib.crc32(b.astype("<u4").tobytes()), p)
            for k, (b, p) in enumerate(zip(blocks, payloads, strict=True))], _BLOCK_SCHEMA))


def _write_shard(path: str, end_id: int, block: int, lanes: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, encoder = TaskContext.get().partitionId(), UnitEncoder(path)
        ids, keys, sizes, held, segment, first = [], [], [], 0, 0, 0
        for part in itertools.chain(texts.chunks(batches), [None]):
            if part is not None:
                got, n = encoder.encode(part.column("text"), end_id)
                ids.append(got)
                keys.append(part.column("doc_id"))
                sizes.append(n)
                held += len(got)
            # a segment ends with a document
            if held and (part is None or held >= block * lanes):
                yield from _segment(shard, segment, first, np.concatenate(ids), pa.concat_arrays(keys), np.concatenate(sizes), encoder.size, block, lanes)
                segment, first = segment + 1, first + held
                ids, keys, sizes, held = [], [], [], 0
        if segment:
            yield pa.RecordBatch.from_pydict(_table([(shard, -1, -1, 0, first, 0, b"")], _BLOCK_SCHEMA))

    return work


def write(docs: DataFrame, path: str, folder: str, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID, block: int = BLOCK, lanes: int = LANES, shards: int | None = None) -> None:
    """Write the ids of all documents in ascending id order below a folder; shards: parts of about `SHARD_BYTES` if not given."""
    spark = docs.sparkSession
    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"))
    if shards is None:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        usual = min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // LEAST_SHARD_BYTES))
        shards = max(1, -(-size // SHARD_BYTES), usual)
    # rows of one id may lie in several shards, if their texts differ
    rows = rows.withColumn("mark", F.xxhash64("text"))
    rows = rows.repartitionByRange(shards, F.col("doc_id").asc_nulls_first(), "mark").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "mark")
    rows.select("doc_id", "text").mapInArrow(texts.tidy(_write_shard(tokenizer, end_id, block, lanes)), _BLOCK_SCHEMA).write.parquet(f"{folder}/{path}")


def _head(payload: bytes) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Size of the vocabulary, document ids, ids of each document, and which document ids are known."""
    parts, at = [], 8
    while at < len(payload):
        size = int.from_bytes(payload[at:at + 8], "little")
        parts.append(zlib.decompress(payload[at + 8:at + 8 + size]))
        at += 8 + size
    return int.from_bytes(payload[:8], "little"), *(np.frombuffer(p, dtype=kind) for p, kind in zip(parts, ("<i8", "<i8", "u1"), strict=True))


def _read_segment(rows: pa.Table) -> pa.Table:
    """Digests of the documents of one segment, from its blocks."""
    rows = rows.sort_by("block")
    found = {name: rows.column(name).to_pylist() for name in ("block", "first", "n_ids", "crc", "payload")}
    shard, segment, head = rows.column("shard")[0].as_py(), rows.column("segment")[0].as_py(), found["payload"][0]
    whole = found["block"] == list(range(-1, rows.num_rows - 1)) and found["n_ids"][0] == sum(found["n_ids"][1:])
    if not whole or zlib.crc32(head) != found["crc"][0]:
        raise ValueError(f"shard {shard}, segment {segment}: damaged or incomplete")
    size, keys, sizes, known = _head(head)
    every, at = np.empty(found["n_ids"][0], dtype="<u4"), 0
    for start in range(1, rows.num_rows, LANES):
        own = slice(start, start + LANES)
        for got, crc, number in zip(decode_blocks(found["payload"][own], found["n_ids"][own], size), found["crc"][own], found["block"][own], strict=True):
            got = got.astype("<u4")
            if zlib.crc32(got.tobytes()) != crc:
                raise ValueError(f"shard {shard}, segment {segment}, block {number}: checksum")
            every[at:at + len(got)] = got
            at += len(got)
    cuts = np.concatenate(([0], np.cumsum(sizes)))
    n = len(keys)
    return pa.table({
        "shard": pa.array([shard] * n, pa.int32()), "segment": pa.array([segment] * n, pa.int32()), "doc_id": pa.array(keys, pa.int64(), mask=known == 0),
        "before": found["first"][0] + cuts[:-1], "n_tokens": pa.array(sizes, pa.int64()),
        "ids_crc32": pa.array([zlib.crc32(every[a:b].tobytes()) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())], pa.int64())})


def read(spark, folder: str, path: str) -> DataFrame:
    """Start, number and checksum of every document's ids, decoded from the files."""
    blocks = spark.read.parquet(f"{folder}/{path}")
    counted = blocks.filter("block = -1").groupBy("shard").agg(
        F.sum(F.when(F.col("segment") >= 0, F.col("n_ids"))).alias("n_ids"), F.max(F.when(F.col("segment") < 0, F.col("n_ids"))).alias("whole"))
    n_ids = F.when(F.col("n_ids") == F.col("whole"), F.col("n_ids")).otherwise(F.raise_error(F.format_string("shard %d: incomplete", "shard")).cast("long"))
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row for each shard
    offsets = counted.select("shard", n_ids.alias("n_ids")).select(F.col("shard").alias("of"), F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("offset"), "n_ids")
    digests = blocks.filter("segment >= 0").groupBy("shard", "segment").applyInArrow(_read_segment, _DIGEST_SCHEMA)
    start = F.coalesce("offset", F.raise_error(F.lit("incomplete")).cast("long")) + F.col("before")
    return digests.join(offsets, F.col("shard") == F.col("of"), "left").select("doc_id", start.alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID) -> DataFrame:
    """Write all ids, and read them back from the files."""
    spark = docs.sparkSession
    folder = session.scratch_path(spark, "ids")
    write(docs, "blocks", folder, tokenizer, key, text, end_id)
    return read(spark, folder, "blocks")
