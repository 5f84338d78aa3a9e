"""Jaccard self-join of word n-gram sets by prefix filters under several orders.

Under any fixed order of all shingles, two sets of Jaccard similarity t share a
shingle among their first n - ceil(t n) + 1. The orders used here put rare
shingles first, by their rough frequency over all documents, and differ in how
they order shingles of one frequency. A pair must share a prefix shingle under
every order; what passes all filters is verified on the whole sets.

Work stays in proportion to the prefixes:

- documents with one set are one class; only classes meet;
- shingles that one class alone has in its prefix are dropped first;
- every class of a shingle's group is compared with the group's smallest class,
  its hub; classes that hubs connect, over any groups, need no comparison with
  each other, as they are in one component anyway. Where classes of a group are
  still apart the next smallest is the hub, as long as that at least halves the
  pairs that are left. What is left is compared in blocks of a group's classes,
  from which only the pairs come out that pass the filters;
- before whole sets move, `BITS` parities of each set bound how much two differ:
  the parities in which they differ are no more than the shingles in which they do.
  Classes that meet others by chance in small groups alone, as more do in a larger
  corpus, are told by sizes and parities, so that their texts are not read again.

Frequencies come from a table of `BUCKETS` counters over all documents; a
coarse count only costs speed, since any fixed order gives the same pairs.

Defined cases: null texts and those without words have an empty set and link to
nothing; with fewer than `n` words the whole sequence is the one shingle;
repeated rows give repeated results; a set that only rows with a null id have
links to nothing; an empty table gives an empty result; further columns are not
read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stormledger import session
from stormledger.llm import texts

WORDS = 4
#: Least similarity, in percent.
PERCENT = 85
ORDERS = 3
#: Counters of shingle frequencies; they reach the driver as one byte each.
BUCKETS = 1 << 22
#: Bits of a shingle's hash that name it in groups: few enough to move cheaply; shingles of one name only make their group larger.
TOKEN_BITS = 40
#: Bits of the set of wanted documents, which goes to all tasks; a full one only lets more texts pass.
WANTED_BITS = 1 << 26
#: Parities of a set, in 64-bit words.
BITS = 1024
#: Classes of a group that are compared with as many others in one piece of work; groups of up to `SMALL` are joined.
BLOCK, SMALL = 1024, 4
#: Classes of a group whose pairs are all told by sizes and parities before texts are read again; larger ones stay whole.
CHANCE = 32
#: Classes whose numbers are broadcast, at most; beyond, Spark joins them.
FEW = 1 << 18
_PART = 1 << 16
U64 = texts.U64


def shingle_sets(column: pa.Array, n: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    data, offsets = texts.raw(column)
    words = texts.words(texts.LOWER[data], offsets)
    hashes, rows, edges = words.hashes(), words.rows, words.edges()
    found, first = texts.windows(hashes, rows, n)
    cuts = np.searchsorted(rows[first], np.arange(words.n_rows + 1)) if len(first) else np.zeros(words.n_rows + 1, dtype=np.int64)
    out = []
    for row in range(words.n_rows):
        own = found[cuts[row]:cuts[row + 1]]
        if not len(own) and edges[row] < edges[row + 1]:
            short = hashes[edges[row]:edges[row + 1]]
            own = texts.mix(texts.windows(short, np.zeros(len(short), dtype=np.int64), len(short))[0] + U64(len(short)))
        out.append(np.unique(own))
    return out


def class_of(own: np.ndarray) -> int:
    """A number of a set, the same for equal sets."""
    total = texts.mix(own ^ U64(0xD6E8FEB86659FD93)).sum(dtype=U64) + U64(len(own))
    return int(texts.mix(np.array([total], dtype=U64)).view(np.int64)[0])


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """Shingles of a set's prefix."""
    return n - -(-percent * n // 100) + 1


def prefix(own: np.ndarray, levels: np.ndarray, order: int, percent: int = PERCENT) -> np.ndarray:
    """The first shingles of a set: by level of frequency, then by a hash that each order has of its own."""
    size = prefix_length(len(own), percent)
    place = (levels[own & U64(len(levels) - 1)].astype(U64) << U64(56)) | (texts.mix(own + U64(order * 0xA0761D6478BD642F % (1 << 64))) >> U64(8))
    return own[np.argpartition(place, size - 1)[:size]] if size < len(own) else own


def packed_counts(counts: np.ndarray) -> bytes:
    """Counters, compressed byte by byte of all of them: most have one small byte."""
    return zlib.compress(counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpacked_counts(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), dtype=np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


def _census(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """Class and size of every document; counters of shingles once per task, in parts."""
    names = ["doc_id", "cls", "n", "bits", "part", "counts"]
    total = np.zeros(BUCKETS, dtype=np.uint32)
    for batch in texts.chunks(batches):
        sets = shingle_sets(batch.column("text"), n)
        every = np.concatenate([np.empty(0, dtype=U64), *sets])
        np.add.at(total, (every & U64(BUCKETS - 1)).astype(np.int64), np.uint32(1))
        size = batch.num_rows
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array([class_of(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
            pa.array([parities(s) for s in sets], pa.list_(pa.int64())), pa.nulls(size, pa.int32()), pa.nulls(size, pa.binary())], names)
    for part in range(BUCKETS // _PART):
        own = total[part * _PART:(part + 1) * _PART]
        if own.any():
            yield pa.RecordBatch.from_arrays([
                pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.list_(pa.int64())), pa.array([part], pa.int32()),
                pa.array([packed_counts(own)], pa.binary())], names)


def _sum_counts(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(_PART, dtype=np.uint64)
    for packed in pdf["counts"]:
        total += unpacked_counts(packed)
    return pd.DataFrame({"part": [pdf["part"].iloc[0]], "counts": [packed_counts(np.minimum(total, 0xFFFFFFFF))]})


def frequency_levels(counts: DataFrame) -> np.ndarray:
    """Counters as levels of a quarter of a power of two. The driver gets `BUCKETS` counters, whatever the input."""
    # summed in two steps, so that no task gets the parts of all others
    some = counts.withColumn("salt", F.spark_partition_id() % 16).groupBy("part", "salt").applyInPandas(texts.tidy_groups(_sum_counts), "part int, counts binary")
    out = np.zeros(BUCKETS, dtype=np.uint8)
    for row in some.groupBy("part").applyInPandas(texts.tidy_groups(_sum_counts), "part int, counts binary").collect():
        own = unpacked_counts(row["counts"])
        out[row["part"] * _PART:(row["part"] + 1) * _PART] = np.minimum(255, 4 * np.log2(own + 1.0))
    return out


def _shared(rows: DataFrame) -> DataFrame:
    """Of (token, cls): each row of a token of at least two classes, once. Rows are read and move once."""
    of_token = Window.partitionBy("token")
    told = rows.withColumn("low", F.min("cls").over(of_token)).withColumn("high", F.max("cls").over(of_token))
    return told.filter("low < high").select("token", "cls").distinct()


def parities(own: np.ndarray) -> np.ndarray:
    """For each of `BITS` cells whether an odd number of shingles fall into it."""
    at = texts.mix(own ^ U64(0x8BB84B93962EACC9))
    out = np.zeros(BITS // 64, dtype=U64)
    np.bitwise_xor.at(out, (at >> U64(6)).astype(np.int64) % len(out), U64(1) << (at & U64(63)))
    return out.view(np.int64)


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the (stored) pairs (a, b), those whose sets are similar enough."""
    def whole(side: str) -> DataFrame:
        met = session.materialize(pairs.select(F.col(side).alias("cls")).distinct(), "met")
        own = sets.select("cls", "own").join(F.broadcast(met) if met.count() <= FEW else met, "cls", "left_semi")
        return own.select(F.col("cls").alias(side), F.col("own").alias(f"own_{side}"))

    common = F.size(F.array_intersect("own_a", "own_b")).cast("long")
    similar = common * 100 >= (F.size("own_a").cast("long") + F.size("own_b") - common) * percent
    # of the hubs, which are fewer, each set moves once
    return pairs.join(whole("b"), "b").join(whole("a"), "a").filter(similar).select("a", "b")


def _bitmap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(WANTED_BITS // 8, dtype=np.uint8)
    for batch in batches:
        at = texts.mix(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(U64)) & U64(WANTED_BITS - 1)
        np.bitwise_or.at(bits, (at >> U64(3)).astype(np.int64), (U64(1) << (at & U64(7))).astype(np.uint8))
    for part in range(len(bits) // _PART):
        own = bits[part * _PART:(part + 1) * _PART]
        if own.any():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([zlib.compress(own.tobytes(), 1)], pa.binary())], ["part", "bits"])


def _or_bits(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(_PART, dtype=np.uint8)
    for packed in pdf["bits"]:
        total |= np.frombuffer(zlib.decompress(packed), dtype=np.uint8)
    return pd.DataFrame({"part": [pdf["part"].iloc[0]], "bits": [zlib.compress(total.tobytes(), 1)]})


def wanted_texts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows (doc_id, text) of about the wanted ids: all of them, and a few that share a bit.

    Keeps most texts from moving in a later join. The driver gets `WANTED_BITS` bits, whatever the input.
    """
    parts = wanted.select("doc_id").filter("doc_id is not null").mapInArrow(texts.tidy(_bitmap), "part int, bits binary")
    some = parts.withColumn("salt", F.spark_partition_id() % 16).groupBy("part", "salt").applyInPandas(texts.tidy_groups(lambda pdf: _or_bits(pdf.drop(columns="salt"))), "part int, bits binary")
    bits = np.zeros(WANTED_BITS // 8, dtype=np.uint8)
    for row in some.groupBy("part").applyInPandas(texts.tidy_groups(_or_bits), "part int, bits binary").collect():
        bits[row["part"] * _PART:(row["part"] + 1) * _PART] = np.frombuffer(zlib.decompress(row["bits"]), dtype=np.uint8)
    shared = rows.sparkSession.sparkContext.broadcast(bits)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.chunks(batches):
            ids = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            at = texts.mix(ids.view(U64)) & U64(WANTED_BITS - 1)
            yield batch.filter(pa.array(shared.value[(at >> U64(3)).astype(np.int64)] >> (at & U64(7)).astype(np.uint8) & 1 == 1))

    return rows.mapInArrow(texts.tidy(work), "doc_id long, text string")


def _sizes_fit(percent: int) -> Column:
    return (F.col("n_a") * 100 >= F.col("n_b") * percent) & (F.col("n_b") * 100 >= F.col("n_a") * percent)


def _parities_fit(percent: int) -> Column:
    """The sets differ in `apart` shingles at least: an upper bound of what they have in common."""
    apart = F.aggregate(F.zip_with("bits_a", "bits_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x).cast("long")
    both = F.col("n_a") + F.col("n_b")
    return (both - apart) * (100 + percent) >= both * 2 * percent


def _filtered(pairs: DataFrame, marks: DataFrame, percent: int, orders: int) -> DataFrame:
    """Pairs (a, b) that pass the size filter and share a prefix shingle under every further order."""
    def side(name: str) -> DataFrame:
        return marks.select(F.col("cls").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("n", "bits", *[f"t{k}" for k in range(1, orders)])])

    fits = _sizes_fit(percent)
    for k in range(1, orders):
        fits &= F.arrays_overlap(f"t{k}_a", f"t{k}_b")
    return pairs.join(side("a"), "a").join(side("b"), "b").filter(fits & _parities_fit(percent)).select("a", "b")


def _not_by_chance(groups: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Rows (token, cls) of large groups, and of classes that sizes and parities let be similar to another one of a small group.

    Similar classes pass both, so that none of their pairs is lost.
    """
    sized = groups.join(groups.groupBy("token").agg(F.count("*").alias("m")), "token")
    small = sized.filter(F.col("m") <= CHANCE).join(classes.select("cls", "n"), "cls")
    one, two = (small.select("token", F.col("cls").alias(side), F.col("n").alias(f"n_{side}")) for side in "ab")
    pairs = one.join(two, "token").filter((F.col("a") < F.col("b")) & _sizes_fit(percent)).select("a", "b", "n_a", "n_b").distinct()
    for side in "ab":
        pairs = pairs.join(classes.select(F.col("cls").alias(side), F.col("bits").alias(f"bits_{side}")), side)
    near = session.materialize(pairs.filter(_parities_fit(percent)).select("a", "b"), "near")
    near = near.select(F.col("a").alias("cls")).unionAll(near.select("b")).distinct()
    return sized.filter(F.col("m") > CHANCE).select("token", "cls").unionByName(sized.filter(F.col("m") <= CHANCE).join(near, "cls", "left_semi").select("token", "cls"))


def _apart(members: DataFrame, marks: DataFrame, percent: int, orders: int) -> DataFrame:
    """Pairs (a, b) of a group's classes (token, cls, at, n) of different components that pass all filters, each once."""
    sizes = members.groupBy("token").agg(F.count("*").alias("m"))
    members = members.join(sizes, "token")
    small = members.filter(F.col("m") <= SMALL)
    one, two = (small.select([F.col(c).alias(f"{c}_{side}") for c in ("token", "cls", "at", "n")]) for side in "ab")
    fits = (F.col("token_a") == F.col("token_b")) & (F.col("cls_a") < F.col("cls_b")) & (F.col("at_a") != F.col("at_b"))
    fits &= (F.col("n_a") * 100 >= F.col("n_b") * percent) & (F.col("n_b") * 100 >= F.col("n_a") * percent)
    pairs = one.join(two, fits).select(F.col("cls_a").alias("a"), F.col("cls_b").alias("b")).distinct()
    few = _filtered(session.materialize(pairs, "small-pairs"), marks, percent, orders)

    large = members.filter(F.col("m") > SMALL)
    # every part of a group meets every part, itself included
    parts = F.ceil(F.col("m") / F.lit(BLOCK)).cast("int")
    placed = large.withColumn("part", F.pmod(F.xxhash64("cls"), parts.cast("long")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    placed = placed.select("token", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "cls", "at")
    groups = large.groupBy("cls").agg(F.collect_list("token").alias("tokens"))
    prefixes = [f"t{k}" for k in range(1, orders)]
    placed = placed.join(marks.join(groups, "cls").select("cls", "n", "bits", "tokens", *prefixes), "cls")

    def compare(table: pa.Table) -> pa.Table:
        found: tuple[list[int], list[int]] = ([], [])
        token, i, j = (table.column(c)[0].as_py() for c in ("token", "i", "j"))
        cls, at, n, part = (table.column(c).to_numpy() for c in ("cls", "at", "n", "part"))
        bits = table.column("bits").combine_chunks().flatten().to_numpy().reshape(len(cls), -1).view(U64)
        left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
        lists = [(x.offsets.to_numpy(), x.values.to_numpy()) for x in (table.column(c).combine_chunks() for c in ("tokens", *prefixes))]
        sets: dict[int, list[set[int]]] = {}

        def own(row: int) -> list[set[int]]:
            if row not in sets:
                sets[row] = [set(values[ends[row]:ends[row + 1]].tolist()) for ends, values in lists]
            return sets[row]

        for first in range(0, len(left), 64):
            rows = left[first:first + 64]
            apart = np.bitwise_count(bits[rows][:, None, :] ^ bits[right][None, :, :]).sum(axis=2, dtype=np.int64)
            x, y = n[rows][:, None], n[right][None, :]
            fits = ((x + y - apart) * (100 + percent) >= (x + y) * 2 * percent) & (x * 100 >= y * percent) & (y * 100 >= x * percent)
            fits &= at[rows][:, None] != at[right][None, :]
            if i == j:
                fits &= cls[rows][:, None] < cls[right][None, :]
            for p, q in zip(*(z.tolist() for z in np.nonzero(fits)), strict=True):
                a, b = own(int(rows[p])), own(int(right[q]))
                # a pair comes from the first of the groups that it shares
                if min(a[0] & b[0]) == token and not any(u.isdisjoint(v) for u, v in zip(a[1:], b[1:], strict=True)):
                    low, high = sorted((int(cls[rows[p]]), int(cls[right[q]])))
                    found[0].append(low)
                    found[1].append(high)
        return pa.table({"a": pa.array(found[0], pa.int64()), "b": pa.array(found[1], pa.int64())})

    many = placed.groupBy("token", "i", "j").applyInArrow(texts.tidy_groups(compare), "a long, b long")
    return few.unionByName(many).distinct()


def stars(edges: DataFrame) -> bool:
    """Whether every node of the distinct (a, b) has one `a`, which is no other's `b`: then `a` names its component."""
    ends = edges.select(F.col("b").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("a").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    others = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up + down > 1")
    return not others.agg(F.count("*").alias("n")).first()["n"]


def connected(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node each node of (a, b) is connected with.

    Each round hangs every node and its neighbours on the smallest of them, in turn
    among larger and smaller neighbours, until all hang on the smallest of their
    component; paths halve, so rounds grow with the logarithm of their length.
    Links that are so already need no round.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges, round_ = session.materialize(links.select(low.alias("a"), high.alias("b")).filter("a < b").distinct(), "edges"), 0
    while not stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large star: larger neighbours of a node hang on the smallest around it
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), F.col("b")).distinct()
        # small star: a node and its smaller neighbours hang on the smallest of these
        down = large.select(F.col("b").alias("node"), F.col("a").alias("to"))
        least = down.groupBy("node").agg(F.min("to").alias("m"))
        joined = down.join(least, "node")
        small = joined.select(F.col("m").alias("a"), F.col("to").alias("b")).unionByName(least.select(F.col("m").alias("a"), F.col("node").alias("b")))
        edges, round_ = session.materialize(small.filter("a < b").distinct(), f"edges-{round_}"), round_ + 1
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))


def similar(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = WORDS, percent: int = PERCENT, orders: int = ORDERS) -> tuple[DataFrame, DataFrame]:
    """(doc_id, cls, n) of every document, and pairs (a, b) of classes that join all similar ones.

    A pair is similar, or `a` is the smallest class that similar ones connect with `b`.
    """
    spark = docs.sparkSession
    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"))
    census = session.materialize(rows.mapInArrow(texts.tidy(lambda batches: _census(batches, n)), "doc_id long, cls long, n long, bits array<long>, part int, counts binary"), "census")
    nodes = census.filter("part is null").select("doc_id", "cls", "n")
    levels = spark.sparkContext.broadcast(frequency_levels(census.filter("part is not null").select("part", "counts")))

    def first_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in texts.chunks(batches):
            tokens, owners = [], []
            for own in shingle_sets(batch.column("text"), n):
                cls = class_of(own)
                if len(own) and cls not in seen:
                    # copies within a task are told once, as far as the task remembers
                    if len(seen) >= 200_000:
                        seen.clear()
                    seen.add(cls)
                    tokens.append(prefix(own, levels.value, 0, percent))
                    owners.append(cls)
            every = (np.concatenate([np.empty(0, dtype=U64), *tokens]) >> U64(64 - TOKEN_BITS)).view(np.int64)
            # the name last: its zeros are next to those between rows, which shuffles compress together
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array(owners, dtype=np.int64), [len(t) for t in tokens])), pa.array(every)], ["cls", "token"])

    entries = rows.select("text").mapInArrow(texts.tidy(first_order), "cls long, token long")
    groups = session.materialize(_shared(entries), "groups")

    classes = census.filter("part is null").groupBy("cls").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("bits").alias("bits"))
    classes = session.materialize(classes, "classes")
    groups = session.materialize(_not_by_chance(groups, classes, percent), "kept-groups")

    # whole sets of the classes that share a prefix shingle, from one document each
    met = groups.select("cls").distinct()
    of_class = classes.select("cls", "doc_id").join(met, "cls", "left_semi")
    of_class = session.materialize(of_class, "wanted")
    whole = wanted_texts(rows, of_class).join(of_class, "doc_id").select("cls", "text")

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[int] = set()  # rows of one id are in one task
        for batch in texts.chunks(batches):
            sets = shingle_sets(batch.column("text"), n)
            # half of each hash is enough for a filter
            further = [pa.array([prefix(s, levels.value, k, percent).astype(np.uint32).view(np.int32) for s in sets], pa.list_(pa.int32())) for k in range(1, orders)]
            out = pa.RecordBatch.from_arrays(
                [batch.column("cls"), pa.array([class_of(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())), pa.array([parities(s) for s in sets], pa.list_(pa.int64())), *further],
                ["cls", "again", "n", "own", "bits", *[f"t{k}" for k in range(1, orders)]])
            # an id that stands for several texts may bring another one's text, or one text twice
            keep = [a == b and a not in told and not told.add(a) for a, b in zip(out["cls"].to_pylist(), out["again"].to_pylist(), strict=True)]
            yield out.filter(pa.array(keep, pa.bool_())).drop_columns(["again"])

    schema = "cls long, n long, own array<long>, bits array<long>" + "".join(f", t{k} array<int>" for k in range(1, orders))
    sets = session.materialize(whole.mapInArrow(texts.tidy(sets_of), schema), "sets")
    levels.destroy()
    marks = sets.drop("own")

    # a group's hub meets all others; then the next one those that no link has brought to it
    links, left, round_ = None, None, 0
    members = groups.join(marks.select("cls", "n"), "cls").select("token", "cls", F.col("cls").alias("at"), "n")
    while True:
        members = session.materialize(members, f"members-{round_}")
        sizes = members.groupBy("token").agg(F.count("*").alias("m"))
        found = sizes.agg(F.coalesce(F.sum("m"), F.lit(0)).alias("members"), F.coalesce(F.sum(F.expr("m * (m - 1) div 2")), F.lit(0)).alias("pairs")).first()
        if not found["members"] or round_ and (found["pairs"] <= 2 * found["members"] or found["pairs"] > left // 2):
            break
        left = found["pairs"]
        hubs = members.groupBy("token").agg(F.min(F.struct("cls", "at", "n")).alias("h")).select("token", F.col("h.cls").alias("hub"), F.col("h.at").alias("hub_at"), F.col("h.n").alias("hub_n"))
        others = members.join(hubs, "token").filter("cls > hub")
        fits = (F.col("n") * 100 >= F.col("hub_n") * percent) & (F.col("hub_n") * 100 >= F.col("n") * percent)
        stars = others.filter((F.col("at") != F.col("hub_at")) & fits).select(F.col("hub").alias("a"), F.col("cls").alias("b")).distinct()
        stars = session.materialize(_filtered(stars, marks, percent, orders), f"star-pairs-{round_}")
        near = session.materialize(_linked(stars, sets, percent), f"stars-{round_}")
        # what is connected so far goes on as stars, and is not connected anew
        together = connected(near if links is None else links.unionByName(near))
        links = together.select(F.col("root").alias("a"), F.col("node").alias("b"))
        rest = others.select("token", "cls", "n").join(together.withColumnRenamed("node", "cls"), "cls", "left").withColumn("at", F.coalesce("root", "cls")).select("token", "cls", "at", "n")
        apart = rest.groupBy("token").agg(F.min("at").alias("x"), F.max("at").alias("y")).filter("x < y").select("token")
        members, round_ = rest.join(apart, "token", "left_semi"), round_ + 1
    if links is None:
        return nodes, spark.createDataFrame([], "a long, b long")
    rest = _apart(members, marks, percent, orders)
    # stored, so that Spark knows how few they are when it joins them with the sets
    rest = session.materialize(rest, "rest-pairs")
    rest = session.materialize(_linked(rest, sets, percent), "rest")
    return nodes, links.unionByName(rest)


def components(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = WORDS, percent: int = PERCENT, orders: int = ORDERS) -> DataFrame:
    """Set size and component of every document; a component is named by its smallest id."""
    nodes, links = similar(docs, key, text, n, percent, orders)
    by_class = nodes.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("least"))
    roots = connected(links).withColumnRenamed("node", "cls")
    named = by_class.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select(F.col("cls").alias("of"), "component_id")
    rows = nodes.join(named, (F.col("cls") == F.col("of")) & (F.col("n") > 0), "left")
    return rows.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents that name their component, each once; all columns stay."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    at, body = f"c{names.index(key)}", f"c{names.index(text)}"
    gone = found.filter("component_id != doc_id").select(F.col("doc_id").alias("_gone")).distinct()
    rows = plain.join(gone, F.col(at).cast("long") == F.col("_gone"), "left_anti")
    again = Window.partitionBy(at, F.xxhash64(body)).orderBy(F.lit(1))
    return rows.withColumn("_again", F.row_number().over(again)).filter("_again = 1").select(*plain.columns).toDF(*names)
