import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from conftest import SMALL
from stormledger import session
from stormledger.llm import catalog, range_coder

PATH = public_tokenizers.path("byte_bpe_50k.json")


def expected(docs):
    tokenizer, start, out = Tokenizer.from_file(PATH), 0, []
    for r in sorted(docs.collect(), key=lambda r: r["doc_id"]):
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        out.append((r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_query_against_library(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert sorted(tuple(r) for r in catalog.QUERIES["op2_range_coder"](spark, SMALL).collect()) == expected(docs)


def test_odd_texts(odd, spark):
    found = sorted(tuple(r) for r in range_coder.round_trip(odd, PATH).collect())
    assert found == expected(odd)


def test_blanks_of_all_kinds(spark):
    rows = [" a", "a ", "a  b", "a\n\nb \n", "\t\ta", " \n ", "a\u00a0\n\nb", "a \u2003 b", "\u3000", "x<|endoftext|> \n<|endoftext|>y", "a \r\n b", "don't  'll"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert sorted(tuple(r) for r in range_coder.round_trip(docs, PATH).collect()) == expected(docs)


def test_no_rows(none):
    assert range_coder.round_trip(none, PATH).count() == 0


@pytest.mark.parametrize("kind", ["random", "constant", "cycle", "rare", "mixed"])
def test_round_trip_of_blocks(kind):
    draw = np.random.default_rng(1)
    n = 3000
    ids = {
        "random": draw.integers(0, 50_000, n), "constant": np.full(n, 7), "cycle": np.tile([5, 9, 5, 11], n // 4),
        "rare": np.where(draw.random(n) < 0.001, draw.integers(0, 50_000, n), 3), "mixed": draw.geometric(0.01, n),
    }[kind].astype(np.int32)
    blocks = [ids[:2000], ids[2000:2001], ids[2001:], ids[:1], ids[:500]]
    payloads = range_coder.encode_blocks(blocks, 50_257)
    assert all((a == b).all() for a, b in zip(blocks, range_coder.decode_blocks(payloads, [len(b) for b in blocks], 50_257), strict=True))
    # each block can be read alone
    for block, payload in zip(blocks, payloads, strict=True):
        assert (range_coder.decode_blocks([payload], [len(block)], 50_257)[0] == block).all()
    if kind in ("constant", "cycle"):
        assert len(payloads[0]) < 2000 // 8


def test_repeated_text_costs_less_than_order_0():
    draw = np.random.default_rng(2)
    phrase = draw.integers(0, 1000, 60)
    ids = np.tile(phrase, 30).astype(np.int32)
    assert len(range_coder.encode_blocks([ids], 1000)[0]) * 8 < len(ids) * np.log2(60) / 2


def test_damage_is_found(spark, odd):
    from pyspark.sql import functions as F

    folder = session.scratch_path(spark, "ids")
    range_coder.write(odd, "blocks", folder, PATH, shards=2)
    blocks = spark.read.parquet(f"{folder}/blocks")
    broken = blocks.withColumn("payload", F.when(F.col("block") == 0, F.unhex(F.regexp_replace(F.hex("payload"), "^..", "FF"))).otherwise(F.col("payload")))
    broken.write.parquet(f"{folder}/broken")
    with pytest.raises(Exception, match="checksum"):
        range_coder.read(spark, folder, "broken").collect()
    for part, lost in (("block", "block != 0 or segment != 0"), ("index", "block != -1")):
        blocks.filter(lost).write.parquet(f"{folder}/no-{part}")
        with pytest.raises(Exception, match="incomplete"):
            range_coder.read(spark, folder, f"no-{part}").collect()
    blocks.filter("block != 0").write.parquet(f"{folder}/less")
    with pytest.raises(Exception, match="incomplete"):
        range_coder.read(spark, folder, "less").collect()


def test_blocks_are_in_order_of_ids(spark):
    folder = session.scratch_path(spark, "ids")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    range_coder.write(docs, "blocks", folder, PATH, shards=4, block=512)
    blocks = spark.read.parquet(f"{folder}/blocks")
    assert blocks.select("shard").distinct().count() == 4
    assert blocks.filter("n_ids > 512 and block >= 0").count() == 0
    assert sorted(tuple(r) for r in range_coder.read(spark, folder, "blocks").collect()) == expected(docs)


def test_segments_end_with_a_document_and_each_is_needed(spark):
    docs = spark.createDataFrame([(k, ("-" * 64 + " ") * 4000 + f"text {k}") for k in range(16)], "doc_id long, text string").repartition(3)
    folder = session.scratch_path(spark, "ids")
    range_coder.write(docs, "blocks", folder, PATH, shards=2, block=512, lanes=16)
    blocks = spark.read.parquet(f"{folder}/blocks")
    assert blocks.select("shard", "segment").distinct().count() >= 4
    assert sorted(tuple(r) for r in range_coder.read(spark, folder, "blocks").collect()) == expected(docs)
    blocks.filter("segment != 1").write.parquet(f"{folder}/less")
    with pytest.raises(Exception, match="incomplete"):
        range_coder.read(spark, folder, "less").collect()


def test_rows_without_id_and_large_ids(spark):
    big = 2 ** 53 + 1
    docs = spark.createDataFrame([(None, "a b"), (big, "c d e"), (None, "x"), (-4, None)], "doc_id long, text string")
    found = sorted((tuple(r) for r in range_coder.round_trip(docs, PATH).collect()), key=lambda r: r[1])
    assert [r[0] for r in found] == [None, None, -4, big]
    assert [r[1] for r in found] == [0, *np.cumsum([r[2] for r in found])[:-1].tolist()] and [r[2] for r in found[2:]] == [1, 4]


def test_orders_are_mixed():
    """Weights go to the order that is right, and an id that two orders expect has the sum of their parts."""
    ids = np.tile([3, 8, 3, 9], 300).astype(np.int64)  # what follows 3 is told by order 2 alone
    mixer = range_coder.Mixer(1, 1000)
    for k in ids:
        mixer.predict(1)
        mixer.learn(np.array([k]))
    shares = []
    for k in ids[:4]:
        id2, id1, end2, end1 = mixer.predict(1)
        shares.append((int(id2[0]) == k, int(end2[0])))
        mixer.learn(np.array([k]))
    assert all(right and share > 0.9 * range_coder._DECIDE for right, share in shares)


def test_order_0_adapts_within_a_block():
    draw = np.random.default_rng(4)
    few, many = draw.integers(40_000, 40_020, 2000).astype(np.int32), draw.integers(0, 50_000, 2000).astype(np.int32)
    cost = [len(p) * 8 / 2000 for p in range_coder.encode_blocks([few, many], 50_257)]
    assert cost[0] < 6.5 and cost[1] < 20


def test_a_block_of_many_ids_is_small_in_memory_and_longer_ones_are_coded_whole():
    """Tables of a block follow its length, not the vocabulary; blocks of any lengths go together."""
    held = [sum(x.nbytes for x in range_coder.Mixer(1, range_coder._room(n)).sums) for n in (1, 2048, 20_000)]
    assert held[0] == held[1] < 10_000 < held[2]
    draw = np.random.default_rng(5)
    blocks = [draw.integers(0, 50_257, n).astype(np.int32) for n in (20_000, 3, 2048, 2049)] + [np.zeros(5000, dtype=np.int32)]
    payloads = range_coder.encode_blocks(blocks, 50_257)
    for block, payload, got in zip(blocks, payloads, range_coder.decode_blocks(payloads, [len(b) for b in blocks], 50_257), strict=True):
        assert (got == block).all() and (range_coder.decode_blocks([payload], [len(block)], 50_257)[0] == block).all()


def test_blanks_that_do_not_cut_words_are_found_in_bytes():
    marks = [c for k in range(0x3100) if (c := chr(k)).isspace() and c not in " \t\n\v\f\r"]
    text = "a".join(marks) + "é“…”‐⁠、" + "â"
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    want = [len(text[:k].encode()) for k, c in enumerate(text) if c in marks]
    assert range_coder.other_blanks(data).tolist() == want and not len(range_coder.other_blanks(data[:0]))


def test_new_units_go_to_the_library_together(monkeypatch):
    """Few texts for many units, with the ids that each unit has alone; units that hold the mark stay alone."""
    encoder = range_coder.UnitEncoder(PATH)
    units = [f" w{k}é" for k in range(700)] + ["\n\n", "a", " <|endof", "text|>", "x<|endoftext|>y", "<|endoftext|>", " <|endoftext|", ">"] + [f"\tv{k}" for k in range(300)]
    calls, tokenizer = [], encoder.tokenizer

    class Counted:
        def encode_batch_fast(self, parts, **how):
            calls.append(len(parts))
            return tokenizer.encode_batch_fast(parts, **how)

    encoder.tokenizer = Counted()
    ids, sizes = encoder.library(units)
    alone = [tokenizer.encode(u, add_special_tokens=False).ids for u in units]
    assert sizes.tolist() == [len(x) for x in alone] and ids.tolist() == sum(alone, [])
    assert sum(calls) <= range_coder.TOGETHER + 3
    encoder.mark = ""
    assert [x.tolist() for x in encoder.library(units)] == [ids.tolist(), sizes.tolist()]
    assert [len(x) for x in encoder.library([])] == [0, 0]
