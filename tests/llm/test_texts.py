import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stormledger.llm import texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SAMPLE = ["", None, "a  b\tc", "\n", "Ä b\n\nc ", "日本 語", "a", " a", "\x1cb\x85c"]


def test_words_and_lines_are_those_of_the_pattern():
    column = pa.array(SAMPLE)
    data, offsets = texts.raw(column)
    words, lines = texts.words(data, offsets), texts.lines(data, offsets)
    for row, text in enumerate(SAMPLE):
        own = [words.content(k).decode() for k in np.flatnonzero(words.rows == row)]
        assert own == WORD.findall(text or "")
        assert [lines.content(k).decode() for k in np.flatnonzero(lines.rows == row)] == (text or "").split("\n")


def test_equal_spans_have_equal_hashes_wherever_they_stand():
    data, offsets = texts.raw(pa.array(["ab cd ab", "cd", "ab"]))
    words = texts.words(data, offsets)
    hashes = dict(zip([words.content(k) for k in range(len(words))], words.hashes().tolist(), strict=True))
    assert len(set(hashes.values())) == 2
    assert all(hashes[words.content(k)] == h for k, h in enumerate(words.hashes().tolist()))


def test_windows_stay_within_a_text():
    data, offsets = texts.raw(pa.array(["a b c", "a b", "a b c"]))
    words = texts.words(data, offsets)
    three, first = texts.windows(words.hashes(), words.rows, 3)
    assert first.tolist() == [0, 5] and three[0] == three[1]


def test_chunks_cover_all_rows_and_take_a_long_text_alone():
    batch = pa.record_batch([pa.array(["a" * n for n in (3, 50, 2, 2, 2, 0)])], ["text"])
    sizes = [part.num_rows for part in texts.chunks(iter([batch]), limit=5)]
    assert sum(sizes) == 6 and sizes == [1, 1, 2, 2]


def test_fold_is_crc32_of_the_key_as_text(spark):
    found = spark.range(50).select("id", texts.fold("id", 5).alias("f")).collect()
    assert all(r["f"] == texts.fold_of(r["id"], 5) for r in found)


def test_keep_texts_keeps_columns_of_any_name(odd):
    out = texts.keep_texts(odd.withColumnRenamed("kept", "a.b"), lambda part: np.array([t is None for t in part.column("text").to_pylist()]))
    assert out.columns == [*odd.columns[:-1], "a.b"] and [r[0] for r in out.collect()] == [0]


@pytest.mark.parametrize("size", [0, 1, 10, 999, 5000])
def test_top_rows_are_no_more_than_asked(spark, size):
    """All of one level, one hot key, and levels that fit."""
    once = spark.range(3000).selectExpr("id", "1 AS n")
    mixed = spark.range(3000).selectExpr("id", "id % 7 AS n")
    for df in (once, mixed):
        found = texts.top_rows(df, F.col("n"), ["id"], size)
        kept = [r["n"] for r in found.collect()]
        assert len(kept) == min(size, 3000)
        assert sorted(kept, reverse=True) == sorted((r["n"] for r in df.collect()), reverse=True)[:size]


@pytest.mark.parametrize("size", [0, 10, 100, 4000])
def test_samples_by_hash_are_bounded(spark, size):
    hot = spark.range(5000).selectExpr("'https://one.example/' AS url")
    many = hot.unionByName(spark.range(200).selectExpr("concat('https://x.example/', id) AS url"))
    assert texts.smallest_hashes(hot, ["url"], size).count() == min(size, 5000)
    assert texts.smallest_hashes(many, ["url"], size).count() == size
    ids = spark.range(100_000)
    found = sorted(r[0] for r in texts.smallest_hashes(ids, ["id"], size).collect())
    assert len(found) == size and found == sorted(r[0] for r in texts.smallest_hashes(ids.repartition(3), ["id"], size).collect())
