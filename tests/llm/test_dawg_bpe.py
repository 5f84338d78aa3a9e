import hashlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from conftest import SMALL
from stormledger.llm import catalog, dawg_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


def expected(texts):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    for text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        yield len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), tokenizer.decode(ids, skip_special_tokens=False)))


def check(docs, found):
    docs = docs.collect()
    want = sorted((r["doc_id"], *x) for r, x in zip(docs, expected([r["text"] for r in docs]), strict=True))
    assert sorted(tuple(r) for r in found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()) == want


def test_query_against_library(spark):
    check(spark.read.parquet(f"{SMALL}/documents.parquet"), catalog.QUERIES["op5_dawg_bpe"](spark, SMALL))


@pytest.mark.parametrize("size", [0, 3, 100_000])
def test_odd_texts_with_any_lexicon(odd, size):
    check(odd, dawg_bpe.encode(odd, PATH, size=size))


def test_no_rows(none):
    assert dawg_bpe.encode(none, PATH).count() == 0


def test_strange_characters(spark):
    rows = ["Σίσυφος ΣΑΣ", "İstanbul ǅ ß ﬁ", "é é É", "a b c   d", "I'LL don't we'd", "①②③ ½ 12345", "🙂🙃 👩‍👩‍👧", "\x1c\x1d\x85", "x<|endoftext|>y <|EndOfText|> <|", "\x00\x01", "한국어 각", "…—–“”"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    check(docs, dawg_bpe.encode(docs, PATH, whole=True))


def numbers(lexicon, words):
    data = np.frombuffer(b"".join(words), dtype=np.uint8)
    ends = np.cumsum([len(w) for w in words])
    return lexicon.numbers(data, ends - [len(w) for w in words], ends).tolist()


def test_automaton_numbers_words_and_shares_suffixes():
    words = sorted(w.encode() for w in ["tapping", "tap", "topping", "top", "stop", "stopping", "é", "a"])
    lexicon = dawg_bpe.Lexicon(dawg_bpe.compile_lexicon((w, [k, len(w)]) for k, w in enumerate(words)))
    assert numbers(lexicon, words) == list(range(len(words)))
    assert [lexicon.lookup(k) for k in range(len(words))] == [[k, len(w)] for k, w in enumerate(words)]
    assert numbers(lexicon, [b"to", b"tops", b"t", b"x" * 100]) == [-1] * 4
    # equal endings are one path: far fewer nodes than letters
    assert len(lexicon.first) - 1 < len(b"".join(words)) // 2


def test_empty_automaton():
    assert numbers(dawg_bpe.Lexicon(dawg_bpe.compile_lexicon([])), [b"a"]) == [-1]


def test_pieces_merge_as_in_the_library_side_by_side_and_alone():
    merge, tokenizer = dawg_bpe.vocabulary(PATH), Tokenizer.from_file(PATH)
    draw = np.random.default_rng(0)
    pieces = ["".join(draw.choice(list("abcdetionhsr"), n)) for n in [*draw.integers(1, 64, 400), 65, 200, 3000]]
    want = [tokenizer.encode(p, add_special_tokens=False).ids for p in pieces]
    assert merge.merge([p.encode() for p in pieces]) == want
    assert [merge._alone(p.encode()) for p in pieces] == want
