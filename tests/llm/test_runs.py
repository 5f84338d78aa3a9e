import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from conftest import SMALL
from stormledger.llm import catalog, runs, texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words, least=12):
    """Every stretch of equal words q apart, by its ends."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = j
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(words, found):
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def planted(i, words):
    n, h = len(words), zlib.crc32(str(i).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]


def brute(i, text):
    words = WORD.findall(text or "")
    words = planted(i, words) if i is not None else words
    found = brute_runs(words)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    best = min(((-n, s, q) for s, n, q in found), default=None)
    shown = (best[1], -best[0], best[2], -best[0] * 1000 // best[2]) if best else (None,) * 4
    return (i, len(found), *shown, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(collapsed(words, found)))


def find(rows, least=12):
    sizes = np.array([len(r) for r in rows], dtype=np.int64)
    flat = np.array([w for r in rows for w in r], dtype=np.int64)
    out = [[] for _ in rows]
    for row, *run in zip(*(x.tolist() for x in runs.find(flat, sizes, least)), strict=True):
        out[row].append(tuple(run))
    return out


@pytest.mark.parametrize("letters", [1, 2, 3, 8])
def test_runs_are_those_of_brute_force(letters, monkeypatch):
    monkeypatch.setattr(runs, "SHORT", 5)
    monkeypatch.setattr(runs, "PAIRS", 300)
    draw = np.random.default_rng(letters)
    rows = [draw.integers(0, letters, size=draw.integers(0, 160)).tolist() for _ in range(60)]
    rows += [[1, 2, 3] * 70, [0] * 333, ([0] * 40 + [1]) * 9, list(range(100)) * 3 + [5], (([0, 1] * 9 + [2]) * 4 + [3]) * 3]
    for least in (2, 12):
        assert find(rows, least) == [brute_runs(r, least) for r in rows]


def test_long_periods():
    draw = np.random.default_rng(1)
    base = draw.integers(0, 5000, size=1300).tolist()
    rows = [base * 4 + base[:200], draw.integers(0, 50, size=4000).tolist(), (base[:601] * 3 + [7]) * 2]
    assert find(rows) == [brute_runs(r) for r in rows]


def test_matches_are_those_word_by_word():
    draw = np.random.default_rng(2)
    codes = np.concatenate((np.tile(draw.integers(0, 9, size=57), 30), draw.integers(0, 2, size=900), np.zeros(500, dtype=np.int64)))
    match = runs.Matches(codes)
    a, b = draw.integers(0, len(codes) + 1, size=(2, 20000))
    a, b = a[a != b], b[a != b]
    assert (match(a, b) == match.direct(a, b, len(codes))).all()


def test_cover_reaches_sampled_places_within_its_modulus():
    a, b = np.divmod(np.arange(31 * 31), 31)
    t = runs._STEPS[a, b]
    assert t.max() < runs.FEW + 31 and np.isin((a + t) % 31, runs.COVER).all() and np.isin((b + t) % 31, runs.COVER).all()
    assert sorted((x - y) % 31 for x in runs.COVER for y in runs.COVER if x != y) == list(range(1, 31))


def test_suffixes_are_not_sorted_where_words_differ():
    match = runs.Matches(np.arange(1000))
    assert not match(np.arange(500), np.arange(500) + 500).any() and match.place is None


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_on_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = catalog.QUERIES["op12_cover_runs"](spark, SMALL)
    assert found.dtypes[:6] == [(c, "bigint") for c in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli")]
    assert rows(found) == sorted((brute(r["doc_id"], r["text"]) for r in docs.collect()), key=repr)


def test_odd_texts(odd, spark):
    more = spark.createDataFrame(
        [(i, t) for i in range(14, 60) for t in ("uno dos tres " * i, "x " * i, "é ü ", "a b c d e f g h i j k l m n", None, "", " \n")] + [(None, "a b " * 20)],
        "doc_id long, text string")
    docs = odd.select("doc_id", "text").unionByName(more)
    found = runs.digests(runs.runs(docs.withColumn("runs", docs["text"]), text=runs.planted(docs)))
    assert rows(found) == sorted((brute(r["doc_id"], r["text"]) for r in docs.collect()), key=repr)


def test_texts_without_their_repetitions(odd, none):
    found = {r["id"]: r for r in runs.runs(odd).collect()}
    for r in odd.collect():
        words = WORD.findall(r["text"] or "")
        own = found[r["doc_id"]]
        assert own["n_words"] == len(words) and [tuple(x) for x in own["runs"]] == brute_runs(words) and own["collapsed"] == collapsed(words, brute_runs(words))
    assert runs.runs(none).count() == 0


def test_one_very_long_text():
    """A text of two million bytes is one piece; the work on it stays near n * ln(n)."""
    text = "alpha beta gamma delta " * 60000 + " ".join(f"w{k % 7919}" for k in range(100000))
    part = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text])], ["id", "text"])
    (part,) = list(texts.chunks(iter([part])))
    found = runs._analysed(part, 12).to_pylist()[0]
    assert [tuple(x.values()) for x in found["runs"]] == [(0, 240000, 4), (240000, 100000, 7919)]
    assert found["collapsed"] == "alpha beta gamma delta " + " ".join(f"w{k}" for k in range(7919))


def test_equal_numbers_mean_equal_words():
    data, offsets = texts.raw(pa.array(["ab a b", None, "", "b  ab\n\na abc"]))
    words = texts.words(data, offsets)
    names = [words.content(i) for i in range(len(words))]
    number = runs.numbered(words).tolist()
    assert [[a == b for a in names] for b in names] == [[a == b for a in number] for b in number]
