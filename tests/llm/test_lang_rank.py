from collections import Counter

import numpy as np

from conftest import SMALL
from stormledger.llm import catalog, lang_rank, texts


def brute_grams(text):
    """Grams as strings: word ends are underscores."""
    body, out = "_", Counter()
    for c in text or "":
        c = c.lower()[0] if c.isalpha() else "_"
        if c != "_" or body[-1] != "_":
            body += c
    body += "_" if body[-1] != "_" else ""
    for k in range(len(body)):
        for n in (1, 2, 3):
            g = body[k:k + n]
            if len(g) == n and g != "_" and "_" not in g[1:-1]:
                out[g] += 1
    return out if len(body) > 1 else Counter()


def code(gram):
    value = 0
    for c in gram:
        value = value << 21 | (1 if c == "_" else ord(c) + 2)
    return value


def top(counts):
    return sorted(counts, key=lambda g: (-counts[g], code(g)))[:lang_rank.SIZE]


def test_query_against_brute_force(spark):
    docs = [r.asDict() for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    by_lang = {}
    for d in docs:
        if d["lang"] is not None and texts.fold_of(d["doc_id"], 3) != 1:
            by_lang.setdefault(d["lang"], Counter()).update(brute_grams(d["text"]))
    profiles = {k: {g: i for i, g in enumerate(top(v))} for k, v in by_lang.items()}
    found = {r["doc_id"]: r for r in catalog.QUERIES["op7_lang_rank"](spark, SMALL).collect()}
    assert len(found) == len(docs)
    for d in docs:
        own = top(brute_grams(d["text"]))
        far = {k: sum(abs(p[g] - i) if g in p else lang_rank.SIZE for i, g in enumerate(own)) for k, p in profiles.items()}
        best = min(sorted(far), key=far.get) if own else "und"
        assert found[d["doc_id"]]["lang_pred"] == best
        assert found[d["doc_id"]]["held_out"] == (texts.fold_of(d["doc_id"], 3) == 1)
        assert abs(found[d["doc_id"]]["score"] - (1 - far[best] / len(own) / lang_rank.SIZE if own else 0)) < 1e-12


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = catalog.QUERIES["op7_lang_rank"](spark, "/root/testdata/sf0.01").filter("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert found.filter("lang_pred = lang").count() >= 0.97 * found.count()


def test_odd_texts(odd):
    profiles = lang_rank.train(odd)
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in lang_rank.predict(odd, profiles).collect()}
    assert profiles.langs == ["de", "en"]
    assert [found[k] for k in (0, 1, 2)] == [("und", 0.0)] * 3
    assert all(0 <= s <= 1 for _, s in found.values())
    kept = lang_rank.known(odd, profiles, 0.0)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 3


def test_no_training_rows(odd, none):
    profiles = lang_rank.train(none)
    assert {r["lang_pred"] for r in lang_rank.predict(odd, profiles).collect()} == {"und"}
    assert lang_rank.predict(none, profiles).count() == 0


def test_ties_go_to_the_smaller_name():
    same = np.array([code("a"), code("_a")])
    assert lang_rank.Profiles({"y": same, "x": same}).nearest("aaa")[0] == "x"
