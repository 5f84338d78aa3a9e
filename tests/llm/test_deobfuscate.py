import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from stormledger.llm import catalog, deobfuscate, texts

BAD = ["idiot", "stupid", "moron", "pathetic", "worthless"]


@pytest.fixture(scope="module")
def chars(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return deobfuscate.char_model(docs)


@pytest.mark.parametrize("token, plain", [
    ("1d10t", "idiot"), ("stup1d", "stupid"), ("m0r0n", "moron"), ("p@thetic", "pathetic"), ("$tupid", "stupid"),
    ("iiidiooot", "idiot"), ("s.t.u.p.i.d", "stupid"), ("m-o-r-o-n", "moron"), ("w0rthl3ss", "worthless"), ("s t u p i d", "stupid"),
])
def test_decoding(chars, token, plain):
    assert deobfuscate.decode(token, chars) == plain


def test_brute_force_agrees_with_viterbi(chars):
    """All paths of the lattice, by product."""
    import itertools

    for token in ("m0r0n", "sstupid", "i.d.i", "a1!t"):
        best = None
        for path in itertools.product(*deobfuscate._options(token)):
            codes, cost = [0, 0], 0.0
            for c, price in path:
                cost += price
                if c is not None:
                    k = deobfuscate._class(c)
                    cost += chars.step(codes[-2], codes[-1], k)
                    codes.append(k)
            cost += chars.step(codes[-2], codes[-1], 0)
            text = "".join(c for c, _ in path if c is not None)
            best = min(best or (cost, text), (cost, text))
        assert deobfuscate.decode(token, chars) == best[1]


def test_plain_texts_stay(chars):
    column = pa.array(["Ein ganz normaler Satz, für 12 Leute.", "a b", "mail x.y@z.org 2024-01-02", None, "", "ok"])
    data, offsets = texts.raw(column)
    restorer = deobfuscate.Restorer(chars)
    out, at = restorer.chunk(data, offsets)
    got = [out[a:b].tobytes().decode() for a, b in zip(at[:-1], at[1:])]
    assert got[0] == "ein ganz normaler satz, für 12 leute." and got[3:] == ["", "", "ok"]


def test_trigram_counts_against_brute_force():
    column = pa.array(["ab c", "", "É1", None])
    counts = deobfuscate.trigram_counts(*texts.raw(column))
    want = np.zeros(28 ** 3, dtype=int)
    seq = []
    for t in column.to_pylist():
        seq += [0, *[ord(chr(b).lower()) - 96 if chr(b).isascii() and chr(b).isalpha() else 27 if b > 127 else 0 for b in (t or "").encode()], 0]
    for a, b, c in zip(seq, seq[1:], seq[2:]):
        want[(a * 28 + b) * 28 + c] += 1
    assert (counts == want).all()


def made(spark, n=400):
    draw = np.random.default_rng(5)
    words = ["the", "river", "house", "stone", "cloud", "paper", "green", "letter", "winter", "garden"]
    rows, labels = [], []
    for k in range(n):
        body = list(draw.choice(words, 30))
        if k % 4 == 0:
            body[draw.integers(0, 30)] = draw.choice(BAD)
        rows.append((k, " ".join(body)))
        labels.append((k, int(k % 4 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_obfuscated_documents_are_caught(spark):
    docs, labels = made(spark)
    scorer = deobfuscate.train(docs, labels, F.lit(True))
    probe = ["the river 1d10t house stone", "the river s t u p i d house", "green m.o.r.o.n. letter", "WOOORTHLESS paper", "p@thet1c stone"]
    clean = ["the river 100 house", "green letter a b", "winter 3rd garden"]
    asked = spark.createDataFrame(list(enumerate(probe + clean)), "doc_id long, text string")
    found = [r["score"] for r in deobfuscate.score(asked, scorer).orderBy("doc_id").collect()]
    assert min(found[:5]) > 0.5 > max(found[5:])
    kept = deobfuscate.clean(asked, scorer)
    assert sorted(r["doc_id"] for r in kept.collect()) == [5, 6, 7]


def test_held_out_quality(spark):
    d = "/root/testdata/sf0.1"
    found = catalog.QUERIES["op4_deobfuscate"](spark, d).filter("held_out").join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").collect()
    toxic, clean = [r for r in found if r["toxic"] == 1], [r for r in found if r["toxic"] == 0]
    assert sum(r["predicted"] for r in toxic) >= 0.95 * len(toxic) and sum(r["predicted"] for r in clean) <= 0.01 * len(clean)


def test_held_out_labels_do_not_matter(spark, doc_table):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("toxic", F.when(texts.fold("doc_id", 5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")).cast("int"))
    folder = doc_table(documents=docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit("y")), labels=flipped)
    a, b = (sorted(map(tuple, catalog.QUERIES["op4_deobfuscate"](spark, d).collect())) for d in (SMALL, folder))
    assert a == b


def test_odd_texts(odd, none, spark):
    labels = spark.createDataFrame([(k, k % 2) for k in range(13)] + [(3, None)], "doc_id long, toxic int")
    scorer = deobfuscate.train(odd, labels, F.lit(True))
    found = deobfuscate.score(odd, scorer).collect()
    assert len(found) == odd.count() and all(0 <= r["score"] <= 1 for r in found)
    assert deobfuscate.score(none, scorer).count() == 0
    assert deobfuscate.restore(odd, scorer.chars).count() == odd.count()
    assert deobfuscate.clean(odd, scorer).columns == odd.columns


def test_labels_of_one_kind(odd, spark):
    for labels in ([], [(4, 0)], [(4, 1)]):
        scorer = deobfuscate.train(odd, spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True))
        share = (sum(x for _, x in labels) + 0.5) / (len(labels) + 1)
        assert {round(r["score"], 9) for r in deobfuscate.score(odd, scorer).collect()} == {round(share, 9)}


def test_long_chains_and_tokens_are_decoded_in_one_piece(chars):
    """However long: as the lattice has it, and no part is left as it is written."""
    for text in (" ".join("stupid" * 100), "st" + "u" * 300 + "pid", ".".join("idiot" * 40)):
        out, _ = deobfuscate.Restorer(chars).chunk(*texts.raw(pa.array([text])))
        assert out.tobytes().decode() == deobfuscate.decode(text, chars) and len(out) < len(text)
    assert deobfuscate.decode("st" + "u" * 300 + "pid", chars) == "stupid"


def test_spellings_that_need_the_whole_lattice_are_caught(spark):
    """Few letters, each kind of look-alike, gaps in chains, and words far inside long tokens and chains."""
    docs, labels = made(spark)
    scorer = deobfuscate.train(docs, labels, F.lit(True))
    plain = ["river", "house", "stone", "cloud", "paper", "green", "letter", "winter", "garden"] * 4
    probe = [
        "the 1d107 house", "the m*ron house", "the st*pid house", "the (idiot house", "the patheti( house", "the mor0n€ idi€ 1d10t",
        "the i d ! o t house", "the m * r o n house", "the p a t h e t i ( house", "the s  t  u  p  i  d house",
        "_".join(".".join(w) for w in [*plain, "stupid", *plain]), "  ".join(" ".join(w) for w in [*plain, "moron", *plain]),
        "the st" + "u" * 300 + "pid house",
    ]
    clean = ["the (river) 100 * house", "12 3.14 2024-01-02 !!!", "_".join(".".join(w) for w in plain), "  ".join(" ".join(w) for w in plain)]
    asked = spark.createDataFrame(list(enumerate(probe + clean)), "doc_id long, text string")
    found = [r["score"] for r in deobfuscate.score(asked, scorer).orderBy("doc_id").collect()]
    assert [p for p, s in zip(probe, found) if s <= 0.5] == []
    assert [p for p, s in zip(clean, found[len(probe):], strict=True) if s > 0.5] == []


def test_numbers_and_marks_stay(chars):
    text = "ein 12 100 3.14 !!! *** 2024-01-02 haus"
    out, _ = deobfuscate.Restorer(chars).chunk(*texts.raw(pa.array([text])))
    assert out.tobytes().decode() == text


def test_long_tokens_are_decoded_in_one_piece(chars):
    word = ".".join("stupid")
    assert deobfuscate.decode("_".join([word] * 500), chars) == " ".join(["stupid"] * 500)
