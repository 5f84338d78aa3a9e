import hashlib
import importlib
import sys

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import SMALL
from llm.test_order_join import shingles


def stages(spark, folder):
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        found = stage(spark, docs, folder)
        path = f"{spark.conf.get('spark.checkpoint.dir')}/pipeline-{name}-{k}-{abs(hash(folder))}"
        found.write.mode("overwrite").parquet(path)
        out.append((name, docs, spark.read.parquet(path)))
        docs = out[-1][2]
    return out


@pytest.fixture(scope="module")
def run(spark):
    return {name: (before, after) for name, before, after in stages(spark, SMALL)}


def test_order_of_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "toxicity", "near_copies", "mixture", "tokens"]


def test_all_but_the_last_return_documents(run):
    for name, (before, after) in run.items():
        if name != "tokens":
            assert after.columns == before.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            assert after.join(before, ["doc_id", "text"], "left_anti").count() == 0


def test_language_rejects_texts_without_letters_alone(run):
    before, after = run["language"]
    assert before.filter("text rlike '[\\\\p{L}]'").count() == after.count()


def test_near_copies_are_those_of_brute_force(run):
    before, after = run["near_copies"]
    docs = [(r["doc_id"], shingles(r["text"], 5)) for r in before.collect()]
    least = {i: i for i, _ in docs}
    changed = True
    links = [(a, b) for k, (a, x) in enumerate(docs) for b, y in docs[:k] if x and y and 100 * len(x & y) >= 80 * len(x | y)]
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            changed |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(i for i, c in least.items() if i == c)


def test_mixture_repeats_documents_as_often_as_they_are_taken(run):
    before, after = run["mixture"]
    assert after.groupBy("doc_id").count().filter("count > 3").count() == 0
    words = lambda df: df.selectExpr("sum(size(split(trim(text), '[ \\\\t\\\\n]+'))) AS n").first()["n"]
    assert abs(words(after) / words(before) - 1) < 0.1


def test_tokens_are_those_of_the_library(run):
    before, after = run["tokens"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted((r["doc_id"], hashlib.sha256(" ".join(map(str, tokenizer.encode(r["text"], add_special_tokens=False).ids)).encode()).hexdigest()) for r in before.collect())
    assert sorted((r["doc_id"], r["ids_sha256"]) for r in after.collect()) == want


def test_run_gives_the_rows_of_the_stages(run, spark):
    _, after = run["tokens"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, SMALL).collect())) == sorted(map(tuple, after.collect()))


def test_odd_documents_pass_all_stages(odd, spark, doc_table):
    labels = spark.createDataFrame([(3, 0), (4, 0), (5, 1)], "doc_id long, toxic int")
    found = stages(spark, doc_table(documents=odd, labels=labels))
    assert found[2][2].columns == odd.columns
    ids = sorted(r["doc_id"] for r in found[2][2].collect())
    assert len(ids) == len(set(ids)) and not {0, 1, 2} & set(ids)


def test_no_documents(none, spark, doc_table):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert all(after.count() == 0 for _, _, after in stages(spark, doc_table(documents=none, labels=labels)))


@pytest.mark.parametrize("gone", ["corpus_pipeline", "stormledger.llm"])
def test_the_library_works_without_the_pipeline(monkeypatch, gone):
    entry = importlib.import_module("__spark_entry__")
    assert "pipeline" in entry.queries() and "op1_line_rules" in entry.queries()

    class Gone:
        def find_spec(self, name, path=None, target=None):
            if name == gone:
                raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    for name in [m for m in sys.modules if m == gone or m.startswith(gone + ".") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.delattr("stormledger.llm", raising=False)
    monkeypatch.setattr(sys, "meta_path", [Gone(), *sys.meta_path])
    monkeypatch.delitem(sys.modules, "__spark_entry__")
    entry = importlib.import_module("__spark_entry__")
    assert "pipeline" not in entry.queries() and "agg_year" in entry.queries()
