import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from stormledger.llm import catalog, maxent_lm, texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
END = object()


def tokens(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [END]


def base(docs, learnt):
    counts = Counter(t for d, text in docs if learnt(d) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    for d, text in docs:
        own = tokens(text)
        yield d, len(own), sum(counts[t] > 0 for t in own), n, sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in own)


def check(docs, found, learnt):
    want = sorted(base(docs, learnt), key=lambda x: (x[0], x[1]))
    found = sorted(found, key=lambda r: (r["doc_id"], r["n_tokens"]))
    assert [(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in found] == [x[:4] for x in want]
    assert [r["base_score"] for r in found] == pytest.approx([x[4] for x in want], rel=1e-9, abs=1e-9)


def test_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    found = catalog.QUERIES["op8_maxent_lm"](spark, SMALL).collect()
    check(docs, found, lambda d: texts.fold_of(d, 10) != 0)
    assert all(r["held_out"] == (texts.fold_of(r["doc_id"], 10) == 0) for r in found)
    assert all(r["score"] < 0 for r in found)


def test_model_beats_the_base_on_held_out_texts(spark):
    found = catalog.QUERIES["op8_maxent_lm"](spark, "/root/testdata/sf0.01").filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert found[0] > 0.97 * found[1]  # logarithms: nearer to 0 is better


def test_odd_texts(odd, none):
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    check(docs, maxent_lm.fit_and_score(odd, F.lit(True)).collect(), lambda d: True)
    check(docs, maxent_lm.fit_and_score(odd, texts.fold("doc_id", 10) != 0).collect(), lambda d: texts.fold_of(d, 10) != 0)
    assert maxent_lm.fit_and_score(none, F.lit(True)).count() == 0


def test_without_training_texts_all_is_certain(odd):
    found = maxent_lm.fit_and_score(odd, F.lit(False)).collect()
    assert all(r["score"] == pytest.approx(0) and r["base_score"] == pytest.approx(0) and r["train_tokens"] == 0 for r in found)


def test_probabilities_sum_to_one():
    """Over all classes and words after any context, with the last class as one event."""
    counts = maxent_lm.Counts(20_000, 400, texts.mix(np.arange(1, 301, dtype=np.uint64)), np.sort(np.random.default_rng(0).integers(1, 100, 300))[::-1].copy())
    draw = np.random.default_rng(1)
    weights = [w + draw.normal(0, 0.3, w.shape).astype(np.float32) for w in maxent_lm.fresh(counts)]
    model = maxent_lm.Model(counts, weights, draw.integers(0, 9, (maxent_lm.FREQUENT + 1, counts.words)).astype(float))
    ids, ends = draw.integers(0, counts.words + 1, 50), np.array([20, 21, 49])
    rows, passed = maxent_lm.context(ids, ends, counts.words)
    classes = np.exp(maxent_lm.class_logs(weights, rows, passed).astype(np.float64))
    for at in range(50):
        total = classes[at, maxent_lm.CLASSES - 1]
        total += sum(classes[at, counts.class_of[w]] * math.exp(model.within[passed[at], w]) for w in range(counts.words))
        assert total == pytest.approx(1, abs=1e-3)


def test_contexts_stay_within_a_text():
    ids, ends = np.array([0, 1, 2, 9, 0, 70, 5]), np.array([2, 3, 6])
    rows, passed = maxent_lm.context(ids, ends, 100)
    first, _ = maxent_lm.context(np.array([9]), np.array([0]), 100)
    assert all(rows[k][3] == first[k][0] for k in range(4)) and passed.tolist()[:4] == [64, 0, 1, 64]
    assert passed.tolist()[4:] == [64, 0, 0]


def test_gradient_step_against_differences():
    draw = np.random.default_rng(2)
    counts = maxent_lm.Counts(25_000, 300, texts.mix(np.arange(1, 201, dtype=np.uint64)), np.arange(200, 0, -1))
    weights = [w.astype(np.float64) for w in maxent_lm.fresh(counts)]
    rows, passed = [draw.integers(0, s, 5) for s in maxent_lm.TABLES], draw.integers(0, 65, 5)
    classes = draw.integers(0, maxent_lm.CLASSES, 5)

    def loss(w):
        return -maxent_lm.class_logs(w, rows, passed)[np.arange(5), classes].sum()

    moved = [w.copy() for w in weights]
    maxent_lm.learn(moved, [np.zeros(len(w)) for w in weights], rows, passed, classes)
    table, at, c = 0, rows[0][0], classes[0]
    up = [w.copy() for w in weights]
    up[table][at, c] += 1e-5
    slope = (loss(up) - loss(weights)) / 1e-5
    times = (rows[0] == at).sum()
    assert moved[table][at, c] - weights[table][at, c] == pytest.approx(-maxent_lm.STEP * slope / math.sqrt(20 + times), rel=1e-3)


def test_end_tokens_follow_each_text():
    hashes, ends = maxent_lm.tokens(pa.array(["A b", None, "", "b"]))
    assert ends.tolist() == [2, 3, 4, 6] and (hashes[ends] == maxent_lm.END).all() and hashes[1] == hashes[5]


def test_the_class_model_has_64_classes_at_least():
    counts = maxent_lm.Counts(25_000, 300, texts.mix(np.arange(1, 201, dtype=np.uint64)), np.arange(200, 0, -1))
    assert len(set(counts.class_of.tolist())) >= 64 and all(w.shape[1] >= 64 for w in maxent_lm.fresh(counts))


def test_sizes_follow_the_corpus():
    """Twice the words and rows for four times the tokens, up to what a task can hold."""
    unit, many = maxent_lm.SCALE_TOKENS, np.arange(maxent_lm.HOT, 0, -1)
    assert [maxent_lm.scale(n) for n in (0, 1, unit, 4 * unit - 1, 4 * unit, 16 * unit, 63 * unit, 64 * unit, 10**15)] == [1, 1, 1, 1, 2, 4, 4, 8, 8]
    for times in (1, 2, 4, 8):
        counts = maxent_lm.Counts(times * times * unit, 1 << 20, texts.mix(np.arange(1, len(many) + 1, dtype=np.uint64)), many)
        assert counts.words == times * maxent_lm.WORDS <= maxent_lm.HOT
        weights = maxent_lm.fresh(counts)
        assert [len(w) for w in weights[:-1]] == [times * n for n in maxent_lm.TABLES]
        rows, _ = maxent_lm.context(np.arange(counts.words), np.array([counts.words - 1]), counts.words, counts.scale)
        assert all(n * times > r.max() >= n * times * 0.9 for n, r in zip(maxent_lm.TABLES, rows, strict=True))


def test_a_larger_model_sums_to_one_and_keeps_the_base(odd, monkeypatch):
    monkeypatch.setattr(maxent_lm, "SCALE_TOKENS", 64)
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    found = maxent_lm.fit_and_score(odd, F.lit(True)).collect()
    check(docs, found, lambda d: True)
    assert all(r["score"] <= 0 for r in found)
    _, counts = maxent_lm.gather(odd)
    assert counts.scale == maxent_lm.MAX_SCALE
    model = maxent_lm.train(odd, counts)
    rows, passed = maxent_lm.context(np.arange(counts.words), np.array([counts.words - 1]), counts.words, counts.scale)
    classes = np.exp(maxent_lm.class_logs(model.weights, rows, passed).astype(np.float64))
    for at in range(counts.words):
        total = classes[at, maxent_lm.CLASSES - 1] + (classes[at, counts.class_of[:-1]] * np.exp(model.within[passed[at]])).sum()
        assert total == pytest.approx(1, abs=1e-3)


@pytest.mark.parametrize("groups", [1, 3, 65, 900, 4000])
def test_sums_of_groups_of_any_size(groups):
    draw = np.random.default_rng(groups)
    values, at = draw.normal(size=(4100, 8)), np.minimum(draw.geometric(0.02, 4100) - 1 if groups == 65 else draw.integers(0, groups, 4100), groups - 1)
    order = np.argsort(at, kind="stable")
    first = np.flatnonzero(np.diff(at[order], prepend=-1))
    by, total = maxent_lm._row_sums(values, order, first)
    assert sorted(by.tolist()) == list(range(len(first)))
    want = np.array([values[at == g].sum(axis=0) for g in np.unique(at)])
    assert np.allclose(total, want[by])


def test_a_gradient_step_of_common_rows_takes_less_than_its_sums_did():
    """Times of one batch against the sums by `reduceat`, which were most of the training."""
    import time

    draw = np.random.default_rng(3)
    at = np.minimum(draw.zipf(1.3, maxent_lm.BATCH), 4000)
    values, order = draw.normal(size=(maxent_lm.BATCH, maxent_lm.CLASSES)).astype(np.float32), np.argsort(at, kind="stable")
    first = np.flatnonzero(np.diff(at[order], prepend=-1))

    def least(work):
        out = []
        for _ in range(15):
            began = time.thread_time()
            work()
            out.append(time.thread_time() - began)
        return min(out)

    assert least(lambda: maxent_lm._row_sums(values, order, first)) < least(lambda: np.add.reduceat(values.take(order, axis=0), first, axis=0))
