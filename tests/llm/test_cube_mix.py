import re

import numpy as np
import pytest

from conftest import SMALL
from stormledger.llm import catalog, cube_mix

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def filled(sizes, weights=cube_mix.WEIGHTS, most=cube_mix.MAX_COPIES):
    """Targets by resharing the excess round by round."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    full, total = {}, float(sum(sizes.values()))
    while True:
        left = [s for s in names if s not in full]
        rest = total - sum(full.values())
        wanted = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        above = [s for s in left if wanted[s] > most * sizes[s]]
        if not above:
            return full | wanted
        full |= {s: float(most * sizes[s]) for s in above}


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 10, "c": 10}, {"a": 1, "b": 100, "c": 100}, {"b": 5, "a": 900, None: 3, "c": 0, "a1": 7},
    {"only": 4}, {"x": 1, "y": 2, "z": 300, None: 4, "w": 1, "v": 1}, {"a": 0, "b": 0},
])
def test_targets_against_rounds(spark, sizes):
    rows = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, size long")
    found = {r["source"]: r["target"] for r in cube_mix.targets(rows).collect()}
    assert found == pytest.approx(filled(sizes))


def test_query(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    found = catalog.QUERIES["op3_cube_mix"](spark, SMALL).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(docs)
    sizes = {}
    for r in found:
        assert r["size"] == len(WORD.findall(docs[r["doc_id"]]["text"] or "")) and r["source"] == docs[r["doc_id"]]["source"]
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    targets = filled(sizes)
    for source, size in sizes.items():
        own = [r for r in found if r["source"] == source]
        assert all(r["source_size"] == size and r["target"] == pytest.approx(targets[source]) for r in own)
        largest = max(r["size"] for r in own)
        assert abs(sum(r["taken"] for r in own) - targets[source]) <= max(0.05 * targets[source], largest)
    assert all(r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"] for r in found)
    assert sorted(map(tuple, found)) == sorted(map(tuple, catalog.QUERIES["op3_cube_mix"](spark, SMALL).collect()))


def test_large_sources_come_near_their_targets(spark):
    found = catalog.QUERIES["op3_cube_mix"](spark, "/root/testdata/sf0.1").groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    assert all(abs(r["sum(taken)"] / r["max(target)"] - 1) < 0.02 for r in found)


def test_pools_of_several_levels(spark):
    rows = [(k, "w " * (1 + k * 7919 % 400), "hot" if k % 3 else "s") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = cube_mix.mix(docs, pool=200).groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    assert all(abs(r["sum(taken)"] / r["max(target)"] - 1) < 0.01 for r in found)


def test_flight_keeps_both_sums():
    draw = np.random.default_rng(3)
    size = np.sort(draw.integers(0, 1000, 400))[::-1].astype(float)
    pi = draw.random(400)
    out = cube_mix.flight(pi, size, draw.random(400))
    assert ((out > 0) & (out < 1)).sum() <= cube_mix.RESERVE + 2
    assert out.sum() == pytest.approx(pi.sum()) and (out * size).sum() == pytest.approx((pi * size).sum())
    landed = cube_mix.land(out, size, draw.random(400))
    assert set(landed) <= {0.0, 1.0} and abs((landed * size).sum() - (pi * size).sum()) < 100


def test_each_unit_is_taken_with_its_probability():
    size, pi = np.array([5.0, 9.0, 4.0, 4.0, 7.0, 1.0, 3.0, 8.0] * 12), np.tile([0.2, 0.5, 0.7, 0.5], 24)
    taken = np.mean([cube_mix.flight(pi, size, np.random.default_rng(s).random(96)) for s in range(400)], axis=0)
    assert np.abs(taken - pi).max() < 0.12


@pytest.mark.parametrize("pi, size", [
    ([0.2] * 12, [5.0] * 12), ([0.2, 0.5, 0.7, 0.5], [9.0, 1.0, 4.0, 4.0]), ([0.3], [7.0]), ([0.1, 0.9], [50.0, 3.0]),
    ([0.5] * 5 + [0.25] * 9, [900.0, *range(1, 14)]),
])
def test_landing_keeps_each_probability(pi, size):
    pi, size = np.array(pi), np.array(size)
    subsets, chances = cube_mix._landings(pi, size)
    assert chances.min() >= 0 and chances.sum() == pytest.approx(1) and chances @ subsets == pytest.approx(pi)
    taken = np.mean([cube_mix.land(pi, size, np.random.default_rng(s).random(len(pi))) for s in range(600)], axis=0)
    assert np.abs(taken - pi).max() < 0.1


def test_landing_of_many_keeps_each_probability_and_the_words():
    draw = np.random.default_rng(5)
    pi, size = draw.uniform(0.1, 0.9, 66), draw.integers(1, 1000, 66).astype(float)
    landed = np.array([cube_mix.land(pi, size, np.random.default_rng(s).random(66)) for s in range(200)])
    assert set(np.unique(landed)) == {0.0, 1.0} and np.abs(landed.mean(axis=0) - pi).max() < 0.15
    assert np.abs(landed @ size - pi @ size).mean() < 20


def test_odd_texts(odd):
    found = cube_mix.mix(odd).collect()
    assert len(found) == odd.count()
    assert all(r["size"] > 0 or r["taken"] == 0 for r in found) and all(0 <= r["copies"] <= 3 for r in found)
    took = cube_mix.take(odd, cube_mix.mix(odd))
    assert took.columns == odd.columns and set(r[0] for r in took.collect()) == {r["doc_id"] for r in found if r["copies"]}


def test_no_rows(none):
    assert cube_mix.mix(none).count() == 0


def test_rows_without_id_and_of_one_id_are_taken_as_the_mix_says(spark):
    rows = [(None if k % 3 else 7, "w " * (1 + k % 50) + ("" if k % 4 else str(k)), ["a", "b", None][k % 5 % 3]) for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = cube_mix.mix(docs, pool=100).cache()
    took = cube_mix.take(docs, mixed).collect()
    want, found = {}, {}
    for r in mixed.collect():
        want[r["source"], r["doc_id"]] = want.get((r["source"], r["doc_id"]), 0) + r["taken"]
    for r in took:
        found[r["source"], r["doc_id"]] = found.get((r["source"], r["doc_id"]), 0) + len(WORD.findall(r["text"]))
    assert found == {k: n for k, n in want.items() if n}


def test_rows_of_one_id_spread_over_pools(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)
    was = cube_mix._pool

    def counted(seed, last):
        work = was(seed, last)

        def check(pdf):
            if len(pdf) > 300:
                seen.add(1)
            return work(pdf)
        return check

    monkeypatch.setattr(cube_mix, "_pool", counted)
    docs = spark.createDataFrame([(5, "same text here", "s") for _ in range(2000)] + [(None, "w " * (k % 90 + 1), "t") for k in range(2000)], "doc_id long, text string, source string")
    assert cube_mix.mix(docs, pool=200).count() == 4000 and seen.value == 0
