import math

import numpy as np
import pytest

from llm.conftest import CLASH
from stormledger.llm import catalog, pivots


def brute(rows, k=20, every=20, scale=64):
    kept = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ints = tuple(math.floor(scale * float(x)) for x in v)
            if all(abs(x) <= pivots.LIMIT for x in ints):
                kept.setdefault(i, set()).add(ints)
    out = []
    for q in kept:
        if q % every == 0:
            asked = min(kept[q])
            scored = sorted((-sum(a * b for a, b in zip(asked, v)), i) for i, own in kept.items() if i != q for v in own)  # noqa: B905
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, table, kind="float"):
    return spark.createDataFrame(table, f"vec_id long, embedding array<{kind}>")


@pytest.mark.parametrize("scale", ["sf0.01", "sf0.1"])
def test_query_is_that_of_brute_force(spark, scale):
    table = spark.read.parquet(f"/root/testdata/{scale}/embeddings.parquet").select("vec_id", "embedding").collect()
    found = catalog.QUERIES["op13_pivot_index"](spark, f"/root/testdata/{scale}")
    assert found.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert rows(found) == brute([tuple(r) for r in table])


@pytest.fixture
def small(monkeypatch):
    """Many pivots, rings, parts and groups of queries on few vectors."""
    for name, value in (("RING", 16), ("PART", 12), ("GROUP", 4), ("BLOCK", 8), ("QUERIES", 3), ("SAMPLE", 400)):
        monkeypatch.setattr(pivots, name, value)


def test_many_rings_rounds_and_parts(spark, small):
    draw = np.random.default_rng(2)
    table = [(i, (draw.normal(size=5) * 10 ** draw.uniform(-1, 1)).astype(np.float32).tolist()) for i in range(900)]
    found = pivots.search(frame(spark, table).repartition(5), k=7, every=15, first=20, growth=3)
    assert rows(found) == brute(table, k=7, every=15)


def test_a_vector_of_a_third_of_all_rows_and_ties(spark, small):
    draw = np.random.default_rng(3)
    table = [(i, [1.0, 2.0, 3.0] if i % 3 else draw.integers(-2, 3, size=3).astype(float).tolist()) for i in range(400)]
    assert rows(pivots.search(frame(spark, table).repartition(4), first=30)) == brute(table)


def test_far_rings_are_not_visited():
    """A query on the sphere's one side has bounds beyond its k-th best for the other."""
    draw = np.random.default_rng(4)
    held = np.concatenate([draw.integers(90, 110, size=(500, 3)), draw.integers(-110, -90, size=(500, 3))])
    largest = int((held * held).sum(axis=1).max())
    form = pivots.Shape(np.zeros((0, 4)), np.zeros((0, 0)), 3, largest)
    form.pivots = np.stack([form.lifted(held[:500]).mean(axis=0), form.lifted(held[500:]).mean(axis=0)])
    form.cuts = np.zeros((2, 0))
    pivot, ring, far = form.keys(held)
    assert (pivot == np.repeat([0, 1], 500)).all() and (ring == 0).all()
    rings = pivots.Rings(*(np.array(x) for x in ([0, 1], [0, 0], [far[:500].min(), far[500:].min()], [far[:500].max(), far[500:].max()], [500, 500], [1, 1])))
    query = np.array([[100, 100, 100]])
    near = pivots.bounds(rings, form.distances(form.lifted(query, query=True)))[0]
    limit = pivots.reach(form, query, np.array([float(np.sort(held @ query[0])[-20])]))[0]
    assert near[0] <= limit < near[1]
    # a bound is never above a real distance
    real = np.sqrt(((form.lifted(query, query=True) - form.lifted(held)) ** 2).sum(axis=1))
    assert near[0] <= real[:500].min() + 1e-9 and near[1] <= real[500:].min() + 1e-9


def test_odd_vectors(spark, small):
    nan, inf = float("nan"), float("inf")
    good = [(i, [(i * 5 + j * 3) % 7 - 3.0 for j in range(3)]) for i in range(80)]
    table = good + good[:30] + good[:30] + [
        (None, [1.0] * 3), (100, None), (101, []), (102, [1.0, 2.0]), (120, [2.0]), (140, []), (103, [nan] * 3), (104, [inf, 0.0, 0.0]), (105, [None, 0.0, 0.0]),
        (106, [3e30] * 3), (160, [0.0, 0.0, 0.0]), (107, [-0.0, -0.001, 0.001]), (20, [5.0, 5.0, 5.0]), (20, [-5.0, 5.0, 5.0]), (33, [4.0, 4.0, 4.0]), (-40, [1.0, 1.0, 1.0])]
    assert rows(pivots.search(frame(spark, table).repartition(3))) == brute(table)


def test_few_and_no_vectors(spark):
    assert rows(pivots.search(frame(spark, [(0, [1.0, 2.0]), (3, [2.0, 1.0])]))) == [(0, 1, 3, 4 * 4096)]
    for none in ([], [(1, None)], [(0, [1.0])], [(1, [1.0]), (2, [1.0])], [(0, [1.0]), (0, [1.0])]):
        found = pivots.search(frame(spark, none))
        assert found.count() == 0 and found.columns == ["query_id", "rank", "vec_id", "score"]
    assert rows(pivots.search(frame(spark, [(0, []), (1, []), (2, [0.0])]))) == [(0, 1, 1, 0), (0, 2, 2, 0)]


def test_products_beyond_doubles_are_exact(spark):
    big = float(1 << 20)
    table = [(0, [big, 1.0, 1.0]), (1, [big, 1 / 64, 0.0]), (2, [big, 0.0, 0.0]), (3, [big, 1 / 64, 1 / 64]), (20, [big, 1.0, -1.0])]
    assert rows(pivots.search(frame(spark, table, "double"), k=3)) == brute(table, k=3)


def test_other_columns(spark):
    table = [(i, [i / 3, -i / 7], *([1] * len(CLASH))) for i in range(45)]
    docs = spark.createDataFrame(table, "vec_id long, embedding array<double>, " + ", ".join(f"`{c}` int" for c in CLASH))
    assert rows(pivots.search(docs)) == brute([r[:2] for r in table])
