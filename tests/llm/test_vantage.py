import hashlib
import math

import numpy as np
import pytest

from llm.conftest import CLASH
from stormledger.llm import catalog, vantage


def brute(rows, k=40, rounds=5, size=64, scale=256):
    """The contract with Python integers."""
    kept = [
        (i, [math.floor(scale * float(x)) for x in v]) for i, v in rows
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, v) for i, v in kept if all(abs(x) <= 1 << 26 for x in v)]
    order = lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1])
    centroids = [list(v) for _, v in sorted(kept, key=order)[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        found = assign()
        for n in range(len(centroids)):
            own = [v for (_, v), (_, m) in zip(kept, found, strict=True) if m == n]
            if own:
                centroids[n] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    found = assign()
    total = sum(d for d, _ in found)
    return sorted(((
        i, n, d, sum(e for e, m in found if m == n), total, hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest())
        for (i, _), (d, n) in zip(kept, found, strict=True)), key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(spark, table, kind="float"):
    return spark.createDataFrame(table, f"vec_id long, embedding array<{kind}>")


def test_query_is_that_of_brute_force(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    want = brute([(r["vec_id"], r["embedding"]) for r in table.collect()])
    found = catalog.QUERIES["op11_vantage_tree"](spark, "/root/testdata/sf0.01")
    assert found.dtypes == [("vec_id", "bigint"), ("cluster", "int"), ("distance", "bigint"), ("cluster_inertia", "bigint"), ("inertia", "bigint"),
                            ("centroid_sha256", "string")]
    assert rows(found) == want


@pytest.mark.parametrize("leaf", [1, 4, 100])
def test_the_tree_finds_the_nearest_with_ties_to_the_smaller_number(leaf):
    draw = np.random.default_rng(5)
    for size, spread in ((1, 4), (2, 3), (5, 40), (64, 300)):
        points = draw.integers(-spread, spread + 1, size=(60, size))  # small spreads give equal points and ties
        vectors = draw.integers(-spread, spread + 1, size=(5000, size))
        far = ((vectors[:, None, :] - points[None]) ** 2).sum(axis=2)
        number, best = vantage.VantageTree(points, leaf).nearest(vectors)
        assert (number == far.argmin(axis=1)).all() and (best == far.min(axis=1)).all()


def test_large_components_stay_exact():
    points = np.array([[1 << 26] * 64, [-(1 << 26)] * 64, [(1 << 26) - 1] * 64])
    number, best = vantage.VantageTree(points, 1).nearest(np.array([[1 << 26] * 64, [-(1 << 26)] * 64, [(1 << 26) - 1] * 63 + [1 << 26]]))
    assert number.tolist() == [0, 1, 2] and best.tolist() == [0, 0, 1]


def test_the_search_leaves_nodes_out():
    """Far groups of points: a vector of one group never sees the others'."""
    draw = np.random.default_rng(6)
    points = np.concatenate([draw.integers(0, 10, size=(10, 8)) + 10000 * g for g in range(4)])
    tree, seen = vantage.VantageTree(points), []
    real = vantage.squared
    try:
        vantage.squared = lambda a, b: seen.append(len(a)) or real(a, b)
        tree.nearest(points)
    finally:
        vantage.squared = real
    assert sum(seen) < 0.6 * len(points) ** 2


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [0.5 * ((i * 7 + j * 3) % 11) - 2.0 for j in range(4)]) for i in range(60)]
    table = good + good[:7] + [(None, [1.0] * 4), (None, [0.25] * 4), (3, [9.0] * 4), (100, None), (101, []), (102, [1.0] * 3), (103, [nan] * 4),
                               (104, [inf, 0.0, 0.0, 0.0]), (105, [None, 0.0, 0.0, 0.0]), (106, [3e30] * 4), (107, [-0.0, 0.0, -0.001, 0.001])]
    found = vantage.cluster(frame(spark, table).repartition(3), size=4)
    assert rows(found) == brute(table, size=4)


def test_few_equal_and_no_vectors(spark):
    one = [(i, [1.0, 2.0]) for i in range(50)]
    found = rows(vantage.cluster(frame(spark, one), size=2))
    assert found == brute(one, size=2) and {r[1] for r in found} == {0}
    few = [(7, [1.0, 2.0]), (8, [-1.0, 0.0])]
    assert rows(vantage.cluster(frame(spark, few), size=2)) == brute(few, size=2)
    for none in (frame(spark, []), frame(spark, [(1, None), (2, [1.0])])):
        empty = vantage.cluster(none, size=2)
        assert empty.count() == 0 and empty.columns == vantage.cluster(frame(spark, few), size=2).columns


def test_doubles_and_other_columns(spark):
    table = [(i, [i / 3, -i / 7], *([1] * len(CLASH))) for i in range(45)]
    docs = spark.createDataFrame(table, "vec_id long, embedding array<double>, " + ", ".join(f"`{c}` int" for c in CLASH))
    assert rows(vantage.cluster(docs, size=2)) == brute([r[:2] for r in table], size=2)
