import re

import numpy as np
import pytest

from conftest import SMALL
from stormledger.llm import catalog, order_join, texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n=4):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k:k + n]) for k in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} if words else set()


def brute(docs, percent=85):
    """All pairs, and a walk over the links."""
    sets = [(i, shingles(t)) for i, t in docs]
    root = {k: k for k in range(len(sets))}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, (_, x) in enumerate(sets):
        for b in range(a):
            y = sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                root[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[top(k)] = min(i, least.get(top(k), i))
    return sorted((i, len(s), least[top(k)]) for k, (i, s) in enumerate(sets))


def rows(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect())


def test_query_on_whole_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert rows(catalog.QUERIES["op6_order_join"](spark, SMALL)) == brute(docs)


def test_odd_texts(odd):
    assert rows(order_join.components(odd)) == brute([(r["doc_id"], r["text"]) for r in odd.collect()])


def test_no_rows(none):
    found = order_join.components(none)
    assert found.count() == 0 and order_join.one_of_each(none, found).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_groups_chains_and_common_passages(spark, seed):
    """Copies, chains of edits, and unlike texts around a common passage."""
    draw = np.random.default_rng(seed)
    vocabulary = [f"w{k}" for k in range(300)]
    common = list(draw.choice(vocabulary, 30))
    docs = []
    for _ in range(14):
        own = list(draw.choice(vocabulary, draw.integers(8, 90)))
        if draw.random() < 0.5:
            own = own[:10] + common + own[10:20]
        for _ in range(draw.integers(1, 9)):
            docs.append(" ".join(own))
            for _ in range(draw.integers(0, 3)):
                own[draw.integers(0, len(own))] = str(draw.choice(vocabulary))
    docs += ["short", "Short", "two words", "one two three four", "one two three four five"]
    table = list(enumerate(draw.permutation(docs).tolist()))
    frame = spark.createDataFrame(table, "doc_id long, text string").repartition(5)
    assert rows(order_join.components(frame)) == brute(table)


def test_one_large_group_of_near_copies(spark):
    base = [f"w{k}" for k in range(60)]
    table = [(k, " ".join(base[:55] + [f"x{k}"] + base[56:])) for k in range(150)]
    found = rows(order_join.components(spark.createDataFrame(table, "doc_id long, text string")))
    assert found == brute(table) and len({c for _, _, c in found}) == 1


def test_prefixes_of_similar_sets_meet_under_every_order():
    draw = np.random.default_rng(4)
    levels = draw.integers(0, 40, 256).astype(np.uint8)
    for _ in range(200):
        x = np.unique(draw.integers(0, 1 << 62, draw.integers(1, 60)).astype(np.uint64))
        y = np.unique(np.concatenate((x[draw.random(len(x)) < 0.93], draw.integers(0, 1 << 62, 2).astype(np.uint64))))
        common = len(np.intersect1d(x, y))
        if 100 * common >= 85 * (len(x) + len(y) - common):
            for order in range(3):
                assert len(np.intersect1d(order_join.prefix(x, levels, order), order_join.prefix(y, levels, order)))


@pytest.mark.parametrize("links", [[], [(1, 2)], [(k, k + 1) for k in range(1, 40)], [(9, 1), (9, 2), (8, 2), (5, 6), (6, 7)], [(3, 3), (4, 3)]])
def test_connected(spark, links):
    found = {r["node"]: r["root"] for r in order_join.connected(spark.createDataFrame(links, "a long, b long")).collect()}
    least = {k: k for pair in links for k in pair}
    for _ in links:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    assert {k: v for k, v in least.items() if k != v} == {k: v for k, v in found.items() if k != v}


def stored(monkeypatch):
    """Names of the tables that are stored from now on."""
    names, keep = [], order_join.session.materialize
    monkeypatch.setattr(order_join.session, "materialize", lambda df, name: (names.append(name), keep(df, name))[1])
    return names


def test_links_that_hang_on_the_smallest_need_no_round(spark, monkeypatch):
    names = stored(monkeypatch)
    links = [(1, 2), (1, 3), (4, 1), (5, 6), (6, 5), (7, 7)]
    found = order_join.connected(spark.createDataFrame(links, "a long, b long"))
    assert names == ["edges"] and sorted(map(tuple, found.select("node", "root").collect())) == [(2, 1), (3, 1), (4, 1), (6, 5)]
    for links, alike in (([(1, 2), (1, 3)], True), ([(1, 2), (2, 3)], False), ([(1, 3), (2, 3)], False), ([], True)):
        assert order_join.stars(spark.createDataFrame(links, "a long, b long")) == alike


def test_what_is_connected_is_not_connected_anew(spark, monkeypatch):
    """Near copies hang on their hubs after the first rounds; the last call finds stars."""
    names = stored(monkeypatch)
    docs = [[f"g{g}x{k}" for k in range(60)] for g in range(6)]
    table = [(10 * g + k, " ".join([*own, f"y{g}x{k}"])) for g, own in enumerate(docs) for k in range(8)]
    found = rows(order_join.components(spark.createDataFrame(table, "doc_id long, text string").repartition(3)))
    assert found == brute(table) and len({c for _, _, c in found}) == 6
    last = len(names) - names[::-1].index("edges")
    assert names[last:] == [] and names.count("edges") == 2


def test_one_of_each_group_stays(odd):
    kept = order_join.one_of_each(odd, order_join.components(odd))
    ids = sorted(r[0] for r in kept.collect())
    assert kept.columns == odd.columns and ids == [0, 1, 2, 3, 4, 5, 7, 8, 10, 11, 12]


@pytest.mark.parametrize("block, small", [(3, 1), (7, 4), (1000, 1)])
def test_groups_that_hubs_leave_apart_are_compared_in_blocks(spark, monkeypatch, block, small):
    """Texts around one long passage: most are not similar to the hub, some to each other."""
    monkeypatch.setattr(order_join, "BLOCK", block)
    monkeypatch.setattr(order_join, "SMALL", small)
    draw = np.random.default_rng(block)
    passage = [f"p{k}" for k in range(60)]
    docs = []
    for g in range(12):
        own = [f"g{g}x{k}" for k in range(draw.integers(6, 16))]
        for _ in range(draw.integers(1, 5)):
            docs.append(" ".join(passage + own))
            own[draw.integers(0, len(own))] = f"r{draw.integers(0, 10 ** 6)}"
    table = list(enumerate(draw.permutation(docs).tolist()))
    assert rows(order_join.components(spark.createDataFrame(table, "doc_id long, text string").repartition(3))) == brute(table)


def test_parities_never_tell_more_than_sets_differ_in():
    draw = np.random.default_rng(1)
    for _ in range(100):
        x, y = (np.unique(draw.integers(0, 3000, draw.integers(1, 2500)).astype(np.uint64)) for _ in range(2))
        told = int(np.bitwise_count((order_join.parities(x) ^ order_join.parities(y)).view(np.uint64)).sum())
        assert told <= len(np.setxor1d(x, y)) and not (order_join.parities(x) ^ order_join.parities(x)).any()


def test_classes_that_meet_by_chance_are_not_read_again(spark, monkeypatch):
    """Unlike texts that share a rare passage two by two: their sizes and parities tell."""
    draw = np.random.default_rng(8)
    docs = []
    for k in range(40):
        shared = [f"s{k}x{j}" for j in range(6)]
        docs += [" ".join([f"a{k}x{j}" for j in range(60)] + shared), " ".join(shared + [f"b{k}x{j}" for j in range(60)])]
    docs += [" ".join([f"c{j}" for j in range(70)] + [f"d{k}"]) for k in range(2)]
    wanted = []
    kept = order_join.wanted_texts
    monkeypatch.setattr(order_join, "wanted_texts", lambda rows, ids: (wanted.append(ids.count()), kept(rows, ids))[1])
    table = list(enumerate(draw.permutation(docs).tolist()))
    found = rows(order_join.components(spark.createDataFrame(table, "doc_id long, text string")))
    assert found == brute(table) and wanted == [2]


def test_functions_of_groups_give_memory_back(spark, monkeypatch):
    """Workers outlive their tasks: those that compare groups must not keep what they held."""
    calls, wrapped, keep = [], [], texts.tidy_groups
    monkeypatch.setattr(texts, "_released", 0.0)
    monkeypatch.setattr(texts, "release", lambda: calls.append(1))
    plus = keep(lambda x: x + 1)
    assert [plus(k) for k in range(1000)] == list(range(1, 1001)) and 1 <= len(calls) < 1000
    monkeypatch.undo()
    monkeypatch.setattr(texts, "tidy_groups", lambda work: wrapped.append(work.__name__) or keep(work))
    base = " ".join(f"w{k}" for k in range(60))
    docs = spark.createDataFrame([(k, f"{base} x{k}") for k in range(6)], "doc_id long, text string")
    assert {r["component_id"] for r in order_join.components(docs).collect()} == {0}
    assert {"_sum_counts", "_or_bits", "compare"} <= set(wrapped)


def test_rows_of_prefixes_move_once(spark):
    """One shuffle finds the shingles of several classes and their rows; copies of a row count once."""
    table = [(7, 1), (7, 1), (8, 2), (8, 1), (8, 2), (9, -3), (9, 5), (-1, 4), (0, 6), (0, 6)]
    shared = order_join._shared(spark.createDataFrame(table, "token long, cls long").repartition(3))
    assert sorted((r["token"], r["cls"]) for r in shared.collect()) == [(8, 1), (8, 2), (9, -3), (9, 5)]
    read = spark.createDataFrame(table, "token long, cls long").mapInArrow(lambda batches: batches, "token long, cls long")
    plan = order_join._shared(read)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and plan.count("Exchange") == 1


def test_shingles_of_one_name_only_make_groups_larger(spark, monkeypatch):
    monkeypatch.setattr(order_join, "TOKEN_BITS", 3)
    draw = np.random.default_rng(3)
    table = [(k, " ".join(draw.choice(list("abcdefgh"), 25))) for k in range(20)]
    table += [(20 + k, " ".join([f"w{j}" for j in range(50)] + [f"x{k}"])) for k in range(4)]
    assert rows(order_join.components(spark.createDataFrame(table, "doc_id long, text string"))) == brute(table)


def test_counters_come_back_and_small_ones_are_small():
    draw = np.random.default_rng(6)
    counts = draw.poisson(0.5, 1 << 16).astype(np.uint32)
    counts[:3] = [0xFFFFFFFF, 256, 70_000]
    packed = order_join.packed_counts(counts)
    assert (order_join.unpacked_counts(packed) == counts).all() and len(packed) * 8 < 3 * len(counts)
