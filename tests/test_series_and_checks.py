import math
import random
from datetime import date, datetime

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from stormledger import bindings
from stormledger.operators import joins, profiling, quality, quantiles, ranking, series

from conftest import SMALL


def days(spark, texts, extra=""):
    return spark.createDataFrame([(t,) for t in texts], "d string").select(
        F.col("d").cast("timestamp_ntz").alias("d"))


def test_gap(spark):
    got = series.gaps(days(spark, ["2024-01-01", "2024-01-02 10:00:00", "2024-01-06", "2024-01-08"]), "d")
    assert [tuple(r) for r in got.collect()] == [(date(2024, 1, 6), date(2024, 1, 2), 4)]


def test_month_on_month_needs_the_month_before(spark):
    df = spark.createDataFrame(
        [(2023, 12, 100), (2024, 1, 120), (2024, 3, 60), (2024, 4, 0), (2024, 5, 5)],
        "ano int, mes int, total_ocorrencias bigint",
    )
    got = {(r["ano"], r["mes"]): (r["variacao_pct"], r["dentro_do_limite"])
           for r in series.month_on_month(df).collect()}
    assert got == {
        (2023, 12): (None, None), (2024, 1): (20.0, True), (2024, 3): (None, None),
        (2024, 4): (-100.0, False), (2024, 5): (None, None),
    }


def test_volume_check(spark):
    texts = ["2024-01-01"] * 10 + ["2024-01-02"] * 7 + ["2024-01-03"] * 8
    got = [(r["total_ocorrencias"], r["volume_usual"], r["volume_baixo"])
           for r in series.volume_check(days(spark, texts), "d").orderBy("dia").collect()]
    assert got == [(10, None, None), (7, 10.0, True), (8, 8.5, False)]


def test_deviation(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("a", 3, 16), ("b", 3, 5)],
                               "k string, ano int, total_ocorrencias bigint")
    got = {(r["k"], r["ano"]): r["desvio_pct"]
           for r in series.deviation_from_history(df, "k", ["ano"]).collect()}
    assert got == {("a", 1): None, ("a", 2): 100.0, ("a", 3): 6.67, ("b", 3): None}


def test_global_rank_matches_a_plain_sort(spark):
    rng = random.Random(7)
    rows = [(f"{rng.choice('abc')}{i:04}", rng.choice([1, 1, 1, 2, 50])) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, n bigint").repartition(5)
    got = {r["k"]: r["r"] for r in ranking.with_global_rank(df, "n", "k", "r").collect()}
    want = sorted(rows, key=lambda r: (-r[1], r[0]))
    assert got == {k: i for i, (k, _) in enumerate(want, start=1)}


def test_latest_per_key_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, "2024-01-01", 1), (1, "2024-01-02", 2), (2, "2024-01-01", 3)],
                               "id int, ts string, row int")
    latest = quality.keep_latest(df, ["id"], "ts", [F.col("row")])
    assert sorted(r["row"] for r in latest.collect()) == [2, 3]
    plan = latest._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_quartiles_interpolate_and_skip_nulls(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,), (math.nan,)], "v double")
    assert quantiles.exact_quantiles(df, ["v"], [0.25, 0.75]) == {"v": [1.75, 3.25]}


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert quantiles.exact_quantiles(df, ["v"], [0.5]) == {"v": [None]}
    row = quantiles.outliers(df, ["v"]).first()
    assert (row["q1"], row["linhas"], row["fora"]) == (None, 1, 0)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(
    st.floats(allow_nan=False, allow_infinity=False), st.integers(-3, 3).map(float),
), min_size=1, max_size=60))
def test_quantiles_match_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    ordered = sorted(values)
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = quantiles.exact_quantiles(df, ["v"], probs)["v"]
    for p, q in zip(probs, got):
        at = (len(values) - 1) * p
        a, b = ordered[math.floor(at)], ordered[math.ceil(at)]
        want = a + (b - a) * (at - math.floor(at))
        assert q == want or math.isclose(q, want, rel_tol=1e-12)


def test_quantiles_with_a_hot_value_and_far_outliers(spark):
    # A third of all rows share one value; others spread over many magnitudes.
    values = [7.0] * 2000 + [10.0 ** (i % 40 - 20) for i in range(3000)] + [1e300, -1e300] * 50
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(6)
    got = quantiles.exact_quantiles(df, ["v"], [0.25, 0.5, 0.75])["v"]
    assert got == list(np.quantile(values, [0.25, 0.5, 0.75]))


def test_approx_quartiles_are_close(spark):
    items = bindings.table(spark, SMALL, "lineitem")
    columns = ["l_quantity", "l_extendedprice"]
    exact = quantiles.exact_quantiles(items, columns, [0.25, 0.75])
    approx = quantiles.approx_quantiles(items, columns, [0.25, 0.75])
    for c in columns:
        ordered = sorted(r[0] for r in items.select(c).collect())
        for e, a in zip(exact[c], approx[c]):
            ranks = np.searchsorted(ordered, [a], "left")[0], np.searchsorted(ordered, [a], "right")[0]
            want = np.searchsorted(ordered, e, "right")
            assert ranks[0] - 0.002 * len(ordered) - 1 <= want <= ranks[1] + 0.002 * len(ordered) + 1


def test_approx_distinct_is_close(spark):
    calls = bindings.calls(spark, SMALL)
    columns = ["posto", "chuva_mm"]
    exact = {r[0]: r[1] for r in profiling.distinct_counts(calls, columns).collect()}
    approx = {r[0]: r[1] for r in profiling.distinct_counts_approx(calls, columns).collect()}
    for c in columns:
        assert abs(approx[c] - exact[c]) <= 0.08 * exact[c]


def test_approx_profile_has_exact_nulls(spark):
    dirty = bindings.dirty(spark, SMALL)
    exact = {r["nome"]: r for r in profiling.profile_columns(dirty).collect()}
    for r in profiling.profile_columns_approx(dirty).collect():
        assert (r["nulos"], r["pct_nulos"]) == (exact[r["nome"]]["nulos"], exact[r["nome"]]["pct_nulos"])
        assert abs(r["valores_unicos"] - exact[r["nome"]]["valores_unicos"]) <= 1 + 0.08 * exact[r["nome"]]["valores_unicos"]


def test_profile_percent_and_examples(spark):
    df = spark.createDataFrame([("b", 1), (None, 1), ("a", 1), ("c", 1), ("d", 1), (None, 1)], "t string, n int")
    got = {r["nome"]: tuple(r)[1:] for r in profiling.profile_columns(df).collect()}
    assert got == {"t": ("string", 2, 33.33, 4), "n": ("int", 0, 0.0, 1)}
    shown = profiling.examples(profiling.value_census(df, ["t"])).orderBy("posicao").collect()
    assert [r["valor"] for r in shown] == ["a", "b", "c"]


def test_rules_count_unknown_as_failed(spark):
    df = spark.createDataFrame([(1.0,), (600.0,), (None,)], "mm double")
    row = quality.check(df, [quality.range_rule("mm", 0, 500)]).first()
    assert (row["verificados"], row["falhas"], row["aprovado"]) == (3, 2, False)
    flagged = quality.flag(df, [quality.range_rule("mm", 0, 500)]).collect()
    assert [r["regras_violadas"] for r in flagged] == [[], ["mm_no_intervalo"], ["mm_no_intervalo"]]


def test_split_required(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, None)], "x int, y string")
    accepted, rejected = quality.split_required(df, ["x", "y"])
    assert [tuple(r) for r in accepted.collect()] == [(1, "a")]
    assert rejected.count() == 2 and rejected.columns == ["x", "y"]


def test_iso_dates(spark):
    df = spark.createDataFrame([("2024-12-06",), ("2024-12-06T10:11:12",), ("06/12/2024",), ("2024-13-01",), (None,),
                                ("2024-12-06 25:99",), ("2024-12-06T10:11:12.5",)], "data string")
    got = [(r["situacao"], r["data_convertida"] is not None) for r in quality.convert_dates(df, "data").collect()]
    assert got == [("ok", True), ("ok", True), ("convertido", True), ("invalido", False), ("invalido", False),
                   ("invalido", False), ("ok", True)]


def test_freshness_window(spark):
    reference = F.lit("2024-01-31 12:00:00").cast("timestamp_ntz")
    df = days(spark, ["2024-01-24", "2024-01-23 23:59:59", "2024-01-31 12:00:01", "2024-01-31 12:00:00"])
    row = quality.check(df, [quality.freshness_rule("d", reference, 7)]).first()
    assert row["falhas"] == 2


def test_scorecard(spark):
    good = spark.createDataFrame([(i, "x") for i in range(100)], "n int, t string")
    rules = [*quality.required_rules(["n", "t"]), quality.range_rule("n", 0, 89)]
    ok = quality.scorecard([quality.check(good, rules)]).first()
    assert (ok["regras"], ok["aprovadas"], ok["falhas_criticas"], ok["aceito"]) == (3, 2, 0, True)
    assert ok["qualidade"] == pytest.approx(1 - 10 / 300, abs=1e-6)
    bad = spark.createDataFrame([(None, "x")] + [(i, "x") for i in range(99)], "n int, t string")
    assert not quality.scorecard([quality.check(bad, quality.required_rules(["n"]))]).first()["aceito"]


def test_duplicate_ratio_with_a_hot_key(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).alias("k"))
    row = quality.duplicate_ratio(df, ["k"]).first()
    assert (row["verificados"], row["falhas"], row["aprovado"]) == (3000, 999, False)


def test_orphans(spark):
    a, b = spark.createDataFrame([(1,), (2,), (2,), (None,)], "x int"), spark.createDataFrame([(2,), (3,)], "y int")
    got = joins.orphans(a, "x", "esquerda", b, "y", "direita").collect()
    assert sorted(tuple(r) for r in got) == [(1, "esquerda"), (3, "direita")]


def test_catalogue(spark):
    df = spark.createDataFrame([("RE-RECIFE",), ("XX",), (None,)], "posto string")
    from stormledger import vocab

    stations = spark.createDataFrame(vocab.STATIONS, "codigo string, nome string, tipo string")
    tagged = joins.tag_members(df, "posto", stations, "codigo", "tag", "desconhecido")
    assert {r["posto"]: r["tag"] for r in tagged.collect()} == {
        "RE-RECIFE": "RE-RECIFE", "XX": "desconhecido", None: "desconhecido"}
    listed = joins.tag_listed(df, "posto", [s[0] for s in vocab.STATIONS], "tag", "desconhecido")
    assert sorted(r["tag"] for r in listed.collect()) == ["RE-RECIFE", "desconhecido", "desconhecido"]
    assert [r["posto"] for r in joins.unknown_keys(df, "posto", stations, "codigo").collect()] == ["XX"]


def test_daily_join_keeps_both_sides(spark):
    rain = spark.createDataFrame([("2024-01-01", 5.0), ("2024-01-01", 2.5), ("2024-01-02", 1.0)], "d string, mm double")
    rain = rain.withColumn("d", F.col("d").cast("timestamp_ntz"))
    got = joins.daily_rain_and_incidents(rain, "d", "mm", days(spark, ["2024-01-02", "2024-01-03"]), "d")
    assert sorted((str(r[0]), r[1], r[2]) for r in got.collect()) == [
        ("2024-01-01", 7.5, 0), ("2024-01-02", 1.0, 1), ("2024-01-03", None, 1)]


def test_mean_response(spark):
    asked = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 2, 1))], "k int, t0 timestamp_ntz")
    done = spark.createDataFrame(
        [(1, datetime(2024, 1, 1, 2)), (1, datetime(2024, 1, 1, 4)), (2, datetime(2024, 2, 2)), (9, datetime(2024, 1, 1))],
        "k int, t1 timestamp_ntz")
    asked = asked.withColumn("mes", F.month("t0"))
    got = joins.mean_response_hours(asked, "k", "t0", done, "k", "t1", "mes").orderBy("mes").collect()
    assert [tuple(r) for r in got] == [(1, 3.0, 2), (2, 24.0, 1)]
