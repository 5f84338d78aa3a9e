"""Figures that are stored and merged: sketches, base counts, observed steps, buckets."""

import math

import pytest
from pyspark.sql import functions as F

from stormledger import bindings, schema
from stormledger.operators import quantiles, sketches
from stormledger.plans import datasets, refresh, stages
from stormledger.sources import buckets, sinks
from test_plans import records_read


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- sketches ----------------------------------------------------------------

@pytest.fixture
def parts(spark):
    """Three files of very different sizes."""
    one = spark.range(30000).select(
        F.when(F.col("id") < 20000, "a.csv").when(F.col("id") < 29990, "b.csv").otherwise("c.csv").alias("f"),
        (F.col("id") % 5000).cast("string").alias("t"), F.when(F.col("id") % 10 != 0, F.col("id") * F.lit(0.5)).alias("x"))
    return one


def test_merged_sketches_are_within_their_errors(spark, parts):
    found = sketches.sketch_columns(parts, keys=("f",))
    assert found.count() == 6
    whole = {r["coluna"]: r for r in sketches.profile_sketches(sketches.merge_sketches(found)).collect()}
    assert (whole["t"]["linhas"], whole["t"]["nulos"], whole["t"]["quantis"]) == (30000, 0, None)
    assert abs(whole["t"]["valores_unicos"] - 5000) <= 5000 * sketches.DISTINCT_ERROR
    assert (whole["x"]["linhas"], whole["x"]["nulos"], whole["x"]["pct_nulos"], whole["x"]["menor"], whole["x"]["maior"]) == (30000, 3000, 10.0, 0.5, 14999.5)
    for p, q in zip((0.25, 0.5, 0.75), whole["x"]["quantis"]):
        assert abs(q / 15000 - p) <= sketches.RANK_ERROR
    # united over some files alone
    two = sketches.merge_sketches(found.where("f <> 'a.csv'")).where("coluna = 'x'").first()
    assert two["linhas"] == 10000 and two["menor"] == 10000.5


def test_sketches_of_odd_columns(spark):
    df = spark.createDataFrame(
        [(None, float("nan"), None), (None, float("inf"), 1.5), (None, None, -2.5)], "a string, b double, c float")
    found = {r["coluna"]: r for r in sketches.profile_sketches(sketches.merge_sketches(sketches.sketch_columns(df).union(sketches.sketch_columns(df)))).collect()}
    assert (found["a"]["nulos"], found["a"]["valores_unicos"], found["a"]["quantis"], found["a"]["muitos_nulos"]) == (6, 0, None, True)
    assert (found["b"]["nulos"], found["b"]["valores_unicos"], found["b"]["quantis"], found["b"]["menor"]) == (4, 1, None, None)
    assert (found["c"]["nulos"], found["c"]["menor"], found["c"]["maior"]) == (2, -2.5, 1.5)
    assert sketches.sketch_columns(df.limit(0)).count() == 0


def test_fences_without_the_rows(spark, parts):
    got = sketches.sketched_fences(sketches.merge_sketches(sketches.sketch_columns(parts))).where("coluna = 'x'").first()
    _, _, low, high = quantiles.fences(parts, ["x"])["x"]
    assert math.isclose(got["limite_inferior"], low, abs_tol=15000 * 0.05) and math.isclose(got["limite_superior"], high, abs_tol=15000 * 0.05)


def test_only_the_changed_years_are_sketched(spark, tmp_path):
    source = sinks.write_parquet_by_year(spark.range(3000).select((2020 + F.col("id") % 3).cast("int").alias("ano"), F.col("id").alias("v")), str(tmp_path / "in"))
    stored, out = sinks.read_by_year(spark, source), str(tmp_path / "out")
    refresh.refresh_sketches(stored, out, [2020, 2021, 2022])
    assert records_read(spark, lambda: refresh.refresh_sketches(stored, out, [2021])) == 1000
    assert rows(refresh.merged_profile(spark, out), "coluna", "linhas") == [("v", 3000)]
    assert records_read(spark, lambda: refresh.merged_profile(spark, out).collect()) == 3


# --- base counts -------------------------------------------------------------

def test_refreshed_counts_are_those_of_a_full_run(spark, tmp_path):
    incidents = bindings.incidents(spark, "/root/testdata/sf0.001")
    source, base = str(tmp_path / "in"), str(tmp_path / "base")
    sinks.write_parquet_by_year(incidents, source)
    years = list(range(1992, 2003))
    refresh.refresh_base(sinks.read_by_year(spark, source), base, years)
    corrected = incidents.where("ano = 1998 AND id_atendimento % 2 = 0").withColumn("bairro", F.lower("bairro"))
    sinks.reload_years(corrected, source, [1997, 1998])
    now = sinks.read_by_year(spark, source)
    read = records_read(spark, lambda: refresh.refresh_base(now, base, [1997, 1998]))
    assert read == corrected.count()
    kept = refresh.stored_base(spark, base)
    for one in (datasets.kpis, datasets.time_series, datasets.area_ranking, datasets.seasonality, datasets.all_aggregates):
        names = one(now).columns
        assert rows(one(kept, weight=datasets.TOTAL), *names) == rows(one(now), *names)


# --- observed steps ----------------------------------------------------------

def test_steps_are_observed_by_the_writing_job_alone(spark, tmp_path):
    path = str(tmp_path / "raw")
    bindings.dirty(spark, "/root/testdata/sf0.001").write.parquet(path)
    raw = spark.read.parquet(path)
    n = raw.count()
    assert records_read(spark, lambda: stages.clean_and_store(raw, str(tmp_path / "clean"))) == n
    clean = spark.read.parquet(str(tmp_path / "clean"))
    found = {r["etapa"]: r for r in stages.clean_and_store(raw, str(tmp_path / "again"), fill=True).collect()}
    assert found["carregado"]["linhas"] == found["limpo"]["linhas"] == clean.count() == n
    assert found["limpo"]["com_data"] == clean.where("data_atendimento IS NOT NULL").count()
    again = spark.read.parquet(str(tmp_path / "again"))
    assert found["limpo"]["nulos"] == sum(again.where(F.col(c).isNull()).count() for c in again.columns)
    assert rows(stages.clean_and_store(raw.limit(0), str(tmp_path / "none")), "etapa", "linhas", "nulos")[0][1:] == (0, 0)


# --- buckets -----------------------------------------------------------------

@pytest.fixture
def history(spark, tmp_path, request):
    name = f"h_{abs(hash(request.node.name))}"
    first = spark.range(1000).select("id", F.lit(1).alias("v"), (F.col("id") * 2).alias("x"))
    buckets.store_bucketed(first, name, f"file://{tmp_path}/h", ["id"], 16)
    second = spark.range(900, 1100).select("id", F.lit(2).alias("v"), F.col("id").alias("x"))
    yield name, second, f"file://{tmp_path}/h"
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_questions_by_key_move_nothing_stored(spark, history):
    name, second, path = history
    stored = spark.table(name)
    seen = buckets.compare_load(second, stored, ["id"])
    assert seen.where("no_historico = 1").count() == 100 and seen.where("no_historico = 0").count() == 100
    stored = buckets.store_bucketed(second, name, path, ["id"], 16, mode="append")
    newest = buckets.latest_rows(stored, ["id"], [F.col("v")])
    assert rows(newest.where("id IN (5, 950, 1050)"), "id", "v", "x") == [(1050, 2, 1050), (5, 1, 10), (950, 2, 950)] and newest.count() == 1100
    assert buckets.repeated_keys(stored, ["id"]).count() == 100
    for df in (newest, buckets.repeated_keys(stored, ["id"])):
        assert "Exchange" not in plan(df) and "Bucketed: true" in plan(df)
    # of a join the load alone moves
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (buckets.compare_load(second, stored, ["id"]), buckets.history_orphans(stored, second, ["id"])):
            assert plan(df).count("Exchange") == 1 and "hashpartitioning(id" in plan(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)
    assert buckets.history_orphans(stored, second, ["id"]).count() == 900


def test_a_history_is_attached_again(spark, history):
    name, _, path = history
    spark.sql(f"DROP TABLE {name}")
    again = buckets.attach_bucketed(spark, name, path, ["id"], 16, "id bigint, v int, x bigint")
    assert again.count() == 1000 and "Exchange" not in plan(buckets.repeated_keys(again, ["id"]))


# --- diagnosis ---------------------------------------------------------------

def test_quartiles_from_counts_for_every_type(spark):
    data = [("a" if i % 3 else None, i % 17 if i % 5 else None, float(i % 13) / 7, i) for i in range(500)] + [("b", None, float("inf"), 1)] + [("b", None, float("nan"), 10 ** 9)]
    df = spark.createDataFrame(data, "f string, i int, r float, n bigint")
    got = {(r["f"], r["coluna"]): (r["pct_fora"], r["outliers"]) for r in stages.diagnose(df, ("f",)).collect()}
    want = {(r["f"], r["coluna"]): (r["pct_fora"], r["problema"]) for r in quantiles.grouped_outliers(df, ["i", "r", "n"], ["f"]).collect()}
    assert len(want) == 9 and all(got[k] == v for k, v in want.items())
    alone = {r["coluna"]: r["pct_fora"] for r in stages.diagnose(df).collect()}
    whole = {r["coluna"]: r["pct_fora"] for r in quantiles.outliers(df, ["i", "r", "n"]).collect()}
    assert all(alone[c] == v for c, v in whole.items())


def test_diagnosis_reads_the_rows_once(spark, tmp_path):
    path = str(tmp_path / "raw")
    bindings.dirty(spark, "/root/testdata/sf0.001").coalesce(1).write.parquet(path)
    raw = spark.read.parquet(path)
    census = sum(raw.select(c).distinct().count() for c in raw.columns)
    # the census is read by the summary, the top values, the quartiles and the share outside
    assert records_read(spark, lambda: stages.diagnose(raw).collect()) <= raw.count() + 8 * census
    assert schema.numeric_columns(raw) == ["id_atendimento", "quantidade"]
