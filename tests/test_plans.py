"""The physical plans stay within what a large cluster can run."""

import re

import pytest
from pyspark.sql import functions as F

from stormledger import bindings, catalog
from stormledger.operators import aggregates as agg, profiling, quality, quantiles, ranking, series
from stormledger.sources import sinks

from conftest import SMALL


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_python_rows_and_no_cross_products(spark, name):
    plan = plan_of(catalog.QUERIES[name](spark, SMALL))
    for bad in ("EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan


def test_only_needed_columns_are_read(spark):
    plan = plan_of(agg.by_year(bindings.orders(spark, SMALL)))
    assert re.search(r"ReadSchema: struct<o_orderdate:timestamp_ntz>", plan)
    plan = plan_of(agg.sum_by(bindings.calls(spark, SMALL), "chuva_mm", "posto", out="mm"))
    assert re.search(r"ReadSchema: struct<user_id:bigint,value:double>", plan)


def test_filters_reach_the_scan(spark):
    rows = bindings.orders(spark, SMALL).where("tipo_ocorrencia = '1-URGENT'")
    assert "EqualTo(o_orderpriority,1-URGENT)" in plan_of(agg.by_year(rows))


def test_counts_are_combined_before_the_shuffle(spark):
    plan = plan_of(agg.count_by(bindings.calls(spark, SMALL), "posto"))
    assert plan.index("Exchange hashpartitioning") < plan.index("partial_count")


@pytest.mark.parametrize("make", [
    lambda df: quality.keep_latest(df, ["posto"], "data_atendimento", [F.col("id_atendimento")]),
    lambda df: agg.hotspots(df, "posto", "tipo_ocorrencia", 2),
    lambda df: profiling.examples(profiling.value_census(df, ["posto", "tipo_ocorrencia"])),
])
def test_groups_are_limited_before_the_shuffle(spark, make):
    plan = plan_of(make(bindings.calls(spark, SMALL)))
    assert "Partial" in "".join(re.findall(r"WindowGroupLimit.*", plan))


def hot(spark, rows: int = 30_000):
    """A third of all rows share one station; the others are spread."""
    i = F.col("id")
    return spark.range(rows, numPartitions=6).select(
        i.alias("id_atendimento"),
        F.when(i % 3 == 0, F.lit(0)).otherwise(i % 997 + 1).alias("posto"),
        F.when(i % 3 == 0, F.lit("a")).otherwise(F.concat(F.lit("k"), i % 7)).alias("tipo"),
        F.timestamp_seconds(i * 60).cast("timestamp_ntz").alias("quando"),
    )


def test_hot_key_results_are_whole(spark):
    df = hot(spark)
    counts = {r["posto"]: r["total_ocorrencias"] for r in agg.count_by(df, "posto").collect()}
    assert counts[0] == 10_000 and sum(counts.values()) == 30_000 and len(counts) == 998
    latest = {r["posto"]: r["id_atendimento"] for r in quality.keep_latest(
        df, ["posto"], "quando", [F.col("id_atendimento")]).collect()}
    assert latest[0] == 29_997 and len(latest) == 998
    named = agg.count_by(df, "posto").withColumn("nome", F.col("posto").cast("string"))
    ranks = ranking.with_global_rank(named, "total_ocorrencias", "nome", "r").collect()
    want = sorted(ranks, key=lambda r: (-r["total_ocorrencias"], r["nome"]))
    assert [r["r"] for r in want] == list(range(1, 999)) and want[0]["posto"] == 0


def test_hot_key_gaps_and_volumes(spark):
    df = hot(spark)
    assert series.gaps(df, "quando", ("posto",), max_days=0).where("posto = 0").count() == 20
    daily = series.volume_check(df, "quando", ("posto",)).where("posto = 0").orderBy("dia").collect()
    assert sum(r["total_ocorrencias"] for r in daily) == 10_000


def records_read(spark, run) -> int:
    """Input records of all stages that ``run`` starts."""
    def stages():
        sc = spark.sparkContext
        sc._jsc.sc().listenerBus().waitUntilEmpty()
        no_quantiles = sc._gateway.new_array(sc._jvm.double, 0)
        found = sc._jsc.sc().statusStore().stageList(
            None, False, False, no_quantiles, sc._jvm.java.util.ArrayList()
        )
        return [found.apply(i) for i in range(found.size())]

    last = max((s.stageId() for s in stages()), default=-1)
    run()
    return sum(s.inputRecords() for s in stages() if s.stageId() > last)


# Rows of the incident tables: orders, customers, nations, regions.
INCIDENT_ROWS = 1500 + 150 + 25 + 5


@pytest.mark.parametrize("name", [
    "agg_area", "stats_area", "share_of_total", "rank_area", "bi_area_ranking", "general_stats",
    "kpis", "all_aggregates", "hotspots", "clean_and_unify", "profile_columns",
    "profile_examples", "profile_categorical", "dq_null_ratio", "dq_schema",
])
def test_incidents_are_read_once(spark, name):
    read = records_read(spark, lambda: catalog.QUERIES[name](spark, SMALL).collect())
    # A ranking also reads its stored ranges, of one row per area, twice.
    assert 1500 < read <= INCIDENT_ROWS + 2 * 25


@pytest.mark.parametrize("name, rows", [
    ("yoy", 1500), ("mode_values", 1500), ("bi_seasonality", 1500), ("orphans", 7500),
    ("mean_response", 7500), ("join_daily_rain", 7500), ("dq_dup_ratio", 6000),
    ("dedup_latest", 6000), ("hour_weekday", 1000), ("dq_rules_rain", 1000),
])
def test_tables_are_read_once(spark, name, rows):
    assert records_read(spark, lambda: catalog.QUERIES[name](spark, SMALL).collect()) == rows


@pytest.mark.parametrize("write", ["write_csv_table", "write_csv_export"])
def test_sinks_read_their_source_once(spark, tmp_path, write):
    rows = bindings.table(spark, SMALL, "lineitem").select("l_orderkey", "l_quantity")
    assert records_read(spark, lambda: getattr(sinks, write)(rows, str(tmp_path / "out"))) == 6000


def test_one_row_per_range_passes_through_one_task(spark):
    items = agg.count_by(bindings.table(spark, SMALL, "lineitem"), "l_partkey").withColumn("nome", F.col("l_partkey").cast("string"))
    plan = plan_of(ranking.with_global_rank(items, "total_ocorrencias", "nome", "r"))
    alone = plan[plan.index("Exchange SinglePartition"):]
    assert "HashAggregate(keys=[_faixa" in alone and plan.count("Exchange SinglePartition") == 1


def test_exact_quantiles_need_few_scans(spark):
    items = bindings.table(spark, SMALL, "lineitem")
    columns = ["l_extendedprice", "l_quantity"]
    read = records_read(spark, lambda: quantiles.exact_quantiles(items, columns, [0.25, 0.75]))
    assert read <= 4 * 6000
