"""Published yearly, monthly and rain series as input and expected output."""

import pytest
from pyspark.sql import functions as F

from stormledger.operators import aggregates as agg, joins, series
from stormledger.plans import datasets

TOTAL = "total_ocorrencias"

# Fixed values: (month totals January..December) per year; 0 = no row.
MONTHLY = {
    2001: [0, 0, 0, 0, 0, 0, 0, 0, 0, 1, 0, 0],
    2013: [0, 0, 0, 1, 1, 0, 1, 4, 1, 0, 0, 0],
    2014: [1245, 1479, 2020, 1627, 1644, 1908, 2294, 1544, 1869, 2376, 2164, 1879],
    2015: [0, 1, 0, 0, 0, 0, 0, 0, 0, 0, 1, 0],
    2016: [3513, 2216, 3832, 3459, 3548, 3360, 3642, 2679, 3157, 2014, 3864, 3479],
    2017: [2172, 2101, 3316, 3019, 3751, 3231, 2731, 2946, 1779, 3110, 2638, 3011],
    2018: [2244, 3353, 2463, 3028, 3211, 2642, 3453, 2721, 3625, 2924, 2835, 2945],
    2019: [0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 2],
    2021: [2164, 2062, 2271, 2052, 2559, 1839, 1861, 2270, 2324, 2225, 1837, 2268],
    2023: [2702, 1943, 3077, 3017, 2111, 2696, 2730, 1836, 2419, 3074, 2878, 1898],
    2024: [2416, 3211, 2594, 3252, 2436, 2831, 2003, 3049, 2876, 2347, 3117, 2298],
}
# Year, total, three-row moving average.
SERIES = [
    (2001, 1, 1.0), (2013, 8, 4.5), (2014, 22049, 7352.666666666667), (2015, 2, 7353.0),
    (2016, 38763, 20271.333333333332), (2017, 33805, 24190.0), (2018, 35444, 36004.0),
    (2019, 2, 23083.666666666668), (2021, 25732, 20392.666666666668), (2023, 30381, 18705.0),
    (2024, 32430, 29514.333333333332),
]
# Month, total, name, season, percent.
SEASONALITY = [
    (1, 16456, "Janeiro", "Verão", 7.53), (2, 16366, "Fevereiro", "Verão", 7.49),
    (3, 19573, "Março", "Outono", 8.95), (4, 19455, "Abril", "Outono", 8.9),
    (5, 19261, "Maio", "Outono", 8.81), (6, 18507, "Junho", "Inverno", 8.47),
    (7, 18715, "Julho", "Inverno", 8.56), (8, 17049, "Agosto", "Inverno", 7.8),
    (9, 18050, "Setembro", "Primavera", 8.26), (10, 18071, "Outubro", "Primavera", 8.27),
    (11, 19334, "Novembro", "Primavera", 8.84), (12, 17780, "Dezembro", "Verão", 8.13),
]


@pytest.fixture(scope="module")
def monthly(spark):
    rows = [(y, m, n) for y, ns in MONTHLY.items() for m, n in enumerate(ns, start=1) if n]
    assert len(rows) == 93
    return spark.createDataFrame(rows, f"ano int, mes int, {TOTAL} bigint")


def test_time_series(monthly):
    assert [tuple(r) for r in datasets.time_series(monthly, weight=TOTAL).collect()] == SERIES


def test_seasonality(monthly):
    got = datasets.seasonality(monthly, weight=TOTAL).select(
        "mes", TOTAL, "nome_mes", "estacao", "percentual"
    )
    assert [tuple(r) for r in got.collect()] == SEASONALITY
    assert round(sum(r[4] for r in SEASONALITY), 2) == 100.01


def test_by_season_is_sum_of_months(monthly):
    from stormledger.functions import dates

    rows = agg.by_season(monthly.withColumn("estacao", dates.season(F.col("mes"))), TOTAL)
    assert [tuple(r) for r in rows.collect()] == [
        ("verao", 50602), ("outono", 58289), ("inverno", 54271), ("primavera", 55455),
    ]


def test_rain_correlation(monthly):
    rows = datasets.rain_correlation(monthly, weight=TOTAL)
    got = [tuple(r) for r in rows.collect()]
    assert len(got) == 93
    assert got[0] == (2001, 10, 1, 120, "Chuvosa")
    assert got[6] == (2014, 1, 1245, 100, "Seca")
    assert sum(r[2] for r in got) == 218617
    coefficient = joins.correlation(rows, "chuva_mm", TOTAL).first()
    assert round(coefficient["coeficiente"], 4) == 0.0492
    assert not coefficient["acima_do_limite"]


def test_kpis(spark, monthly):
    # 213 areas; undated rows count in the total only.
    area = F.concat(F.lit("b"), (F.monotonically_increasing_id() % 213).cast("string"))
    dated = monthly.withColumn("bairro", area)
    undated = spark.createDataFrame(
        [(None, None, 667647 - 120, "b0"), *[(None, None, 1, f"b{i}") for i in range(93, 213)]],
        f"ano int, mes int, {TOTAL} bigint, bairro string",
    )
    rows = spark.createDataFrame(
        [(*r[:3], f"b{i}") for i, r in enumerate(monthly.collect())], undated.schema
    ).unionByName(undated)
    assert dated.count() == 93
    got = datasets.kpis(rows, weight=TOTAL).first()
    assert tuple(got) == (886264, 11, 213, 1656.19, 2016, 3)


def test_rollup_reproduces_years(monthly):
    rolled = agg.rollup_year_month(monthly, weight=TOTAL)
    years = rolled.where("nivel = 1").orderBy("ano").select("ano", TOTAL)
    assert [tuple(r) for r in years.collect()] == [s[:2] for s in SERIES]
    assert rolled.where("nivel = 0").first()[TOTAL] == 218617


def test_moving_average_counts_rows_not_years(monthly):
    rows = series.moving_average(agg.by_year(monthly, TOTAL), "ano").collect()
    assert rows[8]["ano"] == 2021 and rows[8]["media_movel_3anos"] == (35444 + 2 + 25732) / 3


def test_year_over_year_leaves_gaps_open(monthly):
    rows = {r["ano"]: r for r in series.year_over_year(agg.by_year(monthly, TOTAL)).collect()}
    assert rows[2017]["anterior"] == 38763 and rows[2017]["comparavel"]
    assert rows[2021]["anterior"] is None and not rows[2021]["comparavel"]


@pytest.mark.parametrize("make", [
    datasets.time_series, datasets.area_ranking, datasets.seasonality, datasets.rain_correlation,
    datasets.kpis, datasets.general_stats, datasets.all_aggregates,
])
def test_base_aggregate_serves_all_datasets(spark, make):
    from conftest import SMALL

    from stormledger import bindings

    rows = bindings.incidents(spark, SMALL)
    base = datasets.base_aggregate(rows)
    want = sorted(map(repr, make(rows).collect()))
    assert sorted(map(repr, make(base, weight=TOTAL).collect())) == want


def test_area_ranking_published_head(spark):
    # Largest areas and the sum of the others.
    head = [("Cohab", 155684, 17.57), ("Nova Descoberta", 91999, 10.38), ("Dois Unidos", 77326, 8.72),
            ("Varzea", 50461, 5.69), ("Jordao", 42240, 4.77)]
    rest = 886264 - sum(n for _, n, _ in head)
    parts = [(f"outro {i:03}", rest // 208 + (i < rest % 208)) for i in range(208)]
    rows = spark.createDataFrame([(a, n) for a, n, _ in head] + parts, f"bairro string, {TOTAL} bigint")
    got = datasets.area_ranking(rows, weight=TOTAL).collect()
    assert [(r["bairro"], r[TOTAL], r["percentual"]) for r in got[:5]] == head
    assert [r["ranking"] for r in got] == list(range(1, 214))
