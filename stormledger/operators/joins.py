"""Rain enrichment, catalogue membership and cross-source comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from stormledger import vocab
from stormledger.functions.dates import wall_seconds
from stormledger.operators.aggregates import TOTAL
from stormledger.operators.series import with_silent_days


def month_rain_dimension(df: DataFrame) -> DataFrame:
    rows = list(enumerate(vocab.MONTH_RAIN_MM, start=1))
    return df.sparkSession.createDataFrame(rows, "mes int, chuva_mm int")


def join_month_rain(df: DataFrame, rain: DataFrame | None = None) -> DataFrame:
    """Add the rain of the month; the default dimension has twelve rows."""
    dim = month_rain_dimension(df) if rain is None else rain
    return df.join(F.broadcast(dim) if rain is None else dim, "mes", "left")


def daily_rain_and_incidents(
    rain: DataFrame, rain_date: str, rain_mm: str, incidents: DataFrame, date: str, calendar: bool = False
) -> DataFrame:
    """One row per day on either side: rain null where unmeasured, incidents 0 where none.

    Both sides shrink to one row per day before they meet. ``calendar`` also gives
    the days between the first and the last one that neither side has.
    """
    mm = (
        rain.where(F.col(rain_date).isNotNull())
        .groupBy(F.to_date(rain_date).alias("dia"))
        .agg(F.round(F.sum(rain_mm), 2).alias("chuva_mm"))
    )
    per_day = (
        incidents.where(F.col(date).isNotNull())
        .groupBy(F.to_date(date).alias("dia"))
        .agg(F.count(F.lit(1)).alias(TOTAL))
    )
    days = mm.join(per_day, "dia", "full").withColumn(TOTAL, F.coalesce(TOTAL, F.lit(0)))
    return with_silent_days(days, "dia").select(*days.columns) if calendar else days


def correlation(df: DataFrame, x: str, y: str, *keys: str, threshold: float = 0.5) -> DataFrame:
    """Pearson coefficient, overall or per key, and whether it exceeds the threshold."""
    return (
        df.groupBy(*keys)
        .agg(F.corr(x, y).alias("_c"), F.count(F.when(F.col(x).isNotNull(), F.col(y))).alias("n"))
        .withColumn("coeficiente", F.round("_c", 6))
        .withColumn("acima_do_limite", F.col("_c") > threshold)
        .drop("_c")
    )


def tag_listed(df: DataFrame, key: str, known: list, out: str, unknown: str) -> DataFrame:
    """As ``tag_members`` for a short literal catalogue: a membership test, no join."""
    c = F.col(key)
    return df.withColumn(out, F.when(c.isin(known), c.cast("string")).otherwise(F.lit(unknown)))


def tag_members(
    df: DataFrame, key: str, catalog: DataFrame, catalog_key: str, out: str, unknown: str
) -> DataFrame:
    """``out`` = the key where the catalogue knows it, else the ``unknown`` label.

    The join strategy is left to Spark: a catalogue may be large.
    """
    known = catalog.select(F.col(catalog_key).alias("_k")).where(F.col("_k").isNotNull()).distinct()
    return (
        df.join(known, F.col(key) == F.col("_k"), "left")
        .withColumn(out, F.coalesce(F.col("_k").cast("string"), F.lit(unknown)))
        .drop("_k")
    )


def unknown_keys(df: DataFrame, key: str, catalog: DataFrame, catalog_key: str) -> DataFrame:
    """Keys absent from the catalogue with their row counts.

    Counting first makes the anti join one row per key.
    """
    counted = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    known = catalog.select(F.col(catalog_key).alias(key))
    return counted.join(known, key, "left_anti")


def orphans(
    left: DataFrame, left_key: str, left_label: str,
    right: DataFrame, right_key: str, right_label: str,
) -> DataFrame:
    """Keys present on one side only, with the label of that side.

    One aggregation over both key columns (with map-side combine) instead of
    two anti joins: each side is read and shuffled once.
    """
    sides = [
        f.select(F.col(k).alias("chave"), F.lit(is_left).alias("_l")).where(F.col("chave").isNotNull())
        for f, k, is_left in ((left, left_key, True), (right, right_key, False))
    ]
    seen = reduce(DataFrame.unionAll, sides).groupBy("chave").agg(
        F.bool_or("_l").alias("_in_left"), F.bool_and("_l").alias("_only_left")
    )
    side = F.when(F.col("_only_left"), F.lit(left_label)).otherwise(F.lit(right_label))
    return seen.where(F.col("_only_left") | ~F.col("_in_left")).select("chave", side.alias("lado"))


def years_available(requested: DataFrame, available: DataFrame) -> DataFrame:
    """Requested years that are available."""
    return requested.intersect(available)


def mean_response_hours(
    requests: DataFrame, key: str, start: str, answers: DataFrame, answer_key: str, end: str,
    *period: str,
) -> DataFrame:
    """Mean hours from request to answer per period of the request.

    Answers shrink to (count, sum of end times) per request before the join, so
    a request with very many answers is one row.
    """
    answered = (
        answers.where(F.col(end).isNotNull())
        .groupBy(F.col(answer_key).alias("_k"))
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.sum(wall_seconds(F.col(end))).alias("_end"),
        )
    )
    waited = F.col("_end") - F.col("_n") * wall_seconds(F.col(start))
    return (
        requests.join(answered, F.col(key) == F.col("_k"))
        .groupBy(*period)
        .agg(
            F.round(F.sum(waited) / F.sum("_n") / 3600.0, 4).alias("horas_media"),
            F.sum("_n").alias("n"),
        )
    )
