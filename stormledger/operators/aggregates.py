"""Counting aggregates.

Every function takes incident rows or, with ``weight``, a pre-aggregated frame
whose ``weight`` column holds counts; so one base aggregate serves all of them.
Null keys are dropped unless ``keep_null`` is set.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stormledger import schema, vocab
from stormledger.functions import dates
from stormledger.operators.ranking import top_per_group, with_global_rank

TOTAL = "total_ocorrencias"
AREA = ("bairro_normalizado", "bairro")
KIND = ("tipo_ocorrencia_normalizado", "tipo_ocorrencia")


def _measure(weight: str | None) -> Column:
    return (F.count(F.lit(1)) if weight is None else F.sum(weight)).cast("bigint")


def count_by(
    df: DataFrame, *keys: str, weight: str | None = None, keep_null: bool = False
) -> DataFrame:
    """Rows per key combination as ``total_ocorrencias``."""
    if not keep_null:
        df = df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    return df.groupBy(*keys).agg(_measure(weight).alias(TOTAL))


def guarded_count(df: DataFrame, *keys: tuple[str, ...], weight: str | None = None) -> DataFrame:
    """``count_by`` on the first present spelling of each key; empty when one is missing."""
    found = [schema.find_column(df, *names) for names in keys]
    if None in found:
        fields = ", ".join(f"{names[0]} string" for names in keys)
        return schema.empty(df, f"{fields}, {TOTAL} bigint")
    return count_by(df, *found, weight=weight)


def by_year(df: DataFrame, weight: str | None = None) -> DataFrame:
    return count_by(df, "ano", weight=weight).orderBy("ano")


def by_area(df: DataFrame, column: str | None = None, weight: str | None = None) -> DataFrame:
    out = guarded_count(df, (column,) if column else AREA, weight=weight)
    return out.orderBy(F.desc(TOTAL), out.columns[0])


def by_kind(df: DataFrame, column: str | None = None, weight: str | None = None) -> DataFrame:
    out = guarded_count(df, (column,) if column else KIND, weight=weight)
    return out.orderBy(F.desc(TOTAL), out.columns[0])


def by_month(df: DataFrame, weight: str | None = None) -> DataFrame:
    return (
        count_by(df, "mes", weight=weight)
        .withColumn("nome_mes", dates.month_name(F.col("mes")))
        .orderBy("mes")
    )


def by_season(df: DataFrame, weight: str | None = None) -> DataFrame:
    order = F.array_position(F.array(*[F.lit(s) for s in vocab.SEASONS]), F.col("estacao"))
    return count_by(df, "estacao", weight=weight).orderBy(order)


def by_weekday(df: DataFrame, weight: str | None = None) -> DataFrame:
    names = F.array(*[F.lit(d) for d in vocab.WEEKDAYS_EN])
    position = F.array_position(names, F.col("dia_semana_nome")).cast("int") - 1
    return (
        count_by(df, "dia_semana_nome", weight=weight)
        .orderBy(position)
        .withColumn("dia_semana", dates.weekday_name_pt(position))
    )


def by_hour(df: DataFrame, weight: str | None = None) -> DataFrame:
    return count_by(df, "hora", weight=weight).orderBy("hora")


def by_area_year(df: DataFrame, column: str | None = None, weight: str | None = None):
    out = guarded_count(df, (column,) if column else AREA, ("ano",), weight=weight)
    return out.orderBy(*out.columns[:2])


def by_kind_year(df: DataFrame, column: str | None = None, weight: str | None = None):
    out = guarded_count(df, (column,) if column else KIND, ("ano",), weight=weight)
    return out.orderBy(*out.columns[:2])


def by_area_year_ranked(df: DataFrame, column: str | None = None, weight: str | None = None):
    out = guarded_count(df, (column,) if column else AREA, ("ano",), weight=weight)
    return out.orderBy(F.desc(TOTAL), *out.columns[:2])


def by_kind_month(df: DataFrame, column: str | None = None, weight: str | None = None):
    out = guarded_count(df, (column,) if column else KIND, ("mes",), weight=weight)
    return out.orderBy(F.desc(TOTAL), *out.columns[:2])


def by_month_year(df: DataFrame, weight: str | None = None) -> DataFrame:
    return count_by(df, "mes", "ano", weight=weight).orderBy("ano", "mes")


def area_stats(df: DataFrame, column: str = "bairro", weight: str | None = None) -> DataFrame:
    """Total, dated total, distinct years, last and first year per area.

    The first aggregation is per (area, year), so the distinct count is a plain
    count of its rows and a very frequent area is already small when it is
    shuffled by area alone.
    """
    per_year = df.where(F.col(column).isNotNull()).groupBy(column, "ano").agg(
        _measure(weight).alias("n")
    )
    return (
        per_year.groupBy(column)
        .agg(
            F.sum("n").alias(TOTAL),
            F.coalesce(F.sum(F.when(F.col("ano").isNotNull(), F.col("n"))), F.lit(0)).alias(
                "total_com_data"
            ),
            F.count("ano").alias("anos_afetados"),
            F.max("ano").alias("ultimo_ano"),
            F.min("ano").alias("primeiro_ano"),
        )
        .orderBy(F.desc(TOTAL), column)
    )


def with_share(df: DataFrame, total: str = TOTAL, out: str = "percentual") -> DataFrame:
    """Percent of the grand total, two decimals.

    The total is an uncorrelated scalar subquery over the same aggregate: Spark
    reuses its shuffle, and the rows themselves never meet in one task.
    """
    grand = df.select(F.sum(total).alias("_s")).scalar()
    return df.withColumn(out, F.round(F.lit(100.0) * F.col(total) / grand, 2))


def with_ranking(df: DataFrame, key: str, total: str = TOTAL) -> DataFrame:
    """``ranking`` 1..n by total descending, key ascending."""
    return with_global_rank(df, total, key, "ranking")


def top_k(df: DataFrame, column: str, k: int, weight: str | None = None) -> DataFrame:
    """The k most frequent non-null values; ties by value."""
    return count_by(df, column, weight=weight).orderBy(F.desc(TOTAL), column).limit(k)


def argmax_group(df: DataFrame, key: str, weight: str | None = None) -> DataFrame:
    """Most frequent key, smallest on ties."""
    return top_k(df, key, 1, weight)


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def rollup_year_month(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Totals per (year, month), per year and overall, marked by ``nivel`` (2, 1, 0)."""
    monthly = count_by(df, "ano", "mes", weight=weight)
    return monthly.rollup("ano", "mes").agg(
        F.sum(TOTAL).alias(TOTAL),
        (F.lit(2) - F.grouping("ano") - F.grouping("mes")).cast("int").alias("nivel"),
    )


def reconcile_total(df: DataFrame, key: str) -> DataFrame:
    """Does the sum over the groups of ``key`` (null group included) equal the row count?"""
    grouped = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    rows = df.select(F.count(F.lit(1)).alias("_n")).scalar()
    return grouped.agg(F.sum("n").alias("soma_grupos"), F.count(F.lit(1)).alias("grupos")).select(
        "soma_grupos", "grupos", rows.alias("total"),
        (F.col("soma_grupos") == rows).alias("confere"),
    )


def hour_weekday_matrix(df: DataFrame) -> DataFrame:
    """One row per weekday, one count column per hour."""
    per_hour = count_by(df, "dia_semana", "hora")
    sums = [
        F.coalesce(F.sum(F.when(F.col("hora") == h, F.col(TOTAL))), F.lit(0)).alias(f"h{h:02d}")
        for h in range(24)
    ]
    return per_hour.groupBy("dia_semana").agg(*sums).orderBy("dia_semana")


def hotspots(df: DataFrame, area: str, kind: str, k: int) -> DataFrame:
    """The k most frequent kinds of each area."""
    return top_per_group(count_by(df, area, kind), [area], [F.desc(TOTAL), F.col(kind)], k, "posicao")


def risk_share(df: DataFrame, is_risk: Column, *keys: str) -> DataFrame:
    """Percent of rows in risk areas, overall or per key, with a 0..100 check."""
    out = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(is_risk).alias("em_risco")
    )
    pct = F.lit(100.0) * F.col("em_risco") / F.col("total")
    return out.withColumns({"percentual": F.round(pct, 2), "valido": pct.between(0, 100)})


def sum_by(df: DataFrame, value: str, *keys: str, out: str, positive_only: bool = False):
    """Sum of a measure per key; optionally only groups with a positive sum, however small."""
    summed = df.groupBy(*keys).agg(F.sum(value).alias(out))
    kept = summed.where(F.col(out) > 0) if positive_only else summed
    return kept.withColumn(out, F.round(out, 2))


def positive_check(df: DataFrame, value: str, *keys: str, out: str) -> DataFrame:
    """Sum of a measure per key and whether it is positive: a silent station fails."""
    summed = df.groupBy(*keys).agg(F.sum(value).alias(out))
    return summed.withColumns({"valido": F.coalesce(F.col(out) > 0, F.lit(False)), out: F.round(out, 2)})
