"""Window calculations over aggregated series.

A window without partition columns runs in one task, so those here take one
row per year, month or day: the row count is bounded by the calendar, not by
the data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from stormledger.operators.aggregates import TOTAL, count_by

# Longest calendar that is laid out for a key; a date far off is an error, not a flood of days.
MAX_DAYS = 36_600


def moving_average(
    df: DataFrame, order: str, value: str = TOTAL, rows: int = 3, out: str = "media_movel_3anos"
) -> DataFrame:
    """Mean of the current and the ``rows - 1`` preceding rows (rows, not calendar steps)."""
    w = Window.orderBy(order).rowsBetween(1 - rows, 0)
    return df.withColumn(out, F.avg(value).over(w))


def _change(value: Column, base: Column) -> Column:
    """Percent, exact: limits are judged on it, and only what is shown is rounded."""
    return F.lit(100.0) * F.try_divide(value - base, base)


def month_on_month(
    df: DataFrame, value: str = TOTAL, limit_pct: float = 30, keys: tuple[str, ...] = ()
) -> DataFrame:
    """Change against the previous calendar month and whether it is within the limit.

    Null where the month before has no row.
    """
    index = F.col("ano") * 12 + F.col("mes")
    w = Window.partitionBy(*keys).orderBy("ano", "mes")
    adjacent = index - F.lag(index).over(w) == 1
    return (
        df.withColumn("anterior", F.when(adjacent, F.lag(value).over(w)))
        .withColumn("variacao_pct", _change(F.col(value), F.col("anterior")))
        .withColumn("dentro_do_limite", F.abs("variacao_pct") <= limit_pct)
        .withColumn("variacao_pct", F.round("variacao_pct", 2))
    )


def deviation_from_history(
    df: DataFrame, key: str, order: list[str], value: str = TOTAL, limit_pct: float = 20
) -> DataFrame:
    """Deviation from the mean of all earlier periods of the same key."""
    past = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.withColumn("media_historica", F.round(F.avg(value).over(past), 4))
        .withColumn("desvio_pct", _change(F.col(value), F.avg(value).over(past)))
        .withColumn("dentro_do_limite", F.abs("desvio_pct") <= limit_pct)
        .withColumn("desvio_pct", F.round("desvio_pct", 2))
    )


def gaps(df: DataFrame, date: str, keys: tuple[str, ...] = (), max_days: int = 2) -> DataFrame:
    """Consecutive active days further apart than ``max_days``, per key or overall."""
    day = F.to_date(date).alias("dia_atividade")
    days = df.where(F.col(date).isNotNull()).select(*keys, day).distinct()
    w = Window.partitionBy(*keys).orderBy("dia_atividade")
    return (
        days.withColumn("dia_anterior", F.lag("dia_atividade").over(w))
        .withColumn("dias", F.datediff("dia_atividade", "dia_anterior"))
        .where(F.col("dias") > max_days)
    )


def volume_check(
    df: DataFrame, date: str, keys: tuple[str, ...] = (), min_ratio: float = 0.8, usual_days: int = 7
) -> DataFrame:
    """Rows per active day against the mean of the preceding active days."""
    daily = count_by(df.withColumn("dia", F.to_date(date)), *keys, "dia")
    w = Window.partitionBy(*keys).orderBy("dia").rowsBetween(-usual_days, -1)
    usual = F.avg(TOTAL).over(w)
    return daily.withColumns({
        "volume_usual": F.round(usual, 4),
        "volume_baixo": F.col(TOTAL) < min_ratio * usual,
    })


def _last_day(daily: DataFrame, day: str, end: dt.date | None) -> Column:
    """The given end, else the last day of all keys."""
    return F.lit(end).cast("date") if end is not None else daily.select(F.max(day)).scalar()


def with_silent_days(
    daily: DataFrame, day: str, value: str = TOTAL, keys: tuple[str, ...] = (),
    start: dt.date | None = None, end: dt.date | None = None, max_days: int = MAX_DAYS,
) -> DataFrame:
    """One row per key and calendar day, ``value`` 0 and other columns null where a day has none.

    ``daily`` holds one row per key and day. A key's days run from its first one,
    or from ``start``, to the last day of all keys, or to ``end``: a key that stops early
    goes on. Days outside have no row. More than ``max_days`` of a key are an error.
    """
    first = F.lit(start).cast("date") if start is not None else F.min(day)
    spans = daily.groupBy(*keys).agg(first.alias("_de")).withColumn("_ate", _last_day(daily, day, end))
    far = F.raise_error(F.format_string(f"more than {max_days} days from %s to %s", F.col("_de").cast("string"), F.col("_ate").cast("string")))
    days = F.when(F.datediff("_ate", "_de") < max_days, F.sequence("_de", "_ate")).otherwise(far.cast("array<date>"))
    spine = spans.where(F.col("_de") <= F.col("_ate")).select(*keys, F.explode(days).alias(day))
    return spine.join(daily, [*keys, day], "left").withColumn(value, F.coalesce(value, F.lit(0)))


def volume_check_calendar(
    df: DataFrame, date: str, keys: tuple[str, ...] = (), min_ratio: float = 0.8, usual_days: int = 7,
    start: dt.date | None = None, end: dt.date | None = None,
) -> DataFrame:
    """Rows of every calendar day against the mean of the last active days before it.

    Unlike ``volume_check`` it also judges days without any row. Silent days do not
    lower what is usual, so a key that stops fails on each day up to the end.
    """
    daily = count_by(df.withColumn("dia", F.to_date(date)), *keys, "dia")
    recent = Window.partitionBy(*keys).orderBy("dia").rowsBetween(1 - usual_days, 0)
    known = daily.withColumn("_usual", F.avg(TOTAL).over(recent))
    before = Window.partitionBy(*keys).orderBy("dia").rowsBetween(Window.unboundedPreceding, -1)
    usual = F.last("_usual", ignorenulls=True).over(before)
    return with_silent_days(known, "dia", TOTAL, keys, start, end).select(
        *keys, "dia", TOTAL, F.round(usual, 4).alias("volume_usual"),
        (F.col(TOTAL) < min_ratio * usual).alias("volume_baixo"), (F.col(TOTAL) == 0).alias("sem_registro"),
    )


def open_gaps(
    df: DataFrame, date: str, keys: tuple[str, ...] = (), max_days: int = 2, end: dt.date | None = None
) -> DataFrame:
    """Keys silent for more than ``max_days`` up to the last day of all keys, or ``end``; ``gaps`` sees none of these."""
    daily = df.where(F.col(date).isNotNull()).select(*keys, F.to_date(date).alias("_dia"))
    last = daily.groupBy(*keys).agg(F.max("_dia").alias("dia_anterior"))
    until = last.withColumn("ate", _last_day(daily, "_dia", end))
    return until.withColumn("dias", F.datediff("ate", "dia_anterior")).where(F.col("dias") > max_days)


def year_over_year(df: DataFrame, value: str = TOTAL) -> DataFrame:
    """Each year next to the calendar year before; null and not comparable on gaps."""
    w = Window.orderBy("ano")
    adjacent = F.col("ano") - F.lag("ano").over(w) == 1
    return (
        df.select("ano", value)
        .withColumn("anterior", F.when(adjacent, F.lag(value).over(w)))
        .withColumn("variacao_pct", F.round(_change(F.col(value), F.col("anterior")), 2))
        .withColumn("comparavel", F.col("anterior").isNotNull())
    )
