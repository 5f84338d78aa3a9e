"""Row numbers and top-k per group that never sort an unbounded group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stormledger.session import materialize


def with_global_rank(df: DataFrame, total: str, key: str, out: str) -> DataFrame:
    """1..n over the whole frame by ``total`` descending, then ``key`` ascending.

    ``df`` holds one row per key. The rows are dealt into sorted ranges and
    stored with the number of their range. Each row's place inside its range is
    shifted by the rows of all earlier ranges; equal totals split by key, so a
    range is bounded whatever the totals. Only one row per range passes through
    one task.
    """
    order = [F.desc(total), F.asc(key)]
    ranged = materialize(
        df.repartitionByRange(*order).withColumn("_faixa", F.spark_partition_id()), "faixas"
    )
    sizes = ranged.groupBy("_faixa").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_faixa").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_faixa", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_antes"))
    inside = F.row_number().over(Window.partitionBy("_faixa").orderBy(*order))
    return (
        ranged.withColumn("_lugar", inside)
        .join(offsets, "_faixa")
        .withColumn(out, (F.col("_lugar") + F.col("_antes")).cast("int"))
        .drop("_faixa", "_lugar", "_antes")
    )


def top_per_group(
    df: DataFrame, keys: list[str], order: list[Column], k: int, out: str
) -> DataFrame:
    """The first k rows of each group in the given order, numbered.

    The filter sits directly on ``row_number`` so that Spark limits each group
    to k rows per input partition before the shuffle (WindowGroupLimit): a
    group with a third of all rows sends at most k rows per task.
    """
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(out, number).where(F.col(out) <= k)


def latest_per_key(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The newest row of each key; ``order`` must end in a unique column."""
    return top_per_group(df, keys, list(order), 1, "_r").drop("_r")
