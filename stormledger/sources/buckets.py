"""History stored in buckets by key, so that questions by key move only what is new.

All rows of a key lie in one bucket, as many files of it as there were loads. The newest row of
a key, repeated keys, and the match of a new load against the history then need no
exchange of the stored side; the load alone is dealt to the buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def store_bucketed(df: DataFrame, name: str, path: str, keys: list[str], buckets: int, mode: str = "errorifexists") -> DataFrame:
    """Write a frame as a table of buckets at a path, or add to it with mode "append".

    Choose at least as many buckets as ``spark.sql.shuffle.partitions``: with fewer
    Spark may prefer to deal both sides of a join anew. The frame is dealt to the
    buckets first, so that a load adds one file to each and not one per task.
    """
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode(mode).format("parquet").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return df.sparkSession.table(name)


def attach_bucketed(spark: SparkSession, name: str, path: str, keys: list[str], buckets: int, columns: str) -> DataFrame:
    """Name a stored table of buckets in a session whose catalogue does not know it."""
    names = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"CLUSTERED BY ({names}) SORTED BY ({names}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def latest_rows(history: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The newest row of each key: that of the largest values in the given order, which must be unique.

    An aggregate, so that a task keeps one row per key; no exchange on buckets.
    """
    others = [c for c in history.columns if c not in keys]
    newest = F.max_by(F.struct(*others), F.struct(*[c.alias(f"_{i}") for i, c in enumerate(order)]))
    return history.groupBy(*keys).agg(newest.alias("_r")).select(*keys, *[F.col("_r")[c].alias(c) for c in others])


def repeated_keys(history: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of more than one row, with how many."""
    return history.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def compare_load(new: DataFrame, history: DataFrame, keys: list[str]) -> DataFrame:
    """Each key of a load with its rows in the load and in the history: 0 there for keys that are new."""
    load = new.groupBy(*keys).agg(F.count(F.lit(1)).alias("na_carga"))
    stored = history.groupBy(*keys).agg(F.count(F.lit(1)).alias("no_historico"))
    return load.join(stored, keys, "left").withColumn("no_historico", F.coalesce("no_historico", F.lit(0)))


def history_orphans(history: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of the history that a (smaller or newer) frame lacks."""
    return history.select(*keys).distinct().join(other.select(*keys).distinct(), keys, "left_anti")
