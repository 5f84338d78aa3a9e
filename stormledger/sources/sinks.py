"""Sinks. Parquet partitioned by year is the primary format; CSV and JSON are exports."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession, functions as F

from stormledger.session import materialize

_PLACE = "_lugar"


def _csv(df: DataFrame, sep: str = ",") -> DataFrameWriter:
    """A header CSV writer that doubles quotes inside quotes, as most readers expect."""
    return (
        df.write.mode("overwrite").option("header", True).option("sep", sep)
        .option("quote", '"').option("escape", '"')
    )


def _one_part(df: DataFrame) -> DataFrame:
    """All rows in one partition, in their order; the work before it stays parallel."""
    placed = df if _PLACE in df.columns else df.withColumn(_PLACE, F.monotonically_increasing_id())
    return placed.repartition(1).sortWithinPartitions(_PLACE).drop(_PLACE)


def write_parquet_by_year(
    df: DataFrame, path: str, year: str = "ano", rebalance: bool = True, keep_other_years: bool = True
) -> str:
    """Parquet partitioned by year, so that year filters read only their folders.

    Each year of the frame replaces that year in the folder; years without a row in
    the frame stay, unless ``keep_other_years`` is off. Rows without a year are a
    year of their own. Nothing changes before all rows are written.

    Rows of a year come together in well-sized files; adaptive execution splits
    a year with most of the rows over many tasks. Without ``rebalance`` rows
    stay in the tasks that hold them, which suits input that is already one
    file per year.
    """
    if rebalance:
        df = df.hint("rebalance", year)
    mode = "dynamic" if keep_other_years else "static"
    df.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(year).parquet(path)
    return path


def reload_years(df: DataFrame, path: str, years: list[int], year: str = "ano", rebalance: bool = True) -> dict[int, int]:
    """Replace the named years by the frame's rows, all others stay; returns the rows written of each.

    A named year that has no row any more becomes empty. A row of another year, or
    of none, is an error that leaves the folder as it was.
    """
    named = F.col(year)
    strange = F.raise_error(F.concat(F.lit(f"a row of none of the years {sorted(years)}: "), F.coalesce(named.cast("string"), F.lit("null"))))
    checked = df.withColumn(year, F.when(named.isin(years), named).otherwise(strange.cast(df.schema[year].dataType)))
    # counted by the tasks that write, so that a repeated task counts once
    seen = Observation("years")
    placed = checked.hint("rebalance", year) if rebalance else checked
    counted = placed.observe(seen, *[F.count_if(named == y).alias(str(y)) for y in years])
    write_parquet_by_year(counted, path, year, rebalance=False)
    rows = {y: seen.get[str(y)] for y in years}
    for y in (y for y, n in rows.items() if not n):
        df.limit(0).drop(year).write.mode("overwrite").parquet(f"{path}/{year}={y}")
    return rows


def read_by_year(spark: SparkSession, path: str, years: list[int] | None = None, year: str = "ano") -> DataFrame:
    """The folder as one table, or some of its years; columns that only some years have are null in the others."""
    rows = spark.read.option("mergeSchema", True).parquet(path)
    return rows if years is None else rows.where(F.col(year).isin(years))


def write_csv_table(df: DataFrame, path: str, compression: str = "gzip") -> str:
    """CSV part files under the given codec ("none" for plain text)."""
    _csv(df).option("compression", compression).csv(path)
    return path


def write_csv_export(df: DataFrame, path: str, sep: str = ",", single_file: bool = True) -> str:
    """Header CSV for a dashboard: one part file in the frame's order, or as it comes."""
    _csv(_one_part(df) if single_file else df, sep).csv(path)
    return path


def write_many(
    frames: dict[str, DataFrame], folder: str, sep: str = ",", parallel: int = 4,
    single_file: bool = True,
) -> list[str]:
    """Write each non-empty aggregate to its own folder; returns the names written.

    Each frame is computed once, into a table that tells whether it is empty.
    The writes are independent jobs, so a few of them run side by side.
    """
    def write(item: tuple[str, DataFrame]) -> str | None:
        name, df = item
        stored = materialize(df.withColumn(_PLACE, F.monotonically_increasing_id()), name)
        if stored.isEmpty():
            return None
        _csv(_one_part(stored) if single_file else stored.drop(_PLACE), sep).csv(f"{folder}/{name}")
        return name

    with ThreadPoolExecutor(parallel) as pool:
        return [name for name in pool.map(write, frames.items()) if name]


def write_json(df: DataFrame, path: str) -> str:
    """One JSON object per row."""
    df.write.mode("overwrite").json(path)
    return path
