"""Figures that are kept, not counted anew: the base aggregate by year, and sketches by year.

Both hold one set of rows per year. A load or correction computes the years it
changes and replaces them; every dashboard is a sum over the stored counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stormledger.operators import sketches
from stormledger.plans import datasets
from stormledger.sources import sinks


def refresh_base(rows: DataFrame, path: str, years: list[int], year: str = "ano") -> dict[int, int]:
    """Count the given years of the rows and replace them in the stored base aggregate.

    ``rows`` may hold all years: only the given ones are read where it is partitioned
    by year. A year without rows any more leaves the aggregate. Returns the stored rows of each.
    """
    changed = datasets.base_aggregate(rows.where(F.col(year).isin(years)))
    # counts are few: as the aggregation leaves them
    return sinks.reload_years(changed, path, years, year, rebalance=False)


def stored_base(spark: SparkSession, path: str, years: list[int] | None = None) -> DataFrame:
    """The base aggregate, for any dataset with ``weight=datasets.TOTAL``."""
    return sinks.read_by_year(spark, path, years)


def refresh_sketches(
    rows: DataFrame, path: str, years: list[int], columns: list[str] | None = None, keys: tuple[str, ...] = (), year: str = "ano"
) -> dict[int, int]:
    """Sketch the columns of the given years, per ``keys`` such as the source file, and replace them."""
    part = rows.where(F.col(year).isin(years))
    found = sketches.sketch_columns(part, [c for c in (columns or rows.columns) if c != year], (year, *keys))
    return sinks.reload_years(found, path, years, year, rebalance=False)


def merged_profile(spark: SparkSession, path: str, keys: tuple[str, ...] = (), years: list[int] | None = None) -> DataFrame:
    """The profile of all stored parts, or one per ``keys``, without the rows."""
    return sketches.profile_sketches(sketches.merge_sketches(sinks.read_by_year(spark, path, years), keys))
