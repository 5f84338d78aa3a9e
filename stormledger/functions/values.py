"""What counts as a value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def present(df: DataFrame, column: str) -> Column:
    """True where a column of a frame holds a value: neither null nor, for numbers, NaN."""
    kind = df.schema[column].dataType.simpleString()
    c = F.col(column)
    return c.isNotNull() & ~F.isnan(c) if kind in ("double", "float") else c.isNotNull()


def missing(df: DataFrame, column: str) -> Column:
    """True where a column holds no value."""
    return ~present(df, column)


def known(c: Column) -> Column:
    """The same for a column whose type is not known here: NaN is text "NaN" in every type."""
    return c.isNotNull() & (c.cast("string") != "NaN")
