"""Column profiles that merge: sketches of each file, stored, and united without the rows.

A row of sketches stands for one column of one part (a file, a load, a year): rows,
nulls, smallest and largest number, a HyperLogLog sketch of the values and, for
numbers, a KLL sketch. United sketches are those of the united rows, up to the
stated errors: ``DISTINCT_ERROR`` of the distinct values, four standard deviations of
a sketch of 2 ** ``LOG_K`` registers, and ``RANK_ERROR`` of the ranks of quantiles.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from stormledger import schema
from stormledger.functions.values import present
from stormledger.operators.quantiles import _finite

LOG_K = 12
DISTINCT_ERROR = 4 * 1.04 / math.sqrt(1 << LOG_K)
QUANTILE_K = 800
RANK_ERROR = 0.01


def sketch_columns(df: DataFrame, columns: list[str] | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """One row of sketches per column and ``keys``, such as the source file, in one pass.

    A file with a third of all rows is one small row per task before the shuffle.
    NaN is no value; infinite numbers are values without a place among the quantiles.
    """
    columns = [c for c in (columns or df.columns) if c not in keys]
    numeric = set(schema.numeric_columns(df))
    cells = df.select(*keys, F.inline(F.array(*[
        F.struct(
            F.lit(c).alias("coluna"), F.when(present(df, c), F.col(c).cast("string")).alias("_valor"),
            (_finite(c) if c in numeric else F.lit(None).cast("double")).alias("_numero"),
        )
        for c in columns
    ])))
    return cells.groupBy(*keys, "coluna").agg(
        F.count(F.lit(1)).alias("linhas"), F.count_if(F.col("_valor").isNull()).alias("nulos"),
        F.count("_numero").alias("numeros"), F.min("_numero").alias("menor"), F.max("_numero").alias("maior"),
        F.hll_sketch_agg("_valor", F.lit(LOG_K)).alias("distintos"),
        F.kll_sketch_agg_double("_numero", F.lit(QUANTILE_K)).alias("quantis"),
    )


def merge_sketches(sketches: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Sketches of fewer parts: all rows of the same column and ``keys`` become one."""
    return sketches.groupBy(*keys, "coluna").agg(
        F.sum("linhas").alias("linhas"), F.sum("nulos").alias("nulos"), F.sum("numeros").alias("numeros"),
        F.min("menor").alias("menor"), F.max("maior").alias("maior"),
        F.hll_union_agg("distintos").alias("distintos"), F.kll_merge_agg_double("quantis").alias("quantis"),
    )


def profile_sketches(sketches: DataFrame, probs: tuple[float, ...] = (0.25, 0.5, 0.75), limit_pct: float = 50) -> DataFrame:
    """The figures of sketches: nulls, distinct values, quantiles (null without numbers) and whether too much is null."""
    pct = F.lit(100.0) * F.try_divide(F.col("nulos"), F.col("linhas"))
    known = F.col("linhas") > F.col("nulos")
    return sketches.select(
        *[c for c in sketches.columns if c not in ("distintos", "quantis", "numeros")],
        F.round(pct, 2).alias("pct_nulos"), (pct > limit_pct).alias("muitos_nulos"),
        F.when(known, F.hll_sketch_estimate("distintos")).otherwise(F.lit(0)).alias("valores_unicos"),
        F.when(F.col("numeros") > 0, F.array(*[_quantile(p) for p in probs])).alias("quantis"),
    )


def _quantile(p: float) -> Column:
    return F.kll_sketch_get_quantile_double("quantis", F.lit(float(p)))


def sketched_fences(sketches: DataFrame, factor: float = 1.5) -> DataFrame:
    """Sketches with the lowest and highest number that is no outlier; no row is read for it."""
    q1, q3 = (F.when(F.col("numeros") > 0, _quantile(p)) for p in (0.25, 0.75))
    return sketches.withColumns({"limite_inferior": q1 - factor * (q3 - q1), "limite_superior": q3 + factor * (q3 - q1)})
