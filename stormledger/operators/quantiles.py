"""Quartiles and outliers of numeric columns.

``percentile`` keeps one counter per distinct value in a single task, which
does not hold for large columns. ``exact_quantiles`` instead narrows the value
range that holds each wanted rank, by one histogram per round, until the range
is a single value. A round is one scan with a bounded, map-side combined
aggregate; the driver keeps one range per wanted rank. Like Spark's
``approxQuantile``, both functions run jobs and return plain numbers.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from stormledger.session import materialize

BUCKETS = 8192

Quantiles = dict[str, list[float | None]]


@dataclass(frozen=True)
class _Range:
    """Values lo..hi of a column, with the number of smaller values."""

    column: str
    lo: float
    hi: float
    below: int

    def holds(self, v: Column) -> Column:
        return v.between(self.lo, self.hi)

    def bucket(self, v: Column) -> Column:
        """Bucket 0..BUCKETS-1 of a value of the range; grows with the value."""
        # Halves keep the width finite for ranges wider than the largest double.
        half = 0.5 if math.isinf(self.hi - self.lo) else 1.0
        width = F.lit(self.hi * half - self.lo * half)
        step = F.floor((v * half - F.lit(self.lo * half)) / width * BUCKETS)
        return F.least(step, F.lit(BUCKETS - 1)).cast("int")


def _number(column: str) -> Column:
    """A column as double; NaN counts as missing."""
    v = F.col(column).cast("double")
    return F.when(~F.isnan(v), v)


def _finite(column: str) -> Column:
    """The numbers that have a place on a scale; infinite ones are outside any fence."""
    v = _number(column)
    return F.when(F.abs(v) < F.lit(math.inf), v)


def _extent(df: DataFrame, columns: list[str]) -> dict[str, tuple[int, float, float]]:
    """(count, min, max) per column in one pass."""
    measures = [
        F.struct(F.count(_finite(c)), F.min(_finite(c)), F.max(_finite(c))).alias(f"_{i}")
        for i, c in enumerate(columns)
    ]
    row = df.agg(*measures).first()
    return {c: tuple(row[i]) for i, c in enumerate(columns)}


def _narrow(df: DataFrame, ranges: list[_Range], ranks: dict[_Range, set[int]]):
    """One scan: for each range and each rank in it, the smaller range that holds the rank."""
    def mark(column: str) -> Column:
        # The ranges of one column do not overlap: a value falls into one at most.
        v, i, b = _finite(column), F.lit(None).cast("int"), F.lit(None).cast("int")
        for at, r in enumerate(ranges):
            if r.column == column:
                i = F.when(r.holds(v), F.lit(at)).otherwise(i)
                b = F.when(r.holds(v), r.bucket(v)).otherwise(b)
        return F.struct(i.alias("i"), b.alias("b"), v.alias("v"))

    columns = dict.fromkeys(r.column for r in ranges)
    cells = df.select(F.inline(F.array(*map(mark, columns)))).where(F.col("i").isNotNull())
    histogram = cells.groupBy("i", "b").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")
    )
    upto = Window.partitionBy("i").orderBy("b")
    cumulative = histogram.withColumn("upto", F.sum("n").over(upto))
    wanted = F.array(*[
        F.array(*[F.lit(k - r.below).cast("bigint") for k in sorted(ranks[r])]) for r in ranges
    ])
    holds = F.exists(
        F.get(wanted, F.col("i")), lambda k: (k < F.col("upto")) & (k >= F.col("upto") - F.col("n"))
    )
    return [
        (ranges[row["i"]], row["upto"] - row["n"], row["n"], row["lo"], row["hi"])
        for row in cumulative.where(holds).collect()
    ]


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float]) -> Quantiles:
    """Quantiles of the finite values per column, interpolated between neighbouring ranks."""
    extent = _extent(df, columns)
    value: dict[tuple[str, int], float] = {}
    open_ranks: dict[_Range, set[int]] = {}

    def place(r: _Range, ranks: set[int]) -> None:
        if r.lo == r.hi:
            value.update({(r.column, k): r.lo for k in ranks})
        elif ranks:
            open_ranks[r] = ranks

    for c, (n, lo, hi) in extent.items():
        if n:
            places = [(n - 1) * p for p in probs]
            place(_Range(c, lo, hi, 0), {f(x) for x in places for f in (math.floor, math.ceil)})
    while open_ranks:
        ranges, ranks = list(open_ranks), dict(open_ranks)
        open_ranks.clear()
        for parent, before, n, lo, hi in _narrow(df, ranges, ranks):
            first = parent.below + before
            place(
                _Range(parent.column, lo, hi, first),
                {k for k in ranks[parent] if first <= k < first + n},
            )

    def interpolate(c: str, n: int, p: float) -> float | None:
        if not n:
            return None
        at = (n - 1) * p
        a, b = value[c, math.floor(at)], value[c, math.ceil(at)]
        return a + (b - a) * (at - math.floor(at))

    return {c: [interpolate(c, extent[c][0], p) for p in probs] for c in columns}


def grouped_quantiles(cells: DataFrame, keys: list[str], probs: list[float], weight: str | None = None) -> DataFrame:
    """(keys, q) of a frame (keys, v) of numbers: exact quantiles of every group at once.

    Values are counted (``weight`` holds their counts, if they are already) and dealt
    once into ranges sorted by group and value, which are stored. The counts of the
    ranges, a row each, tell which range of a group holds a wanted rank; only these
    are numbered inside. A range is bounded whatever the size of its group.
    """
    counted = cells.select(*keys, "v", F.lit(1).alias("n") if weight is None else F.col(weight).alias("n"))
    counted = counted.where(F.abs("v") < F.lit(math.inf)).groupBy(*keys, "v").agg(F.sum("n").alias("n"))
    ranged = materialize(counted.repartitionByRange(*keys, "v").withColumn("_faixa", F.spark_partition_id()), "faixas")
    sizes = ranged.groupBy(*keys, "_faixa").agg(F.sum("n").alias("_n"))
    up = Window.partitionBy(*keys).orderBy("_faixa")
    sizes = sizes.withColumns({
        "_ate": F.sum("_n").over(up), "total": F.sum("_n").over(Window.partitionBy(*keys)),
    }).withColumn("_antes", F.col("_ate") - F.col("_n"))
    places = F.array_distinct(F.flatten(F.array(*[
        F.array(F.floor((F.col("total") - 1) * p), F.ceil((F.col("total") - 1) * p)) for p in probs
    ])))
    here = F.filter(places, lambda k: (k >= F.col("_antes")) & (k < F.col("_ate")))
    wanted = sizes.select(*keys, "_faixa", "_antes", "total", here.alias("_k")).where(F.size("_k") > 0)
    near = ranged.alias("c").join(wanted.alias("r"), _same(keys + ["_faixa"], "c", "r")).select(
        *[F.col(f"c.{k}").alias(k) for k in [*keys, "_faixa"]], "v", "n", "_antes", "total", "_k")
    inside = Window.partitionBy(*keys, "_faixa").orderBy("v")
    near = near.withColumn("_ate", F.sum("n").over(inside) + F.col("_antes"))
    held = F.filter("_k", lambda k: (k < F.col("_ate")) & (k >= F.col("_ate") - F.col("n")))
    ranks = near.select(*keys, "total", "v", F.explode(held).alias("k"))
    values = ranks.groupBy(*keys).agg(
        F.first("total").alias("total"), F.map_from_entries(F.collect_set(F.struct("k", "v"))).alias("at")
    )

    def quantile(p: float) -> Column:
        place = (F.col("total") - 1) * F.lit(p)
        a, b = F.element_at("at", F.floor(place)), F.element_at("at", F.ceil(place))
        return a + (b - a) * (place - F.floor(place))

    return values.select(*keys, F.array(*map(quantile, probs)).alias("q"))


def _same(keys: list[str], left: str, right: str) -> Column:
    """Equal keys of two named frames, null included."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def grouped_outliers(
    df: DataFrame, columns: list[str], keys: list[str], limit_pct: float = 5, factor: float = 1.5
) -> DataFrame:
    """Share of rows outside the fences of their own group, per group and numeric column."""
    cells = df.select(*keys, *[_number(c).alias(c) for c in columns]).unpivot(keys, columns, "coluna", "v")
    counted = materialize(cells.groupBy(*keys, "coluna", "v").agg(F.count(F.lit(1)).alias("n")), "numbers")
    return counted_outliers(counted, [*keys, "coluna"], limit_pct, factor)


def counted_outliers(counted: DataFrame, group: list[str], limit_pct: float = 5, factor: float = 1.5) -> DataFrame:
    """The same of (group, v, n): numbers with their counts, null for no number."""
    q = grouped_quantiles(counted, group, [0.25, 0.75], "n")
    spread = (F.col("q")[1] - F.col("q")[0]) * factor
    bounds = q.select(*group, (F.col("q")[0] - spread).alias("_lo"), (F.col("q")[1] + spread).alias("_hi"))
    joined = counted.alias("c").join(bounds.alias("r"), _same(group, "c", "r"), "left")
    outside = (F.col("c.v") < F.col("_lo")) | (F.col("c.v") > F.col("_hi"))
    share = F.lit(100.0) * F.col("fora") / F.col("linhas")
    sums = joined.groupBy(*[F.col(f"c.{k}").alias(k) for k in group]).agg(
        F.sum("n").alias("linhas"), F.coalesce(F.sum(F.when(outside, F.col("n"))), F.lit(0)).alias("fora")
    )
    return sums.select(*group, F.round(share, 2).alias("pct_fora"), (share > limit_pct).alias("problema"))


def approx_quantiles(
    df: DataFrame, columns: list[str], probs: list[float], error: float = 0.001
) -> Quantiles:
    """Sketched quantiles within a rank error, in one pass."""
    found = df.select([_finite(c).alias(c) for c in columns]).approxQuantile(columns, probs, error)
    return {c: q or [None] * len(probs) for c, q in zip(columns, found)}


def fences(
    df: DataFrame, columns: list[str], approx: bool = False, factor: float = 1.5
) -> dict[str, tuple[float | None, ...]]:
    """(q1, q3, lowest, highest accepted value) per column."""
    quartiles = (approx_quantiles if approx else exact_quantiles)(df, columns, [0.25, 0.75])

    def bounds(q1, q3):
        if q1 is None:
            return None, None, None, None
        return q1, q3, q1 - factor * (q3 - q1), q3 + factor * (q3 - q1)

    return {c: bounds(*q) for c, q in quartiles.items()}


def _outside(column: str, low: float | None, high: float | None) -> Column:
    v = _number(column)
    return (v < F.lit(low).cast("double")) | (v > F.lit(high).cast("double"))


def outliers(
    df: DataFrame, columns: list[str], approx: bool = False, limit_pct: float = 5, factor: float = 1.5
) -> DataFrame:
    """Per numeric column: quartiles, rows outside the IQR fences and a "> 5 %" flag."""
    measures = [
        F.struct(
            F.lit(c).alias("coluna"), F.lit(q1).cast("double").alias("q1"),
            F.lit(q3).cast("double").alias("q3"), F.count(F.lit(1)).alias("linhas"),
            F.count_if(_outside(c, low, high)).alias("fora"),
        )
        for c, (q1, q3, low, high) in fences(df, columns, approx, factor).items()
    ]
    share = F.try_divide(F.lit(100.0) * F.col("fora"), F.col("linhas"))
    return df.agg(F.array(*measures).alias("m")).select(F.inline("m")).withColumns({
        "pct_fora": F.round(share, 2), "problema": share > limit_pct,
    })


def outlier_rows(
    df: DataFrame, column: str, approx: bool = False, factor: float = 1.5
) -> DataFrame:
    """The rows of a frame whose value lies outside the fences of its column."""
    _, _, low, high = fences(df, [column], approx, factor)[column]
    return df.where(_outside(column, low, high))
