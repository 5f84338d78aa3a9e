"""Column profiles.

``value_census`` turns a table into one counted row per (column, value). Nulls,
distinct counts, examples, modes and top values are small aggregations of that
one frame, so a full profile reads the table once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stormledger import schema
from stormledger.functions import dates, text
from stormledger.functions.values import missing, present
from stormledger.operators.ranking import top_per_group


def value_census(df: DataFrame, columns: list[str] | None = None, keys: tuple[str, ...] = ()):
    """(coluna, valor, n): how often each value of each column occurs, null included.

    ``keys`` (such as the source file) stay in front of the column name.
    Counting starts before the shuffle, so a very frequent value costs one row
    per task.
    """
    columns = [c for c in (columns or df.columns) if c not in keys]
    texts = [F.when(present(df, c), F.col(c).cast("string")).alias(c) for c in columns]
    cells = df.select(*keys, *texts).unpivot(
        list(keys), columns, "coluna", "valor"
    )
    return cells.groupBy(*keys, "coluna", "valor").agg(F.count(F.lit(1)).alias("n"))


def _one_row_per_column(df: DataFrame, measures: list[Column]) -> DataFrame:
    """Any number of per-column measures in a single aggregation, as rows."""
    return df.agg(F.array(*measures).alias("m")).select(F.inline("m"))


def _types(df: DataFrame, columns: list[str] | None) -> dict[str, str]:
    return {
        f.name: f.dataType.simpleString()
        for f in df.schema
        if columns is None or f.name in columns
    }


def _type_of_column(types: dict[str, str]):
    pairs = [F.lit(x) for pair in types.items() for x in pair]
    return F.element_at(F.create_map(*pairs), F.col("coluna"))


def summarize_census(census: DataFrame, keys: tuple[str, ...] = (), more: dict[str, Column] | None = None) -> DataFrame:
    """Rows, nulls, null percent and distinct values per column of a census, and ``more`` sums of it."""
    out = census.groupBy(*keys, "coluna").agg(
        F.sum("n").alias("linhas"),
        F.coalesce(F.sum(F.when(F.col("valor").isNull(), F.col("n"))), F.lit(0)).alias("nulos"),
        F.count("valor").alias("valores_unicos"), *[c.alias(name) for name, c in (more or {}).items()],
    )
    pct = F.round(F.lit(100.0) * F.col("nulos") / F.col("linhas"), 2)
    return out.withColumn("pct_nulos", pct)


def profile_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """nome, tipo, nulos, pct_nulos, valores_unicos per column, all exact."""
    types = _types(df, columns)
    return (
        summarize_census(value_census(df, list(types)))
        .withColumn("tipo", _type_of_column(types))
        .withColumnRenamed("coluna", "nome")
        .select("nome", "tipo", "nulos", "pct_nulos", "valores_unicos")
    )


def profile_columns_approx(df: DataFrame, columns: list[str] | None = None, rsd: float = 0.02):
    """As ``profile_columns`` with sketched distinct counts: one pass, no value shuffle."""
    types = _types(df, columns)
    measures = [
        F.struct(
            F.lit(c).alias("nome"), F.lit(t).alias("tipo"), F.count_if(missing(df, c)).alias("nulos"),
            F.count(F.lit(1)).alias("linhas"),
            F.approx_count_distinct(F.when(present(df, c), F.col(c)), rsd).alias("valores_unicos"),
        )
        for c, t in types.items()
    ]
    return _one_row_per_column(df, measures).select(
        "nome", "tipo", "nulos",
        F.round(F.try_divide(F.lit(100.0) * F.col("nulos"), F.col("linhas")), 2).alias("pct_nulos"),
        "valores_unicos",
    )


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact distinct non-null values per column."""
    return value_census(df, columns).groupBy("coluna").agg(F.count("valor").alias("valores_unicos"))


def distinct_counts_approx(df: DataFrame, columns: list[str], rsd: float = 0.02) -> DataFrame:
    measures = [
        F.struct(
            F.lit(c).alias("coluna"),
            F.approx_count_distinct(F.when(present(df, c), F.col(c)), rsd).alias("valores_unicos"),
        )
        for c in columns
    ]
    return _one_row_per_column(df, measures)


def examples(census: DataFrame, k: int = 3, keys: tuple[str, ...] = ()) -> DataFrame:
    """The k smallest values of each column (deterministic examples)."""
    present = census.where(F.col("valor").isNotNull()).drop("n")
    return top_per_group(present, [*keys, "coluna"], [F.col("valor")], k, "posicao")


def top_values(
    census: DataFrame, k: int = 10, keys: tuple[str, ...] = (), numeric: list[str] = []
) -> DataFrame:
    """The k most frequent values of each column; ties by value (as numbers where ``numeric``)."""
    present = census.where(F.col("valor").isNotNull())
    # Numbers tie by size, texts by letter.
    number = F.when(F.col("coluna").isin(numeric), F.col("valor").try_cast("double"))
    order = [F.desc("n"), number, F.col("valor")]
    return top_per_group(present, [*keys, "coluna"], order, k, "posicao")


def modes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Most frequent value of each column, smallest on ties."""
    numeric = [c for c in schema.numeric_columns(df) if c in columns]
    top = top_values(value_census(df, columns), 1, numeric=numeric)
    return top.select("coluna", F.col("valor").alias("moda"), "n")


def categorical_profile(
    df: DataFrame, fields: list[str] | None = None, k: int = 10, keys: tuple[str, ...] = ()
) -> DataFrame:
    """Distinct count and top k values of each categorical field present."""
    fields = [c for c in (fields or schema.CATEGORICAL_FIELDS) if c in df.columns]
    # Both sides need the same columns of the same filtered census (hence the
    # look at n), so its shuffle is shared and the table is read once.
    present = value_census(df, fields, keys).where(F.col("valor").isNotNull())
    unique = present.groupBy(*keys, "coluna").agg(F.count_if(F.col("n") > 0).alias("total_unicos"))
    return top_values(present, k, keys).join(unique, [*keys, "coluna"])


def column_classes(df: DataFrame) -> DataFrame:
    """Class (data, numerica or texto) and filled cells of each column."""
    return _one_row_per_column(df, [
        F.struct(
            F.lit(f.name).alias("coluna"), F.lit(schema.column_class(f)).alias("classe"),
            F.count_if(present(df, f.name)).alias("preenchidos"),
        )
        for f in df.schema
    ])


def date_column_use(df: DataFrame) -> DataFrame:
    """The discovered incident date column with its rows and valid dates."""
    column = schema.main_date_column(df)
    if column is None:
        return schema.empty(df, "coluna string, linhas bigint, com_data bigint")
    return df.agg(
        F.lit(column).alias("coluna"), F.count(F.lit(1)).alias("linhas"),
        F.count(column).alias("com_data"),
    )


def null_totals(before: DataFrame, after: DataFrame) -> DataFrame:
    """Null cells before and after a step, one pass each."""
    def nulls(df: DataFrame, label: str) -> DataFrame:
        cells = reduce(
            lambda a, b: a + b, [F.count_if(missing(df, c)) for c in df.columns]
        )
        return df.agg(F.lit(label).alias("momento"), cells.alias("nulos"))

    return nulls(before, "antes").unionAll(nulls(after, "depois"))


def cleaning_effect(df: DataFrame, date: str, region_kept: Column) -> DataFrame:
    """Rows loaded, kept by the region filter and with a valid date, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("linhas"),
        F.count_if(region_kept).alias("linhas_filtradas"),
        F.count_if(region_kept & F.col(date).isNotNull()).alias("linhas_com_data"),
    )


def null_ratio_rule(profile: DataFrame, limit_pct: float = 50) -> DataFrame:
    """Columns of a profile with more nulls than the limit."""
    return profile.where(F.col("pct_nulos") > limit_pct)


def no_date_rule(df: DataFrame) -> DataFrame:
    """Whether any column name marks a date."""
    found = schema.date_columns(df)
    return df.agg(
        F.count(F.lit(1)).alias("linhas"), F.lit(len(found)).alias("colunas_data"),
        F.lit(not found).alias("problema"),
    )


def non_ascii_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows with a character outside ASCII per text column (the whole column)."""
    columns = columns or schema.text_columns(df)
    measures = [
        F.struct(F.lit(c).alias("coluna"), F.count_if(text.has_non_ascii(F.col(c))).alias("n"))
        for c in columns
    ]
    return _one_row_per_column(df, measures)


def key_nulls(df: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Null count of each key field present."""
    fields = [c for c in (fields or schema.KEY_FIELDS) if c in df.columns]
    measures = [
        F.struct(F.lit(c).alias("campo"), F.count_if(missing(df, c)).alias("nulos"))
        for c in fields
    ]
    return _one_row_per_column(df, measures)


def date_shape_census(df: DataFrame, column: str) -> DataFrame:
    """Rows per textual date shape."""
    return df.groupBy(dates.date_shape(F.col(column)).alias("formato")).agg(
        F.count(F.lit(1)).alias("n")
    )


def sample_head(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first n rows in a given order."""
    return df.orderBy(*order).limit(n)
