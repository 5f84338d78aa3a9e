"""The three stages: clean and unify, diagnose, aggregate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from stormledger import schema
from stormledger.functions import text
from stormledger.functions.values import missing
from stormledger.operators import cleaning, profiling, quantiles
from stormledger.session import materialize


def clean_and_unify(
    df: DataFrame, regions: list[str] | None = None, fill: bool = False, recover: bool = False
) -> DataFrame:
    """Parse dates, filter the region, normalise names, derive the calendar.

    ``df`` is a united corpus with canonical columns. The region filter is
    opt-in, because raw files may name administrative sectors instead. So is
    filling: a sentinel would count as an area or kind of its own later.
    ``recover`` takes year and month from their raw columns where the date is
    missing.
    """
    out = cleaning.parse_date_columns(df)
    if regions is not None and "regional" in out.columns:
        out = cleaning.filter_region(out, "regional", regions)
    return _normalised(out, fill, recover)


def _normalised(out: DataFrame, fill: bool, recover: bool) -> DataFrame:
    """The steps after dates and region."""
    if fill:
        out = cleaning.fill_numeric(cleaning.fill_text(out))
    if "bairro" in out.columns:
        out = cleaning.normalize_area(out)
    if "tipo_ocorrencia" in out.columns:
        out = cleaning.normalize_kind(out)
    out = cleaning.derive_calendar(out)
    if recover and {"ano_registro", "mes_registro", "ano"} <= set(out.columns):
        out = cleaning.recover_period(out)
    return out


def _observed(df: DataFrame, name: str, date: str | None) -> tuple[DataFrame, Observation]:
    """The frame with its rows, null cells and dated rows counted by whatever job reads it."""
    seen = Observation(name)
    cells = reduce(lambda a, b: a + b, [missing(df, c).cast("bigint") for c in df.columns])
    dated = F.count(date) if date else F.lit(0).cast("bigint")
    counts: list[Column] = [F.count(F.lit(1)).alias("linhas"), F.sum(cells).alias("nulos"), dated.alias("com_data")]
    return df.observe(seen, *counts), seen


def clean_and_store(
    df: DataFrame, path: str, regions: list[str] | None = None, fill: bool = False, recover: bool = False
) -> DataFrame:
    """Clean, write as Parquet, and tell what each step did: (etapa, linhas, nulos, com_data).

    The figures are observed by the job that writes; neither the raw rows nor the
    cleaned ones are read for them. No step moves rows between tasks, so a repeated
    task counts once.
    """
    steps = []

    def observe(frame: DataFrame, step: str) -> DataFrame:
        out, seen = _observed(frame, step, schema.main_date_column(frame))
        steps.append((step, seen))
        return out

    loaded = observe(df, "carregado")
    parsed = observe(cleaning.parse_date_columns(loaded), "datas")
    kept = parsed
    if regions is not None and "regional" in parsed.columns:
        kept = observe(cleaning.filter_region(parsed, "regional", regions), "regiao")
    cleaned = observe(_normalised(kept, fill, recover), "limpo")
    cleaned.write.mode("overwrite").parquet(path)
    found = [(step, seen.get["linhas"], seen.get["nulos"] or 0, seen.get["com_data"]) for step, seen in steps]
    return df.sparkSession.createDataFrame(found, "etapa string, linhas bigint, nulos bigint, com_data bigint")


def diagnose(
    df: DataFrame, keys: tuple[str, ...] = (), limit_pct: float = 50, approx: bool = False, top: int = 10
) -> DataFrame:
    """Column profiles and problems per ``keys`` (such as the source file), in tidy rows.

    Per column: rows, nulls, distinct values, its class, and the five problems:
    too many nulls, no date column, characters outside ASCII, nulls in a key
    field, outliers; and the most frequent values of categorical columns. The rows
    are read once, into a census that holds every value with its count; all
    figures, quartiles too, come from it. With ``approx`` and without keys there is
    no census: one pass of sketches, with neither top values nor exact quartiles.
    """
    columns = [c for c in df.columns if c not in keys]
    classes = {f.name: schema.column_class(f) for f in df.schema if f.name in columns}
    pairs = [F.lit(x) for pair in classes.items() for x in pair]
    kind = F.element_at(F.create_map(*pairs), F.col("coluna"))
    numeric = [c for c in schema.numeric_columns(df) if c in columns]
    texts = [c for c in schema.text_columns(df) if c in columns]
    no_date = F.lit(not schema.date_columns(df.select(columns)))
    group = [*keys, "coluna"]
    if approx and not keys:
        out = _sketched(df, columns)
        # Several scans follow, so the numbers alone become a table first.
        numbers = materialize(df.select(*numeric), "numbers") if numeric else None
        outside = quantiles.outliers(numbers, numeric, approx).select("coluna", "pct_fora", "problema") if numeric else None
    else:
        census = materialize(profiling.value_census(df, columns, keys), "census")
        odd = F.when(F.col("coluna").isin(texts) & text.has_non_ascii(F.col("valor")), F.col("n"))
        out = profiling.summarize_census(census, keys, {"fora_do_ascii": F.coalesce(F.sum(odd), F.lit(0))})
        out = out.withColumn("fora_do_ascii", F.when(F.col("coluna").isin(texts), F.col("fora_do_ascii")))
        fields = [c for c in schema.CATEGORICAL_FIELDS if c in columns]
        frequent = profiling.top_values(census.where(F.col("coluna").isin(fields)), top, keys)
        listed = F.sort_array(F.collect_list(F.struct("posicao", "valor", "n")))
        frequent = frequent.groupBy(*group).agg(listed.alias("principais"))
        out = _same(out, frequent, group)
        outside = quantiles.counted_outliers(_numbers(census, df, numeric, group), group) if numeric else None
    out = out.withColumns({
        "classe": kind, "muitos_nulos": F.col("pct_nulos") > limit_pct, "sem_data": no_date,
        "campo_chave_nulo": F.col("coluna").isin(schema.KEY_FIELDS) & (F.col("nulos") > 0),
    })
    if outside is None:
        return out
    return _same(out, outside.withColumnRenamed("problema", "outliers"), group)


def _numbers(census: DataFrame, df: DataFrame, numeric: list[str], group: list[str]) -> DataFrame:
    """(group, v, n) of the numeric columns of a census; text gives back the number it was made of."""
    single = [c for c in numeric if dict(df.dtypes)[c] == "float"]
    valor = F.col("valor")
    # the shortest text of a float is that float again, but another double
    v = F.when(F.col("coluna").isin(single), valor.cast("float").cast("double")).otherwise(valor.cast("double"))
    return census.where(F.col("coluna").isin(numeric)).select(*group, v.alias("v"), "n")


def _sketched(df: DataFrame, columns: list[str]) -> DataFrame:
    """The profile of whole columns in one pass, with sketched distinct counts."""
    found = profiling.profile_columns_approx(df, columns).withColumnRenamed("nome", "coluna").drop("tipo")
    rows = df.select(F.count(F.lit(1)).alias("_n")).scalar()
    texts = [c for c in schema.text_columns(df) if c in columns]
    out = found.withColumn("linhas", rows)
    if texts:
        odd = profiling.non_ascii_counts(df, texts).withColumnRenamed("n", "fora_do_ascii")
        out = out.join(odd, "coluna", "left")
    return out


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on keys that may be null."""
    right = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return left.join(right, same, "left").drop(*[f"_{k}" for k in keys])
