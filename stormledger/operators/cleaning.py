"""Filters, null handling, normalisation and derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stormledger import schema, vocab
from stormledger.functions import dates, text


def parse_date_columns(df: DataFrame) -> DataFrame:
    """Parse every text column whose name contains "data"."""
    texts = set(schema.text_columns(df))
    return df.withColumns(
        {c: dates.parse_date(F.col(c)) for c in schema.date_columns(df) if c in texts}
    )


def filter_region(
    df: DataFrame, column: str = "regional", spellings: list[str] = vocab.REGION_SPELLINGS
) -> DataFrame:
    """Keep rows whose region has an accepted spelling or is null."""
    c = F.col(column)
    return df.where(c.isNull() | F.lower(c).isin(spellings))


def filter_dated(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull())


def fill_text(df: DataFrame, columns: list[str] | None = None, value: str = vocab.NOT_INFORMED):
    """Fill null texts with a sentinel."""
    return df.na.fill(value, subset=columns if columns is not None else schema.text_columns(df))


def fill_numeric(df: DataFrame, columns: list[str] | None = None, value: float = 0):
    """Fill null numbers; dates stay null."""
    return df.na.fill(value, subset=columns if columns is not None else schema.numeric_columns(df))


def _map_spellings(df: DataFrame, column: str, out: str, rows: list[tuple[str, str]]) -> DataFrame:
    # The sentinel of filled nulls and its spellings in raw files are one name.
    rows = [*rows, (vocab.NOT_INFORMED_PLAIN, vocab.NOT_INFORMED)]
    # The dimension is a module constant (under 150 rows), so the broadcast is bounded.
    dim = df.sparkSession.createDataFrame(rows, "_grafia string, _nome string")
    lowered = df.withColumn("_minusculo", text.normalize(F.col(column)))
    keyed = lowered.withColumn("_grafia", text.fold(F.col("_minusculo")))
    return (
        keyed.join(F.broadcast(dim), "_grafia", "left")
        .withColumn(out, F.coalesce("_nome", "_minusculo"))
        .drop("_grafia", "_nome", "_minusculo")
    )


def normalize_area(df: DataFrame, column: str = "bairro", out: str = "bairro_normalizado"):
    """Canonical area name; unknown names pass through in lower case, stripped."""
    return _map_spellings(df, column, out, vocab.area_rows())


def normalize_kind(
    df: DataFrame, column: str = "tipo_ocorrencia", out: str = "tipo_ocorrencia_normalizado"
):
    """Canonical incident kind; unknown kinds pass through in lower case, stripped."""
    return _map_spellings(df, column, out, vocab.kind_rows())


def derive_calendar(df: DataFrame, column: str | None = None) -> DataFrame:
    """Add the calendar attributes of the (discovered) date column."""
    column = column or schema.main_date_column(df)
    return df if column is None else df.withColumns(dates.calendar(F.col(column)))


def recover_period(
    df: DataFrame, year: str = "ano_registro", month: str = "mes_registro"
) -> DataFrame:
    """Fill year and month from the raw year and month name where the date is missing."""
    month_number = F.coalesce(F.col("mes"), dates.month_number(F.col(month)))
    return df.withColumns({
        "ano": F.coalesce(F.col("ano"), F.expr(f"try_cast(`{year}` as int)")),
        "mes": month_number,
        "estacao": F.coalesce(F.col("estacao"), dates.season(month_number)),
    })


def enrich_calendar(
    df: DataFrame, column: str, holidays: list[tuple] = vocab.NATIONAL_HOLIDAYS,
    movable: list[tuple] = vocab.MOVABLE_HOLIDAYS,
):
    """Add a weekend flag and the holiday name of a date.

    ``holidays`` are (month, day, name), such as national and local days;
    ``movable`` are (days from Easter Sunday, name).
    """
    # One row per holiday of the year: a bounded broadcast.
    dim = df.sparkSession.createDataFrame(holidays, "_m int, _d int, feriado string")
    c = F.col(column)
    moved = F.lit(None).cast("string")
    for offset, name in movable:
        moved = F.when(F.col("_pascoa") == offset, F.lit(name)).otherwise(moved)
    return (
        df.withColumns({
            "fim_de_semana": F.weekday(c) >= 5, "_m": F.month(c), "_d": F.dayofmonth(c),
            "_pascoa": F.datediff(F.to_date(c), dates.easter(F.year(c))),
        })
        .join(F.broadcast(dim), ["_m", "_d"], "left")
        .withColumn("feriado", F.coalesce("feriado", moved))
        .drop("_m", "_d", "_pascoa")
    )
