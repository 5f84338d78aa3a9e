"""Canonical incident record, header aliases and small schema helpers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F, types as T

from stormledger.functions import text

# Raw header (accent-free, lower case) -> canonical column. The
# raw year and month get their own names so that they never clash with the
# derived "ano" and "mes".
HEADER_ALIASES = {
    "regional": "regional",
    "ano": "ano_registro",
    "mes": "mes_registro",
    "data": "data_atendimento",
    "data_atendimento": "data_atendimento",
    "ocorrencia": "tipo_ocorrencia",
    "tipo_ocorrencia": "tipo_ocorrencia",
    "solicitacao": "solicitacao",
    "endereco": "endereco",
    "bairro": "bairro",
    "localidade": "localidade",
    "grau_de_risco": "grau_de_risco",
    "data_da_acao": "data_acao",
    "tipo_da_acao": "acao",
    "acao": "acao",
    "natureza_servico": "natureza_servico",
    "status": "status",
    "quantidade": "quantidade",
    "altura": "altura",
    "largura": "largura",
    "area_m": "area_m",
}

# Raw columns that hold numbers.
NUMERIC_COLUMNS = ["quantidade", "altura", "largura", "area_m"]

# Derived columns that hold integers.
INTEGER_COLUMNS = ["ano", "mes", "dia", "hora", "dia_semana", "_ano_origem"]

# Fields profiled as categories, and key fields that should not
# be null.
CATEGORICAL_FIELDS = [
    "tipo_ocorrencia", "bairro", "regional", "natureza_servico", "acao", "status",
]
KEY_FIELDS = ["bairro", "tipo_ocorrencia", "regional"]

_PLAIN = str.maketrans(text.ACCENTED, text.PLAIN)


def canonical_name(header: str) -> str:
    """Canonical column of a raw header; unknown headers keep their plain spelling."""
    plain = header.strip().lower().translate(_PLAIN).replace(" ", "_")
    return HEADER_ALIASES.get(plain, plain)


def unique_names(names: Iterable[str]) -> list[str]:
    """Names made distinct without regard to case: a repeated one gets its position."""
    out: list[str] = []
    for at, name in enumerate(names):
        taken = {n.lower() for n in out}
        out.append(f"{name}_{at}" if name.lower() in taken else name)
    return out


def canonical_names(headers: Iterable[str], cleaned: bool = False) -> list[str]:
    """Canonical columns of a header line.

    A ``cleaned`` table holds derived columns next to the raw ones: there "ano"
    is the derived year and "Ano" the raw one.
    """
    return unique_names(
        h if cleaned and h in INTEGER_COLUMNS else canonical_name(h)
        for h in (header.strip() for header in headers)
    )


def find_column(df: DataFrame, *candidates: str) -> str | None:
    """First candidate present in ``df``, compared without case."""
    present = {c.lower(): c for c in df.columns}
    return next((present[c.lower()] for c in candidates if c.lower() in present), None)


def date_columns(df: DataFrame) -> list[str]:
    """Columns whose name contains "data", in table order."""
    return [c for c in df.columns if "data" in c.lower()]


def main_date_column(df: DataFrame) -> str | None:
    """The incident date column: prefer names that also contain "atendimento"."""
    dates = date_columns(df)
    return next((c for c in dates if "atendimento" in c.lower()), dates[0] if dates else None)


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def column_class(field: T.StructField) -> str:
    """Class of a column: date by name, else numeric by type, else text."""
    if "data" in field.name.lower():
        return "data"
    return "numerica" if isinstance(field.dataType, T.NumericType) else "texto"


def empty(df: DataFrame, schema: str) -> DataFrame:
    """Empty typed result for a missing input column."""
    return df.sparkSession.createDataFrame([], schema)
