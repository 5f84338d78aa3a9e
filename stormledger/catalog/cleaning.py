"""Filters, null handling, normalisation, dates and the clean stage."""

from __future__ import annotations

from pyspark.sql import functions as F

from stormledger import bindings as b, vocab
from stormledger.catalog.core import query
from stormledger.functions import dates, text
from stormledger.operators import cleaning, profiling
from stormledger.plans import stages

DIRTY, ORD = f"WITH {b.DIRTY_SQL}", f"WITH {b.ORDERS_SQL}"
PARSED = b.PARSE_SQL.format(c="data_atendimento")
REGION_OK = "(regional IS NULL OR lower(regional) IN ('recife', 'recife/pe', 'recife - pe', 'r mr', 'metropolitana'))"
STRIPPED = "lower(trim({c}, ' ' || chr(9) || chr(10) || chr(13) || chr(160)))"
AREA_SQL = f"CASE WHEN {STRIPPED.format(c='bairro')} = 'água fria' THEN 'agua_fria' ELSE {STRIPPED.format(c='bairro')} END"
KIND_SQL = f"""CASE {STRIPPED.format(c='tipo_ocorrencia')} WHEN 'alagamento' THEN 'alagamento'
  WHEN 'risco geotécnico' THEN 'risco' ELSE {STRIPPED.format(c='tipo_ocorrencia')} END"""


@query("filter_region", f"{DIRTY} SELECT id_atendimento, regional FROM dirty WHERE {REGION_OK}")
def filter_region(spark, sf):
    return cleaning.filter_region(b.dirty(spark, sf)).select("id_atendimento", "regional")


@query("filter_dated", f"""{DIRTY} SELECT id_atendimento, CAST({PARSED} AS TIMESTAMP) AS data_atendimento
  FROM dirty WHERE {PARSED} IS NOT NULL""")
def filter_dated(spark, sf):
    parsed = cleaning.parse_date_columns(b.dirty(spark, sf)).select("id_atendimento", "data_atendimento")
    return cleaning.filter_dated(parsed, "data_atendimento")


@query("parse_dates", f"""{DIRTY} SELECT id_atendimento, data_atendimento AS texto,
  strftime({PARSED}, '%Y-%m-%d %H:%M:%S') AS data FROM dirty""")
def parse_dates(spark, sf):
    raw = b.dirty(spark, sf)
    parsed = dates.parse_date(F.col("data_atendimento"))
    return raw.select(
        "id_atendimento", F.col("data_atendimento").alias("texto"),
        F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("data"),
    )


@query("derive_calendar", f"""WITH d AS (SELECT id_atendimento, {PARSED} AS t FROM (WITH {b.DIRTY_SQL} SELECT * FROM dirty))
  SELECT id_atendimento, {b.CALENDAR_SQL.format(d='t')} FROM d""")
def derive_calendar(spark, sf):
    parsed = cleaning.parse_date_columns(b.dirty(spark, sf))
    return cleaning.derive_calendar(parsed).select(
        "id_atendimento", "ano", "mes", "dia", "hora", "dia_semana", "dia_semana_nome", "estacao"
    )


@query("derive_season", f"""{ORD} SELECT mes, CASE WHEN mes IN (12, 1, 2) THEN 'Verão' WHEN mes IN (3, 4, 5)
  THEN 'Outono' WHEN mes IN (6, 7, 8) THEN 'Inverno' ELSE 'Primavera' END AS estacao, count(*) AS n
  FROM ord GROUP BY 1, 2""")
def derive_season(spark, sf):
    season = dates.season(F.col("mes"), vocab.SEASONS_ACCENTED).alias("estacao")
    return b.orders(spark, sf).groupBy("mes", season).agg(F.count(F.lit(1)).alias("n"))


@query("discover_date_column", f"""{DIRTY} SELECT 'data_atendimento' AS coluna, count(*) AS linhas,
  count({PARSED}) AS com_data FROM dirty""")
def discover_date_column(spark, sf):
    return profiling.date_column_use(cleaning.parse_date_columns(b.dirty(spark, sf)))


@query("fill_text", f"""{DIRTY} SELECT id_atendimento, coalesce(regional, 'não informado') AS regional,
  coalesce(bairro, 'não informado') AS bairro, coalesce(tipo_ocorrencia, 'não informado') AS tipo_ocorrencia
  FROM dirty""")
def fill_text(spark, sf):
    raw = b.dirty(spark, sf).select("id_atendimento", "regional", "bairro", "tipo_ocorrencia")
    return cleaning.fill_text(raw)


@query("fill_numeric", f"""{DIRTY} SELECT id_atendimento, coalesce(quantidade, 0) AS quantidade, bairro FROM dirty""")
def fill_numeric(spark, sf):
    return cleaning.fill_numeric(b.dirty(spark, sf).select("id_atendimento", "quantidade", "bairro"))


@query("normalize_text", f"""{DIRTY} SELECT id_atendimento, {STRIPPED.format(c='bairro')} AS bairro FROM dirty""")
def normalize_text(spark, sf):
    return b.dirty(spark, sf).select("id_atendimento", text.normalize(F.col("bairro")).alias("bairro"))


@query("normalize_area", f"""{DIRTY} SELECT id_atendimento, bairro, {AREA_SQL} AS bairro_normalizado FROM dirty""")
def normalize_area(spark, sf):
    return cleaning.normalize_area(b.dirty(spark, sf)).select(
        "id_atendimento", "bairro", "bairro_normalizado"
    )


@query("normalize_kind", f"""{DIRTY} SELECT id_atendimento, tipo_ocorrencia,
  {KIND_SQL} AS tipo_ocorrencia_normalizado FROM dirty""")
def normalize_kind(spark, sf):
    return cleaning.normalize_kind(b.dirty(spark, sf)).select(
        "id_atendimento", "tipo_ocorrencia", "tipo_ocorrencia_normalizado"
    )


@query("fold_accents", """SELECT doc_id, md5(replace(translate(lower(trim(text, ' ' || chr(9) || chr(10) || chr(13) || chr(160))),
  'áàâãäéèêëíìîïóòôõöúùûüçñ', 'aaaaaeeeeiiiiooooouuuucn'), ' ', '_')) AS dobrado FROM documents""")
def fold_accents(spark, sf):
    return b.table(spark, sf, "documents").select(
        "doc_id", F.md5(text.slug(F.col("text"))).alias("dobrado")
    )


@query("non_ascii", r"""SELECT 'text' AS coluna, count(*) FILTER (WHERE regexp_matches(text, '[^\x00-\x7F]')) AS n FROM documents
  UNION ALL SELECT 'lang', count(*) FILTER (WHERE regexp_matches(lang, '[^\x00-\x7F]')) FROM documents
  UNION ALL SELECT 'source', count(*) FILTER (WHERE regexp_matches(source, '[^\x00-\x7F]')) FROM documents""")
def non_ascii(spark, sf):
    return profiling.non_ascii_counts(b.table(spark, sf, "documents"))


@query("month_from_name", f"""{ORD}, r AS (SELECT *, id_atendimento % 13 IN (0, 1, 2, 3, 4, 5, 6, 9, 10, 12) AS dated FROM ord)
  SELECT ano, mes, estacao, count(*) AS n, count(*) FILTER (WHERE NOT dated) AS recuperados
  FROM r GROUP BY 1, 2, 3""")
def month_from_name(spark, sf):
    """Year and month come back from the raw year and month name where the date is unreadable."""
    o = b.orders(spark, sf)
    raw = o.select(
        b.raw_date(F.col("data_atendimento"), F.col("id_atendimento")).alias("data_atendimento"),
        F.col("ano").cast("string").alias("ano_registro"),
        F.upper(dates.month_name(F.col("mes"))).alias("mes_registro"),
    )
    derived = cleaning.derive_calendar(cleaning.parse_date_columns(raw))
    return cleaning.recover_period(derived).groupBy("ano", "mes", "estacao").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("data_atendimento").isNull()).alias("recuperados")
    )


HOLIDAYS = [*vocab.NATIONAL_HOLIDAYS, *vocab.LOCAL_HOLIDAYS]
# Easter Sundays of the years the orders cover.
EASTERS = [
    "1990-04-15", "1991-03-31", "1992-04-19", "1993-04-11", "1994-04-03", "1995-04-16", "1996-04-07", "1997-03-30",
    "1998-04-12", "1999-04-04", "2000-04-23", "2001-04-15", "2002-03-31", "2003-04-20", "2004-04-11", "2005-03-27",
]


@query("enrich_calendar", f"""{ORD}, h AS (SELECT * FROM (VALUES {', '.join(f"({m}, {d}, '{n}')" for m, d, n in HOLIDAYS)})
  AS t(m, d, fixo)), e AS (SELECT CAST(p AS DATE) + f AS quando, movel FROM (VALUES {', '.join(f"('{p}')" for p in EASTERS)}) AS t(p),
  (VALUES {', '.join(f"({f}, '{n}')" for f, n in vocab.MOVABLE_HOLIDAYS)}) AS u(f, movel))
  SELECT isodow(data_atendimento) >= 6 AS fim_de_semana, coalesce(fixo, movel) AS feriado, count(*) AS n FROM ord
  LEFT JOIN h ON mes = m AND dia = d LEFT JOIN e ON CAST(data_atendimento AS DATE) = quando GROUP BY 1, 2""")
def enrich_calendar(spark, sf):
    rows = cleaning.enrich_calendar(b.orders(spark, sf).select("data_atendimento"), "data_atendimento", HOLIDAYS)
    return rows.groupBy("fim_de_semana", "feriado").agg(F.count(F.lit(1)).alias("n"))


@query("clean_and_unify", f"""{DIRTY}, f AS (SELECT id_atendimento, coalesce(regional, 'não informado') AS regional,
  coalesce(bairro, 'não informado') AS bairro, coalesce(tipo_ocorrencia, 'não informado') AS tipo_ocorrencia,
  CAST({PARSED} AS TIMESTAMP) AS data_atendimento, coalesce(quantidade, 0) AS quantidade FROM dirty WHERE {REGION_OK})
  SELECT f.*, {AREA_SQL} AS bairro_normalizado, {KIND_SQL} AS tipo_ocorrencia_normalizado,
  {b.CALENDAR_SQL.format(d='data_atendimento')} FROM f""")
def clean_and_unify(spark, sf):
    return stages.clean_and_unify(b.dirty(spark, sf), regions=vocab.REGION_SPELLINGS, fill=True)


@query("clean_and_unify_nulls", f"""{DIRTY} SELECT id_atendimento, bairro, {AREA_SQL} AS bairro_normalizado,
  CAST({PARSED} AS TIMESTAMP) AS data_atendimento, quantidade FROM dirty""")
def clean_and_unify_nulls(spark, sf):
    """Without filling nulls stay null."""
    return stages.clean_and_unify(b.dirty(spark, sf)).select(
        "id_atendimento", "bairro", "bairro_normalizado", "data_atendimento", "quantidade"
    )


@query("normalize_sentinel", """SELECT o_orderkey AS id, 'não informado' AS bairro_normalizado FROM orders""")
def normalize_sentinel(spark, sf):
    """The sentinel of filled nulls and its raw spellings are one area."""
    key = F.col("o_orderkey")
    area = F.when(key % 3 == 0, F.lit("Nao Informado")).when(key % 3 == 1, F.lit(" NÃO INFORMADO "))
    rows = b.table(spark, sf, "orders").select(key.alias("id"), area.alias("bairro"))
    return cleaning.normalize_area(cleaning.fill_text(rows)).select("id", "bairro_normalizado")


@query("cleaning_effect", f"""{DIRTY} SELECT count(*) AS linhas, count(*) FILTER (WHERE {REGION_OK}) AS linhas_filtradas,
  count(*) FILTER (WHERE {REGION_OK} AND {PARSED} IS NOT NULL) AS linhas_com_data FROM dirty""")
def cleaning_effect(spark, sf):
    parsed = cleaning.parse_date_columns(b.dirty(spark, sf))
    kept = F.col("regional").isNull() | F.lower("regional").isin(vocab.REGION_SPELLINGS)
    return profiling.cleaning_effect(parsed, "data_atendimento", kept)
