"""Column profiles, outliers and the diagnosis."""

from __future__ import annotations

from pyspark.sql import functions as F

from stormledger import bindings as b
from stormledger.catalog.core import query
from stormledger.operators import aggregates as agg, cleaning, profiling, quantiles
from stormledger.plans import stages
from stormledger.session import materialize

DIRTY = f"WITH {b.DIRTY_SQL}"
CALLS = f"WITH {b.CALLS_SQL}"
DIRTY_TYPES = {
    "id_atendimento": "bigint", "regional": "string", "bairro": "string",
    "tipo_ocorrencia": "string", "data_atendimento": "string", "quantidade": "double",
}
PRICE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _profile_sql(types: dict[str, str], source: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS nome, '{t}' AS tipo, count(*) - count({c}) AS nulos,
        round(100.0 * (count(*) - count({c})) / count(*), 2) AS pct_nulos,
        count(DISTINCT {c}) AS valores_unicos FROM {source}"""
        for c, t in types.items()
    )


@query("profile_columns", f"{DIRTY} {_profile_sql(DIRTY_TYPES, 'dirty')}")
def profile_columns(spark, sf):
    return profiling.profile_columns(b.dirty(spark, sf))


MEASURED = f"WITH {b.MEASURED_SQL}"
MEASURED_TYPES = {"id": "bigint", "quando": "timestamp_ntz", "chuva_mm": "double"}
# Three standard errors of a sketch of distinct values.
SKETCH_ERROR = 0.06


@query("profile_columns_nan", f"{MEASURED} {_profile_sql(MEASURED_TYPES, 'seen')}")
def profile_columns_nan(spark, sf):
    return profiling.profile_columns(b.measured(spark, sf))


@query("profile_columns_approx", f"{DIRTY}, p AS ({_profile_sql(DIRTY_TYPES, 'dirty')}) SELECT nome, tipo, nulos, pct_nulos, true AS dentro_do_erro FROM p")
def profile_columns_approx(spark, sf):
    """One pass with sketched distinct counts, each held against the exact count."""
    dirty = b.dirty(spark, sf)
    exact = profiling.profile_columns(dirty).select("nome", F.col("valores_unicos").alias("exatos"))
    error = F.abs(F.col("valores_unicos") - F.col("exatos")) <= SKETCH_ERROR * F.col("exatos")
    return profiling.profile_columns_approx(dirty).join(exact, "nome").select(
        "nome", "tipo", "nulos", "pct_nulos", error.alias("dentro_do_erro")
    )


@query("profile_examples", f"{DIRTY} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS coluna, valor, CAST(p AS INTEGER) AS posicao FROM (
      SELECT valor, row_number() OVER (ORDER BY valor) AS p FROM (
        SELECT DISTINCT CAST({c} AS VARCHAR) AS valor FROM dirty WHERE {c} IS NOT NULL)) WHERE p <= 3"""
    for c in ("regional", "bairro", "tipo_ocorrencia", "data_atendimento")
))
def profile_examples(spark, sf):
    columns = ["regional", "bairro", "tipo_ocorrencia", "data_atendimento"]
    return profiling.examples(profiling.value_census(b.dirty(spark, sf), columns))


@query("profile_categorical", f"{DIRTY} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS coluna, valor, n, CAST(p AS INTEGER) AS posicao,
      (SELECT count(DISTINCT {c}) FROM dirty) AS total_unicos FROM (
      SELECT {c} AS valor, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, {c}) AS p
      FROM dirty WHERE {c} IS NOT NULL GROUP BY {c}) WHERE p <= 10"""
    for c in ("tipo_ocorrencia", "bairro", "regional")
))
def profile_categorical(spark, sf):
    return profiling.categorical_profile(b.dirty(spark, sf))


@query("profile_column_classes", f"{DIRTY} " + " UNION ALL ".join(
    f"SELECT '{c}' AS coluna, '{k}' AS classe, count({c}) AS preenchidos FROM dirty"
    for c, k in {
        "id_atendimento": "numerica", "regional": "texto", "bairro": "texto",
        "tipo_ocorrencia": "texto", "data_atendimento": "data", "quantidade": "numerica",
    }.items()
))
def profile_column_classes(spark, sf):
    return profiling.column_classes(b.dirty(spark, sf))


@query("rule_null_ratio", f"""{DIRTY}, p AS ({_profile_sql(DIRTY_TYPES, 'dirty')})
  SELECT * FROM p WHERE pct_nulos > 20""")
def rule_null_ratio(spark, sf):
    return profiling.null_ratio_rule(profiling.profile_columns(b.dirty(spark, sf)), 20)


@query("rule_no_date", """SELECT count(*) AS linhas, 0 AS colunas_data, true AS problema FROM customer""")
def rule_no_date(spark, sf):
    return profiling.no_date_rule(b.table(spark, sf, "customer"))


@query("rule_key_nulls", f"""{DIRTY} SELECT 'bairro' AS campo, count(*) - count(bairro) AS nulos FROM dirty
  UNION ALL SELECT 'tipo_ocorrencia', count(*) - count(tipo_ocorrencia) FROM dirty
  UNION ALL SELECT 'regional', count(*) - count(regional) FROM dirty""")
def rule_key_nulls(spark, sf):
    return profiling.key_nulls(b.dirty(spark, sf))


def _outlier_sql(columns: list[str], source: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS coluna, round(q1, 6) AS q1, round(q3, 6) AS q3, count(*) AS linhas,
        count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS fora,
        round(100.0 * count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) / count(*), 2)
          AS pct_fora,
        100.0 * count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) / count(*) > 5
          AS problema
        FROM {source}, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {source})
        GROUP BY q1, q3"""
        for c in columns
    )


@query("outliers_iqr", _outlier_sql(PRICE_COLUMNS, "lineitem"))
def outliers_iqr(spark, sf):
    out = quantiles.outliers(b.table(spark, sf, "lineitem"), PRICE_COLUMNS)
    return out.withColumns({"q1": F.round("q1", 6), "q3": F.round("q3", 6)})


@query("outliers_iqr_rain", f"{CALLS} {_outlier_sql(['chuva_mm'], 'calls')}")
def outliers_iqr_rain(spark, sf):
    out = quantiles.outliers(b.calls(spark, sf), ["chuva_mm"])
    return out.withColumns({"q1": F.round("q1", 6), "q3": F.round("q3", 6)})


@query("outliers_iqr_approx", " UNION ALL ".join(
    f"SELECT '{c}' AS coluna, count(*) AS linhas, true AS q1_dentro, true AS q3_dentro FROM lineitem" for c in PRICE_COLUMNS))
def outliers_iqr_approx(spark, sf):
    """Sketched quartiles, each held against the ranks its error allows."""
    items = b.table(spark, sf, "lineitem")
    quartiles = {r["coluna"]: (r["q1"], r["q3"]) for r in quantiles.outliers(items, PRICE_COLUMNS, approx=True).collect()}

    def within(column: str, q: float, p: float):
        below, upto = F.avg((F.col(column) < q).cast("int")), F.avg((F.col(column) <= q).cast("int"))
        return (below <= p + 0.002) & (upto >= p - 0.002)

    return items.agg(F.array(*[
        F.struct(
            F.lit(c).alias("coluna"), F.count(F.lit(1)).alias("linhas"),
            within(c, q1, 0.25).alias("q1_dentro"), within(c, q3, 0.75).alias("q3_dentro"),
        )
        for c, (q1, q3) in quartiles.items()
    ]).alias("m")).select(F.inline("m"))


@query("outliers_nan", f"""{MEASURED}, q AS (SELECT quantile_cont(chuva_mm, 0.25) AS q1, quantile_cont(chuva_mm, 0.75) AS q3 FROM finite),
  f AS (SELECT count(*) AS linhas, count(*) FILTER (WHERE chuva_mm < q1 - 1.5 * (q3 - q1) OR chuva_mm > q3 + 1.5 * (q3 - q1)) AS fora FROM seen, q)
  SELECT 'chuva_mm' AS coluna, round(q1, 6) AS q1, round(q3, 6) AS q3, linhas, fora, round(100.0 * fora / linhas, 2) AS pct_fora,
  100.0 * fora / linhas > 5 AS problema FROM f, q""")
def outliers_nan(spark, sf):
    """NaN is no outlier; an infinite reading is one, and moves no quartile."""
    out = quantiles.outliers(b.measured(spark, sf), ["chuva_mm"])
    return out.withColumns({"q1": F.round("q1", 6), "q3": F.round("q3", 6)})


@query("null_totals_nan", f"""{MEASURED} SELECT 'antes' AS momento, count(*) - count(chuva_mm) AS nulos FROM seen
  UNION ALL SELECT 'depois', 0""")
def null_totals_nan(spark, sf):
    raw = b.measured(spark, sf)
    return profiling.null_totals(raw, cleaning.fill_numeric(raw, ["chuva_mm"]))


@query("series_outliers", f"""{CALLS}, d AS (SELECT posto, CAST(data_atendimento AS DATE) AS dia,
  round(sum(chuva_mm), 2) AS total_dia FROM calls GROUP BY 1, 2),
  q AS (SELECT quantile_cont(total_dia, 0.25) AS q1, quantile_cont(total_dia, 0.75) AS q3 FROM d)
  SELECT posto, dia, total_dia FROM d, q
  WHERE total_dia < q1 - 1.5 * (q3 - q1) OR total_dia > q3 + 1.5 * (q3 - q1)""")
def series_outliers(spark, sf):
    daily = agg.sum_by(
        b.calls(spark, sf).withColumn("dia", F.to_date("data_atendimento")),
        "chuva_mm", "posto", "dia", out="total_dia",
    )
    # Several jobs follow, so the small aggregate becomes a table first.
    return quantiles.outlier_rows(materialize(daily, "daily"), "total_dia")


@query("null_totals", f"""{DIRTY}, c AS (SELECT
  count(*) - count(regional) + count(*) - count(bairro) + count(*) - count(tipo_ocorrencia)
  + count(*) - count(data_atendimento) + count(*) - count(quantidade) AS nulos,
  count(*) - count(data_atendimento) AS datas FROM dirty)
  SELECT 'antes' AS momento, nulos FROM c UNION ALL SELECT 'depois', datas FROM c""")
def null_totals(spark, sf):
    raw = b.dirty(spark, sf)
    filled = cleaning.fill_numeric(cleaning.fill_text(raw, ["regional", "bairro", "tipo_ocorrencia"]))
    return profiling.null_totals(raw, filled)


@query("date_format_census", f"""{DIRTY} SELECT CASE id_atendimento % 13 WHEN 0 THEN 'yyyy-MM-dd' WHEN 1 THEN 'dd/MM/yyyy'
  WHEN 2 THEN 'dd/MM/yyyy HH:mm:ss' WHEN 3 THEN 'dd/MM/yyyy HH:mm' WHEN 4 THEN 'yyyy/MM/dd'
  WHEN 5 THEN 'dd-MM-yyyy' WHEN 6 THEN 'dd-MM-yyyy HH:mm:ss' WHEN 7 THEN 'outro'
  WHEN 8 THEN 'vazio' WHEN 9 THEN 'yyyy-MM-dd HH:mm:ss' WHEN 10 THEN 'yyyy-MM-dd HH:mm:ss' ELSE 'yyyy-MM-dd HH:mm' END AS formato,
  count(*) AS n FROM dirty GROUP BY 1""")
def date_format_census(spark, sf):
    return profiling.date_shape_census(b.dirty(spark, sf), "data_atendimento")


DIAGNOSED = [
    "coluna", "linhas", "nulos", "valores_unicos", "pct_nulos", "classe", "muitos_nulos", "campo_chave_nulo",
    "pct_fora", "outliers",
]


@query("diagnosis", f"""{DIRTY}, p AS ({_profile_sql(DIRTY_TYPES, 'dirty')}),
  o AS ({_outlier_sql(['id_atendimento', 'quantidade'], 'dirty')})
  SELECT nome AS coluna, (SELECT count(*) FROM dirty) AS linhas, nulos, valores_unicos, pct_nulos,
  CASE WHEN nome = 'data_atendimento' THEN 'data' WHEN tipo = 'string' THEN 'texto' ELSE 'numerica' END AS classe,
  pct_nulos > 50 AS muitos_nulos,
  nome IN ('bairro', 'tipo_ocorrencia', 'regional') AND nulos > 0 AS campo_chave_nulo,
  pct_fora, problema AS outliers FROM p LEFT JOIN o ON nome = coluna""")
def diagnosis(spark, sf):
    return stages.diagnose(b.dirty(spark, sf)).select(*DIAGNOSED)


def _per_file_sql(column: str, kind: str, key_field: bool) -> str:
    text = kind == "texto" or column == "data_atendimento"
    odd = f"count(*) FILTER (WHERE regexp_matches({column}, '[^\\x00-\\x7F]'))" if text else "NULL"
    first = f"""(SELECT valor FROM (SELECT {column} AS valor, count(*) AS n FROM f g WHERE g.arquivo = f.arquivo
      AND {column} IS NOT NULL GROUP BY 1) ORDER BY n DESC, valor LIMIT 1)""" if key_field else "NULL"
    share = f"""100.0 * count(*) FILTER (WHERE {column} < q1 - 1.5 * (q3 - q1) OR {column} > q3 + 1.5 * (q3 - q1)) / count(*)""" if kind == "numerica" else None
    source = f"(SELECT *, quantile_cont({column}, 0.25) OVER w AS q1, quantile_cont({column}, 0.75) OVER w AS q3 FROM f WINDOW w AS (PARTITION BY arquivo)) f" if share else "f"
    nulls = f"100.0 * (count(*) - count({column})) / count(*)"
    return f"""SELECT arquivo, '{column}' AS coluna, count(*) AS linhas, count(*) - count({column}) AS nulos,
      count(DISTINCT {column}) AS valores_unicos, round({nulls}, 2) AS pct_nulos, '{kind}' AS classe,
      round({nulls}, 2) > 50 AS muitos_nulos, false AS sem_data, {str(key_field).lower()} AND count(*) > count({column}) AS campo_chave_nulo,
      CAST({odd} AS BIGINT) AS fora_do_ascii, {first} AS principal,
      {f"round({share}, 2)" if share else "CAST(NULL AS DOUBLE)"} AS pct_fora, {f"{share} > 5" if share else "CAST(NULL AS BOOLEAN)"} AS outliers
      FROM {source} GROUP BY arquivo"""


@query("diagnosis_per_file", f"""{DIRTY}, f AS (SELECT dirty.*, 'a' || id_atendimento % 4 AS arquivo FROM dirty) """ + " UNION ALL ".join(
    _per_file_sql(c, k, c in ("regional", "bairro", "tipo_ocorrencia"))
    for c, k in {
        "id_atendimento": "numerica", "regional": "texto", "bairro": "texto",
        "tipo_ocorrencia": "texto", "data_atendimento": "data", "quantidade": "numerica",
    }.items()
))
def diagnosis_per_file(spark, sf):
    """All problems of each file, and the most frequent value of its categorical columns."""
    rows = b.dirty(spark, sf).withColumn("arquivo", F.concat(F.lit("a"), F.col("id_atendimento") % 4))
    found = stages.diagnose(rows, ("arquivo",))
    return found.withColumn("principal", F.col("principais")[0]["valor"]).select(
        "arquivo", *DIAGNOSED, "sem_data", "fora_do_ascii", "principal"
    )


@query("sample_head", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice
  FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice LIMIT 1000""")
def sample_head(spark, sf):
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    return profiling.sample_head(b.table(spark, sf, "lineitem").select(*columns), columns, 1000)
