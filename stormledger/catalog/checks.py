"""Data-quality rules, rain joins, catalogue membership and source comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from stormledger import bindings as b
from stormledger.catalog.core import query
from stormledger.catalog.counting import MONTHLY, RAIN_CASE
from stormledger.functions.dates import wall_seconds
from stormledger.operators import aggregates as agg, joins, quality
from stormledger.operators.cleaning import parse_date_columns
from stormledger.plans import datasets

DIRTY, ORD = f"WITH {b.DIRTY_SQL}", f"WITH {b.ORDERS_SQL}"
INC, CALLS = f"WITH {b.INCIDENTS_SQL}", f"WITH {b.CALLS_SQL}"
PARSED = b.PARSE_SQL.format(c="data_atendimento")
# The day the freshness rules count back from.
REFERENCE = "2024-01-31 00:00:00"


def _reference():
    return F.lit(REFERENCE).cast("timestamp_ntz")


def _rule_sql(name: str, severity: str, failed: str, source: str, tolerance: float = 0) -> str:
    bad = f"count(*) FILTER (WHERE {failed})"
    return f"""SELECT '{name}' AS regra, '{severity}' AS severidade, count(*) AS verificados, {bad} AS falhas,
      round({bad} / count(*), 6) AS razao, {bad} / count(*) <= {tolerance} AS aprovado FROM {source}"""


# --- joins ------------------------------------------------------------------

@query("join_month_rain", f"""{MONTHLY} SELECT ano, mes, total_ocorrencias, CAST({RAIN_CASE} AS INTEGER) AS chuva_mm FROM m""")
def join_month_rain(spark, sf):
    return joins.join_month_rain(agg.count_by(b.orders(spark, sf), "ano", "mes"))


DAILY_SQL = f"""{ORD}, r AS (SELECT CAST(l_shipdate AS DATE) AS dia, round(sum(l_quantity), 2) AS chuva_mm
  FROM lineitem GROUP BY 1), i AS (SELECT CAST(data_atendimento AS DATE) AS dia, count(*) AS n FROM ord GROUP BY 1),
  j AS (SELECT coalesce(r.dia, i.dia) AS dia, chuva_mm, coalesce(n, 0) AS total_ocorrencias
  FROM r FULL JOIN i ON r.dia = i.dia)"""


def _daily(spark, sf):
    return joins.daily_rain_and_incidents(
        b.table(spark, sf, "lineitem"), "l_shipdate", "l_quantity",
        b.orders(spark, sf), "data_atendimento",
    )


@query("join_daily_rain", f"{DAILY_SQL} SELECT * FROM j")
def join_daily_rain(spark, sf):
    return _daily(spark, sf)


@query("corr_rain_daily", f"""{DAILY_SQL} SELECT CAST(year(dia) AS INTEGER) AS ano,
  round(corr(chuva_mm, total_ocorrencias), 6) AS coeficiente, count(chuva_mm) AS n,
  corr(chuva_mm, total_ocorrencias) > 0.5 AS acima_do_limite FROM j GROUP BY 1""")
def corr_rain_daily(spark, sf):
    daily = _daily(spark, sf).withColumn("ano", F.year("dia"))
    return joins.correlation(daily, "chuva_mm", "total_ocorrencias", "ano")


@query("corr_rain", f"""{MONTHLY}, r AS (SELECT *, CAST({RAIN_CASE} AS INTEGER) AS chuva_mm FROM m)
  SELECT round(corr(chuva_mm, total_ocorrencias), 6) AS coeficiente, count(*) AS n,
  corr(chuva_mm, total_ocorrencias) > 0.5 AS acima_do_limite FROM r""")
def corr_rain(spark, sf):
    return joins.correlation(datasets.rain_correlation(b.orders(spark, sf)), "chuva_mm", "total_ocorrencias")


KNOWN_KINDS = ["click", "view", "signup"]


@query("catalog_membership", f"""{CALLS} SELECT CASE WHEN tipo_ocorrencia IN ('click', 'view', 'signup')
  THEN tipo_ocorrencia ELSE 'outro' END AS tipo_catalogado, count(*) AS n FROM calls GROUP BY 1""")
def catalog_membership(spark, sf):
    tagged = joins.tag_listed(
        b.calls(spark, sf), "tipo_ocorrencia", KNOWN_KINDS, "tipo_catalogado", "outro"
    )
    return tagged.groupBy("tipo_catalogado").agg(F.count(F.lit(1)).alias("n"))


@query("catalog_membership_ids", """SELECT CASE WHEN l.doc_id IS NULL THEN 'desconhecido'
  ELSE CAST(d.doc_id AS VARCHAR) END AS rotulado, d.doc_id FROM documents d
  LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id""")
def catalog_membership_ids(spark, sf):
    """A catalogue that grows with the data."""
    docs = b.table(spark, sf, "documents").select("doc_id")
    return joins.tag_members(docs, "doc_id", b.table(spark, sf, "labels"), "doc_id", "rotulado", "desconhecido")


@query("catalog_unknown", """SELECT doc_id, count(*) AS n FROM documents
  WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY doc_id""")
def catalog_unknown(spark, sf):
    return joins.unknown_keys(
        b.table(spark, sf, "documents"), "doc_id", b.table(spark, sf, "labels"), "doc_id"
    )


@query("orphans", """SELECT o_orderkey AS chave, 'sem_itens' AS lado FROM orders
  WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
  UNION ALL SELECT DISTINCT l_orderkey, 'sem_pedido' FROM lineitem
  WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)""")
def orphans(spark, sf):
    return joins.orphans(
        b.table(spark, sf, "orders"), "o_orderkey", "sem_itens",
        b.table(spark, sf, "lineitem"), "l_orderkey", "sem_pedido",
    )


# --- quality rules ----------------------------------------------------------

@query("dq_required", f"""{DIRTY}, p AS (SELECT *, {PARSED} AS d FROM dirty)
  SELECT d IS NOT NULL AND tipo_ocorrencia IS NOT NULL AS aceito, count(*) AS n FROM p GROUP BY 1""")
def dq_required(spark, sf):
    parsed = parse_date_columns(b.dirty(spark, sf))
    marked = quality.mark_accepted(parsed, ["data_atendimento", "tipo_ocorrencia"])
    return marked.groupBy("aceito").agg(F.count(F.lit(1)).alias("n"))


@query("dq_fill_unknown", f"""{DIRTY} SELECT id_atendimento, coalesce(bairro, 'desconhecido') AS bairro FROM dirty""")
def dq_fill_unknown(spark, sf):
    return quality.fill_unknown(b.dirty(spark, sf), "bairro").select("id_atendimento", "bairro")


@query("dq_date_format", f"""{DIRTY} SELECT CASE WHEN id_atendimento % 13 IN (0, 9, 10, 12) THEN 'ok'
  WHEN {PARSED} IS NOT NULL THEN 'convertido' ELSE 'invalido' END AS situacao, count(*) AS n,
  strftime(min({PARSED}), '%Y-%m-%d') AS primeira FROM dirty GROUP BY 1""")
def dq_date_format(spark, sf):
    marked = quality.convert_dates(b.dirty(spark, sf), "data_atendimento")
    return marked.groupBy("situacao").agg(
        F.count(F.lit(1)).alias("n"),
        F.date_format(F.min("data_convertida"), "yyyy-MM-dd").alias("primeira"),
    )


@query("dq_range", " UNION ALL ".join([
    _rule_sql("value_no_intervalo", "alta", "value IS NULL OR value NOT BETWEEN 0 AND 500", "events"),
    _rule_sql("user_id_no_intervalo", "alta", "user_id IS NULL OR user_id NOT BETWEEN 10 AND 120", "events"),
]))
def dq_range(spark, sf):
    return quality.check(b.table(spark, sf, "events"), [
        quality.range_rule("value", 0, 500), quality.range_rule("user_id", 10, 120),
    ])


@query("dq_response_range", _rule_sql(
    "minutos_no_intervalo", "alta", "NOT (epoch(l_shipdate - o_orderdate) / 60 BETWEEN 0 AND 2880)",
    "orders JOIN lineitem ON o_orderkey = l_orderkey", 0.05,
))
def dq_response_range(spark, sf):
    """Response times of 0 to 2880 minutes."""
    answered = b.orders(spark, sf).join(
        b.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id_atendimento"), "l_shipdate"),
        "id_atendimento",
    )
    waited = wall_seconds(F.col("l_shipdate")) - wall_seconds(F.col("data_atendimento"))
    rule = quality.Rule("minutos_no_intervalo", quality.HIGH, (waited / 60).between(0, 2880), 0.05)
    return quality.check(answered, [rule])


@query("dq_daily_range", f"""{CALLS} SELECT posto, CAST(data_atendimento AS DATE) AS dia,
  round(sum(chuva_mm), 2) AS total_dia FROM calls GROUP BY 1, 2 HAVING sum(chuva_mm) NOT BETWEEN 0 AND 300""")
def dq_daily_range(spark, sf):
    return quality.daily_range(
        b.calls(spark, sf), "data_atendimento", F.col("chuva_mm"), 0, 300, "posto"
    )


@query("dq_alerts_per_day", f"""{CALLS} SELECT tipo_ocorrencia, CAST(data_atendimento AS DATE) AS dia,
  CAST(count(*) AS DOUBLE) AS total_dia FROM calls GROUP BY 1, 2 HAVING count(*) > 60""")
def dq_alerts_per_day(spark, sf):
    return quality.daily_range(
        b.calls(spark, sf), "data_atendimento", F.lit(1.0), 0, 60, "tipo_ocorrencia"
    )


@query("dq_alerts_limit", f"""{CALLS} SELECT CAST(data_atendimento AS DATE) AS dia,
  CAST(count(*) AS DOUBLE) AS total_dia FROM calls GROUP BY 1 HAVING count(*) > 1000""")
def dq_alerts_limit(spark, sf):
    """At most 1000 alerts a day."""
    return quality.daily_range(b.calls(spark, sf), "data_atendimento", F.lit(1.0), 0, 1000)


FRESH_SQL = "ts IS NULL OR ts < TIMESTAMP '2024-01-31' - INTERVAL {n} DAY OR ts > TIMESTAMP '2024-01-31'"


@query("dq_freshness", " UNION ALL ".join([
    _rule_sql("ts_recente", "media", FRESH_SQL.format(n=30), "events"),
    _rule_sql("ts_recente", "media", FRESH_SQL.format(n=7), "events"),
]))
def dq_freshness(spark, sf):
    return quality.check(b.table(spark, sf, "events"), [
        quality.freshness_rule("ts", _reference(), 30), quality.freshness_rule("ts", _reference(), 7),
    ])


@query("dq_duplicates", """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
  GROUP BY 1, 2 HAVING count(*) > 1""")
def dq_duplicates(spark, sf):
    return quality.duplicates(b.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


LATEST_ORDER = "l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus"


@query("dedup_latest", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LATEST_ORDER}) AS r FROM lineitem)
  WHERE r = 1""")
def dedup_latest(spark, sf):
    tie = ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax",
           "l_returnflag", "l_linestatus"]
    rows = quality.keep_latest(
        b.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate",
        [F.col(c) for c in tie],
    )
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


@query("dq_bbox", _rule_sql(
    "coordenadas_na_area", "media", "NOT (p_size BETWEEN 5 AND 45 AND p_retailprice BETWEEN 910 AND 1050)", "part"
))
def dq_bbox(spark, sf):
    rule = quality.bbox_rule("p_size", "p_retailprice", (5, 45), (910, 1050))
    return quality.check(b.table(spark, sf, "part"), [rule])


@query("dq_null_ratio", f"{DIRTY} " + " UNION ALL ".join(
    _rule_sql(c, "alta", f"{c} IS NULL", "dirty", 0.15)
    for c in ("id_atendimento", "regional", "bairro", "tipo_ocorrencia", "data_atendimento", "quantidade")
))
def dq_null_ratio(spark, sf):
    return quality.null_ratio(b.dirty(spark, sf))


@query("dq_null_ratio_nan", f"WITH {b.MEASURED_SQL} " + " UNION ALL ".join(
    _rule_sql(c, "alta", f"{c} IS NULL", "seen", 0.15) for c in ("id", "quando", "chuva_mm")
))
def dq_null_ratio_nan(spark, sf):
    return quality.null_ratio(b.measured(spark, sf))


@query("dq_required_nan", f"""WITH {b.MEASURED_SQL} SELECT chuva_mm IS NOT NULL AS aceito, count(*) AS n,
  (SELECT count(*) - count(chuva_mm) FROM seen) AS falhas FROM seen GROUP BY 1""")
def dq_required_nan(spark, sf):
    """NaN is no value, as a field and as a rule."""
    rows = b.measured(spark, sf)
    failed = quality.check(rows, quality.required_rules(["chuva_mm"])).select("falhas").scalar()
    marked = quality.mark_accepted(rows, ["id", "chuva_mm"])
    return marked.groupBy("aceito").agg(F.count(F.lit(1)).alias("n")).withColumn("falhas", failed)


DUP_SQL = """SELECT 'duplicatas' AS regra, 'alta' AS severidade, CAST(sum(n) AS BIGINT) AS verificados,
  CAST(sum(n - 1) AS BIGINT) AS falhas, round(sum(n - 1) / sum(n), 6) AS razao,
  sum(n - 1) / sum(n) <= 0.05 AS aprovado
  FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)"""


@query("dq_dup_ratio", DUP_SQL)
def dq_dup_ratio(spark, sf):
    return quality.duplicate_ratio(b.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_schema", f"""{DIRTY} SELECT 'id_atendimento' AS coluna, 'bigint' AS esperado, 'bigint' AS encontrado,
  'ok' AS situacao, 0 AS invalidos
  UNION ALL SELECT 'data_atendimento', 'date', 'string', 'tipo_diferente',
    count(*) FILTER (WHERE data_atendimento IS NOT NULL AND id_atendimento % 13 NOT IN (0, 9, 10, 11, 12)) FROM dirty
  UNION ALL SELECT 'status', 'string', NULL, 'ausente', 0
  UNION ALL SELECT 'regional', NULL, 'string', 'extra', 0 UNION ALL SELECT 'bairro', NULL, 'string', 'extra', 0
  UNION ALL SELECT 'tipo_ocorrencia', NULL, 'string', 'extra', 0
  UNION ALL SELECT 'quantidade', NULL, 'double', 'extra', 0""")
def dq_schema(spark, sf):
    return quality.schema_check(b.dirty(spark, sf), {
        "id_atendimento": "bigint", "data_atendimento": "date", "status": "string",
    })


RAIN_RULES_SQL = [
    _rule_sql("ts_presente", "critica", "ts IS NULL", "events"),
    _rule_sql("user_id_presente", "critica", "user_id IS NULL", "events"),
    _rule_sql("value_presente", "critica", "value IS NULL", "events"),
    _rule_sql("value_no_intervalo", "alta", "value IS NULL OR value NOT BETWEEN 0 AND 500", "events"),
    _rule_sql("ts_recente", "media", FRESH_SQL.format(n=30), "events"),
]


@query("dq_rules_rain", " UNION ALL ".join(RAIN_RULES_SQL))
def dq_rules_rain(spark, sf):
    return quality.check(
        b.table(spark, sf, "events"), quality.rain_rules("ts", "user_id", "value", _reference())
    )


@query("dq_rules_incidents", f"""WITH p AS (WITH {b.DIRTY_SQL} SELECT * REPLACE ({PARSED} AS data_atendimento) FROM dirty) """ + " UNION ALL ".join([
    _rule_sql("data_atendimento_presente", "critica", "data_atendimento IS NULL", "p"),
    _rule_sql("tipo_ocorrencia_presente", "critica", "tipo_ocorrencia IS NULL", "p"),
    _rule_sql("bairro_presente", "alta", "bairro IS NULL", "p"),
    _rule_sql("data_atendimento_recente", "media", """data_atendimento IS NULL OR data_atendimento < TIMESTAMP '2001-07-25'
      OR data_atendimento > TIMESTAMP '2001-08-01'""", "p"),
]))
def dq_rules_incidents(spark, sf):
    reference = F.lit("2001-08-01 00:00:00").cast("timestamp_ntz")
    parsed = parse_date_columns(b.dirty(spark, sf))
    return quality.check(
        parsed, quality.incident_rules("data_atendimento", "tipo_ocorrencia", "bairro", reference)
    )


@query("dq_flags", """SELECT event_id, concat_ws(',',
  CASE WHEN value NOT BETWEEN 0 AND 50 THEN 'value_no_intervalo' END,
  CASE WHEN ts < TIMESTAMP '2024-01-31' - INTERVAL 7 DAY OR ts > TIMESTAMP '2024-01-31' THEN 'ts_recente' END)
  AS regras_violadas FROM events""")
def dq_flags(spark, sf):
    rules = [quality.range_rule("value", 0, 50), quality.freshness_rule("ts", _reference(), 7)]
    flagged = quality.flag(b.table(spark, sf, "events"), rules)
    return flagged.select("event_id", F.concat_ws(",", "regras_violadas").alias("regras_violadas"))


@query("dq_scorecard", f"""WITH r AS ({' UNION ALL '.join(RAIN_RULES_SQL)} UNION ALL {DUP_SQL})
  SELECT count(*) AS regras, count(*) FILTER (WHERE aprovado) AS aprovadas,
  count(*) FILTER (WHERE severidade = 'critica' AND NOT aprovado) AS falhas_criticas,
  round(1 - sum(falhas) / sum(verificados), 6) AS qualidade,
  1 - sum(falhas) / sum(verificados) >= 0.95
    AND count(*) FILTER (WHERE severidade = 'critica' AND NOT aprovado) = 0 AS aceito FROM r""")
def dq_scorecard(spark, sf):
    return quality.scorecard([dq_rules_rain(spark, sf), dq_dup_ratio(spark, sf)])


def _card_sql(rules: str, name: str) -> str:
    return f"""SELECT count(*) AS regras, count(*) FILTER (WHERE aprovado) AS aprovadas,
      count(*) FILTER (WHERE severidade = 'critica' AND NOT aprovado) AS falhas_criticas,
      round(1 - sum(falhas) / sum(verificados), 6) AS qualidade, 1 - sum(falhas) / sum(verificados) >= 0.95
      AND count(*) FILTER (WHERE severidade = 'critica' AND NOT aprovado) = 0 AS aceito,
      '{name}' AS conjunto FROM ({rules})"""


@query("dq_scorecards", " UNION ALL ".join([
    _card_sql(" UNION ALL ".join(RAIN_RULES_SQL), "chuva"), _card_sql(DUP_SQL, "itens"),
    # 5 of 100 failures are just good enough, 50,001 of a million are not.
    "SELECT 1, 0, 0, 0.95, true, 'limite'", "SELECT 1, 0, 0, 0.949999, false, 'abaixo'",
]))
def dq_scorecards(spark, sf):
    """One verdict per dataset; the last two are at the limit and just below it."""
    def edge(falhas: int, verificados: int):
        rows = [("borda", "alta", verificados, falhas, False)]
        return [spark.createDataFrame(rows, "regra string, severidade string, verificados bigint, falhas bigint, aprovado boolean")]

    return quality.scorecards({
        "chuva": [dq_rules_rain(spark, sf)], "itens": [dq_dup_ratio(spark, sf)],
        "limite": edge(5, 100), "abaixo": edge(50_001, 1_000_000),
    })


@query("dq_stations", f"""{CALLS}, s AS (SELECT posto, CASE WHEN posto % 7 = 0 THEN 0 WHEN posto % 7 = 1 THEN chuva_mm / 1e6
  ELSE chuva_mm END AS mm FROM calls) SELECT posto, round(sum(mm), 2) AS chuva_mm, coalesce(sum(mm) > 0, false) AS valido
  FROM s GROUP BY posto""")
def dq_stations(spark, sf):
    """Stations without rain fail; hardly any rain is rain."""
    mm = F.when(F.col("posto") % 7 == 0, 0.0).when(F.col("posto") % 7 == 1, F.col("chuva_mm") / 1e6).otherwise(F.col("chuva_mm"))
    return agg.positive_check(b.calls(spark, sf).withColumn("chuva_mm", mm), "chuva_mm", "posto", out="chuva_mm")
