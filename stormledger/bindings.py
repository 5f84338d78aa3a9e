"""Test tables seen as incident, rain and raw-record frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stormledger.functions import dates


# Column types of the tables in use; a given schema saves the job that infers one.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-level incidents without the area: no join needed for calendar questions."""
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id_atendimento"),
        F.col("o_custkey").alias("id_solicitante"),
        F.col("o_orderdate").alias("data_atendimento"),
        F.col("o_orderpriority").alias("tipo_ocorrencia"),
        F.col("o_orderstatus").alias("grau_de_risco"),
        F.col("o_totalprice").alias("quantidade"),
    )
    return o.withColumns(dates.calendar(F.col("data_atendimento")))


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents with area and region.

    Spark broadcasts the customers only where their size allows it. Nations
    (25) and regions (5) are fixed tables at every scale factor.
    """
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id_solicitante"), "c_nationkey"
    )
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("bairro"), "n_regionkey"
    )
    region = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("regional")
    )
    return (
        orders(spark, sf_dir)
        # an incident of an unknown customer stays, without an area
        .join(customer, "id_solicitante", "left")
        .join(F.broadcast(nation), "c_nationkey", "left")
        .join(F.broadcast(region), "n_regionkey", "left")
        .drop("c_nationkey", "n_regionkey")
    )


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents with a time of day: events by type and user."""
    e = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id_atendimento"),
        F.col("ts").alias("data_atendimento"),
        F.col("user_id").alias("posto"),
        F.col("event_type").alias("tipo_ocorrencia"),
        F.col("value").alias("chuva_mm"),
    )
    return e.withColumns(dates.calendar(F.col("data_atendimento")))


def measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rain readings with null, NaN and infinite values among them."""
    key, value = F.col("event_id"), F.col("value")
    reading = (
        F.when(key % 10 == 3, F.lit(float("nan"))).when(key % 10 == 5, F.lit(None))
        .when(key % 100 == 7, F.lit(float("inf"))).when(key % 100 == 17, F.lit(float("-inf"))).otherwise(value)
    )
    return table(spark, sf_dir, "events").select(
        key.alias("id"), F.col("ts").alias("quando"), reading.alias("chuva_mm")
    )


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents as damaged raw text: mixed case, padding, nulls and date formats."""
    i = incidents(spark, sf_dir)
    key = F.col("id_atendimento")
    area = (
        F.when(key % 5 == 0, F.lower("bairro"))
        .when(key % 5 == 1, F.concat(F.lit("  "), F.col("bairro"), F.lit(" ")))
        .when(key % 5 == 2, F.lit(None))
        .when(key % 5 == 3, F.lit(" Água Fria "))
        .otherwise(F.col("bairro"))
    )
    kind = (
        F.when(key % 4 == 0, F.lit("ALAGAMENTO"))
        .when(key % 4 == 1, F.lit("Risco Geotécnico "))
        .when(key % 4 == 2, F.lit(None))
        .otherwise(F.col("tipo_ocorrencia"))
    )
    region = (
        F.when(key % 6 == 0, F.lit("Recife"))
        .when(key % 6 == 1, F.lit("RECIFE/PE"))
        .when(key % 6 == 2, F.lit(None))
        .otherwise(F.col("regional"))
    )
    return i.select(
        "id_atendimento", region.alias("regional"), area.alias("bairro"),
        kind.alias("tipo_ocorrencia"), raw_date(F.col("data_atendimento"), key).alias("data_atendimento"),
        F.when(key % 3 != 0, F.col("quantidade")).alias("quantidade"),
    )


def raw_date(date, key):
    """A date as text in one of the accepted formats, or not a date at all."""
    spelled = [
        F.date_format(date, "yyyy-MM-dd"),
        F.date_format(date, "dd/MM/yyyy"),
        F.concat(F.date_format(date, "dd/MM/yyyy"), F.lit(" 10:11:12")),
        F.concat(F.date_format(date, "dd/MM/yyyy"), F.lit(" 10:11")),
        F.date_format(date, "yyyy/MM/dd"),
        F.date_format(date, "dd-MM-yyyy"),
        F.concat(F.date_format(date, "dd-MM-yyyy"), F.lit(" 10:11:12")),
        F.lit("lixo"), F.lit(None),
        F.concat(F.date_format(date, "yyyy-MM-dd"), F.lit(" 10:11:12")),
        F.concat(F.date_format(date, "yyyy-MM-dd"), F.lit("T10:11:12.500000")),
        F.concat(F.date_format(date, "yyyy-MM-dd"), F.lit(" 25:99")),
        F.concat(F.date_format(date, "yyyy-MM-dd"), F.lit("T10:11")),
    ]
    out = F.when(key % 13 == 0, spelled[0])
    for i, text in enumerate(spelled[1:], start=1):
        out = out.when(key % 13 == i, text)
    return out


def oracle_raw_date() -> str:
    """The same text dates in SQL."""
    d = "o_orderdate"
    return f"""CASE o_orderkey % 13
        WHEN 0 THEN strftime({d}, '%Y-%m-%d') WHEN 1 THEN strftime({d}, '%d/%m/%Y')
        WHEN 2 THEN strftime({d}, '%d/%m/%Y') || ' 10:11:12'
        WHEN 3 THEN strftime({d}, '%d/%m/%Y') || ' 10:11'
        WHEN 4 THEN strftime({d}, '%Y/%m/%d') WHEN 5 THEN strftime({d}, '%d-%m-%Y')
        WHEN 6 THEN strftime({d}, '%d-%m-%Y') || ' 10:11:12' WHEN 7 THEN 'lixo'
        WHEN 9 THEN strftime({d}, '%Y-%m-%d') || ' 10:11:12'
        WHEN 10 THEN strftime({d}, '%Y-%m-%d') || 'T10:11:12.500000'
        WHEN 11 THEN strftime({d}, '%Y-%m-%d') || ' 25:99'
        WHEN 12 THEN strftime({d}, '%Y-%m-%d') || 'T10:11' END"""


CALENDAR_SQL = """
  CAST(year({d}) AS INTEGER) AS ano, CAST(month({d}) AS INTEGER) AS mes,
  CAST(day({d}) AS INTEGER) AS dia, CAST(hour({d}) AS INTEGER) AS hora,
  CAST(isodow({d}) - 1 AS INTEGER) AS dia_semana, dayname({d}) AS dia_semana_nome,
  CASE WHEN month({d}) IN (12, 1, 2) THEN 'verao' WHEN month({d}) IN (3, 4, 5) THEN 'outono'
       WHEN month({d}) IN (6, 7, 8) THEN 'inverno' WHEN month({d}) IN (9, 10, 11) THEN 'primavera'
  END AS estacao"""

ORDERS_SQL = f"""ord AS (
  SELECT o_orderkey AS id_atendimento, o_custkey AS id_solicitante, o_orderdate AS data_atendimento,
  o_orderpriority AS tipo_ocorrencia, o_orderstatus AS grau_de_risco, o_totalprice AS quantidade,
  {CALENDAR_SQL.format(d='o_orderdate')} FROM orders)"""

INCIDENTS_SQL = f"""{ORDERS_SQL}, inc AS (
  SELECT ord.*, n_name AS bairro, r_name AS regional FROM ord
  LEFT JOIN customer ON id_solicitante = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey)"""

CALLS_SQL = f"""calls AS (
  SELECT event_id AS id_atendimento, ts AS data_atendimento, user_id AS posto,
  event_type AS tipo_ocorrencia, value AS chuva_mm, {CALENDAR_SQL.format(d='ts')} FROM events)"""

MEASURED_SQL = """measured AS (SELECT event_id AS id, ts AS quando, CASE WHEN event_id % 10 = 3 THEN 'NaN'::DOUBLE
  WHEN event_id % 10 = 5 THEN NULL WHEN event_id % 100 = 7 THEN 'Infinity'::DOUBLE
  WHEN event_id % 100 = 17 THEN '-Infinity'::DOUBLE ELSE value END AS chuva_mm FROM events),
  seen AS (SELECT id, quando, CASE WHEN NOT isnan(chuva_mm) THEN chuva_mm END AS chuva_mm FROM measured),
  finite AS (SELECT chuva_mm FROM seen WHERE isfinite(chuva_mm))"""

DIRTY_SQL = f"""dirty AS (
  SELECT o_orderkey AS id_atendimento,
  CASE o_orderkey % 6 WHEN 0 THEN 'Recife' WHEN 1 THEN 'RECIFE/PE' WHEN 2 THEN NULL ELSE r_name END
    AS regional,
  CASE o_orderkey % 5 WHEN 0 THEN lower(n_name) WHEN 1 THEN '  ' || n_name || ' ' WHEN 2 THEN NULL
    WHEN 3 THEN ' Água Fria ' ELSE n_name END AS bairro,
  CASE o_orderkey % 4 WHEN 0 THEN 'ALAGAMENTO' WHEN 1 THEN 'Risco Geotécnico ' WHEN 2 THEN NULL
    ELSE o_orderpriority END AS tipo_ocorrencia,
  {oracle_raw_date()} AS data_atendimento,
  CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS quantidade
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey)"""

PARSE_SQL = """try_strptime({c}, ['%Y-%m-%d', '%d/%m/%Y', '%d/%m/%Y %H:%M:%S', '%d/%m/%Y %H:%M',
  '%Y/%m/%d', '%d-%m-%Y', '%d-%m-%Y %H:%M:%S', '%Y-%m-%d %H:%M:%S', '%Y-%m-%dT%H:%M:%S.%f',
  '%Y-%m-%dT%H:%M'])"""
