"""File sources and sinks: each query writes given tables as raw files and reads them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stormledger import bindings as b
from stormledger.catalog.core import query
from stormledger.functions import dates
from stormledger.operators import aggregates as agg, profiling
from stormledger.plans import datasets, stages
from stormledger.session import materialize, scratch_path
from stormledger.sources import delimited, records, sinks

INC, ORD = f"WITH {b.INCIDENTS_SQL}", f"WITH {b.ORDERS_SQL}"
RAW_COLUMNS = ["Id", "Regional", "Data", "Ocorrencia", "Bairro", "Quantidade"]


def _raw(spark, sf) -> DataFrame:
    """Incidents with raw headers; the text of one column needs quotes."""
    return b.incidents(spark, sf).select(
        F.col("id_atendimento").alias("Id"), F.col("regional").alias("Regional"),
        F.date_format("data_atendimento", "yyyy-MM-dd").alias("Data"),
        F.concat(F.col("tipo_ocorrencia"), F.lit("; "), F.col("grau_de_risco")).alias("Ocorrencia"),
        F.col("bairro").alias("Bairro"), F.col("quantidade").alias("Quantidade"), "ano",
    )


RAW_SQL = f"""{INC}, raw AS (SELECT CAST(id_atendimento AS VARCHAR) AS "Id", regional AS "Regional",
  strftime(data_atendimento, '%Y-%m-%d') AS "Data", tipo_ocorrencia || '; ' || grau_de_risco AS "Ocorrencia",
  bairro AS "Bairro", round(quantidade, 2) AS "Quantidade", ano FROM inc)"""


def _write_raw(rows: DataFrame, path: str, sep: str = ";", encoding: str = "UTF-8") -> None:
    """One folder per year of quoted files with a header."""
    (
        rows.write.mode("append").partitionBy("ano")
        .option("header", True).option("sep", sep).option("encoding", encoding)
        .option("quoteAll", True).option("escape", '"').csv(path)
    )


def _write_corpus(spark, sf) -> str:
    """A corpus with three layouts: Latin-1 and ";", UTF-8 and ";", UTF-8 and ","."""
    path = scratch_path(spark, "corpus")
    raw = _raw(spark, sf).withColumn("Mês", dates.month_name(F.to_date("Data").cast("date").substr(6, 2).cast("int")))
    old = F.col("ano") <= 1996
    middle = F.col("ano").between(1997, 1999)
    _write_raw(raw.where(old), path, encoding="ISO-8859-1")
    _write_raw(raw.where(middle).drop("Mês").withColumn("Status", F.lit("fechado")), path)
    _write_raw(raw.where(F.col("ano") >= 2000), path, sep=",")
    return path


MONTH_NAME_SQL = "list_extract(['Janeiro','Fevereiro','Março','Abril','Maio','Junho','Julho','Agosto','Setembro','Outubro','Novembro','Dezembro'], CAST(\"Data\"[6:7] AS INTEGER))"


@query("src_csv_semicolon", f'{RAW_SQL} SELECT "Id", "Regional", "Data", "Ocorrencia", "Bairro", "Quantidade" FROM raw')
def src_csv_semicolon(spark, sf):
    path = scratch_path(spark, "semicolon")
    _write_raw(_raw(spark, sf), path)
    rows = delimited.read_delimited(spark, path, RAW_COLUMNS)
    return rows.withColumn("Quantidade", F.round(F.col("Quantidade").try_cast("double"), 2))


@query("src_csv_bad_lines", """SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus || ';' || o_orderpriority AS texto,
  CASE WHEN o_orderkey % 10 <> 5 THEN strftime(o_orderdate, '%Y-%m-%d') END AS dia
  FROM orders WHERE o_orderkey % 10 NOT IN (3, 4)""")
def src_csv_bad_lines(spark, sf):
    """Lines with a surplus field or a trailing separator go, short lines stay."""
    key = F.col("o_orderkey")
    quoted = F.format_string('"%s;%s"', "o_orderstatus", "o_orderpriority")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    head = F.concat(key.cast("string"), F.lit(";"), quoted)
    line = (
        F.when(key % 10 == 5, head)
        .when(key % 10 == 3, F.concat(head, F.lit(";"), day, F.lit(";demais")))
        .when(key % 10 == 4, F.concat(head, F.lit(";"), day, F.lit(";")))
        .otherwise(F.concat(head, F.lit(";"), day))
    )
    path = scratch_path(spark, "bad-lines")
    b.table(spark, sf, "orders").select(line.alias("value")).write.text(path)
    return delimited.read_delimited(spark, path, ["id", "texto", "dia"], header=False)


def _layout_case(old: str, middle: str, new: str) -> str:
    return f"CASE WHEN ano <= 1996 THEN {old} WHEN ano <= 1999 THEN {middle} ELSE {new} END"


@query("src_encoding_probe", f"""{ORD} SELECT ano, {_layout_case("'ISO-8859-1'", "'UTF-8'", "'UTF-8'")} AS encoding,
  count(*) AS registros FROM ord GROUP BY 1, 2""")
def src_encoding_probe(spark, sf):
    probed = delimited.probe_files(spark, _write_corpus(spark, sf))
    return probed.groupBy(delimited.file_year(F.col("caminho")).alias("ano"), "encoding").agg(
        F.sum(F.col("linhas") - 1).alias("registros")
    )


@query("src_separator_probe", f"""{ORD} SELECT ano, {_layout_case("';'", "';'", "','")} AS separador,
  count(*) AS registros FROM ord GROUP BY 1, 2""")
def src_separator_probe(spark, sf):
    probed = delimited.probe_files(spark, _write_corpus(spark, sf))
    return probed.groupBy(delimited.file_year(F.col("caminho")).alias("ano"), "separador").agg(
        F.sum(F.col("linhas") - 1).alias("registros")
    )


@query("src_union_by_name", f"""{RAW_SQL} SELECT "Id" AS id, "Regional" AS regional, "Data" AS data_atendimento,
  "Ocorrencia" AS tipo_ocorrencia, "Bairro" AS bairro, "Quantidade" AS quantidade, ano AS _ano_origem,
  CASE WHEN ano < 1997 OR ano > 1999 THEN {MONTH_NAME_SQL} END AS mes_registro,
  CASE WHEN ano BETWEEN 1997 AND 1999 THEN 'fechado' END AS status FROM raw""")
def src_union_by_name(spark, sf):
    corpus = delimited.read_corpus(spark, _write_corpus(spark, sf))
    rows = delimited.cast_measures(corpus).withColumn("quantidade", F.round("quantidade", 2))
    return rows.drop("_arquivo")


@query("src_file_year", f"{ORD} SELECT ano AS _ano_origem, count(*) AS n FROM ord GROUP BY 1")
def src_file_year(spark, sf):
    path = scratch_path(spark, "years")
    _write_raw(b.orders(spark, sf).select("id_atendimento", "ano"), path)
    rows = delimited.read_delimited(spark, path, ["id"])
    year = delimited.file_year(F.col("_metadata.file_path")).alias("_ano_origem")
    return rows.select(year).groupBy("_ano_origem").agg(F.count(F.lit(1)).alias("n"))


@query("corpus_summary", f"""{ORD}, y AS (SELECT 'atendimentos_' || ano || '.csv' AS arquivo, count(*) AS registros,
  1 AS processados FROM ord GROUP BY ano UNION ALL SELECT 'atendimentos_2100.csv', 0, 0)
  SELECT arquivo, CAST(sum(registros) AS BIGINT) AS registros, count(*) AS arquivos,
  CAST(sum(processados) AS BIGINT) AS processados FROM y GROUP BY ROLLUP (arquivo)""")
def corpus_summary(spark, sf):
    """One file per year, and one of a header alone."""
    path = scratch_path(spark, "summary")
    raw = _raw(spark, sf)
    _write_raw(raw.repartition("ano"), path)
    empty = spark.createDataFrame([("Id;Regional;Data;Ocorrencia;Bairro;Quantidade",)], "value string")
    empty.coalesce(1).write.option("compression", "none").text(f"{path}/ano=2100")
    corpus = delimited.read_corpus(spark, path, names="part-*")
    found = delimited.found_files(spark, path, "part-*")
    named = F.concat(F.lit("atendimentos_"), delimited.name_year(F.element_at(F.split("caminho", "/"), -2)), F.lit(".csv"))
    by_year = corpus.withColumn("_arquivo", F.concat(F.lit("atendimentos_"), "_ano_origem", F.lit(".csv")))
    return delimited.corpus_summary(by_year, found.withColumn("arquivo", named)).withColumnRenamed("_arquivo", "arquivo")


MULTI_TEXT = "CASE WHEN o_orderkey % 4 = 0 THEN 'linha um' || chr(10) || 'linha \"dois\"; ' || o_orderpriority ELSE o_orderpriority END"


@query("src_csv_multiline", f"""SELECT CAST(o_orderkey AS VARCHAR) AS id,
  CASE WHEN year(o_orderdate) % 2 = 0 THEN {MULTI_TEXT} ELSE o_orderpriority END AS texto,
  CAST(year(o_orderdate) AS INTEGER) AS _ano_origem FROM orders""")
def src_csv_multiline(spark, sf):
    """Files of even years hold line breaks in quotes; the others are read in splits."""
    key, kind = F.col("o_orderkey"), F.col("o_orderpriority")
    year = F.year("o_orderdate")
    broken = (key % 4 == 0) & (year % 2 == 0)
    text = F.when(broken, F.concat(F.lit('linha um\nlinha "dois"; '), kind)).otherwise(kind)
    rows = b.table(spark, sf, "orders").select(key.alias("Id"), text.alias("Texto"), year.alias("ano"))
    path = scratch_path(spark, "multiline")
    _write_raw(rows.repartition("ano"), path)
    return delimited.read_corpus(spark, path).select("id", "texto", "_ano_origem")


@query("schema_diff", f"""{ORD}, y AS (SELECT DISTINCT ano FROM ord)
  SELECT 'Mês' AS coluna, ano FROM y WHERE ano < 1997 OR ano > 1999
  UNION ALL SELECT 'Status', ano FROM y WHERE ano BETWEEN 1997 AND 1999""")
def schema_diff(spark, sf):
    probed = delimited.probe_files(spark, _write_corpus(spark, sf))
    year = delimited.file_year(F.col("caminho")).alias("ano")
    return delimited.layout_difference(probed).select("coluna", year).distinct()


@query("src_gzip_roundtrip", """SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem""")
def src_gzip_roundtrip(spark, sf):
    rows = b.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    path = sinks.write_csv_table(rows, scratch_path(spark, "gzip"))
    return spark.read.schema(rows.schema).option("header", True).csv(path)


@query("src_cleaned_table", f"""WITH {b.DIRTY_SQL}, d AS (SELECT *, {b.PARSE_SQL.format(c='data_atendimento')} AS t FROM dirty)
  SELECT CAST(year(t) AS INTEGER) AS ano, CAST(month(t) AS INTEGER) AS mes, count(*) AS total_ocorrencias,
  CAST(min(t) AS TIMESTAMP) AS primeira, round(sum(coalesce(quantidade, 0)), 2) AS quantidade
  FROM d GROUP BY 1, 2""")
def src_cleaned_table(spark, sf):
    """The cleaned table goes to gzip CSV and comes back typed."""
    clean = stages.clean_and_unify(b.dirty(spark, sf), fill=True)
    path = sinks.write_csv_table(clean, scratch_path(spark, "cleaned"))
    rows = delimited.read_cleaned(spark, path)
    return rows.groupBy("ano", "mes").agg(
        F.count(F.lit(1)).alias("total_ocorrencias"), F.min("data_atendimento").alias("primeira"),
        F.round(F.sum("quantidade"), 2).alias("quantidade"),
    )


@query("sink_csv_compressed", """SELECT count(*) AS linhas, round(sum(l_extendedprice), 2) AS soma,
  true AS comprimido FROM lineitem""")
def sink_csv_compressed(spark, sf):
    rows = b.table(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice")
    path = sinks.write_csv_table(rows, scratch_path(spark, "compressed"))
    back = spark.read.schema(rows.schema).option("header", True).csv(path)
    return back.agg(
        F.count(F.lit(1)).alias("linhas"), F.round(F.sum("l_extendedprice"), 2).alias("soma"),
        F.every(F.col("_metadata.file_name").endswith(".csv.gz")).alias("comprimido"),
    )


# Texts that a CSV must carry: quotes, separators, a backslash, a line break, null and empty.
QUOTE_TEXTS = ['rua "A", casa', "a;b, c", "c:\\temp\\", "duas\nlinhas", '"', "'", "fim\\"]
QUOTES_SQL = "SELECT event_id AS id, CASE event_id % 9 " + " ".join(
    "WHEN {} THEN {}".format(i, " || chr(10) || ".join(f"'{part}'" for part in t.replace("'", "''").split("\n")))
    for i, t in enumerate(QUOTE_TEXTS)
) + " WHEN 7 THEN '' END AS texto, event_type AS tipo FROM events"


def _quotes(spark, sf) -> DataFrame:
    key = F.col("event_id")
    text = F.when(key % 9 == 7, F.lit(""))
    for i, t in enumerate(QUOTE_TEXTS):
        text = text.when(key % 9 == i, F.lit(t))
    return b.table(spark, sf, "events").select(key.alias("id"), text.alias("texto"), F.col("event_type").alias("tipo"))


@query("sink_csv_quotes", f"""WITH q AS ({QUOTES_SQL}) SELECT CAST(id AS VARCHAR) AS id,
  CASE WHEN texto <> '' THEN texto END AS texto, tipo, forma FROM q, (VALUES ('tabela'), ('exporta')) AS f(forma)""")
def sink_csv_quotes(spark, sf):
    """Both CSV writers, read back as a corpus; null and empty text are one there, as in the raw files."""
    rows = _quotes(spark, sf)
    table = sinks.write_csv_table(rows, scratch_path(spark, "quotes"))
    export = sinks.write_csv_export(rows, scratch_path(spark, "quotes-export"), sep=";", single_file=False)
    back = [
        delimited.read_cleaned(spark, path).select("id", "texto", "tipo", F.lit(form).alias("forma"))
        for path, form in ((table, "tabela"), (export, "exporta"))
    ]
    return back[0].unionAll(back[1])


@query("sink_csv_semicolon", f"{ORD} SELECT mes, ano, count(*) AS total_ocorrencias FROM ord GROUP BY 1, 2")
def sink_csv_semicolon(spark, sf):
    rows = agg.by_month_year(b.orders(spark, sf))
    path = sinks.write_csv_export(rows, scratch_path(spark, "semicolon-export"), sep=";")
    return spark.read.schema(rows.schema).option("header", True).option("sep", ";").csv(path)


@query("sink_csv_single", f"""{ORD} SELECT ano, count(*) AS total_ocorrencias, 1 AS arquivos FROM ord GROUP BY 1""")
def sink_csv_single(spark, sf):
    rows = agg.by_year(b.orders(spark, sf))
    path = sinks.write_csv_export(rows, scratch_path(spark, "single-export"))
    back = spark.read.schema(rows.schema).option("header", True).csv(path)
    files = back.select(F.count_distinct("_metadata.file_name").cast("int").alias("_n")).scalar()
    return back.withColumn("arquivos", files)


@query("sink_many", f"""{INC} SELECT 'por_ano' AS agregacao, count(DISTINCT ano) AS grupos, count(*) AS total FROM inc
  UNION ALL SELECT 'por_bairro', count(DISTINCT bairro), count(*) FROM inc
  UNION ALL SELECT 'por_tipo', count(DISTINCT tipo_ocorrencia), count(*) FROM inc
  UNION ALL SELECT 'por_mes', count(DISTINCT mes), count(*) FROM inc
  UNION ALL SELECT 'por_estacao', count(DISTINCT estacao), count(*) FROM inc
  UNION ALL SELECT 'por_dia_semana', count(DISTINCT dia_semana), count(*) FROM inc
  UNION ALL SELECT 'por_hora', count(DISTINCT hora), count(*) FROM inc
  UNION ALL SELECT 'por_bairro_ano', count(DISTINCT (bairro, ano)), count(*) FROM inc
  UNION ALL SELECT 'por_tipo_ano', count(DISTINCT (tipo_ocorrencia, ano)), count(*) FROM inc""")
def sink_many(spark, sf):
    """One base aggregate goes to a table; nine exports and an empty one read it."""
    folder = scratch_path(spark, "many")
    base = materialize(datasets.base_aggregate(b.incidents(spark, sf)), "base")
    frames = datasets.aggregate_frames(base, weight=datasets.TOTAL)
    frames["vazio"] = frames["por_ano"].where("ano IS NULL")
    written = sinks.write_many(frames, folder)
    parts = [
        spark.read.schema(frames[n].schema).option("header", True).csv(f"{folder}/{n}").agg(
            F.lit(n).alias("agregacao"), F.count(F.lit(1)).alias("grupos"),
            F.sum(datasets.TOTAL).alias("total"),
        )
        for n in written
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


@query("sink_parquet_partitioned", f"""{ORD} SELECT mes, count(*) AS total_ocorrencias FROM ord
  WHERE ano = 1997 GROUP BY 1""")
def sink_parquet_partitioned(spark, sf):
    path = sinks.write_parquet_by_year(b.orders(spark, sf), scratch_path(spark, "by-year"))
    return agg.count_by(spark.read.parquet(path).where(F.col("ano") == 1997), "mes")


@query("sink_json_report", f"""WITH {b.DIRTY_SQL} SELECT 'regional' AS nome, 'string' AS tipo, count(*) - count(regional) AS nulos,
  round(100.0 * (count(*) - count(regional)) / count(*), 2) AS pct_nulos, count(DISTINCT regional) AS valores_unicos FROM dirty
  UNION ALL SELECT 'bairro', 'string', count(*) - count(bairro),
  round(100.0 * (count(*) - count(bairro)) / count(*), 2), count(DISTINCT bairro) FROM dirty""")
def sink_json_report(spark, sf):
    profile = profiling.profile_columns(b.dirty(spark, sf), ["regional", "bairro"])
    path = sinks.write_json(profile, scratch_path(spark, "report"))
    return spark.read.schema(profile.schema).json(path)


@query("src_json_records", """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE event_id % 3 = 0
  UNION ALL SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) + i FROM events, (VALUES (0), (0)) AS t(i)
  WHERE event_id % 3 = 1""")
def src_json_records(spark, sf):
    """Objects, lists of two and plain text, mixed in one column."""
    key, props = F.col("event_id"), F.col("props")
    payload = (
        F.when(key % 3 == 0, props)
        .when(key % 3 == 1, F.concat(F.lit("["), props, F.lit(","), props, F.lit("]")))
        .otherwise(F.lit("indisponivel"))
    )
    events = b.table(spark, sf, "events").select("event_id", payload.alias("corpo"))
    return records.json_records(events, "corpo", "struct<k: bigint>", "event_id")


@query("html_blocks", r"""SELECT page_id, CAST(unnest(range(len(x))) AS INTEGER) AS posicao, unnest(x) AS conteudo FROM (
  SELECT page_id, regexp_extract_all(html, '(?s)<li(?:\s[^>]*)?>(.*?)</li>', 1) AS x FROM pages)""")
def html_blocks(spark, sf):
    return records.html_blocks(b.table(spark, sf, "pages"), "html", "li", "page_id")


@query("html_block_counts", r"""SELECT page_id, CAST(len(regexp_extract_all(html, '(?s)<li(?:\s[^>]*)?>(.*?)</li>', 1)) AS INTEGER)
  AS blocos FROM pages""")
def html_block_counts(spark, sf):
    return records.html_block_counts(b.table(spark, sf, "pages"), "html", "li", "page_id")


def _catalog(spark, sf) -> DataFrame:
    """A catalogue document: one resource per year, and one that is no yearly file."""
    years = b.orders(spark, sf).select("ano").distinct()
    resource = F.struct(
        F.concat(F.when(F.col("ano") % 2 == 0, F.lit("Atendimentos ")).otherwise(F.lit("atendimentos-")), "ano")
        .alias("name"),
        F.concat(F.lit("atendimentos_"), "ano", F.lit(".csv")).alias("url"),
    )
    resources = years.agg(F.sort_array(F.collect_list(resource)).alias("r"))
    extra = F.array(F.struct(F.lit("Dicionário 2020").alias("name"), F.lit("dicionario.pdf").alias("url")))
    document = F.struct(F.struct(F.concat(extra, "r").alias("resources")).alias("result"))
    return resources.select(F.to_json(document).alias("corpo"))


@query("catalog_years", f"{ORD} SELECT DISTINCT ano FROM ord WHERE ano % 2 = 0 ORDER BY ano")
def catalog_years(spark, sf):
    """Only names with the year as a word of its own count ("atendimentos-1997" does not)."""
    return records.catalog_years(records.catalog_resources(_catalog(spark, sf), "corpo"))


@query("catalog_match", f"""{ORD} SELECT DISTINCT ano, CASE WHEN ano % 2 = 0 THEN 'Atendimentos ' ELSE 'atendimentos-' END
  || ano AS name, 'atendimentos_' || ano || '.csv' AS url FROM ord WHERE ano >= 1998""")
def catalog_match(spark, sf):
    resources = records.catalog_resources(_catalog(spark, sf), "corpo")
    wanted = spark.range(1998, 2010).select(F.col("id").cast("int").alias("ano"))
    return records.match_resource(resources, wanted)
