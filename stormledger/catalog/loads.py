"""Loads over time: years replaced, loads judged and published, growing corpora, silent days."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from stormledger import bindings as b, vocab
from stormledger.catalog.core import query
from stormledger.catalog.files import _raw, _write_raw
from stormledger.operators import joins, quality, series, sketches
from stormledger.plans import datasets, publish, refresh, stages
from stormledger.session import materialize, scratch_path
from stormledger.sources import buckets, manifest, sinks

ORD, CALLS = f"WITH {b.ORDERS_SQL}", f"WITH {b.CALLS_SQL}"


@query("sink_year_reload", f"""{ORD}, y AS (SELECT ano, quantidade FROM ord WHERE ano NOT IN (1996, 1997, 2000)
  UNION ALL SELECT ano, 2 * quantidade FROM ord WHERE ano = 1997 AND id_atendimento % 3 <> 0
  UNION ALL SELECT 2030, quantidade FROM ord WHERE ano = 2000)
  SELECT CAST(ano AS INTEGER) AS ano, count(*) AS n, round(sum(quantidade), 2) AS quantidade FROM y GROUP BY 1""")
def sink_year_reload(spark, sf):
    """1997 comes corrected, 1996 and 2000 empty, 2030 new; all other years stay."""
    rows = b.orders(spark, sf).select("ano", "quantidade", "id_atendimento")
    path = sinks.write_parquet_by_year(rows, scratch_path(spark, "reload"))
    corrected = rows.where("ano = 1997 AND id_atendimento % 3 <> 0").withColumn("quantidade", F.col("quantidade") * 2)
    sinks.reload_years(corrected, path, [1996, 1997])
    moved = rows.where("ano = 2000").withColumn("ano", F.lit(2030))
    sinks.reload_years(moved, path, [2000, 2030])
    return sinks.read_by_year(spark, path).groupBy("ano").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("quantidade"), 2).alias("quantidade"))


PUBLISH_SQL = f"""{ORD}, l AS (
  SELECT 1 AS carga, ano, tipo_ocorrencia AS tipo, grau_de_risco AS risco, quantidade AS q FROM ord WHERE ano <= 1996
  UNION ALL SELECT 2, ano, CASE WHEN id_atendimento % 50 <> 0 THEN tipo_ocorrencia END, grau_de_risco, quantidade FROM ord WHERE ano = 1997
  UNION ALL SELECT 3, ano, tipo_ocorrencia, grau_de_risco, CASE WHEN id_atendimento % 200 <> 7 THEN 2 * quantidade END
    FROM ord WHERE ano IN (1996, 1998)),
  m AS (SELECT *, tipo IS NULL AS f1, q IS NULL AS f2, risco = 'P' AS f3 FROM l),
  c AS (SELECT carga, count(*) AS n, 1 - (count(*) FILTER (WHERE f1) + count(*) FILTER (WHERE f2) + count(*) FILTER (WHERE f3)) / (3.0 * count(*)) AS s,
    count(*) FILTER (WHERE f1) = 0 AND count(*) FILTER (WHERE f2) / count(*) <= 0.02 AS critica FROM m GROUP BY carga),
  v AS (SELECT carga, n, s, critica AND s >= 0.95 AS ok FROM c),
  p AS (SELECT ano, max(carga) AS carga FROM m JOIN v USING (carga) WHERE ok AND NOT f1 AND NOT f2 GROUP BY ano)
  SELECT 'publicado' AS parte, CAST(carga AS INTEGER) AS carga, CAST(ano AS INTEGER) AS ano, count(*) AS linhas, round(sum(q), 2) AS quantidade,
    CAST(NULL AS VARCHAR) AS regras, CAST(NULL AS BOOLEAN) AS aceito, CAST(NULL AS DOUBLE) AS qualidade
    FROM m JOIN p USING (carga, ano) WHERE NOT f1 AND NOT f2 GROUP BY carga, ano
  UNION ALL SELECT 'carga', carga, NULL, n, NULL, NULL, ok, round(s, 6) FROM v
  UNION ALL SELECT 'quarentena', carga, NULL, count(*), NULL,
    concat_ws(',', CASE WHEN f1 THEN 'tipo_ocorrencia_presente' END, CASE WHEN f2 THEN 'quantidade_presente' END, CASE WHEN f3 THEN 'risco_conhecido' END), ok, NULL
    FROM m JOIN v USING (carga) WHERE f1 OR f2 GROUP BY 1, 2, 6, 7"""


def publishing_rules() -> list[quality.Rule]:
    return [
        *quality.required_rules(["tipo_ocorrencia"]),
        quality.Rule("quantidade_presente", quality.CRITICAL, F.col("quantidade").isNotNull(), 0.02),
        quality.Rule("risco_conhecido", quality.MEDIUM, F.col("grau_de_risco") != "P", 0.1),
    ]


@query("dq_publish", PUBLISH_SQL)
def dq_publish(spark, sf):
    """Three loads: one accepted, one refused, one that corrects a year and has a few rejected rows."""
    rows = b.orders(spark, sf)
    key, rules, store = F.col("id_atendimento"), publishing_rules(), scratch_path(spark, "published")
    publish.publish(rows.where("ano <= 1996"), store, rules)
    refused = rows.where("ano = 1997").withColumn("tipo_ocorrencia", F.when(key % 50 != 0, F.col("tipo_ocorrencia")))
    publish.publish(refused, store, rules)
    corrected = rows.where("ano IN (1996, 1998)").withColumn("quantidade", F.when(key % 200 != 7, F.col("quantidade") * 2))
    publish.publish(corrected, store, rules)

    none = {"regras": "string", "aceito": "boolean", "qualidade": "double", "ano": "int", "quantidade": "double"}

    def part(df: DataFrame, name: str) -> DataFrame:
        missing = {c: F.lit(None).cast(t) for c, t in none.items() if c not in df.columns}
        return df.withColumns(missing).withColumn("parte", F.lit(name)).select("parte", "carga", "ano", "linhas", "quantidade", "regras", "aceito", "qualidade")

    published = publish.current(spark, store).groupBy("carga", "ano").agg(
        F.count(F.lit(1)).alias("linhas"), F.round(F.sum("quantidade"), 2).alias("quantidade"))
    seen = publish.loads(spark, store).withColumn("linhas", F.aggregate("anos", F.lit(0).cast("bigint"), lambda a, x: a + x["linhas"] + x["rejeitadas"]))
    held = publish.quarantine(spark, store).groupBy(
        "carga", F.concat_ws(",", publish.BROKEN).alias("regras"), F.col("carga_aceita").alias("aceito")).agg(F.count(F.lit(1)).alias("linhas"))
    return part(published, "publicado").unionAll(part(seen.drop("regras", "anos"), "carga")).unionAll(part(held, "quarentena"))


def _spine_sql(source: str, rows: str, key: str, ratio: float) -> str:
    """rows: the frame's rows with `key` and a timestamp `t`."""
    return f"""{source}, a AS ({rows}), d AS (SELECT {key}, CAST(t AS DATE) AS dia, count(*) AS n FROM a GROUP BY ALL),
      u AS (SELECT *, avg(n) OVER (PARTITION BY {key} ORDER BY dia ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS m FROM d),
      g AS (SELECT {key}, CAST(unnest(generate_series(min(dia), (SELECT max(dia) FROM d), INTERVAL 1 DAY)) AS DATE) AS dia FROM d GROUP BY {key}),
      s AS (SELECT g.{key}, g.dia, coalesce(n, 0) AS n, m FROM g LEFT JOIN u ON g.{key} = u.{key} AND g.dia = u.dia),
      w AS (SELECT {key}, dia, n, last_value(m IGNORE NULLS) OVER (PARTITION BY {key} ORDER BY dia ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM s)
      SELECT {key}, dia, n AS total_ocorrencias, round(m, 4) AS volume_usual, n < {ratio} * m AS volume_baixo, n = 0 AS sem_registro FROM w"""


# Stations of one in five stop, and each is silent on some days.
SILENT = "posto % 5 = 0 AND dia > 20 OR (posto + dia) % 6 = 0"


def _silent(spark, sf) -> DataFrame:
    return b.calls(spark, sf).where(f"NOT ({SILENT})")


@query("volume_check_calendar", _spine_sql(CALLS, f"SELECT posto, data_atendimento AS t FROM calls WHERE NOT ({SILENT})", "posto", 0.8))
def volume_check_calendar(spark, sf):
    return series.volume_check_calendar(_silent(spark, sf), "data_atendimento", ("posto",))


LEAP = "mes = 2 AND dia = 29"


@query("volume_check_leap", _spine_sql(ORD, f"SELECT tipo_ocorrencia, data_atendimento AS t FROM ord WHERE NOT ({LEAP})", "tipo_ocorrencia", 0.7))
def volume_check_leap(spark, sf):
    """Kinds without a row on any leap day."""
    return series.volume_check_calendar(b.orders(spark, sf).where(f"NOT ({LEAP})"), "data_atendimento", ("tipo_ocorrencia",), min_ratio=0.7)


@query("gaps_open", f"""{CALLS}, a AS (SELECT posto, max(CAST(data_atendimento AS DATE)) AS dia_anterior FROM calls WHERE NOT ({SILENT}) GROUP BY posto)
  SELECT posto, dia_anterior, (SELECT max(dia_anterior) FROM a) AS ate,
  CAST(date_diff('day', dia_anterior, (SELECT max(dia_anterior) FROM a)) AS INTEGER) AS dias FROM a
  WHERE date_diff('day', dia_anterior, (SELECT max(dia_anterior) FROM a)) > 2""")
def gaps_open(spark, sf):
    return series.open_gaps(_silent(spark, sf), "data_atendimento", ("posto",))


@query("join_daily_calendar", f"""{CALLS}, r AS (SELECT CAST(data_atendimento AS DATE) AS dia, round(sum(chuva_mm), 2) AS chuva_mm FROM calls
  WHERE dia % 4 = 1 GROUP BY 1), i AS (SELECT CAST(data_atendimento AS DATE) AS dia, count(*) AS n FROM calls WHERE dia % 6 = 1 GROUP BY 1),
  j AS (SELECT coalesce(r.dia, i.dia) AS dia, chuva_mm, n FROM r FULL JOIN i ON r.dia = i.dia),
  g AS (SELECT CAST(unnest(generate_series(min(dia), max(dia), INTERVAL 1 DAY)) AS DATE) AS dia FROM j)
  SELECT g.dia, chuva_mm, coalesce(n, 0) AS total_ocorrencias FROM g LEFT JOIN j ON g.dia = j.dia""")
def join_daily_calendar(spark, sf):
    """Rain of every fourth day and incidents of every sixth, with all days between."""
    calls = b.calls(spark, sf)
    return joins.daily_rain_and_incidents(
        calls.where("dia % 4 = 1"), "data_atendimento", "chuva_mm", calls.where("dia % 6 = 1"), "data_atendimento", calendar=True)


@query("ingest_incremental", f"""{ORD}, a AS (SELECT ano, count(*) AS n, CAST(sum(id_atendimento) AS BIGINT) AS soma FROM ord GROUP BY ano)
  SELECT 'linhas' AS parte, CAST(NULL AS INTEGER) AS carga, CAST(ano AS INTEGER) AS ano, n AS linhas, soma FROM a WHERE ano <> 1997
  UNION ALL SELECT 'arquivos', CASE WHEN ano <= 1998 THEN CASE WHEN ano = 1997 THEN 3 ELSE 1 END ELSE 2 END, ano, CASE WHEN ano = 1997 THEN 0 ELSE n END, NULL FROM a
  UNION ALL SELECT 'lidos', 1, NULL, CAST(count(*) > 0 AS INTEGER), NULL FROM a WHERE ano <= 1998
  UNION ALL SELECT 'lidos', 2, NULL, CAST(count(*) > 0 AS INTEGER), NULL FROM a WHERE ano > 1998
  UNION ALL SELECT 'lidos', 3, NULL, 0, NULL UNION ALL SELECT 'lidos', 4, NULL, 0, NULL""")
def ingest_incremental(spark, sf):
    """Two loads of a corpus that grows, one that finds nothing, one after a year was withdrawn."""
    source, store = scratch_path(spark, "growing"), scratch_path(spark, "ingested")
    raw = _raw(spark, sf)
    # the withdrawn year lies apart, so that a later listing can leave it out
    folders = [f"{source}/{name}" for name in ("a", "b", "c")]
    _write_raw(raw.where("ano <= 1998 AND ano <> 1997"), folders[0])
    _write_raw(raw.where("ano = 1997"), folders[1], sep=",")
    read = [manifest.ingest(spark, folders[:2], store)]
    _write_raw(raw.where("ano > 1998").withColumnRenamed("Bairro", "Localidade"), folders[2], encoding="ISO-8859-1")
    read += [manifest.ingest(spark, folders, store), manifest.ingest(spark, folders, store)]
    read.append(manifest.ingest(spark, [folders[0], folders[2]], store, drop_missing=True))
    year, total = F.col("_ano_origem").alias("ano"), F.sum(F.col("id").cast("bigint")).alias("soma")
    none = F.lit(None)
    rows = manifest.rows(spark, store).groupBy(year).agg(F.count(F.lit(1)).alias("linhas"), total)
    per_load = manifest.manifest(spark, store).groupBy(
        "carga", manifest.delimited.file_year(F.col("caminho")).alias("ano")
    ).agg(F.sum("linhas").alias("linhas"))
    files = spark.createDataFrame([(i, int(n > 0)) for i, n in enumerate(read, 1)], "carga int, linhas bigint")
    return (
        rows.select(F.lit("linhas").alias("parte"), none.cast("int").alias("carga"), "ano", "linhas", "soma")
        .unionAll(per_load.select(F.lit("arquivos"), "carga", "ano", "linhas", none.cast("bigint")))
        .unionAll(files.select(F.lit("lidos"), "carga", none.cast("int"), "linhas", none.cast("bigint")))
    )


# --- kept figures ------------------------------------------------------------

CORRECTED_SQL = f"""WITH {b.INCIDENTS_SQL}, c AS (SELECT * REPLACE (CASE WHEN ano = 1997 AND id_atendimento % 4 = 0 THEN 'CORRIGIDO' ELSE bairro END AS bairro)
  FROM inc WHERE ano <> 1995 AND NOT (ano = 1997 AND id_atendimento % 5 = 0)), n AS (SELECT count(*) AS n FROM c)"""


@query("aggregates_refreshed", f"""{CORRECTED_SQL} SELECT 'ano' AS tipo, CAST(ano AS VARCHAR) AS chave, count(*) AS total_ocorrencias, count(DISTINCT bairro) AS bairros
  FROM c GROUP BY ano UNION ALL SELECT 'bairro', bairro, count(*), 1 FROM c GROUP BY bairro
  UNION ALL SELECT 'tudo', NULL, count(*), count(DISTINCT bairro) FROM c""")
def aggregates_refreshed(spark, sf):
    """1995 is withdrawn and 1997 corrected; only these two years are counted again."""
    rows = b.incidents(spark, sf)
    path, years = scratch_path(spark, "base"), list(range(1992, 2003))
    refresh.refresh_base(rows, path, years)
    wrong = (F.col("ano") == 1997) & (F.col("id_atendimento") % 4 == 0)
    corrected = rows.where("ano <> 1995 AND NOT (ano = 1997 AND id_atendimento % 5 = 0)").withColumn(
        "bairro", F.when(wrong, F.lit("CORRIGIDO")).otherwise(F.col("bairro")))
    refresh.refresh_base(corrected, path, [1995, 1997])
    base = refresh.stored_base(spark, path)
    total, areas = F.sum(datasets.TOTAL).alias("total_ocorrencias"), F.count_distinct("bairro").alias("bairros")
    year, area = F.col("ano").cast("string").alias("chave"), F.col("bairro").alias("chave")
    return (
        base.groupBy(year).agg(total, areas).withColumn("tipo", F.lit("ano"))
        .unionByName(base.groupBy(area).agg(total).withColumns({"bairros": F.lit(1).cast("bigint"), "tipo": F.lit("bairro")}))
        .unionByName(base.agg(total, areas).withColumns({"chave": F.lit(None).cast("string"), "tipo": F.lit("tudo")}))
    )


SKETCHED = ["id_atendimento", "id_solicitante", "tipo_ocorrencia", "grau_de_risco", "quantidade"]


@query("profile_merged", f"""{ORD}, o AS (SELECT * REPLACE (CASE WHEN id_atendimento % 3 <> 0 THEN quantidade END AS quantidade) FROM ord) """ + " UNION ALL ".join(
    f"""SELECT '{c}' AS coluna, count(*) AS linhas, count(*) - count({c}) AS nulos, true AS distintos_no_erro,
      {"min(" + c + ")::DOUBLE" if c not in ("tipo_ocorrencia", "grau_de_risco") else "NULL::DOUBLE"} AS menor,
      {"true" if c not in ("tipo_ocorrencia", "grau_de_risco") else "NULL::BOOLEAN"} AS quantis_no_erro FROM o""" for c in SKETCHED))
def profile_merged(spark, sf):
    """Sketches of each year, one year of them replaced, united; compared with the exact figures."""
    rows = b.orders(spark, sf).select("ano", *SKETCHED)
    rows = rows.withColumn("quantidade", F.when(F.col("id_atendimento") % 3 != 0, F.col("quantidade")))
    path, years = scratch_path(spark, "sketches"), list(range(1992, 2003))
    refresh.refresh_sketches(rows.withColumn("quantidade", F.when(F.col("ano") != 1997, F.col("quantidade"))), path, years, SKETCHED)
    refresh.refresh_sketches(rows, path, [1997], SKETCHED)
    found = materialize(refresh.merged_profile(spark, path), "merged")
    exact = rows.agg(*[F.count_distinct(c).alias(c) for c in SKETCHED]).unpivot([], SKETCHED, "coluna", "exatos")
    # the share of numbers up to a sketched quartile is its rank
    quartiles = {r["coluna"]: r["quantis"] for r in found.where("quantis IS NOT NULL").select("coluna", "quantis").collect()}
    ranks = rows.agg(*[
        F.array(*[F.abs(F.count_if(F.col(c) <= q) / F.count(c) - p) for q, p in zip(qs, (0.25, 0.5, 0.75), strict=True)]).alias(c)
        for c, qs in quartiles.items()
    ]).unpivot([], list(quartiles), "coluna", "_erros")
    near = F.abs(F.col("valores_unicos") - F.col("exatos")) <= F.ceil(F.col("exatos") * sketches.DISTINCT_ERROR)
    # a value that many rows share has many ranks
    inside = F.forall("_erros", lambda e: e <= sketches.RANK_ERROR)
    return found.join(exact, "coluna").join(ranks, "coluna", "left").select(
        "coluna", "linhas", "nulos", near.alias("distintos_no_erro"), "menor", inside.alias("quantis_no_erro"))


@query("cleaning_observed", f"""WITH {b.DIRTY_SQL}, p AS (SELECT * REPLACE ({b.PARSE_SQL.format(c="data_atendimento")} AS data_atendimento) FROM dirty),
  k AS (SELECT * FROM p WHERE regional IS NULL OR lower(regional) IN ({', '.join("'" + r + "'" for r in vocab.REGION_SPELLINGS)}))
  SELECT 'carregado' AS etapa, count(*) AS linhas, CAST(sum(6 - ((id_atendimento IS NOT NULL)::INT + (regional IS NOT NULL)::INT + (bairro IS NOT NULL)::INT
    + (tipo_ocorrencia IS NOT NULL)::INT + (data_atendimento IS NOT NULL)::INT + (quantidade IS NOT NULL)::INT)) AS BIGINT) AS nulos, count(data_atendimento) AS com_data FROM dirty
  UNION ALL SELECT 'datas', count(*), 6 * count(*) - count(id_atendimento) - count(regional) - count(bairro) - count(tipo_ocorrencia) - count(data_atendimento) - count(quantidade),
    count(data_atendimento) FROM p
  UNION ALL SELECT 'regiao', count(*), 6 * count(*) - count(id_atendimento) - count(regional) - count(bairro) - count(tipo_ocorrencia) - count(data_atendimento) - count(quantidade),
    count(data_atendimento) FROM k
  UNION ALL SELECT 'limpo', count(*), 6 * count(*) - count(id_atendimento) - count(regional) - 2 * count(bairro) - 2 * count(tipo_ocorrencia)
    - 8 * count(data_atendimento) - count(quantidade) + 9 * count(*), count(data_atendimento) FROM k""")
def cleaning_observed(spark, sf):
    """Rows, null cells and dates after each step, from the one job that writes the cleaned table."""
    return stages.clean_and_store(b.dirty(spark, sf), scratch_path(spark, "observed"), vocab.REGION_SPELLINGS)


@query("dedup_bucketed", """WITH h AS (SELECT o_orderkey AS id, 1 AS versao, o_totalprice AS valor FROM orders WHERE o_orderkey % 11 <> 3
  UNION ALL SELECT o_orderkey, 2, o_totalprice * 2 FROM orders WHERE o_orderkey % 7 = 0 OR o_orderkey % 11 = 3),
  n AS (SELECT id, count(*) AS linhas, max(versao) AS versao, round(arg_max(valor, versao), 2) AS valor FROM h GROUP BY id)
  SELECT id, CAST(versao AS INTEGER) AS versao, valor, linhas > 1 AS repetido, versao = 2 AND linhas = 1 AS novo FROM n""")
def dedup_bucketed(spark, sf):
    """History in buckets, a load that corrects and adds, the newest row of each id."""
    rows = b.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("valor"))
    history = rows.where("id % 11 <> 3").withColumn("versao", F.lit(1))
    load = rows.where("id % 7 = 0 OR id % 11 = 3").withColumns({"valor": F.col("valor") * 2, "versao": F.lit(2)})
    name, path = f"historico_{uuid.uuid4().hex}", scratch_path(spark, "history")
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = buckets.store_bucketed(history, name, path, ["id"], count)
    # compared before the load joins the history
    known = materialize(buckets.compare_load(load, stored, ["id"]), "compared")
    stored = buckets.store_bucketed(load, name, path, ["id"], count, mode="append")
    newest = buckets.latest_rows(stored, ["id"], [F.col("versao")])
    repeated = buckets.repeated_keys(stored, ["id"]).select("id", F.lit(True).alias("repetido"))
    fresh = known.where("no_historico = 0").select("id", F.lit(True).alias("novo"))
    out = newest.join(repeated, "id", "left").join(fresh, "id", "left")
    return out.select("id", "versao", F.round("valor", 2).alias("valor"), F.coalesce("repetido", F.lit(False)).alias("repetido"), F.coalesce("novo", F.lit(False)).alias("novo"))
