"""Aggregates, top-k, set operations, windows and dashboard datasets."""

from __future__ import annotations

from pyspark.sql import functions as F

from stormledger import bindings as b, vocab
from stormledger.catalog.core import query
from stormledger.functions import dates
from stormledger.operators import aggregates as agg, joins, profiling, ranking, series
from stormledger.plans import datasets

ORD, INC, CALLS = f"WITH {b.ORDERS_SQL}", f"WITH {b.INCIDENTS_SQL}", f"WITH {b.CALLS_SQL}"


def _case(values: list[str], key: str, start: int) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values, start=start))
    return f"CASE {key} {whens} END"


MONTH_CASE = _case(vocab.MONTH_NAMES, "mes", 1)
WEEKDAY_CASE = _case(vocab.WEEKDAYS_PT, "CAST(dia_semana AS INTEGER)", 0)
RAIN_CASE = _case([str(mm) for mm in vocab.MONTH_RAIN_MM], "mes", 1)
SEASON_CASE = """CASE WHEN mes IN (12, 1, 2) THEN 'Verão' WHEN mes IN (3, 4, 5) THEN 'Outono'
  WHEN mes IN (6, 7, 8) THEN 'Inverno' ELSE 'Primavera' END"""
DRY_CASE = "CASE WHEN mes IN (11, 12, 1, 2, 3) THEN 'Seca' ELSE 'Chuvosa' END"


# --- counts -----------------------------------------------------------------

@query("agg_year", f"{ORD} SELECT ano, count(*) AS total_ocorrencias FROM ord GROUP BY ano")
def agg_year(spark, sf):
    return agg.by_year(b.orders(spark, sf))


@query("agg_area", f"{INC} SELECT bairro, count(*) AS total_ocorrencias FROM inc GROUP BY bairro")
def agg_area(spark, sf):
    return agg.by_area(b.incidents(spark, sf))


@query("agg_kind", f"""{ORD} SELECT tipo_ocorrencia, count(*) AS total_ocorrencias
  FROM ord GROUP BY tipo_ocorrencia""")
def agg_kind(spark, sf):
    return agg.by_kind(b.orders(spark, sf))


@query("agg_month", f"""{ORD} SELECT mes, count(*) AS total_ocorrencias, {MONTH_CASE} AS nome_mes
  FROM ord GROUP BY mes""")
def agg_month(spark, sf):
    return agg.by_month(b.orders(spark, sf))


@query("agg_season", f"{ORD} SELECT estacao, count(*) AS total_ocorrencias FROM ord GROUP BY estacao")
def agg_season(spark, sf):
    return agg.by_season(b.orders(spark, sf))


@query("agg_weekday", f"""{CALLS} SELECT dia_semana_nome, count(*) AS total_ocorrencias,
  {WEEKDAY_CASE} AS dia_semana FROM calls GROUP BY dia_semana_nome, calls.dia_semana""")
def agg_weekday(spark, sf):
    return agg.by_weekday(b.calls(spark, sf))


@query("agg_hour", f"{CALLS} SELECT hora, count(*) AS total_ocorrencias FROM calls GROUP BY hora")
def agg_hour(spark, sf):
    return agg.by_hour(b.calls(spark, sf))


@query("agg_area_year", f"""{INC} SELECT bairro, ano, count(*) AS total_ocorrencias
  FROM inc GROUP BY bairro, ano""")
def agg_area_year(spark, sf):
    return agg.by_area_year(b.incidents(spark, sf))


@query("agg_kind_year", f"""{ORD} SELECT tipo_ocorrencia, ano, count(*) AS total_ocorrencias
  FROM ord GROUP BY tipo_ocorrencia, ano""")
def agg_kind_year(spark, sf):
    return agg.by_kind_year(b.orders(spark, sf))


@query("agg_area_year_ranked", f"""{INC} SELECT bairro, ano, count(*) AS total_ocorrencias
  FROM inc GROUP BY bairro, ano ORDER BY 3 DESC, 1, 2""")
def agg_area_year_ranked(spark, sf):
    return agg.by_area_year_ranked(b.incidents(spark, sf))


@query("agg_kind_month", f"""{ORD} SELECT tipo_ocorrencia, mes, count(*) AS total_ocorrencias
  FROM ord GROUP BY tipo_ocorrencia, mes ORDER BY 3 DESC, 1, 2""")
def agg_kind_month(spark, sf):
    return agg.by_kind_month(b.orders(spark, sf))


@query("agg_month_year", f"""{ORD} SELECT mes, ano, count(*) AS total_ocorrencias
  FROM ord GROUP BY mes, ano""")
def agg_month_year(spark, sf):
    return agg.by_month_year(b.orders(spark, sf))


@query("stats_area", f"""{INC} SELECT bairro, count(*) AS total_ocorrencias, count(ano) AS total_com_data,
  count(DISTINCT ano) AS anos_afetados, max(ano) AS ultimo_ano, min(ano) AS primeiro_ano
  FROM inc GROUP BY bairro""")
def stats_area(spark, sf):
    return agg.area_stats(b.incidents(spark, sf))


@query("guarded_groupby", f"""{INC} SELECT bairro, count(*) AS total_ocorrencias FROM inc GROUP BY bairro""")
def guarded_groupby(spark, sf):
    """The raw column stands in for a missing normalised one; a missing one adds no rows."""
    rows = b.incidents(spark, sf)
    absent = agg.guarded_count(rows.drop("bairro"), agg.AREA).withColumnRenamed("bairro_normalizado", "bairro")
    return agg.guarded_count(rows, agg.AREA).unionByName(absent)


@query("value_counts_topk", f"""{CALLS} SELECT posto, count(*) AS total_ocorrencias FROM calls
  GROUP BY posto ORDER BY 2 DESC, 1 LIMIT 10""")
def value_counts_topk(spark, sf):
    return agg.top_k(b.calls(spark, sf), "posto", 10)


@query("topk_area", f"""{INC} SELECT bairro, count(*) AS total_ocorrencias FROM inc
  GROUP BY bairro ORDER BY 2 DESC, 1 LIMIT 10""")
def topk_area(spark, sf):
    return agg.top_k(b.incidents(spark, sf), "bairro", 10)


@query("argmax_group", f"""{ORD} SELECT ano, count(*) AS total_ocorrencias FROM ord
  GROUP BY ano ORDER BY 2 DESC, 1 LIMIT 1""")
def argmax_group(spark, sf):
    return agg.argmax_group(b.orders(spark, sf), "ano")


@query("distinct_counts", f"""{CALLS}
  SELECT 'posto' AS coluna, count(DISTINCT posto) AS valores_unicos FROM calls
  UNION ALL SELECT 'tipo_ocorrencia', count(DISTINCT tipo_ocorrencia) FROM calls
  UNION ALL SELECT 'chuva_mm', count(DISTINCT chuva_mm) FROM calls
  UNION ALL SELECT 'hora', count(DISTINCT hora) FROM calls""")
def distinct_counts(spark, sf):
    return profiling.distinct_counts(b.calls(spark, sf), ["posto", "tipo_ocorrencia", "chuva_mm", "hora"])


@query("distinct_counts_approx", "SELECT coluna, true AS dentro_do_erro FROM (VALUES ('posto'), ('tipo_ocorrencia'), ('chuva_mm'), ('hora')) AS t(coluna)")
def distinct_counts_approx(spark, sf):
    """Sketched counts, each within three standard errors of the exact one."""
    columns = ["posto", "tipo_ocorrencia", "chuva_mm", "hora"]
    exact = profiling.distinct_counts(b.calls(spark, sf), columns).withColumnRenamed("valores_unicos", "exatos")
    within = F.abs(F.col("valores_unicos") - F.col("exatos")) <= 0.06 * F.col("exatos")
    return profiling.distinct_counts_approx(b.calls(spark, sf), columns).join(exact, "coluna").select(
        "coluna", within.alias("dentro_do_erro")
    )


def _mode_sql(column: str) -> str:
    return f"""SELECT * FROM (SELECT '{column}' AS coluna, CAST({column} AS VARCHAR) AS moda, count(*) AS n
      FROM ord GROUP BY {column} ORDER BY n DESC, {column} LIMIT 1)"""


@query("mode_values", f"""{ORD} {_mode_sql('mes')} UNION ALL {_mode_sql('dia_semana_nome')}
  UNION ALL {_mode_sql('estacao')}""")
def mode_values(spark, sf):
    return profiling.modes(b.orders(spark, sf), ["mes", "dia_semana_nome", "estacao"])


@query("share_of_total", f"""{INC}, a AS (SELECT bairro, count(*) AS total_ocorrencias FROM inc GROUP BY bairro)
  SELECT bairro, total_ocorrencias,
  round(100.0 * total_ocorrencias / (SELECT sum(total_ocorrencias) FROM a), 2) AS percentual FROM a""")
def share_of_total(spark, sf):
    return agg.with_share(agg.count_by(b.incidents(spark, sf), "bairro"))


@query("rank_area", f"""{INC}, a AS (SELECT bairro, count(*) AS total_ocorrencias FROM inc GROUP BY bairro)
  SELECT bairro, total_ocorrencias,
  CAST(row_number() OVER (ORDER BY total_ocorrencias DESC, bairro) AS INTEGER) AS ranking FROM a""")
def rank_area(spark, sf):
    return agg.with_ranking(agg.count_by(b.incidents(spark, sf), "bairro"), "bairro")


@query("rank_part", """WITH c AS (SELECT 'peca-0000000' || l_partkey AS nome, count(*) // 8 AS total_ocorrencias
  FROM lineitem GROUP BY 1, l_partkey) SELECT nome, total_ocorrencias,
  CAST(row_number() OVER (ORDER BY total_ocorrencias DESC, nome) AS INTEGER) AS posicao FROM c""")
def rank_part(spark, sf):
    """Many keys with one beginning and equal totals."""
    counts = agg.count_by(b.table(spark, sf, "lineitem"), "l_partkey")
    named = counts.select(
        F.concat(F.lit("peca-0000000"), "l_partkey").alias("nome"),
        F.floor(F.col("total_ocorrencias") / 8).alias("total_ocorrencias"),
    )
    return ranking.with_global_rank(named, "total_ocorrencias", "nome", "posicao")


@query("rank_station", f"""{CALLS}, a AS (SELECT posto, count(*) AS total_ocorrencias FROM calls GROUP BY posto)
  SELECT posto, total_ocorrencias,
  CAST(row_number() OVER (ORDER BY total_ocorrencias DESC, CAST(posto AS VARCHAR)) AS INTEGER) AS ranking
  FROM a""")
def rank_station(spark, sf):
    counted = agg.count_by(b.calls(spark, sf), "posto")
    named = counted.withColumn("_nome", F.col("posto").cast("string"))
    return agg.with_ranking(named, "_nome").drop("_nome")


@query("total_reconcile", f"""{ORD}, g AS (SELECT tipo_ocorrencia, count(*) AS n FROM ord GROUP BY 1)
  SELECT CAST(sum(n) AS BIGINT) AS soma_grupos, count(*) AS grupos,
  (SELECT count(*) FROM ord) AS total, sum(n) = (SELECT count(*) FROM ord) AS confere FROM g""")
def total_reconcile(spark, sf):
    return agg.reconcile_total(b.orders(spark, sf), "tipo_ocorrencia")


@query("rollup_year_month", f"""{ORD} SELECT ano, mes, count(*) AS total_ocorrencias,
  CAST(2 - grouping(ano) - grouping(mes) AS INTEGER) AS nivel FROM ord GROUP BY ROLLUP (ano, mes)""")
def rollup_year_month(spark, sf):
    return agg.rollup_year_month(b.orders(spark, sf))


@query("mean_response", f"""{ORD} SELECT ano, mes,
  round(avg(epoch(l_shipdate - data_atendimento)) / 3600.0, 4) AS horas_media, count(*) AS n
  FROM ord JOIN lineitem ON id_atendimento = l_orderkey GROUP BY ano, mes""")
def mean_response(spark, sf):
    return joins.mean_response_hours(
        b.orders(spark, sf), "id_atendimento", "data_atendimento",
        b.table(spark, sf, "lineitem"), "l_orderkey", "l_shipdate", "ano", "mes",
    )


@query("rain_by_month", """SELECT CAST(year(l_shipdate) AS INTEGER) AS ano, CAST(month(l_shipdate) AS INTEGER) AS mes,
  round(sum(l_quantity), 2) AS chuva_mm FROM lineitem GROUP BY 1, 2""")
def rain_by_month(spark, sf):
    rain = b.table(spark, sf, "lineitem").select(
        F.year("l_shipdate").alias("ano"), F.month("l_shipdate").alias("mes"), "l_quantity"
    )
    return agg.sum_by(rain, "l_quantity", "ano", "mes", out="chuva_mm")


@query("rain_by_station", f"""{CALLS} SELECT posto, round(sum(chuva_mm), 2) AS chuva_mm FROM calls
  GROUP BY posto HAVING sum(chuva_mm) > 0""")
def rain_by_station(spark, sf):
    return agg.sum_by(b.calls(spark, sf), "chuva_mm", "posto", out="chuva_mm", positive_only=True)


@query("hotspots", f"""{INC}, c AS (SELECT bairro, tipo_ocorrencia, count(*) AS total_ocorrencias
  FROM inc GROUP BY 1, 2)
  SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY bairro
    ORDER BY total_ocorrencias DESC, tipo_ocorrencia) AS INTEGER) AS posicao FROM c) WHERE posicao <= 3""")
def hotspots(spark, sf):
    return agg.hotspots(b.incidents(spark, sf), "bairro", "tipo_ocorrencia", 3)


@query("hour_weekday", f"""{CALLS} SELECT dia_semana,
  {', '.join(f"count(*) FILTER (WHERE hora = {h}) AS h{h:02d}" for h in range(24))}
  FROM calls GROUP BY dia_semana""")
def hour_weekday(spark, sf):
    return agg.hour_weekday_matrix(b.calls(spark, sf))


@query("risk_share", f"""{INC} SELECT bairro, count(*) AS total, count(*) FILTER (WHERE grau_de_risco = 'F')
  AS em_risco, round(100.0 * count(*) FILTER (WHERE grau_de_risco = 'F') / count(*), 2) AS percentual,
  true AS valido FROM inc GROUP BY bairro""")
def risk_share(spark, sf):
    return agg.risk_share(b.incidents(spark, sf), F.col("grau_de_risco") == "F", "bairro")


@query("distinct_years", f"{ORD} SELECT DISTINCT ano FROM ord ORDER BY ano")
def distinct_years(spark, sf):
    return agg.distinct_sorted(b.orders(spark, sf), "ano")


@query("years_intersect", f"""{ORD} SELECT CAST(y AS INTEGER) AS ano FROM (VALUES (1994), (1996), (1999), (2004))
  AS t(y) INTERSECT SELECT ano FROM ord""")
def years_intersect(spark, sf):
    requested = spark.createDataFrame([(1994,), (1996,), (1999,), (2004,)], "ano int")
    return joins.years_available(requested, b.orders(spark, sf).select("ano"))


# --- windows ----------------------------------------------------------------

MONTHLY = f"""{ORD}, m AS (SELECT ano, mes, count(*) AS total_ocorrencias FROM ord GROUP BY ano, mes)"""


@query("moving_avg_year", f"""{ORD}, y AS (SELECT ano, count(*) AS total_ocorrencias FROM ord GROUP BY ano)
  SELECT ano, total_ocorrencias, round(avg(total_ocorrencias) OVER (ORDER BY ano
  ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS media_movel_3anos FROM y""")
def moving_avg_year(spark, sf):
    out = series.moving_average(agg.by_year(b.orders(spark, sf)), "ano")
    return out.withColumn("media_movel_3anos", F.round("media_movel_3anos", 6))


@query("mom_variation", f"""{MONTHLY}, p AS (SELECT m.*, a.total_ocorrencias AS anterior FROM m
  LEFT JOIN m a ON m.ano * 12 + m.mes = a.ano * 12 + a.mes + 1)
  SELECT ano, mes, total_ocorrencias, anterior,
  round(100.0 * (total_ocorrencias - anterior) / anterior, 2) AS variacao_pct,
  abs(100.0 * (total_ocorrencias - anterior) / anterior) <= 30 AS dentro_do_limite FROM p""")
def mom_variation(spark, sf):
    return series.month_on_month(agg.count_by(b.orders(spark, sf), "ano", "mes"))


def _monthly_sum_sql(value: str, limit: float) -> str:
    return f"""WITH s AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS ano, CAST(month(l_shipdate) AS INTEGER) AS mes,
      {value} AS total FROM lineitem GROUP BY 1, 2),
      p AS (SELECT s.*, a.total AS anterior FROM s LEFT JOIN s a ON s.ano * 12 + s.mes = a.ano * 12 + a.mes + 1)
      SELECT ano, mes, total, anterior, round(100.0 * (total - anterior) / anterior, 2) AS variacao_pct,
      abs(100.0 * (total - anterior) / anterior) <= {limit} AS dentro_do_limite FROM p"""


def _monthly_items(spark, sf, value):
    items = b.table(spark, sf, "lineitem")
    return items.groupBy(F.year("l_shipdate").alias("ano"), F.month("l_shipdate").alias("mes")).agg(value.alias("total"))


@query("mom_variation_rain", _monthly_sum_sql("sum(l_quantity)", 10))
def mom_variation_rain(spark, sf):
    """Rain may change by 10 % from month to month."""
    return series.month_on_month(_monthly_items(spark, sf, F.sum("l_quantity")), "total", 10)


@query("mom_variation_response", _monthly_sum_sql("count(*)", 15))
def mom_variation_response(spark, sf):
    """Response figures may change by 15 %."""
    return series.month_on_month(_monthly_items(spark, sf, F.count(F.lit(1))), "total", 15)


@query("deviation_hist", f"""{INC}, y AS (SELECT bairro, ano, count(*) AS total_ocorrencias FROM inc GROUP BY 1, 2),
  h AS (SELECT *, avg(total_ocorrencias) OVER (PARTITION BY bairro ORDER BY ano
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM y)
  SELECT bairro, ano, total_ocorrencias, round(m, 4) AS media_historica,
  round(100.0 * (total_ocorrencias - m) / m, 2) AS desvio_pct,
  abs(100.0 * (total_ocorrencias - m) / m) <= 20 AS dentro_do_limite FROM h""")
def deviation_hist(spark, sf):
    yearly = agg.count_by(b.incidents(spark, sf), "bairro", "ano")
    return series.deviation_from_history(yearly, "bairro", ["ano"])


@query("gaps", f"""{CALLS}, d AS (SELECT DISTINCT posto, CAST(data_atendimento AS DATE) AS dia_atividade FROM calls),
  l AS (SELECT *, lag(dia_atividade) OVER (PARTITION BY posto ORDER BY dia_atividade) AS dia_anterior FROM d)
  SELECT posto, dia_atividade, dia_anterior,
  CAST(date_diff('day', dia_anterior, dia_atividade) AS INTEGER) AS dias FROM l
  WHERE date_diff('day', dia_anterior, dia_atividade) > 2""")
def gaps(spark, sf):
    return series.gaps(b.calls(spark, sf), "data_atendimento", ("posto",))


def _volume_sql(source: str, keys: str, ratio: float) -> str:
    part = f"PARTITION BY {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""
    return f"""{source}, d AS (SELECT {lead}CAST(data_atendimento AS DATE) AS dia, count(*) AS total_ocorrencias
      FROM calls GROUP BY {lead}CAST(data_atendimento AS DATE)),
      u AS (SELECT *, avg(total_ocorrencias) OVER ({part} ORDER BY dia ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS m FROM d)
      SELECT {lead}dia, total_ocorrencias, round(m, 4) AS volume_usual,
      total_ocorrencias < {ratio} * m AS volume_baixo FROM u"""


@query("volume_check", _volume_sql(CALLS, "", 0.8))
def volume_check(spark, sf):
    return series.volume_check(b.calls(spark, sf), "data_atendimento")


@query("volume_check_by_kind", _volume_sql(CALLS, "tipo_ocorrencia", 0.7))
def volume_check_by_kind(spark, sf):
    return series.volume_check(
        b.calls(spark, sf), "data_atendimento", ("tipo_ocorrencia",), min_ratio=0.7
    )


@query("yoy", f"""{ORD}, y AS (SELECT ano, count(*) AS total_ocorrencias FROM ord GROUP BY ano)
  SELECT y.ano, y.total_ocorrencias, a.total_ocorrencias AS anterior,
  round(100.0 * (y.total_ocorrencias - a.total_ocorrencias) / a.total_ocorrencias, 2) AS variacao_pct,
  a.ano IS NOT NULL AS comparavel FROM y LEFT JOIN y a ON y.ano = a.ano + 1""")
def yoy(spark, sf):
    return series.year_over_year(agg.by_year(b.orders(spark, sf)))


# --- dashboard datasets -----------------------------------------------------

@query("kpis", f"""{INC}, y AS (SELECT ano, count(*) AS n FROM inc GROUP BY ano),
  m AS (SELECT mes, count(*) AS n FROM inc GROUP BY mes)
  SELECT count(*) AS total_ocorrencias, CAST(count(DISTINCT ano) AS INTEGER) AS anos_cobertos,
  count(DISTINCT bairro) AS bairros_afetados,
  round(count(ano) / (count(DISTINCT ano) * 12), 2) AS media_mensal,
  (SELECT ano FROM y ORDER BY n DESC, ano LIMIT 1) AS ano_mais_ocorrencias,
  (SELECT mes FROM m ORDER BY n DESC, mes LIMIT 1) AS mes_mais_ocorrencias FROM inc""")
def kpis(spark, sf):
    return datasets.kpis(b.incidents(spark, sf))


@query("bi_time_series", f"""{ORD}, y AS (SELECT ano, count(*) AS total_ocorrencias FROM ord GROUP BY ano)
  SELECT ano, total_ocorrencias, round(avg(total_ocorrencias) OVER (ORDER BY ano
  ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS media_movel_3anos FROM y""")
def bi_time_series(spark, sf):
    out = datasets.time_series(b.orders(spark, sf))
    return out.withColumn("media_movel_3anos", F.round("media_movel_3anos", 6))


@query("bi_area_ranking", f"""{INC}, a AS (SELECT bairro, count(*) AS total_ocorrencias FROM inc GROUP BY bairro)
  SELECT bairro, total_ocorrencias,
  CAST(row_number() OVER (ORDER BY total_ocorrencias DESC, bairro) AS INTEGER) AS ranking,
  round(100.0 * total_ocorrencias / sum(total_ocorrencias) OVER (), 2) AS percentual FROM a""")
def bi_area_ranking(spark, sf):
    return datasets.area_ranking(b.incidents(spark, sf))


@query("bi_seasonality", f"""{ORD}, m AS (SELECT mes, count(*) AS total_ocorrencias FROM ord GROUP BY mes)
  SELECT mes, total_ocorrencias, {MONTH_CASE} AS nome_mes, {SEASON_CASE} AS estacao,
  round(100.0 * total_ocorrencias / sum(total_ocorrencias) OVER (), 2) AS percentual FROM m""")
def bi_seasonality(spark, sf):
    return datasets.seasonality(b.orders(spark, sf))


@query("bi_rain_correlation", f"""{MONTHLY} SELECT ano, mes, total_ocorrencias,
  CAST({RAIN_CASE} AS INTEGER) AS chuva_mm, {DRY_CASE} AS estacao_chuvosa FROM m""")
def bi_rain_correlation(spark, sf):
    return datasets.rain_correlation(b.orders(spark, sf))


@query("rain_season_flag", f"""{ORD} SELECT {DRY_CASE} AS estacao_chuvosa, count(*) AS n FROM ord GROUP BY 1""")
def rain_season_flag(spark, sf):
    flagged = b.orders(spark, sf).select(dates.rain_period(F.col("mes")).alias("estacao_chuvosa"))
    return flagged.groupBy("estacao_chuvosa").agg(F.count(F.lit(1)).alias("n"))


def _top_sql(label: str, key: str, shown: str, tie: str, k: int) -> str:
    return f"""SELECT '{label}' AS indicador, CAST(p AS INTEGER) AS posicao, {shown} AS valor, n FROM (
      SELECT {key}, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, {tie}) AS p
      FROM inc GROUP BY {key}) WHERE p <= {k}"""


@query("general_stats", f"""{INC}
  SELECT 'total_registros' AS indicador, 1 AS posicao, CAST(NULL AS VARCHAR) AS valor, count(*) AS n FROM inc
  UNION ALL SELECT 'ano_inicio', 1, CAST(min(ano) AS VARCHAR), NULL FROM inc
  UNION ALL SELECT 'ano_fim', 1, CAST(max(ano) AS VARCHAR), NULL FROM inc
  UNION ALL SELECT 'anos_disponiveis', CAST(row_number() OVER (ORDER BY ano) AS INTEGER),
    CAST(ano AS VARCHAR), count(*) FROM inc GROUP BY ano
  UNION ALL {_top_sql('top_bairros', 'bairro', 'bairro', 'bairro', 5)}
  UNION ALL {_top_sql('top_tipos', 'tipo_ocorrencia', 'tipo_ocorrencia', 'tipo_ocorrencia', 5)}
  UNION ALL {_top_sql('mes_mais_ocorrencias', 'mes', MONTH_CASE, 'mes', 1)}
  UNION ALL {_top_sql('estacao_mais_ocorrencias', 'estacao', 'estacao', 'estacao', 1)}""")
def general_stats(spark, sf):
    return datasets.general_stats(b.incidents(spark, sf))


def _set_sql(name: str, key: str, key2: str | None = None) -> str:
    second = f"CAST({key2} AS VARCHAR)" if key2 else "CAST(NULL AS VARCHAR)"
    group = f"{key}, {key2}" if key2 else key
    return f"""SELECT '{name}' AS agregacao, CAST({key} AS VARCHAR) AS chave, {second} AS chave2,
      count(*) AS total_ocorrencias FROM inc GROUP BY {group}"""


@query("all_aggregates", INC + " " + " UNION ALL ".join([
    _set_sql("por_ano", "ano"), _set_sql("por_bairro", "bairro"), _set_sql("por_tipo", "tipo_ocorrencia"),
    _set_sql("por_mes", "mes"), _set_sql("por_estacao", "estacao"),
    _set_sql("por_dia_semana", "dia_semana_nome"), _set_sql("por_hora", "hora"),
    _set_sql("por_bairro_ano", "bairro", "ano"), _set_sql("por_tipo_ano", "tipo_ocorrencia", "ano"),
]))
def all_aggregates(spark, sf):
    return datasets.all_aggregates(b.incidents(spark, sf))
