"""Dashboard datasets and the aggregate set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stormledger import vocab
from stormledger.functions import dates
from stormledger.operators import aggregates as agg, joins, series
from stormledger.operators.ranking import top_per_group

TOTAL = agg.TOTAL
# Keys of the base aggregate: every dashboard number is a sum over it.
BASE_KEYS = ["ano", "mes", "estacao", "dia_semana_nome", "hora", "bairro", "tipo_ocorrencia"]


def base_aggregate(df: DataFrame, keys: list[str] = BASE_KEYS) -> DataFrame:
    """Row counts per full key combination, nulls kept; feed it on with ``weight``."""
    return agg.count_by(df, *[k for k in keys if k in df.columns], keep_null=True)


def kpis(df: DataFrame, area: str = "bairro", weight: str | None = None) -> DataFrame:
    """One row: totals, covered years, affected areas, monthly mean, top year and month.

    One pass: rows shrink to (year, month, area) counts, grouping sets of those
    give the per-year, per-month and per-area counts, and a last aggregation
    picks the figures from them.
    """
    base = agg.count_by(df, "ano", "mes", area, weight=weight, keep_null=True)
    per_key = base.groupingSets([["ano"], ["mes"], [area]], "ano", "mes", area).agg(
        F.sum(TOTAL).alias("n"), F.grouping_id("ano", "mes", area).alias("g")
    )
    year, month, of_area = F.col("g") == 3, F.col("g") == 5, F.col("g") == 6
    dated = year & F.col("ano").isNotNull()

    def top(rows, key):
        # Largest count, then smallest key.
        best = F.max(F.when(rows & F.col(key).isNotNull(), F.struct("n", (-F.col(key)).alias("k"))))
        return (-best["k"]).cast("int")

    return per_key.agg(
        F.coalesce(F.sum(F.when(of_area, F.col("n"))), F.lit(0)).alias(TOTAL),
        F.count_if(dated).cast("int").alias("anos_cobertos"),
        F.count_if(of_area & F.col(area).isNotNull()).alias("bairros_afetados"),
        F.round(F.try_divide(F.sum(F.when(dated, F.col("n"))), F.count_if(dated) * 12), 2).alias(
            "media_mensal"
        ),
        top(year, "ano").alias("ano_mais_ocorrencias"),
        top(month, "mes").alias("mes_mais_ocorrencias"),
    )


def time_series(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Yearly totals with the three-row moving average."""
    yearly = agg.count_by(df, "ano", weight=weight).withColumn("ano", F.col("ano").cast("int"))
    return series.moving_average(yearly, "ano").orderBy("ano")


def area_ranking(df: DataFrame, area: str = "bairro", weight: str | None = None) -> DataFrame:
    """Areas by total with rank and percent."""
    shares = agg.with_share(agg.count_by(df, area, weight=weight))
    return agg.with_ranking(shares, area).orderBy("ranking")


def seasonality(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Months with name, season and percent."""
    month = F.col("mes").cast("int")
    monthly = agg.count_by(df, "mes", weight=weight).withColumns({
        "nome_mes": dates.month_name(month),
        "estacao": dates.season(month, vocab.SEASONS_ACCENTED),
    })
    return agg.with_share(monthly).orderBy("mes")


def rain_correlation(
    df: DataFrame, rain: DataFrame | None = None, weight: str | None = None
) -> DataFrame:
    """(year, month) totals with the rain of the month and the rain period."""
    monthly = agg.count_by(df, "ano", "mes", weight=weight).select(
        F.col("ano").cast("int").alias("ano"), F.col("mes").cast("int").alias("mes"), TOTAL
    )
    return (
        joins.join_month_rain(monthly, rain)
        .withColumn("estacao_chuvosa", dates.rain_period(F.col("mes")))
        .select("ano", "mes", TOTAL, "chuva_mm", "estacao_chuvosa")
        .orderBy("ano", "mes")
    )


def general_stats(
    df: DataFrame, area: str = "bairro", kind: str = "tipo_ocorrencia", k: int = 5,
    weight: str | None = None,
) -> DataFrame:
    """(indicador, posicao, valor, n) rows: total, covered years, top k areas and kinds, modes.

    All rows come from one (year, month, season, area, kind) aggregate. Nothing
    filters on its keys, so its shuffle is shared by all branches.
    """
    columns = ["ano", "mes", "estacao", area, kind]
    base = agg.count_by(df, *columns, weight=weight, keep_null=True)
    census = (
        base.select(TOTAL, *[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([TOTAL], columns, "coluna", "valor")
        .where(F.col("valor").isNotNull())
        .groupBy("coluna", "valor").agg(F.sum(TOTAL).alias("n"))
    )
    value, n, column = F.col("valor"), F.col("n"), F.col("coluna")
    number = F.when(column.isin("ano", "mes"), value.try_cast("int"))

    years = census.where(column == "ano")
    by_year = Window.orderBy(value)

    def row(label: str, position: Column, count: Column) -> Column:
        return F.struct(
            F.lit(label).alias("indicador"), position.cast("int").alias("posicao"),
            value.alias("valor"), count.cast("bigint").alias("n"),
        )

    # One row per year: a bounded window. The first and last year give a row of their own.
    is_first, is_last = F.col("_p") == 1, F.col("_next").isNull()
    numbered = years.select(
        "valor", "n", F.row_number().over(by_year).alias("_p"), F.lead(value).over(by_year).alias("_next")
    )
    listed = numbered.select(F.inline(F.array_compact(F.array(
        row("anos_disponiveis", F.col("_p"), n),
        F.when(is_first, row("ano_inicio", F.lit(1), F.lit(None))),
        F.when(is_last, row("ano_fim", F.lit(1), F.lit(None))),
    ))))
    label = F.create_map(*[F.lit(x) for x in (
        "mes", "mes_mais_ocorrencias", "estacao", "estacao_mais_ocorrencias",
        area, "top_bairros", kind, "top_tipos",
    )])
    # Months tie by number, names by letter.
    top = top_per_group(
        census.where(column != "ano"), ["coluna"], [n.desc(), number, value], k, "posicao"
    )
    tops = top.where(column.isin(area, kind) | (F.col("posicao") == 1)).select(
        F.element_at(label, column).alias("indicador"), "posicao",
        F.when(column == "mes", dates.month_name(number)).otherwise(value).alias("valor"), "n",
    )
    total = base.agg(F.sum(TOTAL).alias("n")).select(
        F.lit("total_registros").alias("indicador"), F.lit(1).alias("posicao"),
        F.lit(None).cast("string").alias("valor"), "n",
    )
    return total.unionByName(listed).unionByName(tops)


def aggregate_frames(
    df: DataFrame, area: str = "bairro", kind: str = "tipo_ocorrencia", weight: str | None = None
) -> dict[str, DataFrame]:
    """The named aggregates, each a sum over small counts.

    Several writes follow, so hand in a base aggregate that was written to a
    table (``base_aggregate``) with its ``weight``: the rows are then read once.
    """
    keys = ["ano", "mes", "estacao", "dia_semana_nome", "hora", area, kind]
    base = agg.count_by(df, *keys, weight=weight, keep_null=True)
    return {
        "por_ano": agg.by_year(base, TOTAL),
        "por_bairro": agg.by_area(base, area, TOTAL),
        "por_tipo": agg.by_kind(base, kind, TOTAL),
        "por_mes": agg.by_month(base, TOTAL),
        "por_estacao": agg.by_season(base, TOTAL),
        "por_dia_semana": agg.by_weekday(base, TOTAL),
        "por_hora": agg.by_hour(base, TOTAL),
        "por_bairro_ano": agg.by_area_year(base, area, TOTAL),
        "por_tipo_ano": agg.by_kind_year(base, kind, TOTAL),
    }


def all_aggregates(
    df: DataFrame, area: str = "bairro", kind: str = "tipo_ocorrencia", weight: str | None = None
) -> DataFrame:
    """All count aggregates as (agregacao, chave, chave2, total_ocorrencias) rows.

    Rows shrink to the base aggregate first, so the grouping sets expand
    counts, not incidents.
    """
    keys = ["ano", "mes", "estacao", "dia_semana_nome", "hora", area, kind]
    sets = {
        "por_ano": ["ano"], "por_bairro": [area], "por_tipo": [kind], "por_mes": ["mes"],
        "por_estacao": ["estacao"], "por_dia_semana": ["dia_semana_nome"], "por_hora": ["hora"],
        "por_bairro_ano": [area, "ano"], "por_tipo_ano": [kind, "ano"],
    }
    base = agg.count_by(df, *keys, weight=weight, keep_null=True)
    counted = base.groupingSets(list(sets.values()), *keys).agg(
        F.sum(TOTAL).alias(TOTAL), F.grouping_id(*keys).alias("_g")
    )

    def mask(columns: list[str]) -> int:
        # grouping_id has one bit per key, first key highest, set where rolled up.
        return sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in columns)

    def by_set(value) -> Column:
        out = None
        for name, columns in sets.items():
            here = (F.col("_g") == mask(columns), value(name, columns))
            out = F.when(*here) if out is None else out.when(*here)
        return out

    return counted.select(
        by_set(lambda name, cols: F.lit(name)).alias("agregacao"),
        by_set(lambda name, cols: F.col(cols[0]).cast("string")).alias("chave"),
        by_set(lambda name, cols: F.col(cols[1]).cast("string") if cols[1:] else F.lit(None).cast("string")).alias("chave2"),
        by_set(lambda name, cols: F.col(cols[0]).isNotNull() & (F.col(cols[1]).isNotNull() if cols[1:] else F.lit(True))).alias("_ok"),
        TOTAL,
    ).where("_ok").drop("_ok")
