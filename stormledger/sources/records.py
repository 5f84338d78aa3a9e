"""JSON records, HTML blocks and the resource catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

CATALOG_SCHEMA = "struct<result: struct<resources: array<struct<name: string, url: string>>>>"


def json_records(df: DataFrame, payload: str, record_schema: str, *keep: str) -> DataFrame:
    """One row per JSON record: a list gives its elements, an object itself, anything else none."""
    text = F.ltrim(F.col(payload))
    container = text.startswith("[") | text.startswith("{")
    records = F.from_json(payload, f"array<{record_schema}>")
    return (
        df.where(container).select(*keep, F.explode(records).alias("_r"))
        .where(F.col("_r").isNotNull())
        .select(*keep, "_r.*")
    )


def block_pattern(tag: str) -> str:
    return rf"(?s)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>"


def html_block_counts(df: DataFrame, html: str, tag: str, *keep: str) -> DataFrame:
    """Number of ``tag`` blocks per page."""
    found = F.regexp_extract_all(html, F.lit(block_pattern(tag)), 1)
    return df.select(*keep, F.size(found).alias("blocos"))


def html_blocks(df: DataFrame, html: str, tag: str, *keep: str) -> DataFrame:
    """One row per ``tag`` block with its position and content."""
    found = F.regexp_extract_all(html, F.lit(block_pattern(tag)), 1)
    return df.select(*keep, F.posexplode(found).alias("posicao", "conteudo"))


def catalog_resources(df: DataFrame, payload: str) -> DataFrame:
    """(posicao, name, url) rows of catalogue documents."""
    parsed = F.from_json(payload, CATALOG_SCHEMA)
    return df.select(
        F.posexplode(parsed["result"]["resources"]).alias("posicao", "r")
    ).select("posicao", "r.name", "r.url")


def resource_year(name: Column) -> Column:
    """First all-digit word of an "atendimentos" resource name, null for other resources."""
    lower = F.lower(name)
    numbers = F.filter(F.split(lower, r"\s+"), lambda w: w.rlike("^[0-9]+$"))
    return F.when(lower.contains("atendimentos"), F.get(numbers, 0).cast("int"))


def catalog_years(resources: DataFrame) -> DataFrame:
    """Years the catalogue offers, sorted."""
    return (
        resources.select(resource_year(F.col("name")).alias("ano"))
        .where(F.col("ano").isNotNull())
        .orderBy("ano")
    )


def match_resource(resources: DataFrame, years: DataFrame) -> DataFrame:
    """First resource per requested year named "atendimentos Y" or "atendimentos-Y".

    The year is cut out of the name, so the match is an equi-join. The name
    may go on after the year ("atendimentos 2024 v2", "atendimentos 20245").
    """
    lower = F.lower(F.col("name"))
    mentioned = F.array_distinct(
        F.regexp_extract_all(lower, F.lit(r"atendimentos[ -](\d{4})"), 1).cast("array<int>")
    )
    hits = resources.select("posicao", "name", "url", F.explode(mentioned).alias("ano"))
    first = Window.partitionBy("ano").orderBy("posicao")
    return (
        hits.join(years, "ano", "left_semi")
        .withColumn("_r", F.row_number().over(first)).where(F.col("_r") == 1)
        .select("ano", "name", "url")
    )
