"""Data-quality rules.

A row rule is a name, a severity and a condition that good rows meet. Any
number of row rules is checked in one pass; set rules (uniqueness, volume,
ratios) come as frames of the same shape and join the scorecard by union.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stormledger.functions import dates, text
from stormledger.functions.values import known, present
from stormledger.operators.ranking import latest_per_key

CRITICAL, HIGH, MEDIUM = "critica", "alta", "media"


@dataclass(frozen=True)
class Rule:
    name: str
    severity: str
    ok: Column
    # Share of failing rows that is still accepted.
    tolerance: float = 0.0


def _passes(rule: Rule) -> Column:
    # A condition on a null value is unknown; unknown counts as failed.
    return F.coalesce(rule.ok, F.lit(False))


def check(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """regra, severidade, verificados, falhas, razao, aprovado per rule, in one pass."""
    measures = [
        F.struct(
            F.lit(r.name).alias("regra"), F.lit(r.severity).alias("severidade"),
            F.count(F.lit(1)).alias("verificados"), F.count_if(~_passes(r)).alias("falhas"),
            F.lit(float(r.tolerance)).alias("tolerancia"),
        )
        for r in rules
    ]
    return _judge(df.agg(F.array(*measures).alias("m")).select(F.inline("m")))


def _judge(measured: DataFrame) -> DataFrame:
    ratio = F.coalesce(F.try_divide(F.col("falhas"), F.col("verificados")), F.lit(0.0))
    return measured.select(
        "regra", "severidade", "verificados", "falhas", F.round(ratio, 6).alias("razao"),
        (ratio <= F.col("tolerancia")).alias("aprovado"),
    )


def flag(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows with the names of the rules they break in ``regras_violadas``."""
    broken = F.array(*[F.when(~_passes(r), F.lit(r.name)) for r in rules])
    return df.withColumn("regras_violadas", F.array_compact(broken))


def mark_accepted(df: DataFrame, required: list[str], out: str = "aceito") -> DataFrame:
    """Whether all required fields of a row are present."""
    return df.withColumn(out, reduce(lambda a, b: a & b, [present(df, c) for c in required]))


def split_required(df: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) rows by all required fields being present."""
    marked = mark_accepted(df, required, "_ok")
    return marked.where("_ok").drop("_ok"), marked.where("NOT _ok").drop("_ok")


def required_rules(required: list[str]) -> list[Rule]:
    return [Rule(f"{c}_presente", CRITICAL, known(F.col(c))) for c in required]


def fill_unknown(df: DataFrame, column: str, label: str = "desconhecido") -> DataFrame:
    return df.withColumn(column, F.coalesce(column, F.lit(label)))


def range_rule(column: str, low: float, high: float, severity: str = HIGH) -> Rule:
    return Rule(f"{column}_no_intervalo", severity, F.col(column).between(low, high))


def bbox_rule(x: str, y: str, x_range: tuple, y_range: tuple, severity: str = MEDIUM) -> Rule:
    """Both coordinates inside the box."""
    return Rule("coordenadas_na_area", severity, F.col(x).between(*x_range) & F.col(y).between(*y_range))


def freshness_rule(column: str, reference: Column, days: int, severity: str = MEDIUM) -> Rule:
    """Dates within the last ``days`` days up to the reference."""
    c = F.col(column)
    return Rule(
        f"{column}_recente", severity,
        (c >= F.date_add(F.to_date(reference), -days)) & (c <= reference),
    )


def date_format_rule(column: str, severity: str = HIGH) -> Rule:
    """ISO text: yyyy-MM-dd with an optional time, all of it readable."""
    c = text.strip(F.col(column))
    iso = c.rlike(r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?$")
    real = dates.parse_date(F.col(column)).isNotNull()
    return Rule(f"{column}_iso", severity, F.when(iso, real).otherwise(F.lit(False)))


def convert_dates(df: DataFrame, column: str) -> DataFrame:
    """Convert dates of any accepted format and mark what had to be converted or was lost."""
    ok = F.coalesce(date_format_rule(column).ok, F.lit(False))
    parsed = dates.parse_date(F.col(column))
    action = F.when(ok, F.lit("ok")).when(parsed.isNotNull(), F.lit("convertido")).otherwise(
        F.lit("invalido")
    )
    return df.withColumns({"data_convertida": parsed, "situacao": action})


def daily_range(df: DataFrame, date: str, value: Column, low: float, high: float, *keys: str):
    """Daily totals outside [low, high]."""
    daily = df.where(F.col(date).isNotNull()).groupBy(*keys, F.to_date(date).alias("dia")).agg(
        F.sum(value).alias("total_dia")
    )
    outside = daily.where(~F.col("total_dia").between(low, high))
    return outside.withColumn("total_dia", F.round("total_dia", 2))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def duplicate_ratio(df: DataFrame, keys: list[str], limit: float = 0.05) -> DataFrame:
    """Surplus rows per key as a rule result; hot keys are combined before the shuffle."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return _judge(per_key.agg(
        F.lit("duplicatas").alias("regra"), F.lit(HIGH).alias("severidade"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("verificados"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("falhas"),
        F.lit(float(limit)).alias("tolerancia"),
    ))


def keep_latest(df: DataFrame, keys: list[str], ts: str, tie: list[Column]) -> DataFrame:
    """The most recent row of each key."""
    return latest_per_key(df, keys, F.desc(ts), *tie)


def null_ratio(df: DataFrame, limit: float = 0.15, columns: list[str] | None = None) -> DataFrame:
    """One rule per column: share of nulls within the limit."""
    return check(df, [
        Rule(c, HIGH, present(df, c), limit) for c in (columns or df.columns)
    ])


def schema_check(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """Expected against actual columns, and the cells that do not fit the expected type."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema}

    def situation(name: str) -> str:
        if name not in actual:
            return "ausente"
        if name not in expected:
            return "extra"
        return "ok" if actual[name] == expected[name] else "tipo_diferente"

    def misfits(name: str) -> Column:
        if name not in actual or name not in expected:
            return F.lit(0).cast("bigint")
        c = F.col(name)
        return F.count_if(c.isNotNull() & c.try_cast(expected[name]).isNull())

    measures = [
        F.struct(
            F.lit(name).alias("coluna"), F.lit(expected.get(name)).cast("string").alias("esperado"),
            F.lit(actual.get(name)).cast("string").alias("encontrado"),
            F.lit(situation(name)).alias("situacao"), misfits(name).alias("invalidos"),
        )
        for name in dict.fromkeys([*expected, *actual])
    ]
    return df.agg(F.array(*measures).alias("m")).select(F.inline("m"))


def scorecards(results: dict[str, list[DataFrame]], minimum: float = 0.95) -> DataFrame:
    """One scorecard per dataset, in ``conjunto``."""
    return reduce(DataFrame.unionByName, [
        scorecard(found, minimum).withColumn("conjunto", F.lit(name)) for name, found in results.items()
    ])


def scorecard(results: list[DataFrame], minimum: float = 0.95) -> DataFrame:
    """Quality of a dataset: share of passed checks, critical failures and the verdict."""
    rules = reduce(DataFrame.unionByName, results)
    score = F.lit(1.0) - F.coalesce(
        F.try_divide(F.sum("falhas"), F.sum("verificados")), F.lit(0.0)
    )
    critical = F.count_if((F.col("severidade") == CRITICAL) & ~F.col("aprovado"))
    return (
        rules.agg(
            F.count(F.lit(1)).alias("regras"), F.count_if("aprovado").alias("aprovadas"),
            critical.alias("falhas_criticas"), score.alias("qualidade"),
        )
        .withColumn("aceito", (F.col("qualidade") >= minimum) & (F.col("falhas_criticas") == 0))
        .withColumn("qualidade", F.round("qualidade", 6))
    )


def rain_rules(date: str, station: str, mm: str, reference: Column) -> list[Rule]:
    """Row rules of the rain source: required fields, 0..500 mm, last 30 days."""
    return [
        *required_rules([date, station, mm]),
        range_rule(mm, 0, 500),
        freshness_rule(date, reference, 30),
    ]


def incident_rules(date: str, kind: str, area: str, reference: Column) -> list[Rule]:
    """Row rules of the incident source: required fields, area present, last 7 days."""
    return [
        *required_rules([date, kind]),
        Rule(f"{area}_presente", HIGH, F.col(area).isNotNull()),
        freshness_rule(date, reference, 7),
    ]
