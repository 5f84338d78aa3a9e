"""Write, audit, publish: a load is seen only after its critical rules hold.

A store is a folder with two tables. ``linhas`` holds the rows of every load, by load,
situation (accepted or rejected) and year; ``cargas`` one row per load with its
verdict, the result of each rule and its rows per year. Rows are written first and
audited as stored; one small file in ``cargas`` then publishes the load, so a reader
finds the state before or after it, never between. A refused load leaves the
published rows as they are. One load at a time may run on a store; one that broke off is
written anew under the same number.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from stormledger.operators import quality
from stormledger.operators.quality import CRITICAL, Rule
from stormledger.session import stored_table

LOAD, SITUATION, BROKEN = "carga", "situacao", "regras_violadas"
ACCEPTED, REJECTED = "aceita", "rejeitada"
LOADS = (
    "carga int, aceito boolean, qualidade double, falhas_criticas bigint, "
    "regras array<struct<regra: string, severidade: string, verificados: bigint, falhas: bigint, razao: double, aprovado: boolean>>, "
    "anos array<struct<ano: int, linhas: bigint, rejeitadas: bigint>>"
)


def loads(spark: SparkSession, store: str) -> DataFrame:
    """All loads of a store, refused ones too; none before the first."""
    return stored_table(spark, f"{store}/cargas", LOADS)


def publish(
    df: DataFrame, store: str, rules: list[Rule], year: str = "ano", minimum: float = 0.95, reject: tuple[str, ...] = (CRITICAL,),
    set_rules: Callable[[DataFrame], list[DataFrame]] | None = None,
) -> DataFrame:
    """Store a load, judge it and publish it unless it is refused; returns its row of ``cargas``.

    The load is refused if a critical rule fails beyond its tolerance or the quality is
    below ``minimum``. Rows that break a rule of the severities in ``reject`` are
    kept apart with the names of all rules they break (``quarantine``) and
    never published; other rows carry these names. ``set_rules`` gives results of rules about
    all stored rows, such as duplicates. In ``current`` a published load replaces
    the years it has accepted rows of.
    """
    clash = {LOAD, SITUATION, BROKEN} & set(df.columns)
    if clash:
        raise ValueError(f"columns of the store itself: {sorted(clash)}")
    spark = df.sparkSession
    number = 1 + (loads(spark, store).agg(F.max(LOAD)).first()[0] or 0)
    rejecting = [r.name for r in rules if r.severity in reject]
    broken = F.arrays_overlap(BROKEN, F.array(*map(F.lit, rejecting)).cast("array<string>"))
    marked = quality.flag(df, rules).withColumn(SITUATION, F.when(broken, F.lit(REJECTED)).otherwise(F.lit(ACCEPTED)))
    folder = f"{store}/linhas/{LOAD}={number}"
    marked.write.mode("overwrite").partitionBy(SITUATION, year).parquet(folder)

    staged = spark.read.schema(marked.schema).parquet(folder)
    # the marks alone are read again, not the columns the rules look at
    marks = [Rule(r.name, r.severity, ~F.array_contains(BROKEN, r.name), r.tolerance) for r in rules]
    results = [quality.check(staged, marks), *(set_rules(staged) if set_rules else [])]
    judged = reduce(DataFrame.unionByName, results).agg(
        F.sort_array(F.collect_list(F.struct("regra", "severidade", "verificados", "falhas", "razao", "aprovado"))).alias("regras"))
    per_year = staged.groupBy(F.col(year).cast("int").alias("ano")).agg(
        F.count_if(F.col(SITUATION) == ACCEPTED).alias("linhas"), F.count_if(F.col(SITUATION) == REJECTED).alias("rejeitadas"))
    years = per_year.agg(F.sort_array(F.collect_list(F.struct("ano", "linhas", "rejeitadas"))).alias("anos"))
    card = quality.scorecard(results, minimum).select("aceito", "qualidade", "falhas_criticas")
    # one row each
    row = card.crossJoin(judged).crossJoin(years).select(
        F.lit(number).alias(LOAD), "aceito", "qualidade", "falhas_criticas", "regras", "anos")
    row.coalesce(1).write.mode("append").parquet(f"{store}/cargas")
    return loads(spark, store).where(F.col(LOAD) == number)


def _rows(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(f"{store}/linhas")


def current(spark: SparkSession, store: str, year: str = "ano") -> DataFrame:
    """The published rows: of each year those of the last accepted load that has any."""
    seen = loads(spark, store).where("aceito").select(LOAD, F.inline("anos")).where("linhas > 0")
    # one row per year
    valid = seen.groupBy("ano").agg(F.max(LOAD).alias(LOAD)).collect()
    kept = [F.col(year).eqNullSafe(F.lit(r["ano"])) & (F.col(LOAD) == r[LOAD]) for r in valid]
    rows = _rows(spark, store).where(F.col(SITUATION) == ACCEPTED)
    return rows.where(reduce(lambda a, b: a | b, kept) if kept else F.lit(False)).drop(SITUATION)


def quarantine(spark: SparkSession, store: str) -> DataFrame:
    """Rejected rows of all loads with the rules they break, and whether their load was published."""
    verdicts = loads(spark, store).select(LOAD, F.col("aceito").alias("carga_aceita"))
    return _rows(spark, store).where(F.col(SITUATION) == REJECTED).drop(SITUATION).join(verdicts, LOAD)
