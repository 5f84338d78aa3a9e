"""Queries of the training-data operators, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormledger.llm import cube_mix, dawg_bpe, deobfuscate, lang_rank, line_rules, maxent_lm, order_join, pivots, pstable, range_coder, runs, sql, texts, url_gbt, vantage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query under a name."""
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            SQL[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_line_rules")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-first cleaning."""
    return line_rules.score(table(spark, sf_dir, "documents"))


@query("op2_range_coder")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids written to compressed files and read back."""
    return range_coder.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op3_cube_mix")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balanced mixing of sources."""
    return cube_mix.mix(table(spark, sf_dir, "documents")).drop("digest")


@query("op4_deobfuscate")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity after deobfuscation; a fifth of the documents is held out."""
    docs = table(spark, sf_dir, "documents")
    scorer = deobfuscate.train(docs, table(spark, sf_dir, "labels"), texts.fold("doc_id", 5) != 0)
    scored = deobfuscate.score(docs, scorer)
    return scored.select(
        "doc_id", (texts.fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op5_dawg_bpe")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BPE ids and decoded texts as digests."""
    return dawg_bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op6_order_join")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near copies."""
    return order_join.components(table(spark, sf_dir, "documents"))


@query("op7_lang_rank")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text; a third of the documents is held out."""
    docs = table(spark, sf_dir, "documents")
    profiles = lang_rank.train(docs.filter(texts.fold("doc_id", 3) != 1))
    return lang_rank.predict(docs, profiles).select(
        "doc_id", (texts.fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


@query("op8_maxent_lm")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language model scores; a tenth of the documents is held out."""
    scored = maxent_lm.fit_and_score(table(spark, sf_dir, "documents"), texts.fold("doc_id", 10) != 0)
    return scored.select(
        "doc_id", (texts.fold("doc_id", 10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op9_multiprobe")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest neighbours of every 50th vector."""
    return pstable.search(table(spark, sf_dir, "embeddings"))


@query("op10_url_gbt")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL verdicts."""
    return url_gbt.judge(table(spark, sf_dir, "pages"))


@query("op11_vantage_tree", sql.clusters())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of the vectors after five rounds."""
    return vantage.cluster(table(spark, sf_dir, "embeddings"))


@query("op12_cover_runs", sql.word_runs())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words, with some texts made periodic."""
    docs = table(spark, sf_dir, "documents")
    return runs.digests(runs.runs(docs, text=runs.planted(docs)))


@query("op13_pivot_index", sql.largest_products())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest inner products of every 20th vector."""
    return pivots.search(table(spark, sf_dir, "embeddings"))
