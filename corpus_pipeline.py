"""A corpus from raw documents: language, toxicity, near copies, mix, token ids.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written and
read again as the next one's docs. All but the last return documents with their
columns. Models are learnt from the stage's own documents; labels of toxicity
come from the table `labels`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormledger import session
from stormledger.llm import cube_mix, dawg_bpe, deobfuscate, lang_rank, order_join

#: Least score of a language; a text that fits no known language scores near 0.
MIN_LANGUAGE = 0.2
MAX_TOXICITY = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the corpus names."""
    return lang_rank.known(docs, lang_rank.train(docs), MIN_LANGUAGE)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic once deobfuscated."""
    scorer = deobfuscate.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), F.lit(True))
    return deobfuscate.clean(docs, scorer, MAX_TOXICITY)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies, that of the smallest id.

    Near copies share 80 % of their five-word shingles, directly or over others.
    """
    found = order_join.components(docs, n=5, percent=80)
    return order_join.one_of_each(docs, found)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return cube_mix.take(docs, cube_mix.mix(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids as digests, one row for each copy of a document."""
    return dawg_bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language", language), ("toxicity", toxicity), ("near_copies", near_copies), ("mixture", mixture), ("tokens", tokens)]
#: Learnt models and balanced draws are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = session.materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
