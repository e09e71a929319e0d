"""A cleaned, deduplicated, mixed and sharded corpus: five stages, each stored before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from schoolatlas.llm import decontaminate, language, mixing, ngram_join, sharding
from schoolatlas.llm.common import store, table

#: A text must be this much likelier under its language than under all others together.
LEAST_SCORE = 0.5
#: Near duplicates: five words a shingle, a similarity of 0.8 or more.
SHINGLE_WORDS, SHINGLE_PERCENT = 5, 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of no language, or of none that stands out, go.  The model learns from the stage's input."""
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    found = language.identify(rows, language.learn(docs), rows["row"]["text"])
    return found.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select("row.*")


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return ngram_join.keep_one(docs, SHINGLE_WORDS, SHINGLE_PERCENT)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target and its draw say."""
    return mixing.repeat(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard, bucket and slot after the external shuffle."""
    return sharding.shuffle(docs)


STAGES = [
    ("language", identify_language),
    ("near_copies", join_near_copies),
    ("decontamination", remove_benchmark),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: The language model and the shuffle can't be expressed in SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
