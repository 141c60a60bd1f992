"""A corpus from raw documents to a plan of its shards: quality, near-duplicates, benchmark leaks, mixture, shards.

Every stage handles odd rows as its operator does: a null text is an empty one, rows with a null id are rows like any other
(they come last where order counts), repeated rows are judged one by one except by the near-duplicate stage, which keeps one,
an empty table gives an empty table, and columns beyond those of ``documents`` stay up to the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acreline.llm import decontaminate, mixing, pairwise_quality, ring_shards, similar_texts
from acreline.llm.common import free_name, table, written
from acreline.llm.queries import WEIGHTS, domain

#: SimHash, the fitted ranker and md5 windows over its result have no SQL form.
ORACLE_SQL: str | None = None

#: The mixture takes this share of the tokens that reach it, each text at most once.
SHARE = "0.95"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least 0.3 stay. The ranker learns from labelled documents of ``docs``; without labels of both
    kinds all stay."""
    ranker = pairwise_quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs, "__score")
    kept = pairwise_quality.score_quality(docs, ranker, out=score).filter(F.col(score) >= pairwise_quality.THRESHOLD)
    return kept.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of 5-word Jaccard 0.8 or more stays: that with the smallest doc_id. Texts without words are
    one group."""
    return similar_texts.drop_similar_texts(docs, words=5).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark window occurs go; an empty benchmark lets all stay."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole texts up to each leaf's token budget; the text in which the budget ends stays whole."""
    name = free_name(docs, "__domain")
    levels = (name, "lang", "source")
    weights = {name: WEIGHTS["domain"], "lang": WEIGHTS["lang"]}
    mixed = mixing.select_mix(docs.withColumn(name, domain(F.col("source"))), levels, weights, share=SHARE, out=free_name(docs, "__mix"))
    return mixed.select(*docs.columns)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The plan of the shards: every document's shard and its slot there. Texts stay in the table of the stage before; a
    writer joins them by doc_id."""
    rows = docs.select("doc_id", F.crc32("text").alias("text_crc32"), "lang", "source", "n_chars")
    return ring_shards.assign_shards(rows, shards=40, key="doc_id", ties=("text_crc32",)).drop("text_crc32", "home_shard")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("mixing", mixture),
    ("sharding", sharding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each stage's result is a Parquet table that the next one reads."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
