"""The corpus pipeline: from raw documents to packed training sequences.

Each stage reads what its predecessor kept, as Parquet, and its decisions take
effect. All but the last return the columns of ``documents``. Every case that the
operators define (null ids and texts, empty tables, rows that repeat, other
columns) holds here too.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.llm import compression, contamination, jaccard, packing, quality_rules
from feedmill.llm.common import land, small_batches

TOKENIZER = "word_bpe_49k.json"


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or that the rules' posterior calls bad go."""
    return quality_rules.keep_good(docs)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier scores below its threshold go.

    It learns from the labels of documents that came this far.
    """
    small_batches(spark)
    model = compression.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return compression.score(docs, model).where(F.col("predicted") == 1).select("row.*")


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a 5-word Jaccard similarity of 0.8 or more, that with the least id stays."""
    small_batches(spark)
    return jaccard.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a verified passage of the benchmark go."""
    small_batches(spark)
    return contamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER)).drop("ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules_stage),
    ("quality_classifier", quality_classifier_stage),
    ("near_duplicates", near_duplicates_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: The fit of two models, 64-bit hashes and a tokenizer cannot be said in SQL; tests/llm holds brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
