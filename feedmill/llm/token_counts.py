"""Token counts through a cache keyed by content and tokenizer.

A text's key is the digest of its content with the digest of the tokenizer file:
another text or another tokenizer version is another key. Counts that the cache
holds are joined; only distinct texts that it lacks are encoded, once each, and
their counts appended. The cache is a Parquet table of (key, n_tokens).
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.llm.common import land

LIMIT = 4096
#: A key is hot if one in so many rows has it; there are at most as many hot ones.
HOT = 1000
#: Ways in which rows with a hot key are dealt over the tasks of the join that they have no part in.
SALTS = 4096
#: Characters of text that one call of the library gets.
BATCH_CHARS = 4_000_000


def tokenizer_version(path: str) -> str:
    """SHA-256 of the tokenizer's file."""
    with open(path, "rb") as file:
        return hashlib.file_digest(file, "sha256").hexdigest()


@functools.lru_cache(maxsize=2)
def _counter(path: str) -> Callable[[list[str]], list[int]]:
    """Counts by the library that the file belongs to, special strings as it takes them by default."""
    if path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in pieces.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(e) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def ship(spark: SparkSession, path: str) -> str:
    """Send a tokenizer file to the executors; its name there."""
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def _encode(name: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        count = _counter(SparkFiles.get(name))
        for batch in batches:
            texts, counts, start, size = list(batch["text"]), [], 0, 0
            for i, text in enumerate(texts):
                size += len(text)
                if size > BATCH_CHARS or i == len(texts) - 1:
                    counts += count(texts[start : i + 1])
                    start, size = i + 1, 0
            yield pd.DataFrame({"key": batch["key"], "n_tokens": counts})

    return run


def content_key(text: Column, version: str) -> Column:
    """The cache key. The content is the text itself, a null text being the empty one:
    any further folding would merge texts that the tokenizer tells apart."""
    return F.unhex(F.sha2(F.concat(F.lit(version + "\n"), text), 256))


def read_cache(spark: SparkSession, cache: str) -> DataFrame:
    """The cache's rows; none if nothing was written yet. Two runs that overlap may both have written a key."""
    from pyspark.errors import AnalysisException

    schema = "key binary, n_tokens bigint"
    try:
        return spark.read.schema(schema).parquet(cache)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def count(docs: DataFrame, tokenizer: str, cache: str, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row; misses are added to ``cache``.

    Null texts count as empty. Equal texts, in however many rows, are encoded
    once: they meet by partial aggregation. Rows then get their counts: those of
    hot keys, at most ``HOT`` by their definition, by broadcast, so that the rows
    of a text that a third of the table shares stay spread; the others in a
    join. Rows that repeat stay, with equal counts; null ids stay null; columns
    other than the id and text are not read. An append that is cut short leaves
    no rows (Spark commits whole jobs); two runs that append the same key agree,
    and reading takes one of them.
    """
    spark = docs.sparkSession
    name, version = ship(spark, tokenizer), tokenizer_version(tokenizer)
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col("doc_id"), body.alias("text")).withColumn("key", content_key(F.col("text"), version))
    distinct = rows.groupBy("key").agg(F.first("text").alias("text"))
    missing = distinct.join(read_cache(spark, cache).select("key"), "key", "left_anti")
    missing.mapInPandas(_encode(name), "key binary, n_tokens bigint").write.mode("append").parquet(cache)
    # Written by the line above, so it exists, if only as an empty table.
    known = read_cache(spark, cache)
    slim = land(rows.select("doc_id", "key", F.octet_length("text").cast("bigint").alias("n_bytes")), "token-keys")
    hot = slim.groupBy("key").count().where(F.col("count") * HOT >= slim.count()).select("key")
    # Known counts are read once for the few hot keys; as many rows as keys, so they can be broadcast.
    many = known.join(F.broadcast(hot), "key").groupBy("key").agg(F.first("n_tokens").alias("hot_tokens"))
    dealt = F.concat(F.lit("-"), F.pmod(F.xxhash64("doc_id", F.spark_partition_id()), F.lit(SALTS)).cast("string")).cast("binary")
    rest = slim.join(F.broadcast(many), "key", "left").withColumn(
        "meets", F.when(F.col("hot_tokens").isNull(), F.col("key")).otherwise(dealt)
    )
    few = known.groupBy(F.col("key").alias("meets")).agg(F.first("n_tokens").alias("met_tokens"))
    n_tokens = F.coalesce("hot_tokens", "met_tokens")
    return rest.join(few, "meets", "left").select(
        "doc_id", "n_bytes", n_tokens.alias("n_tokens"), (n_tokens > limit).alias("over_limit")
    )
