"""The registered queries of this folder: each operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.llm import (
    compression,
    contamination,
    fill_in_middle,
    filter_audit,
    html_text,
    jaccard,
    licenses,
    packing,
    quality_rules,
    sentence_pieces,
    token_counts,
    training_order,
    warc,
)
from feedmill.llm.common import documents
from feedmill.session import scratch_dir

#: Key of the training order.
ORDER_KEY = 20_240_229


def op1_compression_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = compression.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = compression.score(docs, model)
    doc_id = F.col("row.doc_id")
    return scored.select(
        doc_id.alias("doc_id"), compression.held_out(doc_id).alias("held_out"), "score", "predicted"
    )


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    records = warc.read(warc.write(warc.decide(pages), scratch_dir(spark, "warc")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return html_text.extract(pages).select("row.page_id", "row.url", "text", "n_chars")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).drop("ids")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.count(documents(spark, sf_dir), tokenizer, scratch_dir(spark, "token-counts"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(documents(spark, sf_dir), carry=["doc_id"])
    return judged.select(
        "row.doc_id",
        "c.n_words",
        "c.word_chars",
        "c.n_symbols",
        "c.n_dup_lines",
        "c.n_repeat_words",
        "base_failed",
        "kept",
        "p_good",
    )


def op8_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, tokenised and cut into sequences, as shards in training order; each record read back."""
    listing = training_order.streams(
        documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), scratch_dir(spark, "token-streams")
    )
    folder = scratch_dir(spark, "training-order")
    return training_order.read_back(training_order.materialise(listing, folder, ORDER_KEY), folder)


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link(documents(spark, sf_dir), jaccard.Rule(n=3, percent=90))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.overlaps(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.transform(documents(spark, sf_dir).select("doc_id", "text"))
    restored = fill_in_middle.restore(F.col("fim.output"), F.col("fim.form"))
    return made.select(
        "row.doc_id",
        "fim.n",
        "fim.form",
        "fim.prefix_chars",
        "fim.middle_chars",
        F.sha2("fim.output", 256).alias("output_sha256"),
        F.sha2(restored, 256).alias("restored_sha256"),
    )


def op12_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces with an end id; ``covered_bytes`` is where the last piece's span ends."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    pieces = sentence_pieces.encode(documents(spark, sf_dir), model)
    ids = F.array_append("ids", F.lit(sentence_pieces.END))
    rows = pieces.select("doc_id", ids.alias("ids"), F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)).alias("covered_bytes"))
    return rows.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(sentence_pieces.decode(spark, F.col("ids"), model), 256).alias("decoded_sha256"),
        F.col("covered_bytes").cast("bigint").alias("covered_bytes"),
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return filter_audit.audit(filter_audit.histogram(documents(spark, sf_dir), labels))


QUERIES = {
    "op1_compression_classifier": op1_compression_classifier,
    "op2_warc": op2_warc,
    "op3_html_extraction": op3_html_extraction,
    "op4_packing": op4_packing,
    "op5_token_counts": op5_token_counts,
    "op6_license_scan": op6_license_scan,
    "op7_quality_rules": op7_quality_rules,
    "op8_training_order": op8_training_order,
    "op9_ngram_jaccard": op9_ngram_jaccard,
    "op10_decontamination": op10_decontamination,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_sentence_pieces": op12_sentence_pieces,
    "op13_filter_audit": op13_filter_audit,
}
