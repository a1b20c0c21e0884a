"""The operators over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm import (
    alignment,
    bpe,
    decontaminate,
    negatives,
    pages,
    paragraphs,
    quality,
    repair,
    separators,
    signatures,
    sketches,
    suffixes,
    topk,
)
from tramline.llm.common import crc_mod, table


def op1_paragraph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.digest(paragraphs.remove_paragraphs(table(spark, sf_dir, "documents")))


def op2_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = crc_mod("doc_id", 5)
    model = quality.fit(docs, table(spark, sf_dir, "labels"), usable=fold != 0)
    scored = quality.score(docs, model)
    return scored.select("doc_id", (fold == 0).alias("held_out"), "score", "predicted")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.encode_round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.digest(decontaminate.scan_documents(docs, items))


def op5_induced_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digest(suffixes.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op6_dom_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "pages")
    return pages.extract(found, pages.fit(found))


def op7_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    end_of_text = 49407
    counted = separators.document_counts(docs, public_tokenizers.path("word_bpe_49k.json"), end_of_text)
    return counted.select("doc_id", "n_tokens")  # where a document starts depends on how the files were dealt


def op8_signature_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signatures.similar_sets(table(spark, sf_dir, "documents"))


def op9_repair_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    parts, first = repair.write_token_file(docs, public_tokenizers.path("word_bpe_49k.json"), end=1)
    return repair.read_documents(parts, first)


def op10_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


def op11_fast_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.near_duplicates(table(spark, sf_dir, "documents"))


def op12_angular_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors.withColumn("label", moved))


def op13_aligned_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    files = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align_documents(docs, files[0], public_tokenizers.PATTERN, files[1])[0]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_paragraph_minhash,
        op2_compression_quality,
        op3_byte_bpe,
        op4_decontaminate,
        op5_induced_suffixes,
        op6_dom_field,
        op7_separator_scan,
        op8_signature_trees,
        op9_repair_tokens,
        op10_norm_buckets,
        op11_fast_sketches,
        op12_angular_negatives,
        op13_aligned_tokens,
    )
}
SQL: dict[str, str] = {"op10_norm_buckets": topk.SQL, "op12_angular_negatives": negatives.SQL}
