"""Corpus pipeline: five stages over ``documents``, each on all that the one before kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet to the shared folder
and read again as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tramline.llm import bpe, decontaminate, quality, signatures, suffixes
from tramline.llm.common import crc_mod, prepare, stage, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not reject; labels of held-out documents are not learnt from."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), usable=crc_mod("doc_id", 5) != 0)
    return quality.keep_good(docs, model)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return signatures.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the strings of 200 bytes that stand in two places."""
    return suffixes.without_repeats(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark text, or too little of it to count as contaminated."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text."""
    return bpe.encode_round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram jaccard join", keep_one_of_similar),
    ("suffix-array dedup", cut_repeats),
    ("benchmark decontamination", drop_contaminated),
    ("byte-level bpe", encode),
]

# classification, similarity by trees and subword merges have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table ``documents`` to its encoded documents."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
