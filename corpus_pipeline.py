"""The pipeline over documents: quality, lines, near copies, benchmark passages, token ids.

Each stage works on the rows that the one before it left and wrote. Null, empty and repeated rows
are treated as the operators say; an empty table goes through as one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.llm import bpe, classifier, codec, decontaminate, lines, minhash
from marquee.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier takes."""
    return classifier.accepted(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that stay in another one; n_chars counts what is left."""
    cut = lines.without_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cut


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: shingles of five words, similarity of 0.8 or more."""
    return minhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document as count and hash, and the hash of the text decoded from them."""
    return bpe.digest(docs, codec.read_spec(public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("bpe_encoding", encoding),
]
#: A learned classifier, signatures and a tokenizer are not SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage over the written result of the one before it."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
