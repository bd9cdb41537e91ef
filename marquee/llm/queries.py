"""The registered queries of this subpackage, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    bitpack, bpe, chat, classifier, codec, codes, decontaminate, licenses, lines, merkle, minhash, pii, rules, shards,
)
from ..sources.files import shared_dir
from .common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op6_quality_classifier(spark, sf_dir):
    return classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_chat_formatting(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.createDataFrame(
        [(-7, 0, "user", chat.TRICKY), (-7, 1, "assistant", chat.TRICKY)], rows.schema
    )
    return chat.digest(rows.unionAll(tricky))


SQL["op7_chat_formatting"] = chat.SQL


@query
def op8_line_dedup(spark, sf_dir):
    return lines.digest(table(spark, sf_dir, "documents"))


SQL["op8_line_dedup"] = lines.SQL


@query
def op10_pii(spark, sf_dir):
    """The key of a real run is a secret of the caller; this one makes results repeatable."""
    return pii.digest(table(spark, sf_dir, "documents"), key="op10")


@query
def op9_decontamination(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_bpe(spark, sf_dir):
    return bpe.digest(table(spark, sf_dir, "documents"), codec.read_spec(public_tokenizers.path("byte_bpe_50k.json")))


@query
def op2_token_files(spark, sf_dir):
    spec = codec.read_spec(public_tokenizers.path("word_bpe_49k.json"))
    return bitpack.digest(table(spark, sf_dir, "documents"), shared_dir(spark, "token-files"), spec)


@query
def op1_near_duplicates(spark, sf_dir):
    return minhash.digest(table(spark, sf_dir, "documents"))


SQL["op1_near_duplicates"] = minhash.SQL


@query
def op3_quality_rules(spark, sf_dir):
    return rules.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op11_vector_codes(spark, sf_dir):
    return codes.digest(table(spark, sf_dir, "embeddings"))


SQL["op11_vector_codes"] = codes.SQL


@query
def op12_merkle_manifest(spark, sf_dir):
    return merkle.digest(table(spark, sf_dir, "documents"))


SQL["op12_merkle_manifest"] = merkle.SQL


@query
def op13_sharding(spark, sf_dir):
    return shards.digest(table(spark, sf_dir, "documents"))


SQL["op13_sharding"] = shards.SQL
