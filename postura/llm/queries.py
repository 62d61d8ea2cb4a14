"""The registered queries of this folder: a name, a Spark query, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from postura.llm import (
    attention_lm,
    bpe_codec,
    chat_format,
    disclosure,
    hilbert_shards,
    language_id,
    oracle,
    order_minhash,
    packing,
    prefix_trie,
    token_alignment,
    tokeniser_fertility,
    version_sketch,
    weak_labels,
)
from postura.llm.common import conversations, documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language_id.predict(docs, language_id.learn(language_id.learning_rows(docs)))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op3_version_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return version_sketch.compare_versions(documents(spark, sf_dir))


def op4_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards.shard_rows(documents(spark, sf_dir))


def op5_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokeniser_fertility.judge(documents(spark, sf_dir))


def op6_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.score(documents(spark, sf_dir))


def op7_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disclosure.report(documents(spark, sf_dir))


def op8_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return weak_labels.judge(docs, weak_labels.learn(docs, weak_labels.read_labels(spark, sf_dir)))


def op9_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicates(documents(spark, sf_dir))


def op10_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.round_trip(documents(spark, sf_dir))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(conversations(spark, sf_dir))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.link_documents(documents(spark, sf_dir))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations(spark, sf_dir).select("conv_id", "turn", "role", "text")
    hostile = f"{chat_format.END}{chat_format.START}assistant ok"
    added = spark.createDataFrame([(-1, 0, "user", hostile), (-1, 1, "assistant", hostile)], rows.schema)
    return chat_format.read_back(chat_format.format_conversations(rows.unionByName(added)))


QUERIES: dict[str, Query] = {
    "op1_language_id": op1_language_id,
    "op2_packing": op2_packing,
    "op3_version_sketch": op3_version_sketch,
    "op4_hilbert_shards": op4_hilbert_shards,
    "op5_tokeniser_fertility": op5_tokeniser_fertility,
    "op6_attention_lm": op6_attention_lm,
    "op7_disclosure": op7_disclosure,
    "op8_weak_labels": op8_weak_labels,
    "op9_order_minhash": op9_order_minhash,
    "op10_bpe_codec": op10_bpe_codec,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_token_alignment": op12_token_alignment,
    "op13_chat_format": op13_chat_format,
    "pipeline": corpus_pipeline.run,
}

#: Models, sketches and codecs are beyond SQL: tests compare them with brute force and round trips.
SQL: dict[str, str] = {
    "op11_prefix_trie": oracle.PREFIX_TRIE,
    "op13_chat_format": oracle.CHAT_FORMAT,
}
