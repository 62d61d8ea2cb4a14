"""From raw documents to packed training sequences, in five stages of the numbered operators.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame; ``run`` writes each one's rows to the
shared folder and reads them again for the next.  All stages but the last return the columns of
``documents``, and what a stage rejects is gone for those after it.

* language: texts without a letter, or without a language of some share, go (null and empty texts too);
* quality: junk and toxic documents go, by a scorer learned from weak labels;
* near_duplicates: of each class of near copies the document with the smallest id stays;
* disclosure: personal data and disclosing terms are generalised;
* packing: what is left is cut and packed into sequences of 4,096 tokens.

Repeated rows are near copies of each other.  Columns beyond those of ``documents`` pass untouched.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postura.llm import disclosure, language_id, order_minhash, packing, weak_labels
from postura.llm.common import documents, stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs, language_id.learn(docs))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = weak_labels.learn(docs, weak_labels.read_labels(spark, sf_dir))
    return weak_labels.keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return order_minhash.keep_one(docs)


def disclose_nothing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return disclosure.sanitise(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language", language),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("disclosure", disclose_nothing),
    ("packing", pack),
]

#: Models and iterations decide; tests compare each stage with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
