"""A corpus made ready for training: five stages, each one of the operators over all that the one before has kept.

Language ID drops documents without a letter, and those that resemble no language at all; if no row has a language, it keeps all. The toxicity classifier drops those it predicts toxic; of near duplicates one document of
each group stays; passages that earlier documents have are cut out; what is left is packed into windows of tokens.
All stages but the last return the columns of ``documents``. Nulls in any column are kept as they are, but for null texts: language ID drops them.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpitide.llm import languages, near_duplicates, packing, passages, toxicity
from kpitide.llm.common import ship_package, table, written

#: Five words and a similarity of 0.8.
NEAR = near_duplicates.Rule(words=5, num=4, den=5)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return languages.accepted(docs)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicate_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return near_duplicates.first_of_each(docs, NEAR)


def passage_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    cut = passages.remove(docs).select(*docs.columns)
    return cut.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else cut


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language_id),
    ("toxicity", toxicity_filter),
    ("n-gram Jaccard join", near_duplicate_filter),
    ("substring dedup", passage_filter),
    ("packing", pack),
]

ORACLE_SQL: str | None = None  # models and tokenizers are beyond SQL; the tests hold each stage against a plain version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
