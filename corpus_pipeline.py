"""The corpus pipeline: documents to packed training sequences in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are
written as Parquet to the shared folder and read again as the next stage's
``docs``.  All stages but the last return the columns of ``documents``.

language_id    documents whose language is not recognised go
exact_dedup    of equal texts the largest doc_id stays
near_dedup     of each group of near copies the smallest doc_id stays
mix_sources    every source is repeated or cut to its target share of words
pack           token pieces, packed into sequences of 2048 tokens

A null text counts as empty: language ID rejects it.  Empty tables pass through.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sessionlens.llm import exact_dedup, language, mixing, near_join, packing
from sessionlens.llm.common import read_table, shared_folder

#: Language probability below which a document goes.
LEAST_SCORE = 0.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.drop_unknown(docs, LEAST_SCORE)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_join.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.apply_mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("exact_dedup", drop_exact),
    ("near_dedup", drop_near),
    ("mix_sources", mix_sources),
    ("pack", pack),
]

#: SQL cannot express the first stage (a trained network) nor the last (a tokenizer).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    folder = f"{shared_folder(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {"pipeline": run}
