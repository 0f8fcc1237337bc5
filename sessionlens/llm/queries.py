"""The registered queries opN_<name>: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlens.llm import (alignment, conversation_trie, exact_dedup, language, license_scan, lz_dedup, mixing,
                             near_join, neighbours, packing, quality, sharding, suffix_dedup)
from sessionlens.llm.common import read_table

#: Shards of op10, all of one weight.
SHARDS = 16
#: Token ids of op2.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: The two sides of op12.
ALIGNED = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents")).drop("kept", "removed")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), TOKENIZER)


def op3_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_join.near_groups(read_table(spark, sf_dir, "documents")).drop("rec", "class_rec")


def op4_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, top=20)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read_table(spark, sf_dir, "documents"))


def op6_lz_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lz_dedup.remove_held_words(read_table(spark, sf_dir, "documents")).drop("kept", "removed")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read_table(spark, sf_dir, "documents"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents")).drop("text_md5", "source")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read_table(spark, sf_dir, "documents"))


def op10_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"), [1.0] * SHARDS)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(read_table(spark, sf_dir, "conversations"), share_openings=True)


def op12_align_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_report(read_table(spark, sf_dir, "documents"), *ALIGNED)


def op13_quality_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_suffix_dedup, op2_best_fit_packing, op3_near_copies, op4_nn_descent, op5_license_scan, op6_lz_dedup,
    op7_exact_dedup, op8_mix_sources, op9_language_id, op10_rendezvous_shards, op11_prefix_trie, op12_align_tokens, op13_quality_nbsvm)}
