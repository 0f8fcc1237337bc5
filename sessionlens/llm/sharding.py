"""Sharding by weighted rendezvous hashing of stable record keys (native).

Each record draws one number per shard, ``-weight / ln(u)`` with ``u`` uniform
in (0, 1) from md5(key:shard), and goes to the shard with the largest draw.
The key and the weights decide alone: a shard that is added takes records only
into itself, one that is removed gives up only its own.

The key is the document's id; a row without an id takes its text's md5 as key.
Rows with the same key share a shard.  A null text counts as no bytes.  Slots
number a shard's rows without gaps in key order; equal keys are numbered by
text checksum and size.  No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlens.llm.common import (buckets_for, empty_if_null, hex_bucket, materialise,
                                    with_running_total)

#: Rows of a shard that are numbered in one task.
ROWS_PER_BUCKET = 4096


def record_key(id_col: str, text_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("string"),
                      F.concat(F.lit("text:"), F.md5(empty_if_null(text_col))))


def draw(key: Column, shard: int, weight: float) -> Column:
    """-weight / ln(u), u = (52 leading bits of md5(key:shard) + 1/2) / 2^52."""
    digest = F.md5(F.concat(key, F.lit(f":{shard}")))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    return F.lit(-float(weight)) / F.log((bits + F.lit(0.5)) / F.lit(float(1 << 52)))


def rendezvous(draws: Sequence[Column]) -> Column:
    """The shard with the largest draw (the smallest such shard, if two are equal)."""
    best = F.array_max(F.array(*[F.struct(d.alias("d"), F.lit(-i).alias("i")) for i, d in enumerate(draws)]))
    return -best["i"]


def shard_documents(docs: DataFrame, weights: Sequence[float], added_weight: float = 1.0,
                    id_col: str = "doc_id", text_col: str = "text",
                    rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (the shard if one of ``added_weight`` were added)."""
    text = empty_if_null(text_col)
    keyed = docs.select(F.col(id_col).alias("doc_id"), record_key(id_col, text_col).alias("key"),
                        (F.octet_length(text) + 1).cast("long").alias("size"),
                        F.crc32(text.cast("binary")).alias("text_crc32"))
    all_weights = [*weights, added_weight]
    names = [f"draw_{i}" for i in range(len(all_weights))]
    drawn = keyed.select("*", *[draw(F.col("key"), i, w).alias(n)
                                for i, (n, w) in enumerate(zip(names, all_weights, strict=True))])
    columns = [F.col(n) for n in names]
    placed = materialise(drawn.select("doc_id", "key", "size", "text_crc32", F.md5("key").alias("position"),
                                      rendezvous(columns[:-1]).alias("shard"),
                                      rendezvous(columns).alias("grown_shard")))
    buckets = buckets_for(placed.count(), rows_per_bucket * len(weights))
    slotted = with_running_total(placed.withColumn("bucket", hex_bucket(F.col("position"), buckets)),
                                 "shard", "bucket", [F.col(c) for c in ("position", "key", "text_crc32", "size")],
                                 F.lit(1).cast("long"), "slot")
    return slotted.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"),
                          F.col("shard").cast("int").alias("shard"), "slot",
                          F.col("grown_shard").cast("int").alias("grown_shard"))
