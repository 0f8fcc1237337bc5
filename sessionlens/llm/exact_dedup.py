"""Exact dedup by a heavy-hitter split (native).

Texts are equal when their bytes are; a null text counts as empty.  Of equal
texts the row with the largest id stays.  A frequent digest would send all its
rows to one reducer, so:

1. Misra-Gries summaries (Spark's ``approx_top_k`` sketches, mergeable
   Misra-Gries) name the frequent digests: every digest with more than about
   rows * 7 / ``TRACKED`` rows is among them.  Each task accumulates one, and they
   are combined in a tree, ``ARITY`` at a time, so no task reads more sketches
   than that, however many tasks there were;
2. one counted aggregate verifies these (at most ``CANDIDATES``) names;
3. the verified winners (the largest id, among equal ids the largest row mark,
   and the group size) are broadcast, and all other rows of a frequent digest are
   decided where they are read;
4. what remains, which has a bounded number of rows per digest, takes the
   ordinary shuffle on the digest.

Nulls, ties, empty input: a row with a null id loses to any row with an id.
Rows with the same text and id are repeated rows: exactly one of them stays, where
other columns differ the one with the larger hash of the row.
No rows give no rows.  Further columns of the input may have any names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlens.llm.common import empty_if_null, files_for, free_name, materialise
from sessionlens.operators.joins import row_hash

#: Frequent digests that are named at most; bounds what is broadcast.
CANDIDATES = 1024
#: Counters of a Misra-Gries sketch; bounds a task's memory and the rows left to one reducer.
TRACKED = 8192


#: Sketches that one task combines.
ARITY = 8


def misra_gries(df: DataFrame, column: str, candidates: int = CANDIDATES,
                tracked: int = TRACKED) -> DataFrame:
    """The values of ``column`` that occur most, ``candidates`` rows at most (column ``value``)."""
    sketches = (df.groupBy(F.spark_partition_id().alias("place"))
                .agg(F.expr(f"approx_top_k_accumulate(`{column}`, {tracked})").alias("sketch")))
    sketches = materialise(sketches)
    # places are combined by their leading digits in base ARITY until one is left
    last = sketches.agg(F.max("place")).first()[0]
    if last is None:
        return df.select(F.col(column).alias("value")).limit(0)
    while True:
        # grouped to the end, as a combination of no sketches at all (of an empty partition) fails
        sketches = (sketches.groupBy(F.floor(F.col("place") / ARITY).cast("int").alias("place"))
                    .agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch")))
        last //= ARITY
        if not last:
            break
    return sketches.select(F.expr(f"approx_top_k_estimate(sketch, {candidates})").alias("top")).select(F.explode("top.item").alias("value"))


def verified_winners(digests: DataFrame, id_col: str, digest: str, mark: str) -> DataFrame:
    """Exact group size, and id and mark of the row that stays, for every digest that the sketch names and that
    occurs twice or more."""
    named = misra_gries(digests, digest)
    return (digests.join(F.broadcast(named), F.col(digest) == F.col("value"))
            .groupBy("value").agg(F.count("*").alias("winner_size"),
                                  F.max(F.struct(F.col(id_col).isNotNull(), id_col, mark)).alias("winner"))
            .filter(F.col("winner_size") > 1)
            .select("value", "winner_size", F.col(f"winner.{id_col}").alias("winner_id"),
                    F.col(f"winner.{mark}").alias("winner_mark")))


def _split(rows: DataFrame, digests: DataFrame, id_col: str, digest: str, mark: str) -> tuple[DataFrame, DataFrame]:
    """(rows of frequent digests, with ``wins``; the rest with row number, size and largest id of the digest)."""
    winners = verified_winners(digests, id_col, digest, mark)
    marked = rows.join(F.broadcast(winners), F.col(digest) == F.col("value"), "left").drop("value")
    wins = F.col(id_col).eqNullSafe(F.col("winner_id")) & (F.col(mark) == F.col("winner_mark"))
    by_digest = Window.partitionBy(digest)
    rest = (marked.filter(F.col("winner_size").isNull())
            .withColumn("row_no", F.row_number().over(by_digest.orderBy(F.col(id_col).desc_nulls_last(), F.col(mark).desc())))
            .withColumn("size_", F.count("*").over(by_digest))
            .withColumn("keep_", F.max(id_col).over(by_digest)))
    return marked.filter(F.col("winner_size").isNotNull()).withColumn("wins", wins), rest


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256."""
    # the rows are written, so their numbers stay as they are
    digests = materialise(docs.select(F.col(id_col).alias("doc_id"), F.sha2(empty_if_null(text_col), 256).alias("text_sha256"),
                                      F.monotonically_increasing_id().alias("mark")))
    frequent, rest = _split(digests, digests, "doc_id", "text_sha256", "mark")
    return (frequent.select("doc_id", F.col("winner_id").alias("keep_id"),
                            F.col("winner_size").alias("group_size"), F.col("wins").alias("kept"), "text_sha256")
            .unionByName(rest.select("doc_id", F.col("keep_").alias("keep_id"), F.col("size_").alias("group_size"),
                                     (F.col("row_no") == 1).alias("kept"), "text_sha256")))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns; whole rows are shuffled once, frequent losers never."""
    packed = free_name(docs, "row_")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(packed),
                       F.col(id_col).alias("doc_id"), F.sha2(empty_if_null(text_col), 256).alias("digest"),
                       row_hash(docs).alias("mark"))
    frequent, rest = _split(rows, materialise(rows.drop(packed)), "doc_id", "digest", "mark")
    # rows that are equal in all columns win together: one of them, by an aggregate that starts in every task
    winners = frequent.filter("wins").groupBy("digest").agg(F.any_value(packed).alias(packed))
    return (rest.filter("row_no = 1").select(f"{packed}.*").unionByName(winners.select(f"{packed}.*"))
            .coalesce(files_for(docs)))
