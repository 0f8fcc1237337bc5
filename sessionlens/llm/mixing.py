"""Mixing sources to target weights (native).

The sources, in code point order with null last, weigh 1, 2, 3, 1, 2, 3, ...
and share all words of the corpus by weight.  No target exceeds ``MOST_EPOCHS``
times its source; the excess is shared anew by weight until none does (solved
in closed form: one water level over the capped ratios).

Each document draws a hash-random key from its id.  Within a source, documents
are range-sorted by key into buckets, sizes are summed within a bucket and the
totals of the earlier buckets, one row each, are added: a distributed prefix
sum.  A source is taken ``floor(target / size)`` whole times, then from the
start of its random order up to the rest of its budget; the document at the
cut gives only the words that fit.

A null or empty text has size 0 and is taken 0 times; a source of size 0 has
target 0; a row without an id draws its key from its text; repeated rows count
as often as they stand there.  No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlens.llm.common import (WORD, buckets_for, empty_if_null, files_for, free_name, hex_bucket,
                                    materialise, with_running_total)

#: A source is taken so many times at most.
MOST_EPOCHS = 3
#: Rows of a source that are summed in one task.
ROWS_PER_BUCKET = 4096


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """source, source_size, target: one row per source; ``sized`` has source and size."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    pattern = F.array(*[F.lit(float(w)) for w in weights])
    weighed = sources.withColumn("weight", F.element_at(
        pattern, (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int")))
    weighed = weighed.withColumn("cap", F.col("source_size") * F.lit(MOST_EPOCHS))
    # In order of cap / weight the first sources are capped; the others stand at one level times weight.
    by_ratio = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    onwards = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.partitionBy()
    levels = (weighed
              .withColumn("total", F.sum("source_size").over(everywhere))
              .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0)))
              .withColumn("open_weight", F.sum("weight").over(onwards))
              .withColumn("level", (F.col("total") - F.col("capped")).cast("double") / F.col("open_weight"))
              .withColumn("open", F.col("level") * F.col("weight") <= F.col("cap")))
    # The first source that its level leaves uncapped fixes the level of all from there on.
    level = F.min(F.when(F.col("open"), F.struct((F.col("cap") / F.col("weight")).alias("r"),
                                                 F.col("source").isNull().alias("n"), F.col("source").alias("s"),
                                                 F.col("level").alias("level")))).over(everywhere)["level"]
    return (levels.withColumn("final", level)
            .select("source", "source_size",
                    F.least(F.col("cap").cast("double"), F.coalesce(F.col("final"), F.lit(0.0)) * F.col("weight"))
                    .alias("target")))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """doc_id, size, source, source_size, target, taken, text_md5: one row per document."""
    text = empty_if_null(text_col)
    sized = materialise(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(text).alias("size"),
        F.md5(text).alias("text_md5"))
        .withColumn("key", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.col("text_md5")))))
    buckets = buckets_for(sized.count(), rows_per_bucket)
    summed = with_running_total(sized.withColumn("bucket", hex_bucket(F.col("key"), buckets)),
                                "source", "bucket", [F.col(c) for c in ("key", "doc_id", "text_md5")],
                                F.col("size"), "words_before")
    targets = source_targets(sized).withColumnRenamed("source", "s_")
    budgeted = summed.join(targets, F.col("source").eqNullSafe(F.col("s_")), "left").drop("s_")
    epochs = F.when(F.col("source_size") > 0,
                    F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.floor(F.col("target")).cast("long") - F.col("epochs") * F.col("source_size")
    last = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - F.col("words_before")))
    return (budgeted.withColumn("epochs", epochs)
            .withColumn("taken", F.col("epochs") * F.col("size") + last)
            .select("doc_id", "size", "source", "source_size", "target", "taken", "text_md5"))


def apply_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              source_col: str = "source", chars_col: str | None = "n_chars") -> DataFrame:
    """The mixed corpus, with the columns of ``docs``: every taken document once per epoch.

    The document at a source's cut stands there once more, shortened to the words that its budget has left
    (``chars_col``, if given and present, is then the length of the shortened text).  Documents without words stay
    as they are: they take nothing from any budget.
    """
    row, times, words, cut = (free_name(docs, n) for n in ("row_", "times_", "words_", "cut_"))
    decided = mix(docs, id_col=id_col, text_col=text_col, source_col=source_col).select(
        F.col("doc_id").alias("k1"), F.col("source").alias("k2"), F.col("text_md5").alias("k3"), "size", "taken")
    # Repeated rows may be taken differently: the n-th of them here meets the n-th there.
    same = Window.partitionBy("k1", "k2", "k3").orderBy("taken")
    decided = decided.withColumn("k4", F.row_number().over(same))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row),
                         F.col(id_col).alias("j1"), F.col(source_col).alias("j2"),
                         F.md5(empty_if_null(text_col)).alias("j3"))
    packed = packed.withColumn("j4", F.row_number().over(Window.partitionBy("j1", "j2", "j3").orderBy(F.lit(0))))
    on = (F.col("j1").eqNullSafe(F.col("k1")) & F.col("j2").eqNullSafe(F.col("k2"))
          & (F.col("j3") == F.col("k3")) & (F.col("j4") == F.col("k4")))
    joined = packed.join(decided, on).withColumn(
        times, F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(1).cast("int"))
    joined = joined.withColumn(words, F.when(F.col("size") > 0, F.col("taken") - F.col(times) * F.col("size"))
                               .otherwise(0).cast("int"))
    copies = joined.withColumn(cut, F.explode(F.concat(
        F.array_repeat(F.lit(0), F.col(times)), F.when(F.col(words) > 0, F.array(F.col(words)))
        .otherwise(F.array().cast("array<int>")))))
    spaced = F.regexp_extract_all(F.col(f"{row}.{text_col}"), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    shortened = F.when(F.col(cut) > 0, F.array_join(F.slice(spaced, F.lit(1), F.greatest(F.col(cut), F.lit(1))), "")
                       ).otherwise(F.col(f"{row}.{text_col}"))
    out = copies.withColumn("short_", shortened)
    columns = []
    for c in docs.columns:
        value = F.col(f"{row}.`{c}`")
        if c == text_col:
            value = F.col("short_")
        elif c == chars_col:
            value = F.when(F.col(cut) > 0, F.char_length("short_").cast(docs.schema[c].dataType)).otherwise(value)
        columns.append(value.alias(c))
    return out.select(*columns).coalesce(files_for(docs))
