"""Shared pieces: reading tables, materialising intermediate rows, ranks."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sessionlens.session import checkpoint_dir

#: Words of the white-space kind: runs of anything but these six characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows, and bytes of text, from which a part of a result gets a file of its own.
ROWS_PER_FILE = 2048
BYTES_PER_FILE = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; on one machine without that setting, one of its own."""
    fallback = None
    if spark.sparkContext.master.split("[")[0] == "local":
        fallback = os.path.join(tempfile.gettempdir(), "sessionlens-checkpoints")
    return checkpoint_dir(spark, fallback).rstrip("/")


def narrow_files(spark: SparkSession, rows: int) -> int:
    """How many files so many short rows fill; no fewer than tasks run at once."""
    return max(spark.sparkContext.defaultParallelism, buckets_for(rows, ROWS_PER_FILE))


def files_for(df: DataFrame) -> int:
    """How many files the rows of ``df`` fill, by their number and the bytes of their texts."""
    size = F.lit(0).cast("long")
    for c, kind in df.dtypes:
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0))
    rows, held = df.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return max(narrow_files(df.sparkSession, rows), buckets_for(held, BYTES_PER_FILE))


def materialise(df: DataFrame, files: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder, to ``files`` files at most if given, and read it from there.

    Rows that an executor wrote there outlive that executor.  On local disks
    each file that Hadoop creates starts two processes (``chmod``), which for a
    moment show the executor's memory as theirs: few rows belong in few files.
    """
    shared_folder(df.sparkSession)
    return (df if files is None else df.coalesce(files)).checkpoint(eager=True)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores appended until no column has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def empty_if_null(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def hex_bucket(key: Column, buckets: int) -> Column:
    """Bucket 0..buckets-1 of a uniform hex digest, increasing with the digest."""
    head = F.conv(F.substring(key, 1, 8), 16, 10).cast("long")
    return F.floor(head * F.lit(buckets) / F.lit(float(1 << 32))).cast("long")


def buckets_for(rows: int, rows_per_bucket: int) -> int:
    return max(1, -(-rows // rows_per_bucket))


def with_running_total(df: DataFrame, group: str, bucket: str, order: Sequence[Column],
                       value: Column, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all earlier rows of the group.

    Rows of a group are ordered by ``bucket`` and then ``order``.  A group's
    rows never meet in one task: each (group, bucket) is summed by itself and
    the totals of the earlier buckets, one row per bucket, are joined on.
    ``df`` must be materialised, as it is read twice.
    """
    v, before, b_group, b_bucket = (free_name(df, n) for n in ("_v", "_before", "_g", "_b"))
    df = df.withColumn(v, value)
    inside = (Window.partitionBy(group, bucket).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    totals = (df.groupBy(F.col(group).alias(b_group), F.col(bucket).alias(b_bucket))
              .agg(F.sum(v).alias(v)))
    earlier = Window.partitionBy(b_group).orderBy(b_bucket).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(b_group, b_bucket, F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(before))
    ranked = df.withColumn(out, F.sum(v).over(inside) - F.col(v))
    return (ranked.join(totals, F.col(group).eqNullSafe(F.col(b_group))
                        & (F.col(bucket) == F.col(b_bucket)), "left")
            .withColumn(out, F.col(out) + F.col(before)).drop(v, before, b_group, b_bucket))
