"""Incremental refresh of a keyed table (C11).

A run rebuilds only rows newer than the target's high-water mark minus a
lookback, then replaces target rows by key: rows of the target whose key
appears in the batch are dropped (all of them, delete+insert semantics, so
a key repeated in the batch keeps every batch row) and the batch is
appended.  A stored table is partitioned by date; a run stages the rebuilt
partitions in the shared folder and replaces them by Spark's dynamic
partition overwrite, so a run that fails can be repeated.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Name of the folder that holds rows without a date.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

def high_water_mark(target: DataFrame | None, date_col: str, lookback_days: int = 1):
    """max(date_col) - lookback days (one scalar to the driver), or None
    when there is no target or it is empty (the caller then builds all)."""
    if target is None:
        return None
    row = target.agg(F.date_sub(F.max(F.col(date_col)), lookback_days).alias("b")).first()
    return None if row is None else row["b"]


def merge_by_key(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Target rows whose key is not in the batch, plus all batch rows."""
    keys = batch.select(key).distinct()
    return target.join(keys, key, "left_anti").unionByName(batch)


def incremental_refresh(build: Callable[[object], DataFrame], target: DataFrame | None,
                        key: str, date_col: str, lookback_days: int = 1) -> DataFrame:
    """Refreshed table as a DataFrame.  ``build(bound)`` must return the
    model restricted to rows after ``bound`` (``None`` = full build)."""
    bound = high_water_mark(target, date_col, lookback_days)
    if bound is None:
        return build(None)
    return merge_by_key(target, build(bound), key)


# ------------------------------------------------ partition-scoped refresh

def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def partition_dates(spark: SparkSession, path: str, date_col: str) -> list[_dt.date | None]:
    """The dates among the partition folders of a table, None for rows without one (no file is read)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    prefix = f"{date_col}="
    names = [status.getPath().getName() for status in fs.listStatus(p) if status.isDirectory()]
    values = [n[len(prefix):] for n in names if n.startswith(prefix)]
    return [None if v == NULL_PARTITION else _dt.date.fromisoformat(v) for v in values]


def latest_partition(spark: SparkSession, path: str, date_col: str) -> _dt.date | None:
    """The largest date among the partition folders of a table."""
    return max((d for d in partition_dates(spark, path, date_col) if d is not None), default=None)


def footer_maximum(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One row ``maximum``: the largest value of a column of a stored table, from the statistics in the
    files' footers.

    Spark pushes the aggregate into the scan for numbers and dates; other types are scanned.  The
    settings that this needs are made in a session of its own, so the caller's stay as they are.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.parquet(path).agg(F.max(F.col(column)).alias("maximum"))


def stored_high_water_mark(spark: SparkSession, path: str, date_col: str, lookback_days: int = 1) -> _dt.date | None:
    """``high_water_mark`` of a stored table without reading its rows: from the names of its partition
    folders, or else from file footers (S4, A11).  None if there is no table or no date.

    Files that carry no statistics are scanned.
    """
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    latest = latest_partition(spark, path, date_col)
    if latest is None:
        table = spark.read.parquet(path)
        if date_col not in table.columns:
            raise ValueError(f"{path} has no column {date_col}")
        try:
            latest = footer_maximum(spark, path, date_col).first()["maximum"]
        except (PySparkException, Py4JJavaError) as failed:
            if "statistic" not in str(failed).lower() and "min/max" not in str(failed).lower():
                raise
            latest = table.agg(F.max(date_col)).first()[0]
    return None if latest is None else latest - _dt.timedelta(days=lookback_days)


def by_date(df: DataFrame, date_col: str) -> DataFrame:
    """Rows gathered by date before a partitioned write, so that a date gets few files.

    The rows of a build are dealt by session key, and every task would write a file for every date it meets.
    The rebalance is one more shuffle of the rows to be written; AQE splits a date too large for one task.
    """
    return df.hint("rebalance", F.col(date_col))


def write_by_date(df: DataFrame, path: str, date_col: str, mode: str = "errorifexists") -> None:
    by_date(df, date_col).write.mode(mode).partitionBy(date_col).parquet(path)


def refresh_partitioned(spark: SparkSession, path: str, build: Callable[[object], DataFrame],
                        key: str, date_col: str, lookback_days: int = 1,
                        staging_root: str | None = None) -> None:
    """Refresh a table partitioned by ``date_col``, rewriting only the partitions of rebuilt rows.

    ``build(bound)`` gives the rows to replace: those after the bound, and for a build that
    follows late events also older rows (``plans.models.site_model_touched``).  Precondition: a
    key always lands in the same ``date_col`` value (true for the site model, whose key hashes the
    session start that ``DATE`` is derived from).

    The rebuilt rows are staged in the shared checkpoint folder, and the names of their
    partition folders say which partitions of the table change; only those are read, merged by
    key, staged too (a table cannot be overwritten while it is being read) and swapped in by
    dynamic partition overwrite.  The bound comes from partition names as well.  A run thus costs
    the rebuilt rows and the partitions they fall into, and one that fails can be repeated.
    Staged rows are deleted at the end.
    """
    from sessionlens.session import checkpoint_dir

    latest = latest_partition(spark, path, date_col)
    if latest is None:
        write_by_date(build(None), path, date_col, "overwrite")
        return
    bound = latest - _dt.timedelta(days=lookback_days)
    target = spark.read.parquet(path)
    root = staging_root or checkpoint_dir(spark)
    staging = f"{root.rstrip('/')}/refresh-staging-{uuid.uuid4().hex}"
    rebuilt, merged = f"{staging}/rebuilt", f"{staging}/merged"
    try:
        write_by_date(build(bound).select(*target.columns), rebuilt, date_col)
        dates = partition_dates(spark, rebuilt, date_col)
        if not dates:
            return
        batch = spark.read.schema(target.schema).parquet(rebuilt)
        touched = F.col(date_col).isin([d for d in dates if d is not None])
        if None in dates:
            touched = touched | F.col(date_col).isNull()
        write_by_date(merge_by_key(target.where(touched), batch, key), merged, date_col)
        (spark.read.schema(target.schema).parquet(merged).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(date_col).parquet(path))
    finally:
        staged_fs, staged = _fs(spark, staging)
        staged_fs.delete(staged, True)
