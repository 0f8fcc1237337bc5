"""SparkSession construction and cluster-shared locations."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every job here relies on.  AQE re-plans joins from runtime sizes
# (a side is broadcast only once it is measured below the threshold, sort-
# merge otherwise), splits skewed join partitions and coalesces small ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(app_name: str = "sessionlens", master: str | None = None,
              shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    On a cluster leave ``master`` unset (spark-submit supplies it) and size
    ``shuffle_partitions`` to the data; AQE coalesces what is too small.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  Only when it is unset (local runs,
    tests) is ``fallback`` installed; with neither, fail instead of writing
    to a machine-local folder that executors on other hosts cannot see.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    if fallback is None:
        raise RuntimeError("spark.checkpoint.dir is not set; pass a shared fallback folder")
    spark.conf.set("spark.checkpoint.dir", fallback)
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback


def local_test_session(app_name: str = "sessionlens-test", cores: int = 8) -> SparkSession:
    """Session for tests and local benchmarks (``local[N]``, N shuffle partitions)."""
    cores = int(os.environ.get("BENCH_CPUS", cores))
    return get_spark(app_name, master=f"local[{cores}]", shuffle_partitions=cores,
                     **{"spark.driver.memory": "8g"})


MIB = 1 << 20


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Total size of files under ``paths`` (file-system metadata only)."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(conf).getContentSummary(path).getLength()
    return total


def scale_settings(shuffle_bytes: int, total_cores: int, partition_bytes: int = 256 * MIB) -> dict[str, str]:
    """Shuffle and scan sizing for a given volume of shuffled data.

    ``shuffle_bytes``: the widest shuffle of the job (for these models the
    event rows entering a join such as the identity join or the session
    base; per-session aggregates are far smaller).  The initial partition
    count targets ``partition_bytes`` per reducer so tasks fit in executor
    memory without heavy spill; AQE then coalesces small partitions and
    splits skewed ones (a partition is skewed above 4x the target).
    """
    wanted = -(-shuffle_bytes // partition_bytes)
    partitions = max(2 * total_cores, wanted)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(partition_bytes // 8),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * MIB),
    }
