"""Reading the input tables.

Tables are parquet; Catalyst prunes columns and pushes filters into the
scan, so readers return the whole relation and callers select what they
use.  ``read_table`` is the single place that knows the on-disk layout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(base, name))


class Tables:
    """Lazy accessor: ``Tables(spark, dir).events`` reads ``dir/events.parquet``."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in DRIVER_TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.base, name)
        return self._cache[name]
