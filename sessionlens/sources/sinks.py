"""Writing model outputs.

``write_table`` replaces a table with a model's result (the original's
``table`` materialisation).  Keyed incremental tables go through
``operators.refresh.refresh_partitioned`` instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, partition_by: str | list[str] | None = None,
                fmt: str = "parquet") -> None:
    """Replace the table at ``path`` with ``df``.

    With ``partition_by``, only partitions present in ``df`` are replaced
    when the session sets ``spark.sql.sources.partitionOverwriteMode=dynamic``;
    by default the whole table is replaced.
    """
    writer = df.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    writer.save(path)
