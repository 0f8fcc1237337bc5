"""Register the same inline rows as Spark DataFrames and DuckDB tables."""

import duckdb
import pandas as pd

SPARK_TO_SQL = {"timestamp_ntz": "TIMESTAMP", "bigint": "BIGINT", "string": "VARCHAR",
                "date": "DATE", "boolean": "BOOLEAN", "int": "INTEGER", "double": "DOUBLE"}


def register(spark, tables):
    """tables: name -> ([(column, spark type)], rows).  Returns (duckdb con, {name: DataFrame})."""
    con = duckdb.connect()
    frames = {}
    for name, (cols, rows) in tables.items():
        names = [c for c, _ in cols]
        con.register(f"{name}_pdf", pd.DataFrame(rows, columns=names))
        select = ", ".join(f"CAST({c} AS {SPARK_TO_SQL[t]}) AS {c}" for c, t in cols)
        con.execute(f"CREATE TABLE {name} AS SELECT {select} FROM {name}_pdf")
        frames[name] = spark.createDataFrame(rows, ", ".join(f"{c} {t}" for c, t in cols))
    return con, frames
