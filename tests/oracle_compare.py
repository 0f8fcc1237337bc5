"""Run a Spark query and its DuckDB oracle on the same parquet and compare.

Mirrors the driver's check: same column names (sorted), same row count, and
the same multiset of rows after normalising values (timestamps to ISO
strings, floats rounded).
"""

from __future__ import annotations

import datetime as dt
import math

import duckdb

from sessionlens.sources.tables import DRIVER_TABLES, table_path


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i].lower())
    cols = [columns[i].lower() for i in order]
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=_key)
    return cols, out


SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
    "smallint": "SMALLINT", "tinyint": "TINYINT", "float": "FLOAT",
}


def type_mismatches(spark_df, con, sql: str):
    """(column, spark type, duckdb type) for columns whose types differ."""
    d_types = {r[0].lower(): str(r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    out = []
    for name, t in spark_df.dtypes:
        want = SPARK_TO_DUCK.get(t, t.upper())
        got = d_types.get(name.lower())
        if got is not None and got != want:
            out.append((name, t, got))
    return out


def compare(spark_df, con, sql: str):
    s_cols, s_rows = normalise(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_cols, d_rows = normalise(d_cols, rel.fetchall())
    problems = []
    types = type_mismatches(spark_df, con, sql)
    if types:
        problems.append(f"types differ: {types[:6]}")
    if s_cols != d_cols:
        problems.append(f"columns differ: spark-only {sorted(set(s_cols) - set(d_cols))}, "
                        f"oracle-only {sorted(set(d_cols) - set(s_cols))}")
    if len(s_rows) != len(d_rows):
        problems.append(f"row count spark={len(s_rows)} oracle={len(d_rows)}")
    if not problems and s_rows != d_rows:
        ss, ds = set(s_rows), set(d_rows)
        only_s = list(ss - ds)[:3]
        only_d = list(ds - ss)[:3]
        diff_cols = set()
        for a, b in zip(only_s, only_d):
            diff_cols |= {s_cols[i] for i in range(len(a)) if a[i] != b[i]}
        problems.append(f"values differ (e.g. columns {sorted(diff_cols)[:10]}): "
                        f"spark {only_s[:1]} oracle {only_d[:1]}")
    return problems, len(s_rows)
