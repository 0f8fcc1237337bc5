"""Ordered rule tables: first matching rule wins.

A rule is ``(label, predicate)`` where the predicate is a SQL boolean
expression over the frame's columns.  ``classify`` turns a table into one
chained ``CASE WHEN`` Column (evaluated by Catalyst, inside codegen);
``classify_sql`` renders the same table as SQL text for the DuckDB oracle.
Keeping the rules as data keeps their order explicit: one entry per rule.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[str, str]


def classify(rules: Sequence[Rule], default: str | None) -> Column:
    out = None
    for label, predicate in rules:
        cond = F.expr(predicate)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    if out is None:
        return F.lit(default).cast("string")
    return out.otherwise(F.lit(default).cast("string"))


def sql_literal(value: str | None) -> str:
    if value is None:
        return "NULL"
    return "'" + value.replace("'", "''") + "'"


def classify_sql(rules: Sequence[Rule], default: str | None) -> str:
    lines = ["CASE"]
    for label, predicate in rules:
        lines.append(f"  WHEN {predicate} THEN {sql_literal(label)}")
    lines.append(f"  ELSE {sql_literal(default)} END")
    return "\n".join(lines)
