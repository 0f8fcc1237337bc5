"""Joins of wide row sets to one-row-per-key aggregates.

When the small side of a join is an aggregate grouped by the join key,
Spark reuses the aggregate's shuffle for the join: the sort-merge join then
reads ``Sort(HashAggregate(shuffle))`` on that side.  AQE's skew-join
optimisation only splits joins whose children are shuffles, so a hot key
on the wide side would run in a single task.  ``join_per_key`` adds a hash
of the key to the join keys; the aggregate's partitioning no longer covers
all join keys, so the join gets its own shuffle on both sides (the extra
one moves per-key rows only) and AQE can split a skewed partition of the
wide side, replicating the one matching aggregate row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_H = "_join_key_hash"


def row_hash(df: DataFrame) -> Column:
    """xxhash64 of the whole row."""
    # xxhash64 rejects maps, at any depth; their JSON text stands for them.
    return F.xxhash64(*[F.to_json(F.struct(c)) if "map<" in t else F.col(c) for c, t in df.dtypes])


def spread_key(df: DataFrame, keys: Sequence[str]) -> Column:
    """xxhash64 of the key, or of the whole row when a key is NULL.

    A NULL key never matches, yet every such row would hash to the same
    reducer; hashing the row content instead spreads them (deterministically,
    so a recomputed map task sends each row to the same place)."""
    any_null = None
    for k in keys:
        term = F.col(k).isNull()
        any_null = term if any_null is None else (any_null | term)
    return F.when(any_null, row_hash(df)).otherwise(F.xxhash64(*keys))


def join_per_key(rows: DataFrame, per_key: DataFrame, keys: str | Sequence[str],
                 how: str = "left") -> DataFrame:
    """``rows.join(per_key, keys, how)`` with a skew-splittable plan.

    Same result and column layout as the plain USING-style join (``keys``
    once, then the remaining columns of ``rows`` and ``per_key``).  Rows
    with a NULL key are spread over reducers instead of all landing on one
    (``spread_key``).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    left = rows.withColumn(_H, spread_key(rows, keys))
    right = per_key.withColumn(_H, F.xxhash64(*keys))
    return left.join(right, [*keys, _H], how).drop(_H)
