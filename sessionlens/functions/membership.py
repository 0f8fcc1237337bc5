"""Set membership of a string column through one broadcast lookup.

Operators that test the same column against many small lists of values
(event names for 53 funnel steps or 41 milestones) would evaluate one
``IN`` per list on every row.  ``Membership`` turns the lists into a lookup
table ``value -> bit words`` (bit i set when the value is in list i): rows
are hash-joined to it once, after which each test is a bit operation on a
long.  The table has one row per configured value, so its size is fixed by
configuration and broadcasting it is safe.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS_PER_WORD = 62  # of a signed 64-bit long, clear of the sign bit


def _sql_literal(v) -> str:
    if v is None:
        return "CAST(NULL AS STRING)"
    if isinstance(v, int):
        return f"{v}L"
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


class Membership:
    """Lookup table for ``len(sets)`` value lists; see the module doc."""

    def __init__(self, spark: SparkSession, sets: Sequence[Iterable[str]], prefix: str = "_w"):
        self.sets = [frozenset(s) for s in sets]
        self.prefix = prefix
        self.key = f"{prefix}_value"
        self.n_words = max(1, -(-len(self.sets) // BITS_PER_WORD))
        values = sorted(set().union(*self.sets)) if self.sets else []
        rows = []
        for v in values:
            words = [0] * self.n_words
            for i, s in enumerate(self.sets):
                if v in s:
                    words[i // BITS_PER_WORD] |= 1 << (i % BITS_PER_WORD)
            rows.append((v, *words))
        if not rows:  # a row that never matches keeps the SQL valid
            rows.append((None, *[0] * self.n_words))
        body = ", ".join("(" + ", ".join(_sql_literal(x) for x in r) + ")" for r in rows)
        cols = ", ".join([self.key, *self.words])
        # An inline VALUES relation: a local table scan of known size.
        self.table: DataFrame = spark.sql(f"SELECT * FROM VALUES {body} AS membership({cols})")

    @property
    def words(self) -> list[str]:
        return [f"{self.prefix}{g}" for g in range(self.n_words)]

    def attach(self, df: DataFrame, column: str, how: str = "left") -> DataFrame:
        """``df`` with the bit words of ``column`` (NULL words when no list holds it)."""
        joined = df.join(F.broadcast(self.table), F.col(column) == F.col(self.key), how)
        return joined.drop(self.key)

    def bit(self, i: int) -> Column:
        """0/1 (bigint): list ``i`` holds the row's value (words may be NULL or aggregated)."""
        word = F.coalesce(F.col(f"{self.prefix}{i // BITS_PER_WORD}"), F.lit(0))
        return F.shiftright(word, i % BITS_PER_WORD).bitwiseAND(F.lit(1))

    def member(self, i: int) -> Column:
        """Boolean: list ``i`` holds the row's value."""
        return self.bit(i) == 1
