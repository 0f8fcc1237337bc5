"""Column expressions shared by the operators.

All of them are built from ``pyspark.sql.functions`` so they stay inside
whole-stage codegen; none needs a Python UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """Whole-second boundaries crossed between two timestamps.

    .9 s -> 1.1 s counts 1 (warehouse ``datediff(second, ..)`` semantics),
    where ``timestampdiff(SECOND, ..)`` counts elapsed whole seconds and
    gives 0.  Each end becomes microseconds since a TIMESTAMP_NTZ epoch,
    floored to whole seconds, and the seconds are subtracted.  Nothing is
    cast, so TIMESTAMP_NTZ inputs stay wall-clock values whatever the
    session time zone (even inside a skipped daylight-saving hour).
    """
    return _epoch_seconds(col(end)) - _epoch_seconds(col(start))


def _epoch_seconds(c: Column) -> Column:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.floor(F.timestamp_diff("MICROSECOND", epoch, c) / F.lit(1_000_000))


def minutes_between(start: str | Column, end: str | Column) -> Column:
    """Fractional minutes between two timestamps (seconds / 60, a double)."""
    return seconds_between(start, end) / F.lit(60)


def surrogate_key(*cols: str | Column) -> Column:
    """md5 over the '-'-joined string forms, a NULL part rendered as ''.

    ``concat_ws`` alone would skip NULL parts and shift the others.
    """
    parts = [F.coalesce(col(c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def url_param(query: str | Column, key: str) -> Column:
    """Value after the first ``key`` in ``query``.

    The value ends at the first '&' after the key; only when there is no
    '&' does it end at the first '%'; otherwise it runs to the end.  An
    absent key (or NULL query) gives NULL, an empty value ''.
    """
    q = col(query)
    pos = F.locate(key, q)
    # Text after the first occurrence (substring_index(.., -1) would take
    # the text after the last one).
    after = q.substr(pos + F.lit(len(key)), F.char_length(q))
    value = (F.when(after.contains("&"), F.substring_index(after, "&", 1))
             .when(after.contains("%"), F.substring_index(after, "%", 1))
             .otherwise(after))
    return F.when(pos > 0, value)


def flag(cond: Column) -> Column:
    """Per-row 0/1 indicator of a condition (NULL condition -> 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def first_time(cond: Column, time: str | Column) -> Column:
    """Aggregate: earliest ``time`` among rows where ``cond`` holds."""
    return F.min(F.when(cond, col(time)))


def last_time(cond: Column, time: str | Column) -> Column:
    """Aggregate: latest ``time`` among rows where ``cond`` holds."""
    return F.max(F.when(cond, col(time)))


def like_any(c: str | Column, patterns: Sequence[str]) -> Column:
    out = None
    for p in patterns:
        term = col(c).like(p)
        out = term if out is None else (out | term)
    return out if out is not None else F.lit(False)
