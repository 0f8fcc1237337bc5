"""Session-level operators: rollup (C1), first seen (A1), session base."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlens.functions.columns import surrogate_key


def session_rollup(events: DataFrame, keys: Sequence[str] = ("user_id", "session_id"), *,
                   counts: Mapping[str, Iterable[str]] | None = None,
                   time_col: str = "time", name_col: str = "event_table_name",
                   end_col: str = "session_end_time", count_col: str = "event_count") -> DataFrame:
    """Per key, the last event time, the number of event rows and one
    conditional count per entry of ``counts`` (bigint)."""
    name = F.col(name_col)
    aggs = [F.max(time_col).alias(end_col), F.count(F.lit(1)).alias(count_col)]
    for out, evs in (counts or {}).items():
        aggs.append(F.sum(F.when(name.isin(list(evs)), F.lit(1)).otherwise(F.lit(0))).alias(out))
    return events.groupBy(*keys).agg(*aggs)


def first_seen(sessions: DataFrame, key: str = "user_id", time_col: str = "session_start_time",
               out_col: str = "first_session_date") -> DataFrame:
    """A1: earliest session start per user."""
    return sessions.groupBy(key).agg(F.min(time_col).alias(out_col))


def session_base(sessions: DataFrame, events: DataFrame, view_events: Iterable[str], *,
                 keys: Sequence[str] = ("user_id", "session_id"),
                 session_cols: Sequence[str] = ("session_start_time", "library", "platform",
                                                "device_type", "country", "region", "city", "ip"),
                 time_col: str = "time", name_col: str = "event_table_name",
                 key_col: str = "distinct_session_id",
                 hashed: Sequence[str] = ("session_id", "user_id", "session_start_time"),
                 one_row_per_session: bool = False, unique_sessions: bool = False) -> DataFrame:
    """Sessions that have at least one view event.

    One row per session and distinct view-event time, all sharing the
    session's surrogate key, the md5 of its ``hashed`` columns joined by '-':
    the original filters the right side of a left join, which makes it an
    inner join, and keeps ``time`` in its DISTINCT list.

    Both sides are de-duplicated *before* the join (each hashed on all of
    its columns, so a hot session spreads over tasks).  Every output column
    comes from one side or is a function of them, so the join of two
    distinct inputs is already distinct and no aggregate follows it; AQE
    can then split a skewed session's partition of the join.

    ``one_row_per_session=True`` keeps only the session's first view time
    (one row per session key instead of one per view time).
    ``unique_sessions=True`` declares that ``sessions`` has no duplicate
    rows, which skips their DISTINCT (a shuffle of the sessions table).
    """
    views = events.where(F.col(name_col).isin(list(view_events)))
    if one_row_per_session:
        ev = views.groupBy(*keys).agg(F.min(time_col).alias(time_col))
    else:
        ev = views.select(*keys, time_col).distinct()
    kept = [c for c in session_cols if c not in keys]
    sess = sessions.select(*keys, *kept)
    if not unique_sessions:
        sess = sess.distinct()
    joined = sess.join(ev, list(keys), "inner")
    return joined.select(
        *keys, surrogate_key(*hashed).alias(key_col), time_col, *kept,
    )
