"""Milestone times per session (C3) and the durations between them (C4).

The original computes each milestone with ``first_value(..) IGNORE NULLS``
over a whole-partition window ordered by time and then DISTINCTs the rows
back to one per session.  Every such window is an aggregate in disguise:
the first non-null time of a matching event is the minimum of those times.
Here all milestones are one ``groupBy(session).agg(...)``: partial
aggregation map-side, one shuffle of one row per session per task, no sort
of the event rows and no Window operator.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlens.functions.columns import first_time, flag, last_time, minutes_between

Milestone = tuple[str, str, Sequence[str]]


def _agg(fn: str, col: Column) -> Column:
    return F.max(col) if fn == "max" else F.min(col)


def milestone_partials(specs: Sequence[Milestone], *, time_col: str = "event_time",
                       name_col: str = "event_table_name", link_time_col: str | None = None,
                       linked_events: Sequence[str] = ()) -> list[Column]:
    """Aggregate columns for the time milestones (not "last_name").

    A linked-view milestone keeps its timed and NULL-time parts apart
    (``<out>__t`` / ``<out>__u``); ``finish_partials`` combines them.
    """
    name = F.col(name_col)
    t = F.col(time_col)
    aggs = []
    for out, kind, evs in specs:
        cond = name.isin(list(evs))
        if kind == "first":
            aggs.append(first_time(cond, t).alias(out))
        elif kind == "last":
            aggs.append(last_time(cond, t).alias(out))
        elif kind in ("csp_first", "csp_last"):
            if link_time_col is None:
                raise ValueError(f"{out}: {kind} needs link_time_col")
            link = F.col(link_time_col)
            c = cond | (name.isin(list(linked_events)) & link.isNotNull())
            fn = "max" if kind == "csp_last" else "min"
            aggs.append(_agg(fn, F.when(c, t)).alias(f"{out}__t"))
            aggs.append(_agg(fn, F.when(c & t.isNull(), link)).alias(f"{out}__u"))
        elif kind != "last_name":
            raise ValueError(f"unknown milestone kind {kind!r}")
    return aggs


def finish_partials(df: DataFrame, specs: Sequence[Milestone], by: str) -> DataFrame:
    """Final milestone columns from partials: a linked view takes its timed
    part, except that NULL-time rows sort last and so win "last"."""
    cols = [F.col(by)]
    for out, kind, _ in specs:
        if kind in ("first", "last"):
            cols.append(F.col(out))
        elif kind == "csp_first":
            cols.append(F.coalesce(f"{out}__t", f"{out}__u").alias(out))
        elif kind == "csp_last":
            cols.append(F.coalesce(f"{out}__u", f"{out}__t").alias(out))
    return df.select(*cols)


def last_event_names(events: DataFrame, outs: Sequence[str], *, by: str = "session_id",
                     time_col: str = "event_time", name_col: str = "event_table_name") -> DataFrame:
    """Name of the last event per key (NULL times last, ties to the larger name).

    A string-valued aggregate forces sort-based aggregation.  Keep it off the
    event rows: a hash aggregate first reduces events to one row per (key,
    event name) holding the latest time as a fixed-width number (NULL time =
    largest); only those few rows per key reach the sort-based max_by.
    """
    name = F.col(name_col)
    t = F.col(time_col)
    order = F.when(t.isNull(), F.lit(2**63 - 1)).otherwise(_epoch_micros(t))
    per_name = events.groupBy(by, name).agg(F.max(order).alias("_last_t"))
    return per_name.groupBy(by).agg(*[F.max_by(name, F.struct("_last_t", name)).alias(o) for o in outs])


def milestones(events: DataFrame, specs: Sequence[Milestone], *, by: str = "session_id",
               time_col: str = "event_time", name_col: str = "event_table_name",
               link_time_col: str | None = None, linked_events: Sequence[str] = ()) -> DataFrame:
    """One row per ``by`` with one column per milestone spec.

    kinds: "first"/"last" time of a matching event; "csp_first"/"csp_last"
    the same over matching events *or* ``linked_events`` rows whose
    ``link_time_col`` is set, valued coalesce(time, link time); "last_name"
    the name of the last event (NULL times last, ties to the larger name).
    Time milestones are one hash aggregate (fixed-width buffers).
    """
    time_specs = [sp for sp in specs if sp[1] != "last_name"]
    name_outs = [out for out, kind, _ in specs if kind == "last_name"]
    aggs = milestone_partials(time_specs, time_col=time_col, name_col=name_col,
                              link_time_col=link_time_col, linked_events=linked_events)
    times = (finish_partials(events.groupBy(by).agg(*aggs), time_specs, by) if aggs
             else events.select(by).distinct())
    if not name_outs:
        return times
    names = last_event_names(events, name_outs, by=by, time_col=time_col, name_col=name_col)
    # Null-safe: rows without a key form one group, as they do in the aggregates.
    named = names.withColumnRenamed(by, "_named")
    out = times.join(named, F.col(by).eqNullSafe(F.col("_named")), "left")
    return out.select(by, *[o for o, _, _ in specs])


def events_by_name(events: DataFrame, by: Sequence[str], *, time_col: str = "event_time",
                   name_col: str = "event_table_name", link_time_col: str) -> DataFrame:
    """One row per (``by``, event name, link present): all that rollups and milestones need.

    ``n`` rows, ``t_min`` / ``t_max`` times, ``untimed`` rows without a time, and the least and
    greatest link time among those (``u_min`` / ``u_max``); fixed-width buffers, combined map-side.
    """
    t, link = F.col(time_col), F.col(link_time_col)
    no_time = F.when(t.isNull(), link)
    return events.groupBy(*by, F.col(name_col).alias("name"), link.isNotNull().alias("has_link")).agg(
        F.count(F.lit(1)).alias("n"), F.min(t).alias("t_min"), F.max(t).alias("t_max"),
        F.sum(flag(t.isNull())).alias("untimed"), F.min(no_time).alias("u_min"), F.max(no_time).alias("u_max"))


def counted_events_by_name(events: DataFrame, by: Sequence[str], *, time_col: str = "event_time",
                           name_col: str = "event_table_name", links_col: str = "n_links") -> DataFrame:
    """``events_by_name`` of the identity join, from event rows that carry their number of later links.

    The join repeats an event once per later link and keeps one row of an event without any; an
    event without a time has none, so it brings no link time.
    """
    t, links = F.col(time_col), F.col(links_col)
    no_time = F.lit(None).cast("timestamp_ntz")
    return events.groupBy(*by, F.col(name_col).alias("name"), (links > 0).alias("has_link")).agg(
        F.sum(F.greatest(links, F.lit(1))).alias("n"), F.min(t).alias("t_min"), F.max(t).alias("t_max"),
        F.sum(flag(t.isNull())).alias("untimed"), F.min(no_time).alias("u_min"), F.max(no_time).alias("u_max"))


def milestones_from_names(by_name: DataFrame, specs: Sequence[Milestone], *, by: str = "session_id",
                          linked_events: Sequence[str] = ()) -> DataFrame:
    """C3 over ``events_by_name`` rows; same columns and values as ``milestones``."""
    name = F.col("name")
    last = F.struct(F.when(F.col("untimed") > 0, F.lit(2**63 - 1)).otherwise(_epoch_micros(F.col("t_max"))), name)
    aggs = []
    for out, kind, evs in specs:
        cond = name.isin(list(evs))
        shared = cond | (name.isin(list(linked_events)) & F.col("has_link"))
        if kind == "first":
            aggs.append(F.min(F.when(cond, F.col("t_min"))).alias(out))
        elif kind == "last":
            aggs.append(F.max(F.when(cond, F.col("t_max"))).alias(out))
        elif kind == "csp_first":
            aggs += [F.min(F.when(shared, F.col("t_min"))).alias(f"{out}__t"),
                     F.min(F.when(shared, F.col("u_min"))).alias(f"{out}__u")]
        elif kind == "csp_last":
            aggs += [F.max(F.when(shared, F.col("t_max"))).alias(f"{out}__t"),
                     F.max(F.when(shared, F.col("u_max"))).alias(f"{out}__u")]
        elif kind == "last_name":
            aggs.append(F.max_by(name, last).alias(out))
        else:
            raise ValueError(f"unknown milestone kind {kind!r}")
    folded = by_name.groupBy(by).agg(*aggs)
    cols = [F.col(by)]
    for out, kind, _ in specs:
        parts = {"csp_first": ("t", "u"), "csp_last": ("u", "t")}.get(kind)
        cols.append(F.coalesce(*[F.col(f"{out}__{p}") for p in parts]).alias(out) if parts else F.col(out))
    return folded.select(*cols)


def _epoch_micros(t: Column) -> Column:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, t)


def milestone_durations(df: DataFrame, durations: Sequence[tuple[str, str, Sequence[str]]], *,
                        valid_after: tuple[str, str, str, str] | None = None,
                        order: Sequence[str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """C4: fractional minutes between milestones, plus a validity rule.

    ``durations``: (out, from, [to, fallback, ...]); the first non-NULL
    ``to`` is used.  ``valid_after``: (out, value, start, blocker) gives
    ``value`` only when it is later than ``start`` and ``blocker`` is NULL.
    ``order`` fixes the output columns (after ``keep``).
    """
    new = {}
    if valid_after is not None:
        out, value, start, blocker = valid_after
        new[out] = F.when((F.col(value) > F.col(start)) & F.col(blocker).isNull(), F.col(value))
    for out, start, targets in durations:
        end = F.coalesce(*[F.col(x) for x in targets]) if len(targets) > 1 else F.col(targets[0])
        new[out] = minutes_between(start, end)
    out_df = df.withColumns(new)
    if order is not None:
        out_df = out_df.select(*keep, *order)
    return out_df
