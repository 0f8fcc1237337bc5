"""Funnel operators: step flags per session (C5), gates between steps (C6),
exclusive booking attribution (C7) and "A happened no later than B" (C8).

Plan shape.  The literal model joins every session row to all of its
events and then groups by ~23 session dimensions with 16 COUNT(DISTINCT)
and 37 SUM(CASE) aggregates: Spark would shuffle every event together with
the wide dimension tuple and add an Expand for the distinct aggregates.
Flags depend only on the session id (plus whether the user id is NULL), so
here events are reduced to one row per session id *before* any join: a
hash aggregate with map-side partial aggregation, which also absorbs hot
session ids (each task ships at most one partial row per id).  The session
dimensions are joined to that small per-session table afterwards.

The original also semi-joins events to the known session ids before its
left join from sessions; that semi join cannot change the result (the left
join drops unmatched events anyway), so the per-session table is built from
all events and the join to the sessions keeps only known ids.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlens.functions.columns import first_time, flag
from sessionlens.functions.membership import Membership
from sessionlens.operators.joins import join_per_key

Step = tuple[str, str, Sequence[str]]  # (flag name, "user" | "any", event names)
PortalSpec = tuple[str, str, Sequence[str]]  # (flag name, portal event, evaluation events)


def effective_steps(steps: Sequence[Step], allow_list: Iterable[str] | None) -> list[Step]:
    """Restrict each step to allowed event names (names outside never fire)."""
    if allow_list is None:
        return [(n, s, list(ev)) for n, s, ev in steps]
    allowed = set(allow_list)
    return [(n, s, [e for e in ev if e in allowed]) for n, s, ev in steps]


def session_step_flags(events: DataFrame, steps: Sequence[Step], *,
                       allow_list: Iterable[str] | None = None,
                       portal: PortalSpec | None = None,
                       session_col: str = "session_id",
                       name_col: str = "event_table_name",
                       time_col: str = "time") -> DataFrame:
    """One row per session id: 0/1 (int) per step, and ``<portal>_bf_eval``.

    ``allow_list`` defaults to the union of the step events; pass the
    model's own list for parity (steps naming unlisted events never fire).
    With ``portal``, ``<name>_bf_eval`` is 1 when the session's first
    portal event is not after its first evaluation event (or there is no
    evaluation, or a time is missing), 0 when it is after, and NULL when
    the session never reached the portal.

    Each event is looked up once in a broadcast ``Membership`` table (a
    hash join that also drops unrelated events) and the session aggregate
    is a ``bit_or`` per 62 steps: per-event work does not grow with the
    number of steps, and the partial aggregates shuffled per session are a
    few longs instead of one column per step.
    """
    steps = effective_steps(steps, allow_list)
    sets = [evs for _, _, evs in steps]
    if portal is not None:
        sets += [[portal[1]], list(portal[2])]
    lookup = Membership(events.sparkSession, sets)
    ev = lookup.attach(events.where(F.col(session_col).isNotNull()), name_col, "inner")
    aggs = [F.bit_or(w).alias(w) for w in lookup.words]
    if portal is not None:
        p_idx, e_idx = len(steps), len(steps) + 1
        aggs += [
            F.max(lookup.member(p_idx)).alias("_has_portal"),
            first_time(lookup.member(p_idx), time_col).alias("_first_portal"),
            first_time(lookup.member(e_idx), time_col).alias("_first_eval"),
        ]
    out = ev.groupBy(session_col).agg(*aggs)
    cols = [F.col(session_col), *[lookup.bit(i).cast("int").alias(step)
                                  for i, (step, _, _) in enumerate(steps)]]
    if portal is not None:
        cols.append(F.when(F.col("_has_portal"),
                           F.when(F.col("_first_portal") > F.col("_first_eval"), F.lit(0))
                           .otherwise(F.lit(1))).alias(f"{portal[0]}_bf_eval"))
    return out.select(*cols)


def attach_step_flags(sessions: DataFrame, flags: DataFrame, steps: Sequence[Step], *,
                      portal_name: str | None = None,
                      session_col: str = "session_id", user_col: str = "user_id") -> DataFrame:
    """Left-join per-session flags onto session rows and finish their values.

    "any" steps become ``coalesce(flag, 0)`` (int).  "user" steps (and the
    portal flag) count the session's user: 1 only when the user id is not
    NULL (bigint, as a distinct count of user ids within one session row).
    """
    joined = join_per_key(sessions, flags, session_col, "left")
    user_known = F.col(user_col).isNotNull()
    finished = {}
    for step, style, _ in steps:
        raw = F.col(step)
        if style == "user":
            finished[step] = F.when(user_known & (raw == 1), F.lit(1)).otherwise(F.lit(0)).cast("bigint")
        else:
            finished[step] = F.coalesce(raw, F.lit(0))
    if portal_name is not None:
        finished[portal_name] = (F.when(user_known & (F.col(f"{portal_name}_bf_eval") == 1), F.lit(1))
                                 .otherwise(F.lit(0)).cast("bigint"))
    keep = [c for c in sessions.columns]
    return joined.select(*keep, *[c.alias(n) for n, c in finished.items()])


def funnel_flags(sessions: DataFrame, events: DataFrame, steps: Sequence[Step], *,
                 allow_list: Iterable[str] | None = None,
                 portal: PortalSpec | None = None,
                 session_col: str = "session_id", user_col: str = "user_id",
                 name_col: str = "event_table_name", time_col: str = "time") -> DataFrame:
    """Session rows with one flag per funnel step (see module doc)."""
    flags = session_step_flags(events, steps, allow_list=allow_list, portal=portal,
                               session_col=session_col, name_col=name_col, time_col=time_col)
    return attach_step_flags(sessions, flags, steps,
                             portal_name=portal[0] if portal else None,
                             session_col=session_col, user_col=user_col)


#: Conditions that one bit mask holds.
MASK_BITS = 62


def conditional_distinct_counts(rows: DataFrame, group: Sequence[str], id_col: str,
                                conditions: Mapping[str, Column]) -> DataFrame:
    """A5: per group and condition, how many different ids have a row on which the condition holds.

    COUNT(DISTINCT CASE WHEN condition THEN id END) per condition would repeat every row once per
    condition.  Here rows are first reduced to one per (group, id) with a bit per condition,
    partially in every task, so a hot group is spread over its ids and a hot id is one row a
    task; then the bits are summed.  NULL ids are not counted; their groups stay, as do groups
    without any match (0).  NULL group values form groups.
    """
    names = list(conditions)
    masks = {}
    for w in range(0, len(names), MASK_BITS):
        bits = [F.when(conditions[n], F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long"))
                for k, n in enumerate(names[w:w + MASK_BITS])]
        masks[f"_mask{w // MASK_BITS}"] = reduce(Column.bitwiseOR, bits)
    per_id = rows.groupBy(*group, F.col(id_col).alias("_id")).agg(*[F.bit_or(m).alias(n) for n, m in masks.items()])
    sums = []
    for k, n in enumerate(names):
        bit = F.shiftright(F.col(f"_mask{k // MASK_BITS}"), k % MASK_BITS).bitwiseAND(F.lit(1))
        sums.append(F.sum(F.when(F.col("_id").isNotNull(), bit).otherwise(F.lit(0))).alias(n))
    return per_id.groupBy(*group).agg(*sums)


def _gate_column(spec: tuple) -> Column:
    kind = spec[0]
    if kind == "keep":
        return F.col(spec[1])
    if kind == "any":
        cond = None
        for c in spec[1]:
            term = F.col(c) == 1
            cond = term if cond is None else (cond | term)
        return flag(cond)
    if kind == "all":
        cond = None
        for group in spec[1]:
            g = None
            for c in group:
                term = F.col(c) == 1
                g = term if g is None else (g & term)
            cond = g if cond is None else (cond | g)
        return flag(cond)
    if kind == "needs":
        return F.when(F.col(spec[1]) == 0, F.lit(0)).otherwise(F.col(spec[2]))
    if kind == "unless":
        return F.when(F.col(spec[1]) == 1, F.lit(0)).otherwise(F.col(spec[2]))
    raise ValueError(f"unknown gate kind {kind!r}")


def gate_funnel(df: DataFrame, gates: Sequence[tuple[str, tuple]], keep: Sequence[str] = ()) -> DataFrame:
    """Apply gates in ONE projection, so each reads the ungated flags.

    Output: ``keep`` columns followed by one column per gate, in order.
    """
    return df.select(*[F.col(c) for c in keep], *[_gate_column(s).alias(n) for n, s in gates])


def exclusive_attribution(df: DataFrame, rules: Sequence[tuple[str, list]]) -> DataFrame:
    """Add one 0/1 column per rule: 1 when any alternative's
    (column, value) pairs all hold.  Later rules may read earlier outputs."""
    out, batch = df, {}
    for name, alternatives in rules:
        # one projection for all rules up to the first that reads one of them
        if batch.keys() & {c for alt in alternatives for c, _ in alt}:
            out, batch = out.withColumns(batch), {}
        batch[name] = flag(reduce(or_, [reduce(and_, [F.col(c) == v for c, v in alt]) for alt in alternatives]))
    return out.withColumns(batch) if batch else out


def happened_before(events: DataFrame, first_events: Sequence[str], then_events: Sequence[str], *,
                    out_col: str = "happened_before", session_col: str = "session_id",
                    name_col: str = "event_table_name", time_col: str = "time") -> DataFrame:
    """Per session with any ``first_events`` row: 0 when its first such
    event is after the first ``then_events`` event, else 1 (no ``then``
    event, a tie or a missing time all give 1).  One aggregate, no join."""
    name = F.col(name_col)
    ev = events.where(name.isin(sorted(set(first_events) | set(then_events))))
    agg = ev.groupBy(session_col).agg(
        F.max(name.isin(list(first_events))).alias("_has_first"),
        first_time(name.isin(list(first_events)), time_col).alias("_t_first"),
        first_time(name.isin(list(then_events)), time_col).alias("_t_then"),
    )
    return (agg.where(F.col("_has_first"))
               .select(session_col,
                       F.when(F.col("_t_first") > F.col("_t_then"), F.lit(0)).otherwise(F.lit(1))
                       .alias(out_col)))
