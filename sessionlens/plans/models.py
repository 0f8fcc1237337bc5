"""The reference's four models expressed as compositions of operators.

Each function takes its input DataFrames (already shaped like the model's
sources) and returns the model's output DataFrame; nothing is collected
except the single high-water-mark scalar of the incremental refresh.
"""

from __future__ import annotations

import datetime as _dt
import os
import tempfile

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlens.functions.columns import like_any
from sessionlens.operators.classify import campaign_intent, classify_columns
from sessionlens.operators.funnel import (
    attach_step_flags, conditional_distinct_counts, exclusive_attribution, gate_funnel, session_step_flags,
)
from sessionlens.operators.identity import bounded_identity_join
from sessionlens.operators.joins import join_per_key
from sessionlens.operators.later_links import later_link_counts
from sessionlens.operators.milestones import (
    counted_events_by_name, milestone_durations, milestones, milestones_from_names,
)
from sessionlens.operators.outcomes import outcomes_after, research_measures
from sessionlens.operators.sessions import first_seen, session_base
from sessionlens.plans import app_config as A
from sessionlens.plans import site_config as S
from sessionlens.session import checkpoint_dir


def as_timestamp(bound) -> Column:
    """Literal TIMESTAMP_NTZ for a date/datetime/ISO string bound."""
    if isinstance(bound, (_dt.date, _dt.datetime)):
        bound = bound.isoformat(sep=" ") if isinstance(bound, _dt.datetime) else bound.isoformat()
    return F.lit(str(bound)).cast("timestamp_ntz")


# ------------------------------------------------------------------ web

def site_staging(sessions: DataFrame, events: DataFrame, bound=None) -> tuple[DataFrame, DataFrame]:
    """Staged inputs: non-app sessions and events, after ``bound`` if given.

    ``!=`` also drops sessions whose landing-page group is NULL.
    """
    stg_s = sessions.where(F.col("grouped_landing_pages") != S.APP_SESSIONS_GROUP)
    stg_e = events
    if bound is not None:
        b = as_timestamp(bound)
        stg_s = stg_s.where(F.col("session_start_time") > b)
        stg_e = stg_e.where(F.col("time") > b)
    return stg_s, stg_e


def site_classified(stg_sessions: DataFrame, extra: tuple[str, ...] = (),
                    campaigns: DataFrame | None = None) -> DataFrame:
    """Session rows with lowercased labels, ``ad_intention`` and the four
    rule-table classifications (``browser_class``, ``channel``,
    ``email_stream``, ``platform_class``).  ``extra`` columns pass through.
    Campaigns are looked up among those of ``campaigns`` (the sessions themselves if None)."""
    lowered = {c: F.lower(c) for c in S.LOWERED_SESSION_COLUMNS}
    sess = stg_sessions.select(
        "distinct_session_id", "session_id", "user_id", *extra,
        *[expr.alias(c) for c, expr in lowered.items()])
    sess = campaign_intent(sess, stg_sessions if campaigns is None else campaigns, S.RETARGETING_CAMPAIGNS)
    return classify_columns(sess, {
        "browser_class": (S.BROWSER_RULES, S.BROWSER_DEFAULT),
        "channel": (S.CHANNEL_RULES, S.CHANNEL_DEFAULT),
        "email_stream": (S.EMAIL_STREAM_RULES, S.EMAIL_STREAM_DEFAULT),
        "platform_class": (S.PLATFORM_RULES, S.PLATFORM_DEFAULT),
    })


def site_session_dimensions(stg_sessions: DataFrame, unique_sessions: bool = False,
                            campaigns: DataFrame | None = None) -> DataFrame:
    """Classified, distinct session dimension rows (the model's first 18 columns).

    ``unique_sessions=True`` declares that the input has one row per
    ``distinct_session_id`` (the model's own unique key); the projected rows
    are then already distinct and the DISTINCT, a full shuffle of the
    sessions, is skipped.
    """
    sess = site_classified(stg_sessions, extra=("session_start_time", "business_entity",
                                                "business_entity_language", "first_session_date"),
                           campaigns=campaigns)
    dims = sess.select(
        F.to_date("session_start_time").alias("DATE"), "user_id", "distinct_session_id",
        "session_id", F.col("device_type").alias("device"), "channel",
        "utm_primary_rollup", "utm_primary_rollup_split", "utm_medium", "utm_source",
        "utm_platform", "utm_digital_rollup", F.col("browser_class").alias("browser"),
        "email_stream", F.col("platform_class").alias("platform"),
        "business_entity", "business_entity_language",
        F.to_date("first_session_date").alias("first_session_date"))
    # One distinct over the published dimensions replaces the original's
    # two (group-by over 23 columns, then SELECT DISTINCT): flags depend
    # only on session_id and user_id, both kept here.
    return dims if unique_sessions else dims.distinct()


def site_gated(sessions: DataFrame, events: DataFrame, bound=None,
               unique_sessions: bool = False) -> DataFrame:
    """Session dimensions and gated step flags (74 columns, before attribution)."""
    stg_s, stg_e = site_staging(sessions, events, bound)
    return _gated(stg_s, stg_e, unique_sessions)


def _gated(stg_s: DataFrame, stg_e: DataFrame, unique_sessions: bool, campaigns: DataFrame | None = None) -> DataFrame:
    dims = site_session_dimensions(stg_s, unique_sessions, campaigns)
    flags = session_step_flags(stg_e, S.SITE_STEPS, allow_list=S.SITE_EVENT_ALLOW_LIST,
                               portal=S.PORTAL)
    d1 = attach_step_flags(dims, flags, S.SITE_STEPS, portal_name=S.PORTAL[0])
    return gate_funnel(d1, S.GATES, keep=S.SITE_DIMENSIONS)


def site_model(sessions: DataFrame, events: DataFrame, bound=None,
               unique_sessions: bool = False) -> DataFrame:
    """Web sessions with channel attribution and gated funnel flags (83 columns).

    See ``site_session_dimensions`` for ``unique_sessions``."""
    return exclusive_attribution(site_gated(sessions, events, bound, unique_sessions), S.ATTRIBUTION)


def touched_session_ids(sessions: DataFrame, events: DataFrame, bound) -> DataFrame:
    """Ids of sessions that began by ``bound`` and that rows after it change: late events of the
    session, or the first session whose campaign text the session's own campaign is looked up by."""
    after = as_timestamp(bound)
    recent = F.coalesce(F.col("session_start_time") > after, F.lit(False))
    late = events.where((F.col("time") > after) & F.col("session_id").isNotNull()).select("session_id").distinct()
    texts = sessions.where(F.col("utm_campaign").isNotNull())
    new = (texts.where(recent).select("utm_campaign").distinct()
           .join(texts.where(~recent).select("utm_campaign").distinct(), "utm_campaign", "left_anti"))
    named = (texts.where(~recent).select("session_id", F.lower("utm_campaign").alias("utm_campaign"))
             .join(new, "utm_campaign", "left_semi").select("session_id").distinct())
    return late.unionByName(named.where(F.col("session_id").isNotNull())).distinct()


def site_model_touched(sessions: DataFrame, events: DataFrame, bound=None, unique_sessions: bool = False) -> DataFrame:
    """``site_model`` of the sessions that began after ``bound`` or that rows after it change, each
    from all of its events.  With these rows replaced, a table equals a full rebuild.

    Semi joins by session id narrow sessions and events; Spark puts a Bloom filter of the
    touched ids before the scan of the event table where that is large.
    """
    if bound is None:
        return site_model(sessions, events, None, unique_sessions)
    stg_s, stg_e = site_staging(sessions, events)
    recent = F.coalesce(F.col("session_start_time") > as_timestamp(bound), F.lit(False))
    ids = touched_session_ids(stg_s, stg_e, bound)
    rebuilt = stg_s.where(recent).unionByName(stg_s.where(~recent).join(ids, "session_id", "left_semi").select(*stg_s.columns))
    known = ids.unionByName(stg_s.where(recent & F.col("session_id").isNotNull()).select("session_id")).distinct()
    own_events = stg_e.join(known, "session_id", "left_semi").select(*stg_e.columns)
    return exclusive_attribution(_gated(rebuilt, own_events, unique_sessions, campaigns=stg_s), S.ATTRIBUTION)


def funnel_users(sessions: DataFrame, events: DataFrame) -> DataFrame:
    """Users who reached each "user" step, per day and channel: the model's 16 conditional distinct
    counts (A5) over groups of many users."""
    stg_s, stg_e = site_staging(sessions, events)
    steps = [step for step in S.SITE_STEPS if step[1] == "user"]
    flags = session_step_flags(stg_e, steps, allow_list=S.SITE_EVENT_ALLOW_LIST, portal=S.PORTAL)
    dims = site_classified(stg_s, extra=("session_start_time",)).select(
        F.to_date("session_start_time").alias("DATE"), "channel", "user_id", "session_id").distinct()
    visits = join_per_key(dims, flags, "session_id")
    conditions = {name: F.col(name) == 1 for name, _, _ in steps}
    conditions[S.PORTAL[0]] = F.col(f"{S.PORTAL[0]}_bf_eval") == 1
    return conditional_distinct_counts(visits, ["DATE", "channel"], "user_id", conditions)


# ------------------------------------------------------------------ app

def app_event_filter(events: DataFrame, name_col: str = "event_table_name") -> DataFrame:
    """App events only: names matching the app patterns or listed exactly."""
    name = F.col(name_col)
    return events.where(like_any(name, A.APP_EVENT_LIKE) | name.isin(A.APP_EVENT_EXACT))


def simplified_links(links: DataFrame) -> DataFrame:
    """Distinct app-to-web links that carry a web identity."""
    return (links.select("primary_account_id", "account_id_user", "acs_user_id",
                         "account_id_user_first_session")
            .where(F.col("account_id_user").isNotNull()).distinct())


def linked_app_events(events: DataFrame, links: DataFrame) -> DataFrame:
    """App events with the links whose first web session came later."""
    return bounded_identity_join(app_event_filter(events), simplified_links(links),
                                 event_key="user_id", link_key="acs_user_id",
                                 time_col="time", bound_col="account_id_user_first_session")


def counted_app_events(events: DataFrame, links: DataFrame) -> DataFrame:
    """App events, each with the number of links whose first web session came later (C12 without the product)."""
    narrow = app_event_filter(events).select("user_id", "session_id", "time", "event_table_name")
    return later_link_counts(narrow, simplified_links(links), event_key="user_id", link_key="acs_user_id",
                             time_col="time", bound_col="account_id_user_first_session")


def app_milestones(linked_events: DataFrame) -> DataFrame:
    """C3 + C4 over linked app events: one row per session id."""
    ev = linked_events.select("session_id", F.col("time").alias("event_time"), "event_table_name",
                              "account_id_user_first_session")
    ms = milestones(ev, A.MILESTONES, link_time_col="account_id_user_first_session",
                    linked_events=A.CONTACT_INFO_EVENTS)
    return milestone_durations(ms, A.DURATIONS, valid_after=A.SCAN_END,
                               order=A.MILESTONE_OUTPUT_ORDER, keep=["session_id"])


def written_once(df: DataFrame) -> DataFrame:
    """``df`` read back from the shared checkpoint folder.  A cluster must name one in ``spark.checkpoint.dir``."""
    spark = df.sparkSession
    local = spark.sparkContext.master.split("[")[0] == "local"
    checkpoint_dir(spark, os.path.join(tempfile.gettempdir(), "sessionlens-checkpoints") if local else None)
    return df.checkpoint(eager=True)


def app_session_model(sessions: DataFrame, events: DataFrame, links: DataFrame,
                      account_map: DataFrame, unique_sessions: bool = False,
                      one_row_per_session: bool = False) -> DataFrame:
    """App sessions with account, rollup and milestone times.

    One row per session and view-event time (the original keeps ``time`` in
    its session DISTINCT), all rows of a session sharing its surrogate key;
    ``one_row_per_session=True`` keeps only the first view time.
    """
    base = session_base(sessions, events, A.APP_VIEW_EVENTS, unique_sessions=unique_sessions,
                        one_row_per_session=one_row_per_session)
    # The identity join is counted, not built.  One aggregate of the counted events, written once; the
    # rollup per user and session and the milestones per session are partial aggregates of its rows,
    # so a session that many users share never stands in one row.
    by_name = written_once(counted_events_by_name(counted_app_events(events, links), ["user_id", "session_id"],
                                                  time_col="time"))
    shared = F.when(F.col("name").isin(A.CSP_SHARED_EVENTS), F.col("n")).otherwise(F.lit(0))
    rollup = by_name.groupBy("session_id", "user_id").agg(
        F.max("t_max").alias("session_end_time"), F.sum("n").alias("event_count"),
        F.sum(shared).alias("CSP_shared_count"))
    reached = milestones_from_names(by_name, A.MILESTONES, linked_events=A.CONTACT_INFO_EVENTS)
    reached = milestone_durations(reached, A.DURATIONS, valid_after=A.SCAN_END,
                                  order=A.MILESTONE_OUTPUT_ORDER, keep=["session_id"])
    # Both per-user tables (first session, account by the id's text) are
    # joined to each other first, so the wide session rows are shuffled
    # once for the pair.  Every user of ``base`` has a first session, so
    # the account rows (possibly several) attach exactly as they would to
    # ``base`` directly.
    acct = account_map.select("reference_number", "primary_account_id").distinct()
    per_user = (first_seen(base).withColumn("_uid", F.col("user_id").cast("string"))
                .join(acct, F.col("_uid") == F.col("reference_number"), "left")
                .drop("_uid", "reference_number"))
    # Per-session / per-user tables: joined so that a hot session or user
    # can be split by AQE (see operators/joins.py).
    joined = join_per_key(join_per_key(base, per_user, "user_id"), rollup, ["session_id", "user_id"])
    joined = join_per_key(joined, reached, "session_id")
    return joined.select(
        *base.columns, "primary_account_id", "first_session_date",
        "session_end_time", "event_count", "CSP_shared_count",
        *A.MILESTONE_OUTPUT_ORDER)


# ------------------------------------------------------------- research

def research_effects(accounts: DataFrame, opportunities: DataFrame, research: DataFrame) -> DataFrame:
    """Opportunities closed / won / lost after a research presentation, per company."""
    return outcomes_after(accounts, opportunities, research, research_measures(),
                          outcome_date=F.to_date("close_date"))
