"""Query catalogue: one entry per operator of the survey's inventory.

Each entry is ``(spark, sf_dir) -> DataFrame`` over the driver's tables
(through the adapters), running the operator on whole tables.  The DuckDB
twin of each entry is ``oracle.oracle_queries()[key]``.
"""

from __future__ import annotations

import datetime as dt
import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlens.functions.columns import url_param
from sessionlens.operators.funnel import (
    exclusive_attribution, funnel_flags, happened_before,
)
from sessionlens.operators.identity import identity_routes
from sessionlens.operators.milestones import milestones
from sessionlens.operators.refresh import (
    latest_partition, merge_by_key, refresh_partitioned, stored_high_water_mark, write_by_date,
)
from sessionlens.operators.sessions import first_seen, session_base, session_rollup
from sessionlens.plans import app_config as A
from sessionlens.plans import models as M
from sessionlens.plans import site_config as S
from sessionlens.session import checkpoint_dir
from sessionlens.sources import adapters as AD
from sessionlens.sources.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]

# The refresh queries build the table without the last days of the data, then
# refresh it from its own high-water mark.
REFRESHED_DAYS = 10

URL_PARAMS = ["page=", "ref=", "utm_source="]


def _web(spark, sf):
    t = Tables(spark, sf)
    return AD.web_sessions(t), AD.web_events(t)


def q_site_model(spark, sf):
    s, e = _web(spark, sf)
    return M.site_model(s, e)


def q_funnel_flags_any(spark, sf):
    s, e = _web(spark, sf)
    stg_s, stg_e = M.site_staging(s, e)
    sess = stg_s.select("distinct_session_id", "session_id", "user_id").distinct()
    steps = [st for st in S.SITE_STEPS if st[1] == "any"]
    return funnel_flags(sess, stg_e, steps, allow_list=S.SITE_EVENT_ALLOW_LIST)


def q_funnel_flags_user(spark, sf):
    s, e = _web(spark, sf)
    stg_s, stg_e = M.site_staging(s, e)
    sess = stg_s.select("distinct_session_id", "session_id", "user_id").distinct()
    steps = [st for st in S.SITE_STEPS if st[1] == "user"]
    return funnel_flags(sess, stg_e, steps, allow_list=S.SITE_EVENT_ALLOW_LIST, portal=S.PORTAL)


def q_funnel_gated(spark, sf):
    s, e = _web(spark, sf)
    return M.site_gated(s, e)


def q_exclusive_attribution(spark, sf):
    s, e = _web(spark, sf)
    out = exclusive_attribution(M.site_gated(s, e), S.ATTRIBUTION)
    return out.select("distinct_session_id", "session_id", "user_id",
                      *[name for name, _ in S.ATTRIBUTION])


def q_funnel_users(spark, sf):
    s, e = _web(spark, sf)
    return M.funnel_users(s, e)


def q_happened_before(spark, sf):
    _, e = _web(spark, sf)
    name, portal_event, eval_events = S.PORTAL
    return happened_before(e, [portal_event], eval_events, out_col="portal_bf_sale")


def _classified(spark, sf):
    s, e = _web(spark, sf)
    stg_s, _ = M.site_staging(s, e)
    return M.site_classified(stg_s)


def q_classify_channel(spark, sf):
    return _classified(spark, sf).select("distinct_session_id", "utm_source", "utm_campaign",
                                         "utm_medium", "referrer", "ad_intention", "channel")


def q_campaign_intent(spark, sf):
    return _classified(spark, sf).select("distinct_session_id", "utm_campaign", "ad_intention")


def q_classify_browser(spark, sf):
    return _classified(spark, sf).select(
        "distinct_session_id", F.col("browser_class").alias("browser"),
        F.col("platform_class").alias("platform"), "email_stream")


def q_url_param(spark, sf):
    urls = AD.link_urls(Tables(spark, sf))
    return urls.select("page_id", "url", *[url_param("url", k).alias(k.rstrip("=")) for k in URL_PARAMS])


def _routes(spark, sf):
    t = Tables(spark, sf)
    return identity_routes(AD.id_history(t), AD.contact_keys(t), AD.emails(t), AD.app_web_lookup(t),
                           AD.web_session_facts(t), AD.page_views(t))


def q_link_identities(spark, sf):
    return _routes(spark, sf).product()


def q_identity_routes(spark, sf):
    """C10 without the product: one row per account, route and web user."""
    return _routes(spark, sf).long()


def q_account_visits(spark, sf):
    """The first and last web session date of each account's app users."""
    return _routes(spark, sf).accounts.select("primary_account_id", "buy_now_user_first_session_date",
                                              "buy_now_user_last_session_date")


def _linked(spark, sf):
    t = Tables(spark, sf)
    return M.linked_app_events(AD.app_events(t), AD.app_to_web_links(t))


def q_bounded_identity_join(spark, sf):
    return _linked(spark, sf)


def q_later_link_counts(spark, sf):
    """C12 counted: every app event with the number of links that begin after it."""
    t = Tables(spark, sf)
    return M.counted_app_events(AD.app_events(t), AD.app_to_web_links(t))


def q_session_rollup(spark, sf):
    return session_rollup(_linked(spark, sf), counts={"CSP_shared_count": A.CSP_SHARED_EVENTS})


def q_session_base(spark, sf):
    t = Tables(spark, sf)
    return session_base(AD.app_sessions(t), AD.app_events(t), A.APP_VIEW_EVENTS)


def q_first_seen(spark, sf):
    t = Tables(spark, sf)
    return first_seen(session_base(AD.app_sessions(t), AD.app_events(t), A.APP_VIEW_EVENTS))


def q_milestones(spark, sf):
    ev = _linked(spark, sf).select("session_id", F.col("time").alias("event_time"),
                                   "event_table_name", "account_id_user_first_session")
    return milestones(ev, A.MILESTONES, link_time_col="account_id_user_first_session",
                      linked_events=A.CONTACT_INFO_EVENTS)


def q_milestone_durations(spark, sf):
    derived = [A.SCAN_END[0], *[d[0] for d in A.DURATIONS]]
    return M.app_milestones(_linked(spark, sf)).select("session_id", *derived)


def q_app_session_model(spark, sf):
    t = Tables(spark, sf)
    return M.app_session_model(AD.app_sessions(t), AD.app_events(t), AD.app_to_web_links(t),
                               AD.app_account_map(t))


def q_linked_app_session_model(spark, sf):
    """The app model reading the linking model's output; app users carry that model's ids."""
    t = Tables(spark, sf)
    links = _routes(spark, sf).app_to_web()
    named = F.concat(F.lit("app-"), F.col("user_id").cast("string"))
    accounts = AD.app_account_map(t).withColumn("reference_number", F.concat(F.lit("app-"), "reference_number"))
    return M.app_session_model(AD.app_sessions(t).withColumn("user_id", named),
                               AD.app_events(t).withColumn("user_id", named), links, accounts)


def q_outcomes_after(spark, sf):
    t = Tables(spark, sf)
    return M.research_effects(AD.accounts(t), AD.opportunities(t), AD.research_log(t))


def _early(sessions, events):
    """Sessions and events before the last REFRESHED_DAYS days of the data."""
    last = sessions.agg((F.max("session_start_time") - F.make_interval(days=F.lit(REFRESHED_DAYS))).alias("t"))
    until = F.lit(last.first()["t"]).cast("timestamp_ntz")
    return sessions.where(F.col("session_start_time") < until), events.where(F.col("time") < until)


def q_incremental_refresh(spark, sf):
    """Site model of the early data, then refreshed with all data from the
    target's own high-water mark (one day lookback).  The target is written
    once, so the bound and the merge read files, not its plan."""
    s, e = _web(spark, sf)
    path = f"{_shared_folder(spark)}/refresh-target-{uuid.uuid4().hex}"
    write_by_date(M.site_model(*_early(s, e)), path, "DATE")
    latest = latest_partition(spark, path, "DATE")
    if latest is None:      # all data are of the last days
        return M.site_model(s, e)
    target = spark.read.parquet(path)
    batch = M.site_model(s, e, latest - dt.timedelta(days=1))
    return merge_by_key(target.select(*batch.columns), batch, "distinct_session_id")


def _refreshed(spark, sf, model):
    """A stored table of the early data, refreshed in place with all data and read back.  The table
    stays in the shared folder, as the rows returned are read from it."""
    s, e = _web(spark, sf)
    path = f"{_shared_folder(spark)}/site-{uuid.uuid4().hex}"
    for sessions, events in (_early(s, e), (s, e)):
        refresh_partitioned(spark, path, lambda bound, s=sessions, e=events: model(s, e, bound),
                            key="distinct_session_id", date_col="DATE",
                            staging_root=_shared_folder(spark))
    return spark.read.parquet(path)


def q_stored_watermark(spark, sf):
    """The high-water mark of a stored table without date partitions, from its files' footers."""
    s, _ = _web(spark, sf)
    path = f"{_shared_folder(spark)}/sessions-{uuid.uuid4().hex}"
    s.select("distinct_session_id", F.to_date("session_start_time").alias("DATE")).write.parquet(path)
    bound = stored_high_water_mark(spark, path, "DATE")
    return spark.range(1).select(F.lit(bound).cast("date").alias("high_water_mark"))


def q_stored_refresh(spark, sf):
    """The same on a stored table: written, refreshed in place by partition, read back."""
    return _refreshed(spark, sf, M.site_model)


def q_touched_refresh(spark, sf):
    """A stored refresh that follows late events into older partitions: equal to a full rebuild."""
    return _refreshed(spark, sf, M.site_model_touched)


def _shared_folder(spark):
    """The cluster's checkpoint folder; on one machine without that setting, one of its own."""
    local = spark.sparkContext.master.split("[")[0] == "local"
    fallback = os.path.join(tempfile.gettempdir(), "sessionlens-checkpoints") if local else None
    return checkpoint_dir(spark, fallback).rstrip("/")


QUERIES: dict[str, Query] = {
    "site_model": q_site_model,
    "funnel_flags_any": q_funnel_flags_any,
    "funnel_flags_user": q_funnel_flags_user,
    "funnel_gated": q_funnel_gated,
    "exclusive_attribution": q_exclusive_attribution,
    "funnel_users": q_funnel_users,
    "happened_before": q_happened_before,
    "classify_channel": q_classify_channel,
    "campaign_intent": q_campaign_intent,
    "classify_browser": q_classify_browser,
    "url_param": q_url_param,
    "link_identities": q_link_identities,
    "identity_routes": q_identity_routes,
    "account_visits": q_account_visits,
    "bounded_identity_join": q_bounded_identity_join,
    "later_link_counts": q_later_link_counts,
    "session_rollup": q_session_rollup,
    "session_base": q_session_base,
    "first_seen": q_first_seen,
    "milestones": q_milestones,
    "milestone_durations": q_milestone_durations,
    "app_session_model": q_app_session_model,
    "linked_app_session_model": q_linked_app_session_model,
    "outcomes_after": q_outcomes_after,
    "incremental_refresh": q_incremental_refresh,
    "stored_watermark": q_stored_watermark,
    "stored_refresh": q_stored_refresh,
    "touched_refresh": q_touched_refresh,
}
