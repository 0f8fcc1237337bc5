"""Adapters: the driver's parquet tables reshaped into the models' inputs.

The reference models read warehouse tables (web sessions, app events,
identity maps, CRM opportunities) that the driver does not ship.  Each
adapter derives one of those inputs from the driver tables with ordinary
DataFrame operations, deterministically, so the work grows with the data
and the DuckDB oracle can rebuild the same rows (``plans/oracle.py`` holds
the SQL twin of every adapter; keep them in step).

Labels (campaigns, browsers, event names, ...) are picked from small
vocabularies by arithmetic on ids and times.  The vocabularies below are
test-data choices, written so every rule family and trap of the models is
reachable; they are not model configuration.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlens.functions.columns import surrogate_key
from sessionlens.plans.app_config import app_vocabulary
from sessionlens.plans.site_config import site_vocabulary
from sessionlens.sources.tables import Tables

# Synthetic label vocabularies (test data, see module doc).
SOURCES = [None, "google", "Google", "bing", "yahoo", "facebook", "pinterest", "instagram",
           "taboola", "outbrain", "snapchat", "dataxu", "email", "groupon", "pandora",
           "tinder", "affiliates", "sfmc", "yh", "theskimm"]
CAMPAIGNS = [None, "brand-branded", "x-non-branded", "competitors-q1", "rtg", "RTG",
             "Retargeting", "prsp-video", "infl-spring", "{campaign.id}", "brdcst_slead_1",
             "wbk-2", "groupon-deal", "c21", "6115796720030", "trig-reset", "retargeting_new"]
MEDIUMS = [None, "cpc", "email", "social", "paidsocial", "rtgg", "prsp", "native",
           "paidsocialca", "organic", "nativeca"]
TERMS = [None, "{adset.id}", "6117747670230", "kw"]
REFERRERS = [None, "https://www.google.com/", "https://l.facebook.com/", "https://website.com/",
             "https://www.pinterest.com/pin", "https://outbrain.com/x",
             "https://mail.example.com/?utm_medium=email", "https://x.example.com/?u%3Demail",
             "https://website.com/.ca/", "https://www.website.ca/page", "https://taboola.com/",
             "https://instagram.com/", "https://bing.com/", "https://groupon.com/"]
LANDING_PAGES = ["website.com/", "website.ca/", "website.com/scan", "website.ca/kit", "other.com/"]
BROWSERS = [None, "Firefox 121", "Chrome", "IE 11", "Microsoft Internet Explorer",
            "Mobile Safari", "Pinterest", "Facebook App", "Opera"]
PLATFORMS = [None, "Android", "Windows 10", "Chrome OS", "iOS", "Mac OS X", "Linux"]
DEVICES = ["Desktop", "Mobile", "Tablet"]
LANDING_GROUPS = ["Homepage", "Scan pages", "App sessions", None, "Kit pages"]
ENTITIES = ["US", "CA"]
LANGUAGES = ["en", "fr", "es"]
ROLLUPS = ["paid", "organic", None]

# (vocabulary, multiplier, offset) for each web-session label column.  The
# multipliers are primes larger than every vocabulary, so no column is
# constant and the columns vary independently of each other.
WEB_SESSION_LABELS = [
    ("device_type", DEVICES, 23, 1),
    ("referrer", REFERRERS, 29, 2),
    ("landing_page", LANDING_PAGES, 31, 3),
    ("grouped_landing_pages", LANDING_GROUPS, 37, 4),
    ("utm_source", SOURCES, 41, 5),
    ("utm_campaign", CAMPAIGNS, 43, 6),
    ("utm_medium", MEDIUMS, 47, 7),
    ("utm_term", TERMS, 53, 8),
    ("utm_primary_rollup", ROLLUPS, 59, 9),
    ("utm_primary_rollup_split", ROLLUPS, 61, 10),
    ("utm_digital_rollup", ROLLUPS, 67, 11),
    ("utm_platform", PLATFORMS, 71, 12),
    ("browser", BROWSERS, 73, 13),
    ("platform", PLATFORMS, 79, 14),
    ("business_entity", ENTITIES, 83, 15),
    ("business_entity_language", LANGUAGES, 89, 16),
]

WEB_SESSION_COLUMNS = [
    "distinct_session_id", "session_id", "user_id", "ip", "session_start_time",
    "device_type", "referrer", "landing_page", "grouped_landing_pages", "utm_source",
    "utm_campaign", "utm_medium", "utm_term", "utm_primary_rollup", "utm_primary_rollup_split",
    "utm_digital_rollup", "utm_platform", "browser", "platform", "business_entity",
    "business_entity_language", "first_session_date",
]

# Number of session-id slots per day for web sessions: ids are shared by
# several users, as the web model joins events on session_id alone.
WEB_SESSION_SLOTS = 16
# Web users whose id ends in this digit are anonymous (NULL user id).
ANONYMOUS_DIGIT = 3
APP_SESSION_DAYS = 7


def pick(values: Sequence[str | None], index: Column) -> Column:
    """values[index mod len] (index >= 0)."""
    arr = F.array(*[F.lit(v).cast("string") for v in values])
    return F.element_at(arr, (F.pmod(index, F.lit(len(values))) + 1).cast("int"))


def epoch_day(ts: str | Column) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("bigint")


# ---------------------------------------------------------------- web model

def _web_keyed_events(t: Tables) -> DataFrame:
    e = t.events.select("event_id", "ts", "user_id")
    return (e.withColumn("session_id",
                         epoch_day("ts") * WEB_SESSION_SLOTS + F.pmod("user_id", F.lit(WEB_SESSION_SLOTS)))
             .withColumn("web_user_id",
                         F.when(F.pmod("user_id", F.lit(10)) == ANONYMOUS_DIGIT, F.lit(None))
                         .otherwise(F.col("user_id"))))


def web_events(t: Tables) -> DataFrame:
    """Web events: session_id, user_id, time, event_table_name."""
    vocab = site_vocabulary()
    e = _web_keyed_events(t)
    return e.select(
        "session_id",
        F.col("web_user_id").alias("user_id"),
        F.col("ts").alias("time"),
        pick(vocab, F.col("event_id") * 13 + F.col("user_id")).alias("event_table_name"),
    )


def web_sessions(t: Tables) -> DataFrame:
    """Web session facts, one row per (session_id, user_id)."""
    e = _web_keyed_events(t)
    s = (e.groupBy("session_id", F.col("web_user_id").alias("user_id"))
          .agg(F.min("ts").alias("session_start_time")))
    # (No NULL-user filter: a NULL user never matches the join below, and
    # leaving the filter out keeps this branch identical to the session
    # aggregate above, so Spark reuses its shuffle instead of rescanning.)
    first = s.groupBy("user_id").agg(F.min("session_start_time").alias("user_first_session"))
    s = s.join(first, "user_id", "left")
    seed = (F.col("session_id") * 7 + F.minute("session_start_time") * 60
            + F.second("session_start_time"))
    labels = [pick(vocab, seed * mult + off).alias(name)
              for name, vocab, mult, off in WEB_SESSION_LABELS]
    out = s.select(
        "session_id", "user_id", "session_start_time",
        F.concat(F.lit("10.0."), F.pmod(seed, F.lit(256)).cast("string"), F.lit(".1")).alias("ip"),
        F.coalesce("user_first_session", "session_start_time").alias("first_session_date"),
        *labels,
    ).withColumn("distinct_session_id",
                 surrogate_key("session_id", "user_id", "session_start_time"))
    return out.select(*WEB_SESSION_COLUMNS)


# ---------------------------------------------------------------- app model

def _app_keyed_events(t: Tables) -> DataFrame:
    e = t.events.select("event_id", "ts", "user_id", "event_type")
    return e.withColumn("session_id",
                        F.col("user_id") * 100000 + F.floor(epoch_day("ts") / APP_SESSION_DAYS))


def app_events(t: Tables) -> DataFrame:
    """App events: user_id, session_id, time, event_table_name."""
    vocab = app_vocabulary()
    e = _app_keyed_events(t)
    return e.select(
        "user_id", "session_id", F.col("ts").alias("time"),
        pick(vocab, F.col("event_id") * 17 + F.col("user_id")).alias("event_table_name"),
    )


def app_sessions(t: Tables) -> DataFrame:
    """App sessions, one row per (user_id, session_id), with customer geography."""
    e = _app_keyed_events(t)
    s = e.groupBy("user_id", "session_id").agg(F.min("ts").alias("session_start_time"))
    geo = (t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
           .join(t.nation.select("n_nationkey", "n_name", "n_regionkey"),
                 F.col("c_nationkey") == F.col("n_nationkey"), "left")
           .join(t.region.select("r_regionkey", "r_name"),
                 F.col("n_regionkey") == F.col("r_regionkey"), "left")
           .select(F.col("c_custkey").alias("user_id"), F.col("n_name").alias("country"),
                   F.col("r_name").alias("region"), F.col("c_mktsegment").alias("city")))
    s = s.join(geo, "user_id", "left")
    return s.select(
        "user_id", "session_id", "session_start_time",
        F.lit("app-sdk").alias("library"),
        pick(["iOS", "Android"], F.col("user_id")).alias("platform"),
        pick(DEVICES, F.col("session_id")).alias("device_type"),
        "country", "region", "city",
        F.concat(F.lit("10.1."), F.pmod("user_id", F.lit(256)).cast("string"), F.lit(".1")).alias("ip"),
    )


def app_account_map(t: Tables) -> DataFrame:
    """Account-service id map: app user id (as text) -> primary account."""
    c = t.customer.select("c_custkey")
    return c.select(F.col("c_custkey").cast("string").alias("reference_number"),
                    F.concat(F.lit("acct-"), (F.col("c_custkey") / 2).cast("bigint").cast("string"))
                    .alias("primary_account_id"))


def app_to_web_links(t: Tables) -> DataFrame:
    """App-to-web links: the web identity and first web session of app users.

    Every customer has a row; the web user and time are NULL for those in
    debt or without events.  BUILDING customers get a second, later link
    (fan-out in the bounded join).
    """
    first = t.events.groupBy("user_id").agg(F.min("ts").alias("first_ts"))
    c = t.customer.select("c_custkey", "c_acctbal", "c_mktsegment")
    linked = F.when(F.col("c_acctbal") >= 0, F.col("first_ts"))
    j = (c.join(first, F.col("user_id") == F.col("c_custkey"), "left")
         .select(F.col("c_custkey").alias("user_id"), "c_mktsegment", linked.alias("first_ts")))
    offsets = F.when(F.col("c_mktsegment") == "BUILDING", F.array(F.lit(10), F.lit(20))) \
               .otherwise(F.array(F.lit(10)))
    j = j.withColumn("days", F.explode(offsets))
    return j.select(
        F.concat(F.lit("acct-"), (F.col("user_id") / 2).cast("bigint").cast("string")).alias("primary_account_id"),
        F.when(F.col("first_ts").isNotNull(), F.concat(F.lit("web-"), F.col("user_id").cast("string")))
        .alias("account_id_user"),
        F.col("user_id").cast("string").alias("acs_user_id"),
        (F.col("first_ts") + F.make_interval(days=F.col("days"))).alias("account_id_user_first_session"),
    )


# ----------------------------------------------------- identity linking

def id_history(t: Tables) -> DataFrame:
    """App id history: each app user's account and id creation time, plus a
    legacy id created 400 days earlier (dropped by the model's date bound)."""
    first = t.events.groupBy("user_id").agg(F.min("ts").alias("first_ts"))
    acct = F.concat(F.lit("acct-"), (F.col("user_id") / 2).cast("bigint").cast("string"))
    current = first.select(acct.alias("primary_account_id"),
                           F.col("first_ts").alias("date_created"),
                           F.concat(F.lit("app-"), F.col("user_id").cast("string")).alias("primary_reference_number"))
    legacy = first.select(acct.alias("primary_account_id"),
                          (F.col("first_ts") - F.make_interval(days=F.lit(400))).alias("date_created"),
                          F.concat(F.lit("legacy-"), F.col("user_id").cast("string")).alias("primary_reference_number"))
    return current.unionByName(legacy)


def primary_accounts(t: Tables) -> DataFrame:
    return t.customer.select(
        F.concat(F.lit("acct-"), (F.col("c_custkey") / 2).cast("bigint").cast("string")).alias("primary_account_id")
    ).distinct()


def contact_keys(t: Tables) -> DataFrame:
    """One contact key per customer; two customers share an account."""
    c = t.customer.select("c_custkey")
    return c.select(
        F.concat(F.lit("acct-"), (F.col("c_custkey") / 2).cast("bigint").cast("string")).alias("primary_account_id"),
        F.concat(F.lit("ck-"), F.col("c_custkey").cast("string")).alias("reference_number"),
        (F.lit("2023-01-01 00:00:00").cast("timestamp_ntz")
         + F.make_interval(days=F.pmod(F.col("c_custkey") * 3, F.lit(500)).cast("int"))).alias("date_created"),
    )


def emails(t: Tables) -> DataFrame:
    """E-mail ids, one row per customer; NULL for customers not in credit."""
    c = t.customer.select("c_custkey", "c_acctbal")
    return c.select(
        F.concat(F.lit("acct-"), (F.col("c_custkey") / 2).cast("bigint").cast("string")).alias("primary_account_id"),
        F.when(F.col("c_acctbal") > 0, F.concat(F.lit("e-"), F.col("c_custkey").cast("string")))
        .alias("reference_number"),
    )


def app_web_lookup(t: Tables) -> DataFrame:
    u = t.events.select("user_id").distinct()
    return u.select(F.concat(F.lit("app-"), F.col("user_id").cast("string")).alias("app_user_id"),
                    F.concat(F.lit("web-"), F.col("user_id").cast("string")).alias("web_user_id"))


def web_session_facts(t: Tables) -> DataFrame:
    """Web session facts: one row per (user, day) with the user's first session."""
    e = t.events.select("user_id", "ts")
    s = e.groupBy("user_id", epoch_day("ts").alias("day")).agg(F.min("ts").alias("start"))
    first = s.groupBy("user_id").agg(F.min("start").alias("first_session_date"))
    return s.join(first, "user_id").select(
        F.concat(F.lit("web-"), F.col("user_id").cast("string")).alias("user_id"),
        F.col("start").alias("session_start_time"), "first_session_date")


def page_views(t: Tables) -> DataFrame:
    """Web page views with utm fields, url query and path."""
    e = t.events.select("event_id", "user_id", "ts", "event_type")
    acct = F.concat(F.lit("acct-"), (F.col("user_id") / 2).cast("bigint").cast("string"))
    k = F.pmod(F.col("event_id"), F.lit(6))
    query = (F.when(k == 0, F.concat(F.lit("accountId="), acct, F.lit("&utm_source=app")))
             .when(k == 1, F.concat(F.lit("accountId="), acct, F.lit("%26x=1")))
             .when(k == 2, F.concat(F.lit("ref=x&accountId="), acct))
             .when(k == 3, F.lit("accountId="))
             .when(k == 4, F.lit("utm_source=sfmc")))
    return e.select(
        F.concat(F.lit("web-"), F.col("user_id").cast("string")).alias("user_id"),
        F.when(F.col("event_type").isin("click", "signup"), F.lit("sfmc")).otherwise(F.lit("app")).alias("utm_source"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("ck-"), F.col("user_id").cast("string"))).alias("utm_term"),
        F.col("ts").alias("session_time"),
        query.alias("query"),
        F.when(F.col("event_type") == "view", F.lit("/en/custom-smile-plan-3d/view"))
         .otherwise(F.lit("/en/home")).alias("path"),
    )


# -------------------------------------------------------- research effects

def accounts(t: Tables) -> DataFrame:
    """CRM accounts: three customers per company."""
    return t.customer.select(
        (F.col("c_custkey") / 3).cast("bigint").alias("main_company_identifier"),
        F.col("c_custkey").alias("account_id"),
        F.col("c_name").alias("account_name"),
        F.col("c_mktsegment").alias("account_type"),
    )


def opportunities(t: Tables) -> DataFrame:
    """Opportunities from orders: won F / lost P / open O (NULL)."""
    o = t.orders
    return o.select(
        F.col("o_custkey").alias("account_id"),
        F.col("o_orderkey").alias("opportunity_id"),
        F.col("o_orderdate").alias("close_date"),
        F.when(F.col("o_orderstatus") == "F", F.lit(True))
         .when(F.col("o_orderstatus") == "P", F.lit(False)).alias("is_opp_won"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("Renewal"))
         .when(F.col("o_orderpriority") == "2-HIGH", F.lit("New"))
         .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("New Logo"))
         .otherwise(F.col("o_orderpriority")).alias("type"),
        F.col("o_totalprice").alias("amount"),
    )


def research_log(t: Tables) -> DataFrame:
    """Research log, one row per customer; a presentation date for BUILDING,
    MACHINERY and AUTOMOBILE customers that are not in debt."""
    c = t.customer
    presented = F.date_add(F.lit("1995-01-01").cast("date"),
                           F.pmod(F.col("c_custkey") * 37, F.lit(2000)).cast("int"))
    presented = F.when((F.col("c_acctbal") >= 0)
                       & F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "AUTOMOBILE"), presented)
    return c.select(
        (F.col("c_custkey") / 3).cast("bigint").alias("main_company_identifier"),
        F.date_sub(presented, 7).alias("deck_delivered_date"),
        presented.alias("deck_presented_date"),
    )


# ------------------------------------------------------------------ urls

def link_urls(t: Tables) -> DataFrame:
    """Page urls, plus a copy with '&' encoded as '%26'."""
    p = t.pages.select("page_id", "url")
    return p.select("page_id", "url").unionByName(
        p.select((F.col("page_id") + 1000000000).alias("page_id"),
                 F.regexp_replace("url", "&", "%26").alias("url")))
