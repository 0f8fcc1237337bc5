"""Identity operators: the time-bounded identity join (C12) and the
app-account to web-user linking model (C10).

The linking model's windows (``first_value(date) OVER (PARTITION BY
account ORDER BY date)`` followed by DISTINCT) are per-account minimums.  A
window would pull every row of an account into one task; a grouped
minimum aggregates map-side instead and is joined back by key, so a hot
account costs one partial row per task.  Side tables that only contribute
one column through a DISTINCT (session facts) are reduced to their
distinct (key, value) pairs before joining, which removes the fan-out the
DISTINCT would otherwise have to undo.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlens.functions.columns import url_param
from sessionlens.operators.joins import join_per_key, spread_key


def bounded_identity_join(events: DataFrame, links: DataFrame, *, event_key: str, link_key: str,
                          time_col: str, bound_col: str) -> DataFrame:
    """Left-join links whose bound is strictly after the event time.

    Keys are compared as strings (both sides cast once in a projection so
    the shuffle hashes identical values).  An event matching several links
    is repeated once per link; an event matching none keeps NULL link
    columns.  Output: the event columns then the link columns (the link key
    included).
    """
    ev = events.withColumn("_ek", F.col(event_key).cast("string"))
    ev = ev.withColumn("_eh", spread_key(ev, ["_ek"]))
    ln = links.withColumn("_lk", F.col(link_key).cast("string"))
    ln = ln.withColumn("_lh", F.xxhash64("_lk"))
    # The hash pair is implied by the key equality; it only spreads events
    # without a key (which cannot match) over reducers.
    cond = ((F.col("_ek") == F.col("_lk")) & (F.col("_eh") == F.col("_lh"))
            & (F.col(time_col) < F.col(bound_col)))
    out = ev.join(ln, cond, "left")
    return out.select(*events.columns, *links.columns)


def join_back(rows: DataFrame, per_key: DataFrame, key: str) -> DataFrame:
    """Left-join a per-key aggregate back onto rows; NULL keys match NULL
    (a window partitions NULL keys together, so their aggregate applies)."""
    # The hash, implied by the key, gives the join a shuffle of its own, so AQE
    # can split a hot (or NULL) key.
    agg = per_key.withColumn("_jb_hash", F.xxhash64(key)).withColumnRenamed(key, "_jb_key")
    keyed = rows.withColumn("_row_hash", F.xxhash64(key))
    out = keyed.join(agg, F.col(key).eqNullSafe(F.col("_jb_key"))
                     & (F.col("_row_hash") == F.col("_jb_hash")), "left")
    return out.drop("_jb_key", "_jb_hash", "_row_hash")


def _day_start(day: str, plus_days: int = 0):
    d = _dt.date.fromisoformat(day) + _dt.timedelta(days=plus_days)
    return F.lit(d.isoformat() + " 00:00:00").cast("timestamp_ntz")


def _distinct_first_session(session_facts: DataFrame, user_col: str, date_col: str) -> DataFrame:
    return session_facts.select(F.col(user_col).alias("_f_user"),
                                F.col(date_col).alias("_f_first")).distinct()


@dataclass(frozen=True)
class IdentityRoutes:
    """The identities of accounts, route by route (C10, J10): rows add up instead of multiplying.

    An account with i app ids, e e-mails, k contact keys that u web users came by, and d users
    by the query string has i + e + u + d rows here, and i * e * u * d in ``product``.

    accounts        primary_account_id, acs_reference_date_created, acs_contact_key_created_date,
                    buy_now_user_first_session_date, buy_now_user_last_session_date: one row each
    app_ids         primary_account_id, acs_user_id, buy_now_user_id, first_session
    emails          primary_account_id, acs_email
    contact_users   primary_account_id, acs_contact_key, contact_key_user_id, contact_key_user_first_session
    account_users   primary_account_id, account_id_user, account_id_user_first_session

    All are distinct, hold only accounts with an app id, and may hold a NULL account, whose
    rows no other route can join.
    """

    accounts: DataFrame
    app_ids: DataFrame
    emails: DataFrame
    contact_users: DataFrame
    account_users: DataFrame

    def long(self) -> DataFrame:
        """One row per account, route and web user: primary_account_id, route, via (the app id, contact
        key or NULL), web_user_id, first_session."""
        def route(df: DataFrame, name: str, via: Column, user: str, first: str) -> DataFrame:
            return (df.where(F.col(user).isNotNull())
                    .select("primary_account_id", F.lit(name).alias("route"), via.cast("string").alias("via"),
                            F.col(user).cast("string").alias("web_user_id"), F.col(first).alias("first_session")).distinct())
        return (route(self.app_ids, "app_id", F.col("acs_user_id"), "buy_now_user_id", "first_session")
                .unionByName(route(self.contact_users, "contact_key", F.col("acs_contact_key"), "contact_key_user_id",
                                   "contact_key_user_first_session"))
                .unionByName(route(self.account_users, "account_id", F.lit(None), "account_id_user",
                                   "account_id_user_first_session")))

    def app_to_web(self) -> DataFrame:
        """What the app model reads of the product: primary_account_id, account_id_user, acs_user_id,
        account_id_user_first_session; i * d rows an account."""
        ids = self.app_ids.select("primary_account_id", "acs_user_id").distinct()
        return (join_per_key(ids, self.account_users, "primary_account_id")
                .select("primary_account_id", "account_id_user", "acs_user_id", "account_id_user_first_session"))

    def product(self) -> DataFrame:
        """Every combination of an account's identities, as chained left joins give it.

        Each join has a shuffle of its own, so AQE can split a hot account.
        """
        ids = self.app_ids.drop("first_session").distinct()
        rows = join_back(ids, self.accounts.drop("buy_now_user_last_session_date"), "primary_account_id")
        for route in (self.emails, self.contact_users, self.account_users):
            rows = join_per_key(rows, route, "primary_account_id")
        return rows.select(
            "primary_account_id", "acs_reference_date_created", "acs_user_id", "acs_email",
            "acs_contact_key", "acs_contact_key_created_date", "buy_now_user_id",
            "buy_now_user_first_session_date", "contact_key_user_id", "contact_key_user_first_session",
            "account_id_user", "account_id_user_first_session")


def last_value(value: str) -> Column:
    """W5 as an aggregate: NULL if any row of the group is NULL (NULLs sort last), else the maximum."""
    return F.when(F.count(F.lit(1)) == F.count(F.col(value)), F.max(F.col(value)))


def identity_routes(id_history: DataFrame, contact_keys: DataFrame, emails: DataFrame,
                    app_web_lookup: DataFrame, session_facts: DataFrame, page_views: DataFrame, *,
                    min_created: str = "2023-01-01", min_page_view_date: str = "2022-01-01",
                    contact_source: str = "sfmc", account_param: str = "accountId=",
                    plan_path_like: str = "%/custom-smile-plan-3d%") -> IdentityRoutes:
    """The web identities of app accounts by three routes.

    1. app id -> app-to-web lookup -> web user (``buy_now_user_*``);
    2. the account's contact key used as ``utm_term`` on page views from the
       e-mail source (``contact_key_user_*``);
    3. the account id carried in the page-view query string
       (``account_id_user*``).
    """
    # -- app ids created on/after min_created, with the account's first creation time.
    # (date(t) >= D is t >= D 00:00: a bound on the raw column reaches the scan.)
    hist = id_history.where(F.col("date_created") >= _day_start(min_created))
    acs = hist.select("primary_account_id", F.col("primary_reference_number").alias("acs_user_id")).distinct()
    known = acs.where(F.col("primary_account_id").isNotNull()).select("primary_account_id").distinct()
    opened = hist.groupBy("primary_account_id").agg(F.min("date_created").alias("acs_reference_date_created"))

    def of_known(rows: DataFrame) -> DataFrame:
        return join_per_key(rows, known, "primary_account_id", "inner").select(*rows.columns)

    # -- the contact key's first date, a minimum over the account's contact keys alone.
    keyed = (contact_keys.where(F.col("primary_account_id").isNotNull()).groupBy("primary_account_id")
             .agg(F.min("date_created").alias("acs_contact_key_created_date")))
    mail = of_known(emails.select("primary_account_id", F.col("reference_number").alias("acs_email")).distinct())

    # -- route 1: app id -> web user, with that user's first web session.
    facts = _distinct_first_session(session_facts, "user_id", "first_session_date")
    lookup = app_web_lookup.select(F.col("app_user_id").alias("acs_user_id"),
                                   F.col("web_user_id").alias("buy_now_user_id")).distinct()
    app_ids = (join_per_key(join_per_key(acs, lookup, "acs_user_id"),
                            facts.withColumnRenamed("_f_user", "buy_now_user_id"), "buy_now_user_id")
               .select("primary_account_id", "acs_user_id", "buy_now_user_id", F.col("_f_first").alias("first_session")))
    visited = app_ids.groupBy("primary_account_id").agg(
        F.min("first_session").alias("buy_now_user_first_session_date"),
        last_value("first_session").alias("buy_now_user_last_session_date"))
    accounts = join_back(join_back(opened, keyed, "primary_account_id"), visited, "primary_account_id")

    # -- route 2: contact key as utm_term on e-mail page views.
    pv2 = page_views.where((F.col("utm_source") == contact_source) & F.col("utm_term").isNotNull()
                           & (F.col("session_time") >= _day_start(min_page_view_date, 1)))
    by_term = (join_per_key(pv2.select("user_id", "utm_term").distinct(), facts.withColumnRenamed("_f_user", "user_id"),
                            "user_id")
               .select(F.col("user_id").cast("string").alias("contact_key_user_id"),
                       F.col("utm_term").alias("acs_contact_key"),
                       F.col("_f_first").alias("contact_key_user_first_session"))
               .distinct())
    keys = of_known(contact_keys.select("primary_account_id", F.col("reference_number").alias("acs_contact_key")).distinct())
    contact_users = (join_per_key(keys, by_term, "acs_contact_key")
                     .select("primary_account_id", "acs_contact_key", "contact_key_user_id", "contact_key_user_first_session"))

    # -- route 3: the account id parameter in the page-view query.
    pv3 = page_views.where(F.col("path").like(plan_path_like))
    direct = (join_per_key(pv3.select("user_id", url_param("query", account_param).alias("primary_account_id")).distinct(),
                           facts.withColumnRenamed("_f_user", "user_id"), "user_id")
              .select("primary_account_id", F.col("user_id").cast("string").alias("account_id_user"),
                      F.col("_f_first").alias("account_id_user_first_session"))
              .distinct())
    return IdentityRoutes(accounts, app_ids, mail, contact_users, of_known(direct))


def link_identities(*tables: DataFrame, **options: str) -> DataFrame:
    """C10 as one table: every web identity linked to each app account (``identity_routes``, multiplied out).

    All joins are left joins, so every account row survives; rows multiply across routes exactly as
    the chained joins do (no final dedup).
    """
    return identity_routes(*tables, **options).product()
