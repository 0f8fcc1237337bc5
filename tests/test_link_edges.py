"""Linking model on inline edge tables: shaped Spark operator vs the literal
window + DISTINCT SQL in DuckDB over the very same rows."""

import datetime as dt

from inline_tables import register
from oracle_compare import compare
from sessionlens.operators.identity import identity_routes, link_identities
from sessionlens.plans.oracle import LINK_SELECT, ROUTES_SELECT, VISITS_SELECT, link_identities_body, with_ctes


def ts(s):
    return None if s is None else dt.datetime.fromisoformat(s)


TABLES = {
    "id_history": (["primary_account_id", "date_created", "primary_reference_number"], [
        ("A", ts("2023-02-01 10:00:00"), "app-1"),
        ("A", ts("2023-01-15 09:00:00"), "app-1"),      # earlier duplicate id
        ("A", ts("2022-12-31 23:59:59"), "app-old"),    # before the bound: dropped
        ("B", ts("2023-03-01 00:00:00"), "app-2"),
        (None, ts("2023-04-01 00:00:00"), "app-3"),     # NULL account
        (None, ts("2023-05-01 00:00:00"), "app-4"),
        ("C", ts("2023-06-01 00:00:00"), None),         # NULL id
    ]),
    "primary_accounts": (["primary_account_id"], [("A",), ("B",), ("A",)]),
    "contact_keys": (["primary_account_id", "reference_number", "date_created"], [
        ("A", "ck-1", ts("2023-03-01 00:00:00")),
        ("A", "ck-2", None),                             # NULL date sorts last
        ("B", "ck-3", None),
    ]),
    "emails": (["primary_account_id", "reference_number"], [("A", "e-1"), ("A", "e-2"), ("C", "e-3")]),
    "app_web_lookup": (["app_user_id", "web_user_id"], [
        ("app-1", "w-1"), ("app-1", "w-2"), ("app-3", "w-3"), ("app-4", "w-4")]),
    "web_session_facts": (["user_id", "session_start_time", "first_session_date"], [
        ("w-1", ts("2024-01-01 00:00:00"), ts("2024-01-01 00:00:00")),
        ("w-1", ts("2024-01-02 00:00:00"), ts("2024-01-01 00:00:00")),
        ("w-2", ts("2024-01-03 00:00:00"), ts("2023-12-01 00:00:00")),
        ("w-3", ts("2024-01-04 00:00:00"), ts("2024-01-04 00:00:00")),
        ("w-4", ts("2024-01-05 00:00:00"), None),
        ("w-9", ts("2024-01-06 00:00:00"), ts("2024-01-06 00:00:00")),
    ]),
    "page_views": (["user_id", "utm_source", "utm_term", "session_time", "query", "path"], [
        ("w-9", "sfmc", "ck-1", ts("2024-01-06 00:00:00"), None, "/x"),
        ("w-9", "sfmc", "ck-1", ts("2022-01-01 12:00:00"), None, "/x"),   # not after 2022-01-01
        ("w-8", "sfmc", "ck-2", ts("2024-01-06 00:00:00"), None, "/x"),
        ("w-7", "other", "ck-1", ts("2024-01-06 00:00:00"), None, "/x"),
        ("w-9", "app", None, ts("2024-01-06 00:00:00"), "a=1&accountId=A&z", "/en/custom-smile-plan-3d/"),
        ("w-8", "app", None, ts("2024-01-06 00:00:00"), "accountId=A%26q", "/custom-smile-plan-3d"),
        ("w-7", "app", None, ts("2024-01-06 00:00:00"), "accountId=B", "/custom-smile-plan-3d/x"),
        ("w-6", "app", None, ts("2024-01-06 00:00:00"), "accountId=", "/custom-smile-plan-3d/x"),
        ("w-5", "app", None, ts("2024-01-06 00:00:00"), "nothing", "/custom-smile-plan-3d/x"),
    ]),
}


TS_COLS = {"date_created", "session_start_time", "first_session_date", "session_time"}


def test_link_identities_edges_match_literal_sql(spark):
    con, frames = register(spark, {
        name: ([(c, "timestamp_ntz" if c in TS_COLS else "string") for c in cols], rows)
        for name, (cols, rows) in TABLES.items()})
    got = link_identities(frames["id_history"], frames["contact_keys"], frames["emails"],
                          frames["app_web_lookup"], frames["web_session_facts"], frames["page_views"])
    problems, n = compare(got, con, with_ctes(link_identities_body()) + LINK_SELECT)
    assert not problems, problems
    assert n > 0
    rows = got.collect()
    # The NULL account keeps its own earliest creation time (a window over
    # the NULL partition), so the shaped join-back must be NULL-safe.
    null_rows = [r for r in rows if r["primary_account_id"] is None]
    assert null_rows and {r["acs_reference_date_created"] for r in null_rows} == {ts("2023-04-01 00:00:00")}


def _frames(spark):
    con, frames = register(spark, {
        name: ([(c, "timestamp_ntz" if c in TS_COLS else "string") for c in cols], rows)
        for name, (cols, rows) in TABLES.items()})
    return con, [frames[n] for n in ("id_history", "contact_keys", "emails", "app_web_lookup", "web_session_facts", "page_views")]


def test_routes_first_and_last_visits_match_sql(spark):
    con, tables = _frames(spark)
    routes = identity_routes(*tables)
    for got, sql in ((routes.long(), ROUTES_SELECT),
                     (routes.accounts.select("primary_account_id", "buy_now_user_first_session_date",
                                             "buy_now_user_last_session_date"), VISITS_SELECT)):
        problems, n = compare(got, con, with_ctes(link_identities_body()) + sql)
        assert not problems and n > 0, problems
    last = {r["primary_account_id"]: r["buy_now_user_last_session_date"] for r in routes.accounts.collect()}
    assert last["A"] == ts("2024-01-01 00:00:00") and last[None] is None and last["B"] is None


def test_app_model_links_equal_those_of_the_product(spark):
    from sessionlens.plans.models import simplified_links
    _, tables = _frames(spark)
    routes = identity_routes(*tables)
    a, b = simplified_links(routes.app_to_web()), simplified_links(routes.product())
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and not a.isEmpty()


def test_hot_account_without_its_product(spark):
    """1,000 users by each of three routes: 3,000 rows of routes, where the product has a thousand million."""
    at = ts("2024-01-06 00:00:00")
    n = range(1000)
    tables = [spark.createDataFrame(rows, schema) for rows, schema in (
        ([("H", at, f"app-{i}") for i in n], "primary_account_id string, date_created timestamp_ntz, primary_reference_number string"),
        ([("H", "ck", at)], "primary_account_id string, reference_number string, date_created timestamp_ntz"),
        ([("H", f"e-{i}") for i in range(20)], "primary_account_id string, reference_number string"),
        ([(f"app-{i}", f"w-{i}") for i in n], "app_user_id string, web_user_id string"),
        ([(f"w-{i}", at, at) for i in n], "user_id string, session_start_time timestamp_ntz, first_session_date timestamp_ntz"),
        ([(f"t-{i}", "sfmc", "ck", at, None, "/x") for i in n]
         + [(f"d-{i}", "app", None, at, "accountId=H", "/custom-smile-plan-3d") for i in n],
         "user_id string, utm_source string, utm_term string, session_time timestamp_ntz, query string, path string"))]
    counts = {r["route"]: r["count"] for r in identity_routes(*tables).long().groupBy("route").count().collect()}
    assert counts == {"app_id": 1000, "contact_key": 1000, "account_id": 1000}
