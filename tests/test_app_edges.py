"""App-session model on inline edge rows: shaped Spark model vs the literal
window + DISTINCT SQL in DuckDB over the very same rows."""

import datetime as dt

from inline_tables import register
from oracle_compare import compare
from sessionlens.plans import app_config as A
from sessionlens.plans.models import app_session_model
from sessionlens.plans.oracle import app_body, with_ctes


def ts(s):
    return None if s is None else dt.datetime.fromisoformat(s)


VIEW, ONBOARD, CONTACT = A.APP_VIEW_EVENTS[0], "general_app_ios_view_onboarding", A.CONTACT_INFO_EVENTS[0]
VIDEO, SKIP = "general_app_ios_view_smile_maker_video", "general_app_ios_tap_skip_smile_maker_video"
SHARE = A.CSP_SHARED_EVENTS[0]

SESSIONS = (["user_id", "session_id", "session_start_time", "library", "platform", "device_type", "country",
             "region", "city", "ip"], [
    (1, 10, ts("2024-01-01 09:00:00"), "sdk", "iOS", "m", "US", "NA", "x", "ip1"),
    (2, 20, ts("2024-01-02 09:00:00"), "sdk", "iOS", "m", "US", "NA", "x", "ip2"),
    (None, 30, ts("2024-01-03 09:00:00"), "sdk", None, "m", None, None, None, None),
])
EVENTS = (["user_id", "session_id", "time", "event_table_name"], [
    (1, 10, ts("2024-01-01 09:00:00.900000"), VIDEO),
    (1, 10, ts("2024-01-01 09:00:01.100000"), SKIP),        # one second boundary
    (1, 10, ts("2024-01-01 09:01:00"), VIEW),
    (1, 10, ts("2024-01-01 09:01:00"), ONBOARD),            # tie on time
    (1, 10, ts("2024-01-01 09:02:00"), CONTACT),            # linked: counts as a CSP view
    (1, 10, ts("2024-01-01 09:03:00"), SHARE),
    (1, 10, None, "general_app_ios_tap_opt_in"),           # NULL time: last event
    (1, 10, ts("2024-01-01 09:04:00"), "general_appxios_view_welcome_screen"),  # LIKE '_' trap
    (2, 20, ts("2024-01-02 09:00:00"), VIEW),
    (2, 20, ts("2024-01-02 10:00:00"), CONTACT),            # link starts exactly now: no link
    (2, 20, ts("2024-01-02 10:00:00"), "web_page_view"),    # not an app event
    (None, 30, ts("2024-01-03 09:00:00"), VIEW),
])
LINKS = (["primary_account_id", "account_id_user", "acs_user_id", "account_id_user_first_session"], [
    ("acct-0", "web-1", "1", ts("2024-01-05 00:00:00")),
    ("acct-0", "web-1b", "1", ts("2024-01-06 00:00:00")),   # second link: rows fan out
    ("acct-1", "web-2", "2", ts("2024-01-02 10:00:00")),
    ("acct-9", None, "9", ts("2024-01-02 10:00:00")),       # no web identity: ignored
])
ACCOUNT_MAP = (["reference_number", "primary_account_id"], [("1", "acct-0"), ("2", "acct-1"), ("2", "acct-1")])

TS_COLS = {"session_start_time", "time", "account_id_user_first_session"}
INT_COLS = {"user_id", "session_id"}


def _spark_type(c):
    return "timestamp_ntz" if c in TS_COLS else "bigint" if c in INT_COLS else "string"


def test_app_model_edges_match_literal_sql(spark):
    con, frames = register(spark, {
        name: ([(c, _spark_type(c)) for c in cols], rows)
        for name, (cols, rows) in {"app_sessions": SESSIONS, "app_events": EVENTS,
                                   "app_to_web_links": LINKS, "app_account_map": ACCOUNT_MAP}.items()})
    got = app_session_model(frames["app_sessions"], frames["app_events"], frames["app_to_web_links"],
                            frames["app_account_map"])
    problems, n = compare(got, con, with_ctes(app_body()) + "\nSELECT * FROM app_visits")
    assert not problems, problems
    rows = {r["session_id"]: r for r in got.collect()}
    s1 = rows[10]
    assert s1["last_event_name"] == "general_app_ios_tap_opt_in"
    assert s1["skip_smile_maker_video_time"] == 1 / 60
    assert s1["first_viewed_CSP_time"] == ts("2024-01-01 09:02:00")
    assert s1["event_count"] > 8  # events repeated once per later link
    assert rows[20]["first_viewed_CSP_time"] is None  # link not strictly later
    assert 30 not in rows  # a NULL user never matches its events


def test_a_session_id_shared_by_many_users_is_never_one_row(spark):
    sessions = [(u, 10, ts("2024-01-01 09:00:00"), "sdk", "iOS", "m", "US", "NA", "x", "ip") for u in range(300)]
    events = [(u, 10, ts("2024-01-01 09:01:00") + dt.timedelta(seconds=k), name) for u in range(300)
              for k, name in enumerate([VIEW, SHARE, SHARE][:1 + u % 3])]
    con, frames = register(spark, {
        name: ([(c, _spark_type(c)) for c in cols], rows)
        for name, (cols, rows) in {"app_sessions": (SESSIONS[0], sessions), "app_events": (EVENTS[0], events),
                                   "app_to_web_links": LINKS, "app_account_map": ACCOUNT_MAP}.items()})
    got = app_session_model(frames["app_sessions"], frames["app_events"], frames["app_to_web_links"],
                            frames["app_account_map"])
    problems, n = compare(got, con, with_ctes(app_body()) + "\nSELECT * FROM app_visits")
    assert not problems, problems
    assert n == 300
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "array" not in plan.lower()
