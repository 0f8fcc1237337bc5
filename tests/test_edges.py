"""Edge rows the driver data cannot produce (FIXTURES.md part C)."""

import datetime as dt
import itertools

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlens.functions.columns import surrogate_key, url_param
from sessionlens.operators.classify import campaign_intent, classify_columns
from sessionlens.operators.funnel import (
    exclusive_attribution, funnel_flags, gate_funnel, happened_before,
)
from sessionlens.operators.identity import bounded_identity_join
from sessionlens.operators.milestones import milestone_durations, milestones
from sessionlens.operators.outcomes import outcomes_after, research_measures
from sessionlens.operators.sessions import session_base
from sessionlens.plans import app_config as A
from sessionlens.plans import models as M
from sessionlens.plans import site_config as S

TS = T.TimestampNTZType()


def ts(s):
    return dt.datetime.fromisoformat(s) if s else None


EV_SCHEMA = T.StructType([
    T.StructField("session_id", T.StringType()), T.StructField("event_time", TS),
    T.StructField("event_table_name", T.StringType()), T.StructField("link", TS)])


def events(spark, rows):
    return spark.createDataFrame([(s, ts(t), n, ts(l)) for s, t, n, l in rows], EV_SCHEMA)


def test_last_event_name_tie_breaks_by_name(spark):
    df = events(spark, [("s", "2024-01-01 10:00:00", "b", None),
                        ("s", "2024-01-01 10:00:00", "a", None)])
    out = milestones(df, [("last_event_name", "last_name", [])]).first()
    assert out["last_event_name"] == "b"


def test_null_time_ignored_by_milestones_but_last_in_order(spark):
    df = events(spark, [("s", "2024-01-01 10:00:00", "general_app_ios_view_onboarding", None),
                        ("s", None, "general_app_ios_view_onboarding", None),
                        ("s", None, "zzz_not_last_by_name_only", None)])
    spec = [("first_start_user_onboarding", "first", ["general_app_ios_view_onboarding"]),
            ("last_event_name", "last_name", [])]
    out = milestones(df, spec).first()
    assert out["first_start_user_onboarding"] == ts("2024-01-01 10:00:00")
    # NULL times sort last, so a NULL-time row is the last event.
    assert out["last_event_name"] == "zzz_not_last_by_name_only"


def test_linked_csp_view_falls_back_to_link_time(spark):
    contact = A.CONTACT_INFO_EVENTS[0]
    df = events(spark, [("s", None, contact, "2024-02-01 00:00:00"),
                        ("s", "2024-01-05 00:00:00", contact, "2024-02-01 00:00:00"),
                        ("t", None, contact, "2024-03-01 00:00:00")])
    spec = [("first_viewed_CSP_time", "csp_first", A.CSP_VIEW_EVENTS),
            ("last_viewed_CSP_time", "csp_last", A.CSP_VIEW_EVENTS)]
    rows = {r["session_id"]: r for r in milestones(df, spec, link_time_col="link",
                                                   linked_events=A.CONTACT_INFO_EVENTS).collect()}
    assert rows["s"]["first_viewed_CSP_time"] == ts("2024-01-05 00:00:00")
    assert rows["s"]["last_viewed_CSP_time"] == ts("2024-02-01 00:00:00")
    assert rows["t"]["first_viewed_CSP_time"] == ts("2024-03-01 00:00:00")


def test_boundary_seconds_and_invalid_scan_end(spark):
    schema = T.StructType([T.StructField(c, TS) for c in [
        "first_CSP_view_event", "last_CSP_interaction_event", "first_3ds_end_time_temp",
        "first_3ds_start_time", "first_android_back_alert_end"]])
    df = spark.createDataFrame([
        (ts("2024-01-01 00:00:00.900000"), ts("2024-01-01 00:00:01.100000"),
         ts("2024-01-01 09:00:00"), ts("2024-01-01 10:00:00"), None),
        (None, None, ts("2024-01-01 11:00:00"), ts("2024-01-01 10:00:00"), ts("2024-01-01 10:30:00")),
        (None, None, ts("2024-01-01 11:00:00"), ts("2024-01-01 10:00:00"), None),
    ], schema)
    out = milestone_durations(df, [("mins", "first_CSP_view_event", ["last_CSP_interaction_event"])],
                              valid_after=A.SCAN_END).collect()
    assert out[0]["mins"] == 1 / 60  # one second boundary crossed, not 0
    assert out[0]["first_3ds_end_time"] is None  # end before start
    assert out[1]["first_3ds_end_time"] is None  # back alert fired
    assert out[2]["first_3ds_end_time"] == ts("2024-01-01 11:00:00")


def test_session_base_keeps_view_times_and_null_key_parts(spark):
    s = spark.createDataFrame(
        [(1, 10, ts("2024-01-01 00:00:00"), "lib", "ios", "m", "US", "r", "c", "ip"),
         (None, 11, ts("2024-01-01 00:00:00"), "lib", "ios", "m", "US", "r", "c", "ip")],
        "user_id bigint, session_id bigint, session_start_time timestamp_ntz, library string, "
        "platform string, device_type string, country string, region string, city string, ip string")
    e = spark.createDataFrame(
        [(1, 10, ts("2024-01-01 00:01:00"), A.APP_VIEW_EVENTS[0]),
         (1, 10, ts("2024-01-01 00:02:00"), A.APP_VIEW_EVENTS[1]),
         (1, 10, ts("2024-01-01 00:03:00"), "not_a_view")],
        "user_id bigint, session_id bigint, time timestamp_ntz, event_table_name string")
    out = session_base(s, e, A.APP_VIEW_EVENTS).collect()
    assert len(out) == 2 and len({r["distinct_session_id"] for r in out}) == 1
    one = session_base(s, e, A.APP_VIEW_EVENTS, one_row_per_session=True).collect()
    assert [r["time"] for r in one] == [ts("2024-01-01 00:01:00")]
    key = spark.range(1).select(surrogate_key(F.lit(10), F.lit(None).cast("bigint"),
                                              F.lit("x")).alias("k")).first()["k"]
    import hashlib
    assert key == hashlib.md5(b"10--x").hexdigest()


def test_like_underscore_is_a_wildcard(spark):
    df = spark.createDataFrame([("general_appXios_tap",), ("general_app_ios_tap",), ("other",)],
                               "event_table_name string")
    kept = {r[0] for r in M.app_event_filter(df).collect()}
    assert kept == {"general_appXios_tap", "general_app_ios_tap"}


def test_portal_before_evaluation(spark):
    portal, evals = S.PORTAL[1], S.PORTAL[2]
    df = spark.createDataFrame([
        ("no_eval", ts("2024-01-01 10:00:00"), portal),
        ("tie", ts("2024-01-01 10:00:00"), portal), ("tie", ts("2024-01-01 10:00:00"), evals[0]),
        ("later", ts("2024-01-01 11:00:00"), portal), ("later", ts("2024-01-01 10:00:00"), evals[1]),
        ("no_portal", ts("2024-01-01 10:00:00"), evals[0]),
    ], "session_id string, time timestamp_ntz, event_table_name string")
    got = {r[0]: r[1] for r in happened_before(df, [portal], evals, out_col="p").collect()}
    assert got == {"no_eval": 1, "tie": 1, "later": 0}


def _d1_row(**flags):
    names = [n for n, _, _ in S.SITE_STEPS] + [S.PORTAL[0]]
    return tuple(flags.get(n, 0) for n in names), names


def test_gates_read_ungated_inputs(spark):
    row, names = _d1_row(scan_book_page=1, ik_product_page=1, ik_thanks_page=1)
    df = spark.createDataFrame([row], names)
    out = gate_funnel(df, S.GATES).first()
    assert out["ik_product_page"] == 0
    assert out["ik_thanks_page_temp"] == 1  # reads the raw ik_product_page


def _attribution(c, l, s, bypass_prod, bypass_order, ik_tmp):
    """Truth table of the booking attribution, written from its definition."""
    scan = int(c == 1 and s == 0 and l == 0)
    loc = int(c == 0 and s == 0 and l == 1)
    return {
        "scan_complete_page": scan,
        "scan_locations_complete_page": loc,
        "single_scan_location_complete_page": int(c == 0 and s == 1 and l == 0),
        "scan_location_complete_after_checkout_page": int(s == 1 and c == 1 and l == 0),
        "scan_location_complete_after_shops_page": int(s == 1 and l == 1 and c == 0),
        "bypass_sa_order_page": int(l == 0 and bypass_prod == 1),
        "non_by_pass_scan_completion": int((bypass_prod == 0 and c == 1) or scan == 1 or loc == 1),
        "ik_thanks_page": int(bypass_order == 0 and ik_tmp == 1),
    }


def test_attribution_exhaustive(spark):
    rows = list(itertools.product([0, 1], repeat=6))
    cols = ["scan_complete_page_temp", "scan_locations_complete_page_temp",
            "scan_single_location_complete_page_temp", "bypass_scan_complete_page_temp",
            "bypass_sa_order_page_temp", "ik_thanks_page_temp"]
    df = spark.createDataFrame(rows, cols).withColumns(
        {"any_scan_complete_page": F.lit(0), "view_web_csp": F.lit(0)})
    out = exclusive_attribution(df, S.ATTRIBUTION).collect()
    assert len(out) == 64
    for r in out:
        want = _attribution(r[cols[0]], r[cols[1]], r[cols[2]], r[cols[3]], r[cols[4]], r[cols[5]])
        for k, v in want.items():
            assert r[k] == v, (k, r)
        if r[cols[0]] == 1 and r[cols[1]] == 1:  # c = l = 1: unattributed booking
            assert sum(r[k] for k in list(want)[:5]) == 0


def _classify(spark, rows):
    schema = ("row_id int, utm_source string, utm_campaign string, utm_medium string, utm_term string, "
              "referrer string, landing_page string")
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)
    df = campaign_intent(df, df, S.RETARGETING_CAMPAIGNS)
    out = classify_columns(df, {"channel": (S.CHANNEL_RULES, S.CHANNEL_DEFAULT)})
    return [r["channel"] for r in out.orderBy("row_id").collect()]


def test_channel_rule_order_and_null_traps(spark):
    got = _classify(spark, [
        ("google", None, "cpc", None, None, None),
        ("google", None, "organic", None, None, None),
        ("google", "x-non-branded", None, None, None, None),
        ("google", "spring", None, None, None, None),
        (None, None, None, None, None, "website.com/"),
        (None, None, None, None, "https://x/?a%3demail", None),
    ])
    assert got == ["Google Paid Search - Non-Branded", "Other", "Google Paid Search - Branded",
                   "Google Paid Search - Non-Branded", "Direct Load - Homepage", "Other"]


def test_mixed_case_campaign_gets_no_intention(spark):
    sess = spark.createDataFrame([("rtg",), ("retargeting",)], "utm_campaign string")
    raw = spark.createDataFrame([("rtg",), ("Retargeting",)], "utm_campaign string")
    got = {r[0]: r[1] for r in campaign_intent(sess, raw, S.RETARGETING_CAMPAIGNS).collect()}
    assert got == {"rtg": "retargeting", "retargeting": None}


def test_url_param_cases(spark):
    rows = [("a=1&accountId=12%3&x",), ("accountId=9%26a",), ("accountId=",), ("nothing",),
            (None,), ("accountId=1&accountId=2",)]
    df = spark.createDataFrame(rows, "q string")
    got = [r[0] for r in df.select(url_param("q", "accountId=")).collect()]
    assert got == ["12%3", "9", "", None, None, "1"]


def test_link_requires_strictly_later_first_session(spark):
    ev = spark.createDataFrame([(7, ts("2024-01-10 00:00:00"))], "user_id bigint, time timestamp_ntz")
    links = spark.createDataFrame([("7", ts("2024-01-10 00:00:00")), ("7", ts("2024-01-11 00:00:00"))],
                                  "app_id string, first_session timestamp_ntz")
    out = bounded_identity_join(ev, links, event_key="user_id", link_key="app_id",
                                time_col="time", bound_col="first_session").collect()
    assert [r["first_session"] for r in out] == [ts("2024-01-11 00:00:00")]


def test_outcomes_with_missing_null_and_repeated_interventions(spark):
    acc = spark.createDataFrame([(1, 10), (1, 11), (2, 20), (3, 30), (None, 40)],
                                "main_company_identifier bigint, account_id bigint")
    opp = spark.createDataFrame([
        (10, ts("2020-01-10 00:00:00"), True, "Renewal"),
        (11, ts("2020-01-01 00:00:00"), False, "New"),
        (20, ts("2020-06-01 00:00:00"), True, "New Logo"),
        (40, ts("2020-06-01 00:00:00"), True, "New")],
        "account_id bigint, close_date timestamp_ntz, is_opp_won boolean, type string")
    res = spark.createDataFrame([
        (1, dt.date(2020, 1, 5)), (1, dt.date(2020, 1, 1)),   # repeated: counts twice
        (2, None)],                                           # NULL date: zeros
        "main_company_identifier bigint, deck_presented_date date")
    out = {r[0]: tuple(r[1:]) for r in outcomes_after(acc, opp, res, research_measures()).collect()}
    assert out[1] == (3, 2, 1, 2, 0)
    assert out[2] == (0, 0, 0, 0, 0)
    assert out[3] == (0, 0, 0, 0, 0)
    assert out[None] == (0, 0, 0, 0, 0)


def test_funnel_flags_user_vs_any_on_null_user(spark):
    sess = spark.createDataFrame([("a", None), ("a", 5)], "session_id string, user_id bigint")
    ev = spark.createDataFrame([("a", "x")], "session_id string, event_table_name string")
    steps = [("u", "user", ["x"]), ("r", "any", ["x"])]
    out = {r["user_id"]: (r["u"], r["r"]) for r in funnel_flags(sess, ev, steps).collect()}
    assert out == {None: (0, 1), 5: (1, 1)}


def test_more_steps_than_one_mask_word(spark):
    # 70 steps span two 62-bit words; each step fires on its own event name.
    steps = [(f"s{i}", "any", [f"e{i}"]) for i in range(70)]
    rows = [("a", f"e{i}") for i in range(0, 70, 3)] + [("b", "e69"), ("b", "e61"), ("b", "e62"), ("c", "zzz")]
    ev = spark.createDataFrame(rows, "session_id string, event_table_name string")
    sess = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "session_id string")
    out = {r["session_id"]: r for r in funnel_flags(sess, ev, steps).collect()}
    for sid in "abcd":
        fired = {e for s, e in rows if s == sid}
        assert [out[sid][f"s{i}"] for i in range(70)] == [int(f"e{i}" in fired) for i in range(70)], sid


def test_last_event_name_of_rows_without_a_key(spark):
    df = events(spark, [(None, "2024-01-01", "a", None), ("s", "2024-01-01", "b", None), ("s", None, "c", None)])
    specs = [("first_a", "first", ["a"]), ("last_event_name", "last_name", [])]
    got = {r["session_id"]: (r["first_a"], r["last_event_name"]) for r in milestones(df, specs).collect()}
    assert got == {None: (ts("2024-01-01"), "a"), "s": (None, "c")}


def test_session_base_with_other_keys(spark):
    sessions = spark.createDataFrame([("t1", "v1", "iOS"), ("t2", "v2", "web")], "tenant string, visit string, platform string")
    events = spark.createDataFrame([("t1", "v1", 5, "view"), ("t1", "v1", 5, "view"), ("t2", "v2", 6, "other")],
                                   "tenant string, visit string, time int, event_table_name string")
    out = session_base(sessions, events, ["view"], keys=("tenant", "visit"), session_cols=("platform",),
                       hashed=("visit", "tenant"))
    assert out.columns == ["tenant", "visit", "distinct_session_id", "time", "platform"]
    assert [(r["tenant"], r["visit"], r["time"], r["platform"]) for r in out.collect()] == [("t1", "v1", 5, "iOS")]


def test_spread_key_with_nested_maps(spark):
    from sessionlens.operators.joins import join_per_key
    rows = spark.sql("SELECT * FROM VALUES (CAST(NULL AS INT), array(map('a', 1))), (1, array(map('b', 2))) AS t(k, v)")
    names = spark.createDataFrame([(1, "one")], "k int, name string")
    got = sorted(((r["k"] or 0), r["name"] or "-") for r in join_per_key(rows, names, "k").collect())
    assert got == [(0, "-"), (1, "one")]


def test_url_param_of_a_very_long_query(spark):
    value = "x" * 3_000_000
    df = spark.createDataFrame([(f"a=1&k={value}",)], "q string")
    assert df.select(url_param("q", "k=").alias("v")).first()["v"] == value
