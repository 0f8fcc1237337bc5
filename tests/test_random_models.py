"""Seeded random inputs for the composed models, Spark vs the literal SQL.

Unlike the driver tables these inputs have NULL event times, NULL session
and user ids, dense sharing of session ids, repeated events and links on
the exact event time, so NULL ordering and tie handling are exercised on
every step, gate, milestone and attribution rule.
"""

import datetime as dt
import random

from inline_tables import register
from oracle_compare import compare
from sessionlens.plans import app_config as A
from sessionlens.plans import site_config as S
from sessionlens.plans.models import app_session_model, site_model
from sessionlens.plans.oracle import app_body, site_model_body, with_ctes
from sessionlens.sources import adapters as AD

T0 = dt.datetime(2024, 1, 1)


def _time(rnd, null_rate=0.05):
    if rnd.random() < null_rate:
        return None
    return T0 + dt.timedelta(seconds=rnd.randrange(0, 5 * 86400), microseconds=rnd.choice([0, 500000]))


def _site_inputs(seed):
    rnd = random.Random(seed)
    sessions = []
    for i in range(200):
        sid = rnd.choice([None] + list(range(25)))
        user = rnd.choice([None, None] + list(range(40)))
        start = T0 + dt.timedelta(seconds=rnd.randrange(0, 5 * 86400))
        labels = {name: rnd.choice(vocab) for name, vocab, _, _ in AD.WEB_SESSION_LABELS}
        row = {"distinct_session_id": f"d{i}", "session_id": sid, "user_id": user, "ip": "ip",
               "session_start_time": start, "first_session_date": start, **labels}
        sessions.append(tuple(row[c] for c in AD.WEB_SESSION_COLUMNS))
    vocab = S.site_vocabulary()
    events = [(rnd.choice([None] + list(range(25))), rnd.choice([None] + list(range(40))),
               _time(rnd), rnd.choice(vocab)) for _ in range(3000)]
    return sessions, events


def test_site_model_random(spark):
    for seed in (1, 2):
        sessions, events = _site_inputs(seed)
        types = {"session_id": "bigint", "user_id": "bigint", "session_start_time": "timestamp_ntz",
                 "first_session_date": "timestamp_ntz"}
        cols = [(c, types.get(c, "string")) for c in AD.WEB_SESSION_COLUMNS]
        ev_cols = [("session_id", "bigint"), ("user_id", "bigint"), ("time", "timestamp_ntz"),
                   ("event_table_name", "string")]
        con, frames = register(spark, {"web_sessions": (cols, sessions), "web_events": (ev_cols, events)})
        got = site_model(frames["web_sessions"], frames["web_events"])
        problems, n = compare(got, con, with_ctes(site_model_body()) + "\nSELECT * FROM site")
        assert not problems, (seed, problems)
        assert n > 50


def test_app_model_random(spark):
    rnd = random.Random(3)
    vocab = A.app_vocabulary()
    sessions = []
    for u in range(30):
        for s in range(3):
            start = T0 + dt.timedelta(days=s)
            sessions.append((u if u % 9 else None, u * 10 + s, start, "sdk", "iOS", "m", "US", "NA", "x", "ip"))
    events = []
    for _ in range(2500):
        u = rnd.randrange(30)
        s = rnd.randrange(3)
        t = _time(rnd, 0.05)
        events.append((u if u % 9 else None, u * 10 + s, t, rnd.choice(vocab)))
    links = []
    for u in range(0, 30, 2):
        first = T0 + dt.timedelta(seconds=rnd.randrange(0, 4 * 86400))
        links.append(("acct", f"web-{u}", str(u), first))
        if u % 4 == 0:
            links.append(("acct", f"web-{u}b", str(u), first + dt.timedelta(days=1)))
        if u % 6 == 0:  # a link starting exactly at an event time
            t = next((e[2] for e in events if e[0] == u and e[2] is not None), None)
            if t is not None:
                links.append(("acct", f"web-{u}c", str(u), t))
    account_map = [(str(u), f"acct-{u // 2}") for u in range(30)] + [("4", "acct-extra")]
    int_cols, ts_cols = {"user_id", "session_id"}, {"session_start_time", "time", "account_id_user_first_session"}

    def typed(cols):
        return [(c, "bigint" if c in int_cols else "timestamp_ntz" if c in ts_cols else "string") for c in cols]

    con, frames = register(spark, {
        "app_sessions": (typed(["user_id", "session_id", "session_start_time", "library", "platform",
                                "device_type", "country", "region", "city", "ip"]), sessions),
        "app_events": (typed(["user_id", "session_id", "time", "event_table_name"]), events),
        "app_to_web_links": (typed(["primary_account_id", "account_id_user", "acs_user_id",
                                    "account_id_user_first_session"]), links),
        "app_account_map": (typed(["reference_number", "primary_account_id"]), account_map),
    })
    got = app_session_model(frames["app_sessions"], frames["app_events"], frames["app_to_web_links"],
                            frames["app_account_map"])
    problems, n = compare(got, con, with_ctes(app_body()) + "\nSELECT * FROM app_visits")
    assert not problems, problems
    assert n > 50


def test_link_model_random(spark):
    from sessionlens.operators.identity import link_identities
    from sessionlens.plans.oracle import LINK_SELECT, link_identities_body
    rnd = random.Random(5)
    accts = [None, "A", "B", "C", "D"]

    def ts_or_null(lo_days, hi_days, null_rate=0.15):
        if rnd.random() < null_rate:
            return None
        return dt.datetime(2022, 6, 1) + dt.timedelta(days=rnd.randrange(lo_days, hi_days))

    tables = {
        "id_history": (["primary_account_id", "date_created", "primary_reference_number"],
                       [(rnd.choice(accts), ts_or_null(0, 900, 0.0), rnd.choice([None, "a1", "a2", "a3", "a4"]))
                        for _ in range(40)]),
        "primary_accounts": (["primary_account_id"], [(a,) for a in accts if a] * 2),
        "contact_keys": (["primary_account_id", "reference_number", "date_created"],
                         [(rnd.choice(accts), rnd.choice(["k1", "k2", "k3"]), ts_or_null(200, 900))
                          for _ in range(12)]),
        "emails": (["primary_account_id", "reference_number"],
                   [(rnd.choice(accts), rnd.choice(["e1", "e2"])) for _ in range(6)]),
        "app_web_lookup": (["app_user_id", "web_user_id"],
                           [(rnd.choice(["a1", "a2", "a3", "a5"]), rnd.choice(["w1", "w2", "w3"])) for _ in range(8)]),
        "web_session_facts": (["user_id", "session_start_time", "first_session_date"],
                              [(rnd.choice(["w1", "w2", "w3", "w4"]), ts_or_null(300, 900, 0.0), ts_or_null(300, 900))
                               for _ in range(15)]),
        "page_views": (["user_id", "utm_source", "utm_term", "session_time", "query", "path"],
                       [(rnd.choice(["w1", "w2", "w3", "w4", None]), rnd.choice(["sfmc", "app", None]),
                         rnd.choice(["k1", "k2", "k3", None]), ts_or_null(0, 900, 0.05),
                         rnd.choice([None, "accountId=A", "x=1&accountId=B&y", "accountId=C%26z", "accountId=",
                                     "accountId=D&accountId=A", "nothing"]),
                         rnd.choice(["/custom-smile-plan-3d/x", "/home", None]))
                        for _ in range(60)]),
    }
    ts_cols = {"date_created", "session_start_time", "first_session_date", "session_time"}
    con, frames = register(spark, {n: ([(c, "timestamp_ntz" if c in ts_cols else "string") for c in cols], rows)
                                   for n, (cols, rows) in tables.items()})
    got = link_identities(frames["id_history"], frames["contact_keys"], frames["emails"],
                          frames["app_web_lookup"], frames["web_session_facts"], frames["page_views"])
    problems, n = compare(got, con, with_ctes(link_identities_body()) + LINK_SELECT)
    assert not problems, problems
    assert n > 10


def test_outcomes_random(spark):
    from sessionlens.plans.models import research_effects
    from sessionlens.plans.oracle import RESEARCH_SELECT, research_body
    rnd = random.Random(6)
    accounts = [(rnd.choice([None, 1, 2, 3, 4]), rnd.randrange(12), "n", "t") for _ in range(20)]
    opps = [(rnd.choice([None] + list(range(12))), T0 + dt.timedelta(days=rnd.randrange(-30, 30))
             if rnd.random() > 0.1 else None, rnd.choice([True, False, None]),
             rnd.choice(["Renewal", "New", "New Logo", "Other", None])) for _ in range(150)]
    research = [(rnd.choice([None, 1, 2, 3, 5]), (T0 + dt.timedelta(days=rnd.randrange(-20, 20))).date()
                 if rnd.random() > 0.2 else None) for _ in range(10)]
    con, frames = register(spark, {
        "accounts": ([("main_company_identifier", "bigint"), ("account_id", "bigint"),
                      ("account_name", "string"), ("account_type", "string")], accounts),
        "opportunities": ([("account_id", "bigint"), ("close_date", "timestamp_ntz"),
                           ("is_opp_won", "boolean"), ("type", "string")], opps),
        "research_log": ([("main_company_identifier", "bigint"), ("deck_presented_date", "date")], research),
    })
    got = research_effects(frames["accounts"], frames["opportunities"], frames["research_log"])
    problems, n = compare(got, con, with_ctes(research_body()) + RESEARCH_SELECT)
    assert not problems, problems
