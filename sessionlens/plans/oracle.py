"""DuckDB oracle SQL: the adapters, and the models restated from their meaning.

Nothing here follows the shape of the Spark plans.  A session's events become
one list of names and flags are membership tests on it; first and last times
are filtered aggregates; optional matches are a union of what matches and what
has no match; pairs of dates are counted by scalar subqueries.  Rule tables,
step lists and gates are rendered from the configuration the Spark side uses.
"""


from __future__ import annotations

from collections.abc import Sequence

from sessionlens.functions.rules import classify_sql, sql_literal
from sessionlens.plans import app_config as A
from sessionlens.plans import site_config as S
from sessionlens.sources import adapters as AD


def sql_list(values: Sequence[str | None]) -> str:
    return ", ".join(sql_literal(v) for v in values)


def sql_pick(values: Sequence[str | None], index: str) -> str:
    return f"([{sql_list(values)}])[(({index}) % {len(values)}) + 1]"


def epoch_day(ts: str) -> str:
    return f"date_diff('day', DATE '1970-01-01', CAST({ts} AS DATE))"


def acct(user: str) -> str:
    return f"('acct-' || CAST(({user}) // 2 AS VARCHAR))"


# ------------------------------------------------------------ adapters

def web_adapters_sql() -> str:
    labels = ",\n    ".join(
        f"{sql_pick(vocab, f'seed * {mult} + {off}')} AS {name}"
        for name, vocab, mult, off in AD.WEB_SESSION_LABELS)
    return f"""
web_keyed AS (
  SELECT event_id, ts, user_id,
         {epoch_day('ts')} * {AD.WEB_SESSION_SLOTS} + (user_id % {AD.WEB_SESSION_SLOTS}) AS session_id,
         CASE WHEN user_id % 10 = {AD.ANONYMOUS_DIGIT} THEN NULL ELSE user_id END AS web_user_id
  FROM events),
web_events AS (
  SELECT session_id, web_user_id AS user_id, ts AS time,
         {sql_pick(S.site_vocabulary(), 'event_id * 13 + user_id')} AS event_table_name
  FROM web_keyed),
web_sess0 AS (
  SELECT session_id, web_user_id AS user_id, min(ts) AS session_start_time
  FROM web_keyed GROUP BY 1, 2),
web_first AS (
  SELECT user_id, min(session_start_time) AS user_first_session
  FROM web_sess0 WHERE user_id IS NOT NULL GROUP BY 1),
web_sess1 AS (
  SELECT s.*, f.user_first_session,
         s.session_id * 7 + minute(s.session_start_time) * 60 + second(s.session_start_time) AS seed
  FROM web_sess0 s LEFT JOIN web_first f ON s.user_id = f.user_id),
web_sessions AS (
  SELECT md5(coalesce(CAST(session_id AS VARCHAR), '') || '-' || coalesce(CAST(user_id AS VARCHAR), '')
             || '-' || coalesce(CAST(session_start_time AS VARCHAR), '')) AS distinct_session_id,
    session_id, user_id, '10.0.' || CAST(seed % 256 AS VARCHAR) || '.1' AS ip,
    session_start_time,
    coalesce(user_first_session, session_start_time) AS first_session_date,
    {labels}
  FROM web_sess1)"""


def app_adapters_sql() -> str:
    return f"""
app_keyed AS (
  SELECT event_id, ts, user_id, event_type,
         user_id * 100000 + CAST(floor({epoch_day('ts')} / {AD.APP_SESSION_DAYS}) AS BIGINT) AS session_id
  FROM events),
app_events AS (
  SELECT user_id, session_id, ts AS time,
         {sql_pick(A.app_vocabulary(), 'event_id * 17 + user_id')} AS event_table_name
  FROM app_keyed),
app_geo AS (
  SELECT c.c_custkey AS user_id, n.n_name AS country, r.r_name AS region, c.c_mktsegment AS city
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
app_sessions AS (
  SELECT s.user_id, s.session_id, s.session_start_time, 'app-sdk' AS library,
         {sql_pick(['iOS', 'Android'], 's.user_id')} AS platform,
         {sql_pick(AD.DEVICES, 's.session_id')} AS device_type,
         g.country, g.region, g.city,
         '10.1.' || CAST(s.user_id % 256 AS VARCHAR) || '.1' AS ip
  FROM (SELECT user_id, session_id, min(ts) AS session_start_time FROM app_keyed GROUP BY 1, 2) s
  LEFT JOIN app_geo g ON s.user_id = g.user_id),
app_account_map AS (
  SELECT CAST(c_custkey AS VARCHAR) AS reference_number, {acct('c_custkey')} AS primary_account_id
  FROM customer),
app_to_web_links AS (
  SELECT {acct('u.user_id')} AS primary_account_id,
         CASE WHEN u.first_ts IS NOT NULL THEN 'web-' || CAST(u.user_id AS VARCHAR) END AS account_id_user,
         CAST(u.user_id AS VARCHAR) AS acs_user_id,
         u.first_ts + to_days(CAST(o.days AS INTEGER)) AS account_id_user_first_session
  FROM (SELECT c_custkey AS user_id, c_mktsegment,
               CASE WHEN c_acctbal >= 0 THEN (SELECT min(ts) FROM events WHERE user_id = c_custkey) END AS first_ts
        FROM customer) u
  CROSS JOIN LATERAL (SELECT unnest(CASE WHEN u.c_mktsegment = 'BUILDING' THEN [10, 20] ELSE [10] END) AS days) o)"""


def identity_adapters_sql() -> str:
    return f"""
ev_first AS (SELECT user_id, min(ts) AS first_ts FROM events GROUP BY 1),
id_history AS (
  SELECT {acct('user_id')} AS primary_account_id, first_ts AS date_created,
         'app-' || CAST(user_id AS VARCHAR) AS primary_reference_number FROM ev_first
  UNION ALL
  SELECT {acct('user_id')}, first_ts - to_days(400), 'legacy-' || CAST(user_id AS VARCHAR) FROM ev_first),
primary_accounts AS (SELECT DISTINCT {acct('c_custkey')} AS primary_account_id FROM customer),
contact_keys AS (
  SELECT {acct('c_custkey')} AS primary_account_id, 'ck-' || CAST(c_custkey AS VARCHAR) AS reference_number,
         TIMESTAMP '2023-01-01 00:00:00' + to_days(CAST((c_custkey * 3) % 500 AS INTEGER)) AS date_created
  FROM customer),
emails AS (
  SELECT {acct('c_custkey')} AS primary_account_id,
         CASE WHEN c_acctbal > 0 THEN 'e-' || CAST(c_custkey AS VARCHAR) END AS reference_number
  FROM customer),
app_web_lookup AS (
  SELECT 'app-' || CAST(user_id AS VARCHAR) AS app_user_id, 'web-' || CAST(user_id AS VARCHAR) AS web_user_id
  FROM (SELECT DISTINCT user_id FROM events)),
wsf0 AS (SELECT user_id, {epoch_day('ts')} AS day, min(ts) AS start FROM events GROUP BY 1, 2),
web_session_facts AS (
  SELECT 'web-' || CAST(s.user_id AS VARCHAR) AS user_id, s.start AS session_start_time, f.first_session_date
  FROM wsf0 s JOIN (SELECT user_id, min(start) AS first_session_date FROM wsf0 GROUP BY 1) f
  ON s.user_id = f.user_id),
page_views AS (
  SELECT 'web-' || CAST(user_id AS VARCHAR) AS user_id,
         CASE WHEN event_type IN ('click', 'signup') THEN 'sfmc' ELSE 'app' END AS utm_source,
         CASE WHEN event_type = 'error' THEN NULL ELSE 'ck-' || CAST(user_id AS VARCHAR) END AS utm_term,
         ts AS session_time,
         CASE event_id % 6
           WHEN 0 THEN 'accountId=' || {acct('user_id')} || '&utm_source=app'
           WHEN 1 THEN 'accountId=' || {acct('user_id')} || '%26x=1'
           WHEN 2 THEN 'ref=x&accountId=' || {acct('user_id')}
           WHEN 3 THEN 'accountId='
           WHEN 4 THEN 'utm_source=sfmc' END AS query,
         CASE WHEN event_type = 'view' THEN '/en/custom-smile-plan-3d/view' ELSE '/en/home' END AS path
  FROM events)"""


def research_adapters_sql() -> str:
    return """
accounts AS (
  SELECT c_custkey // 3 AS main_company_identifier, c_custkey AS account_id,
         c_name AS account_name, c_mktsegment AS account_type FROM customer),
opportunities AS (
  SELECT o_custkey AS account_id, o_orderkey AS opportunity_id, o_orderdate AS close_date,
         CASE WHEN o_orderstatus = 'F' THEN TRUE WHEN o_orderstatus = 'P' THEN FALSE END AS is_opp_won,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'Renewal' WHEN o_orderpriority = '2-HIGH' THEN 'New'
              WHEN o_orderpriority = '3-MEDIUM' THEN 'New Logo' ELSE o_orderpriority END AS type,
         o_totalprice AS amount FROM orders),
research_log AS (
  SELECT c_custkey // 3 AS main_company_identifier,
         CASE WHEN c_acctbal >= 0 AND c_mktsegment IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE') THEN DATE '1995-01-01' + CAST((c_custkey * 37) % 2000 AS INTEGER) END - 7
           AS deck_delivered_date,
         CASE WHEN c_acctbal >= 0 AND c_mktsegment IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE') THEN DATE '1995-01-01' + CAST((c_custkey * 37) % 2000 AS INTEGER) END
           AS deck_presented_date
  FROM customer)"""


def link_urls_sql() -> str:
    return """
link_urls AS (
  SELECT page_id, url FROM pages
  UNION ALL
  SELECT page_id + 1000000000, replace(url, '&', '%26') FROM pages)"""


def with_ctes(*blocks: str) -> str:
    return "WITH " + ",".join(b.strip("\n") for b in blocks)


# ------------------------------------------------------------ web sessions

def _one_if(condition: str, kind: str = "INTEGER") -> str:
    return f"CAST(coalesce({condition}, false) AS {kind})"


def _gate(spec: tuple) -> str:
    kind, *rest = spec
    if kind == "keep":
        return rest[0]
    if kind == "any":
        return f"CAST(greatest({', '.join(rest[0])}) AS INTEGER)"
    if kind == "all":
        return "CAST(greatest(" + ", ".join(f"least({', '.join(group)})" for group in rest[0]) + ") AS INTEGER)"
    if kind == "needs":
        return f"if({rest[0]} <> 0, {rest[1]}, 0)"
    if kind == "unless":
        return f"if({rest[0]} <> 1, {rest[1]}, 0)"
    raise ValueError(kind)


def _credited(alternatives: list) -> str:
    return _one_if(" OR ".join("(" + " AND ".join(f"{c} IS NOT DISTINCT FROM {v}" for c, v in alt) + ")"
                               for alt in alternatives))


def web_marks(after: str | None = None, sessions: str = "web_sessions", events: str = "web_events",
              tag: str = "") -> str:
    """{tag}visits (labelled sessions with their flags), {tag}portal (who opened the portal before buying)."""
    visit_bound = f"AND session_start_time > {after}" if after else ""
    event_bound = f"AND time > {after}" if after else ""
    portal_name, opened, bought = S.PORTAL
    # "user" steps count the session's user: 0 or 1, as a bigint.
    flags = []
    for name, style, evs in S.SITE_STEPS:
        heard = f"list_has_any(names, [{sql_list(evs)}])"
        flag = _one_if(f"{heard} AND user_id IS NOT NULL", "BIGINT") if style == "user" else _one_if(heard)
        flags.append(f"{flag} AS {name}")
    flags.append(f"{_one_if('portal_bf_sale = 1 AND user_id IS NOT NULL', 'BIGINT')} AS {portal_name}")
    labels = ", ".join(f"lower({c}) AS {c}" for c in S.LOWERED_SESSION_COLUMNS)
    rules = ", ".join(f"{classify_sql(rules, default)} AS {name}" for name, rules, default in (
        ("browser_class", S.BROWSER_RULES, S.BROWSER_DEFAULT), ("channel", S.CHANNEL_RULES, S.CHANNEL_DEFAULT),
        ("email_stream", S.EMAIL_STREAM_RULES, S.EMAIL_STREAM_DEFAULT),
        ("platform_class", S.PLATFORM_RULES, S.PLATFORM_DEFAULT)))
    campaign = "lower(utm_campaign)"
    return f"""
{tag}web AS (
  SELECT * FROM {sessions}
  WHERE NOT coalesce(grouped_landing_pages = {sql_literal(S.APP_SESSIONS_GROUP)}, true) {visit_bound}),
{tag}heard AS (
  SELECT session_id,
         list(DISTINCT event_table_name) FILTER (WHERE event_table_name IN ({sql_list(S.SITE_EVENT_ALLOW_LIST)})) AS names,
         count(*) FILTER (WHERE event_table_name = {sql_literal(opened)}) AS opened_count,
         min(time) FILTER (WHERE event_table_name = {sql_literal(opened)}) AS opened_at,
         min(time) FILTER (WHERE event_table_name IN ({sql_list(bought)})) AS bought_at
  FROM {events} WHERE true {event_bound} GROUP BY session_id),
{tag}portal AS (
  SELECT session_id, CAST(coalesce(opened_at <= bought_at, true) AS INTEGER) AS portal_bf_sale
  FROM {tag}heard WHERE opened_count > 0),
{tag}labelled AS (
  SELECT distinct_session_id, session_id, user_id, session_start_time, business_entity, business_entity_language,
         first_session_date, {labels},
         CASE WHEN {campaign} IN (SELECT utm_campaign FROM {tag}web WHERE utm_campaign IS NOT NULL)
              THEN if({campaign} IN ({sql_list(S.RETARGETING_CAMPAIGNS)}), 'retargeting', 'prospecting') END AS ad_intention
  FROM {tag}web),
{tag}ruled AS (SELECT *, {rules} FROM {tag}labelled),
{tag}visits AS (
  SELECT r.*, {', '.join(flags)}
  FROM {tag}ruled r LEFT JOIN {tag}heard USING (session_id) LEFT JOIN {tag}portal USING (session_id))"""


def site_model_body(after: str | None = None, sessions: str = "web_sessions", events: str = "web_events",
                    prefix: str = "") -> str:
    """{prefix}gated (74 columns) and {prefix}site (83 columns) on top of the marks."""
    renamed = {"DATE": "CAST(session_start_time AS DATE)", "device": "device_type", "browser": "browser_class",
               "platform": "platform_class", "first_session_date": "CAST(first_session_date AS DATE)"}
    published = ", ".join(f'{renamed[c]} AS "{c}"' if c in renamed else c for c in S.SITE_DIMENSIONS)
    gates = ", ".join(f"{_gate(spec)} AS {name}" for name, spec in S.GATES)
    credit = ", ".join(f"{_credited(alternatives)} AS {name}" for name, alternatives in S.ATTRIBUTION)
    # A rule may read what an earlier rule has credited.
    return web_marks(after, sessions, events, prefix) + f""",
{prefix}gated AS (SELECT DISTINCT {published}, {gates} FROM {prefix}visits),
{prefix}site AS (SELECT *, {credit} FROM {prefix}gated)"""


def _site(select: str) -> str:
    return with_ctes(web_adapters_sql(), site_model_body()) + "\n" + select


def _step_flags(style: str, extra: str = "") -> str:
    names = ", ".join(name for name, kind, _ in S.SITE_STEPS if kind == style)
    return _site(f"SELECT DISTINCT distinct_session_id, session_id, user_id, {names}{extra} FROM visits")


def refreshed_sql() -> str:
    """The table as of ``split``, its rows replaced by key with what a rebuild after the bound gives."""
    from sessionlens.plans.catalog import REFRESHED_DAYS
    split = f"(SELECT max(session_start_time) - INTERVAL {REFRESHED_DAYS} DAY FROM web_sessions)"
    return with_ctes(
        web_adapters_sql(),
        f"""
early_sessions AS (SELECT * FROM web_sessions WHERE session_start_time < {split}),
early_events AS (SELECT * FROM web_events WHERE time < {split})""",
        site_model_body(None, "early_sessions", "early_events", "before_"),
        site_model_body('(SELECT max("DATE") - INTERVAL 1 DAY FROM before_site)', prefix="since_"),
    ) + """
SELECT * FROM since_site
UNION ALL
SELECT * FROM before_site WHERE distinct_session_id NOT IN (SELECT distinct_session_id FROM since_site)"""


# ------------------------------------------------------------ query strings

def parameter(text: str, key: str) -> str:
    """What follows the first ``key``, up to the next '&' or, if there is none, the next '%'."""
    rest = f"substr({text}, strpos({text}, {sql_literal(key)}) + {len(key)})"
    ends = f"if(contains({rest}, '&'), '&', '%')"
    return f"CASE WHEN contains({text}, {sql_literal(key)}) THEN split_part({rest}, {ends}, 1) END"


def url_param_sql() -> str:
    from sessionlens.plans.catalog import URL_PARAMS
    found = ", ".join(f"{parameter('url', key)} AS {key.rstrip('=')}" for key in URL_PARAMS)
    return with_ctes(link_urls_sql()) + f"\nSELECT page_id, url, {found} FROM link_urls"


# ------------------------------------------------------------ linked identities

def link_identities_body() -> str:
    """``identities``: each account's app ids with whatever web user each route gives."""
    return f"""
recent_ids AS (
  SELECT primary_account_id AS account, primary_reference_number AS app_id, date_created
  FROM id_history WHERE date_created >= TIMESTAMP '2023-01-01 00:00:00'),
opened_accounts AS (SELECT account, min(date_created) AS opened_on FROM recent_ids GROUP BY account),
first_keys AS (SELECT primary_account_id AS account, min(date_created) AS keyed_on FROM contact_keys GROUP BY ALL),
first_visits AS (SELECT DISTINCT user_id, first_session_date AS visited_on FROM web_session_facts),
bought AS (
  SELECT app_user_id AS app_id, web_user_id, visited_on
  FROM app_web_lookup LEFT JOIN first_visits ON user_id = web_user_id),
first_bought AS (
  SELECT account, min(visited_on) AS bought_on FROM recent_ids JOIN bought USING (app_id) GROUP BY account),
mailed AS (
  SELECT DISTINCT v.user_id::VARCHAR AS mailed_user, v.utm_term AS contact_key, visited_on AS mailed_on
  FROM page_views v LEFT JOIN first_visits USING (user_id)
  WHERE v.utm_source = 'sfmc' AND v.utm_term IS NOT NULL AND v.session_time >= TIMESTAMP '2022-01-02 00:00:00'),
planned AS (
  SELECT DISTINCT v.user_id::VARCHAR AS planning_user, {parameter('v.query', 'accountId=')} AS account,
         visited_on AS planned_on
  FROM page_views v LEFT JOIN first_visits USING (user_id)
  WHERE contains(v.path, '/custom-smile-plan-3d')),
holders AS (
  SELECT DISTINCT i.account, i.app_id, m.reference_number AS email, k.reference_number AS contact_key, b.web_user_id
  FROM recent_ids i
  LEFT JOIN emails m ON m.primary_account_id = i.account
  LEFT JOIN contact_keys k ON k.primary_account_id = i.account
  LEFT JOIN bought b ON b.app_id = i.app_id),
identities AS (
  SELECT h.account AS primary_account_id, o.opened_on AS acs_reference_date_created, h.app_id AS acs_user_id,
         h.email AS acs_email, h.contact_key AS acs_contact_key, f.keyed_on AS acs_contact_key_created_date,
         h.web_user_id AS buy_now_user_id, w.bought_on AS buy_now_user_first_session_date,
         t.mailed_user AS contact_key_user_id, t.mailed_on AS contact_key_user_first_session,
         d.planning_user AS account_id_user, d.planned_on AS account_id_user_first_session
  FROM holders h
  LEFT JOIN opened_accounts o ON o.account IS NOT DISTINCT FROM h.account
  LEFT JOIN first_keys f ON f.account = h.account
  LEFT JOIN first_bought w ON w.account IS NOT DISTINCT FROM h.account
  LEFT JOIN mailed t ON t.contact_key = h.contact_key
  LEFT JOIN planned d ON d.account = h.account)"""


LINK_SELECT = "\nSELECT * FROM identities"


def link_identities_sql() -> str:
    return with_ctes(identity_adapters_sql(), link_identities_body()) + LINK_SELECT


ROUTES_SELECT = """
SELECT DISTINCT i.account AS primary_account_id, 'app_id' AS route, i.app_id AS via, b.web_user_id, b.visited_on AS first_session
FROM recent_ids i JOIN bought b USING (app_id) WHERE b.web_user_id IS NOT NULL
UNION ALL
SELECT DISTINCT k.primary_account_id, 'contact_key', m.contact_key, m.mailed_user, m.mailed_on
FROM contact_keys k JOIN mailed m ON m.contact_key = k.reference_number
WHERE k.primary_account_id IN (SELECT account FROM recent_ids) AND m.mailed_user IS NOT NULL
UNION ALL
SELECT DISTINCT account, 'account_id', NULL, planning_user, planned_on
FROM planned WHERE account IN (SELECT account FROM recent_ids) AND planning_user IS NOT NULL"""

VISITS_SELECT = """
SELECT DISTINCT account AS primary_account_id, first_value(visited_on) OVER w AS buy_now_user_first_session_date,
       last_value(visited_on) OVER w AS buy_now_user_last_session_date
FROM recent_ids LEFT JOIN bought USING (app_id)
WINDOW w AS (PARTITION BY account ORDER BY visited_on NULLS LAST
             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"""


# ------------------------------------------------------------ app sessions

def _among(names: Sequence[str]) -> str:
    return f"event_table_name IN ({sql_list(names)})"


def _milestone(out: str, kind: str, names: Sequence[str]) -> str:
    bound = "account_id_user_first_session"
    if kind == "first":
        return f"min(time) FILTER (WHERE {_among(names)}) AS {out}"
    if kind == "last":
        return f"max(time) FILTER (WHERE {_among(names)}) AS {out}"
    if kind == "last_name":
        return f"max_by(event_table_name, (coalesce(time, 'infinity'::TIMESTAMP), event_table_name)) AS {out}"
    shared = f"({_among(names)} OR ({_among(A.CONTACT_INFO_EVENTS)} AND {bound} IS NOT NULL))"
    pick = "min" if kind == "csp_first" else "max"
    timed, untimed = (f"{pick}({value}) FILTER (WHERE {shared} AND {test})" for value, test in
                      (("time", "time IS NOT NULL"), (bound, "time IS NULL")))
    # Rows without a time come last.
    return f"coalesce({timed}, {untimed}) AS {out}" if kind == "csp_first" else f"coalesce({untimed}, {timed}) AS {out}"


def app_body(links: str = "app_to_web_links") -> str:
    """joined_events, visit_starts, per_session, reached (and its durations), app_visits."""
    wanted = " OR ".join([f"event_table_name LIKE {sql_literal(p)}" for p in A.APP_EVENT_LIKE] + [_among(A.APP_EVENT_EXACT)])
    reached = ", ".join(_milestone(*m) for m in A.MILESTONES)
    scan_end, value, start, blocker = A.SCAN_END
    spans = ", ".join(f"date_diff('second', {begin}, coalesce({', '.join(ends)}, NULL)) / 60 AS {out}"
                      for out, begin, ends in A.DURATIONS)
    published = ", ".join(f"d.{c}" for c in A.MILESTONE_OUTPUT_ORDER)
    return f"""
known_links AS (
  SELECT primary_account_id, account_id_user, acs_user_id, account_id_user_first_session
  FROM {links} WHERE account_id_user IS NOT NULL GROUP BY ALL),
own_events AS (SELECT row_number() OVER () AS event_no, * FROM app_events WHERE {wanted}),
matched AS (
  SELECT e.*, l.* FROM own_events e, known_links l
  WHERE e.user_id::VARCHAR = l.acs_user_id::VARCHAR AND l.account_id_user_first_session > e.time),
joined_events AS (
  SELECT * EXCLUDE (event_no) FROM
    (SELECT * FROM matched UNION ALL BY NAME
     SELECT * FROM own_events WHERE event_no NOT IN (SELECT event_no FROM matched))),
views AS (SELECT user_id, session_id, time FROM app_events WHERE {_among(A.APP_VIEW_EVENTS)} GROUP BY ALL),
visit_starts AS (
  SELECT s.user_id, s.session_id,
         md5(concat(s.session_id, '-', s.user_id, '-', s.session_start_time)) AS distinct_session_id,
         v.time, s.session_start_time, s.library, s.platform, s.device_type, s.country, s.region, s.city, s.ip
  FROM (SELECT DISTINCT * FROM app_sessions) s JOIN views v ON v.user_id = s.user_id AND v.session_id = s.session_id),
first_starts AS (SELECT user_id, min(session_start_time) AS first_session_date FROM visit_starts GROUP BY user_id),
per_session AS (
  SELECT user_id, session_id, max(time) AS session_end_time, count(*) AS event_count,
         count(*) FILTER (WHERE {_among(A.CSP_SHARED_EVENTS)}) AS CSP_shared_count
  FROM joined_events GROUP BY user_id, session_id),
reached AS (SELECT session_id, {reached} FROM joined_events GROUP BY session_id),
durations AS (
  SELECT *, {spans}
  FROM (SELECT *, if({value} > {start} AND {blocker} IS NULL, {value}, NULL) AS {scan_end} FROM reached)),
account_names AS (SELECT DISTINCT reference_number, primary_account_id FROM app_account_map),
app_visits AS (
  SELECT v.*, (n.primary_account_id) AS primary_account_id, f.first_session_date, p.session_end_time, p.event_count,
         p.CSP_shared_count, {published}
  FROM visit_starts v
  LEFT JOIN first_starts f ON f.user_id = v.user_id
  LEFT JOIN account_names n ON n.reference_number = v.user_id::VARCHAR
  LEFT JOIN per_session p ON p.user_id = v.user_id AND p.session_id = v.session_id
  LEFT JOIN durations d ON d.session_id = v.session_id)"""


def _app(select: str) -> str:
    return with_ctes(app_adapters_sql(), app_body()) + "\n" + select


def linked_app_sql() -> str:
    """The app model on the linking model's own output (app users named as there)."""
    renamed = """
named_events AS (SELECT * REPLACE ('app-' || user_id AS user_id) FROM app_events),
named_sessions AS (SELECT * REPLACE ('app-' || user_id AS user_id) FROM app_sessions),
named_accounts AS (SELECT * REPLACE ('app-' || reference_number AS reference_number) FROM app_account_map)"""
    body = app_body("identities")
    for table in ("events", "sessions"):
        body = body.replace(f"app_{table}", f"named_{table}")
    body = body.replace("app_account_map", "named_accounts")
    return with_ctes(app_adapters_sql(), identity_adapters_sql(), link_identities_body(), renamed, body) + \
        "\nSELECT * FROM app_visits"


# ------------------------------------------------------------ research

def research_body() -> str:
    """``deals``: every opportunity with the number of presentations its company had seen by then."""
    return """
deals AS (
  SELECT a.main_company_identifier AS company, o.type AS kind, o.is_opp_won AS won,
         (SELECT count(*) FROM research_log r
          WHERE r.main_company_identifier = a.main_company_identifier
            AND r.deck_presented_date <= o.close_date::DATE) AS seen
  FROM opportunities o JOIN accounts a USING (account_id))"""


RESEARCH_SELECT = """
SELECT c.main_company_identifier,
       coalesce(sum(seen), 0)::BIGINT AS total_opps_closed_after_deck_delivered,
       coalesce(sum(seen) FILTER (WHERE won), 0)::BIGINT AS total_opps_won_after_deck_delivered,
       coalesce(sum(seen) FILTER (WHERE NOT won), 0)::BIGINT AS total_opps_lost_after_deck_delivered,
       coalesce(sum(seen) FILTER (WHERE won AND kind = 'Renewal'), 0)::BIGINT AS total_renewal_won_after_deck_delivered,
       coalesce(sum(seen) FILTER (WHERE won AND kind IN ('New', 'New Logo')), 0)::BIGINT
         AS total_new_opps_won_after_deck_delivered
FROM (SELECT DISTINCT main_company_identifier FROM accounts) c
LEFT JOIN deals d ON d.company = c.main_company_identifier
GROUP BY c.main_company_identifier"""


def research_sql() -> str:
    return with_ctes(research_adapters_sql(), research_body()) + RESEARCH_SELECT


# ------------------------------------------------------------ all queries

def oracle_queries() -> dict[str, str]:
    durations = ", ".join([A.SCAN_END[0], *[d[0] for d in A.DURATIONS]])
    milestones = ", ".join(m[0] for m in A.MILESTONES)
    credited = ", ".join(name for name, _ in S.ATTRIBUTION)
    refreshed = refreshed_sql()
    return {
        "site_model": _site("SELECT * FROM site"),
        "funnel_flags_any": _step_flags("any"),
        "funnel_flags_user": _step_flags("user", f", {S.PORTAL[0]}"),
        "funnel_gated": _site("SELECT * FROM gated"),
        "exclusive_attribution": _site(f"SELECT distinct_session_id, session_id, user_id, {credited} FROM site"),
        "funnel_users": _site('SELECT CAST(session_start_time AS DATE) AS "DATE", channel, ' + ", ".join(
            f"count(DISTINCT CASE WHEN {name} = 1 THEN user_id END) AS {name}"
            for name in [*(n for n, style, _ in S.SITE_STEPS if style == "user"), S.PORTAL[0]])
            + " FROM visits GROUP BY ALL"),
        "happened_before": _site("SELECT session_id, portal_bf_sale FROM portal"),
        "classify_channel": _site("SELECT distinct_session_id, utm_source, utm_campaign, utm_medium, referrer, "
                                  "ad_intention, channel FROM ruled"),
        "campaign_intent": _site("SELECT distinct_session_id, utm_campaign, ad_intention FROM ruled"),
        "classify_browser": _site("SELECT distinct_session_id, browser_class AS browser, platform_class AS platform, "
                                  "email_stream FROM ruled"),
        "url_param": url_param_sql(),
        "link_identities": link_identities_sql(),
        "identity_routes": with_ctes(identity_adapters_sql(), link_identities_body()) + ROUTES_SELECT,
        "account_visits": with_ctes(identity_adapters_sql(), link_identities_body()) + VISITS_SELECT,
        "bounded_identity_join": _app("SELECT * FROM joined_events"),
        "later_link_counts": _app("""SELECT e.user_id, e.session_id, e.time, e.event_table_name,
       (SELECT count(*) FROM known_links l WHERE l.acs_user_id::VARCHAR = e.user_id::VARCHAR
        AND l.account_id_user_first_session > e.time) AS n_links FROM own_events e"""),
        "session_rollup": _app("SELECT * FROM per_session"),
        "session_base": _app("SELECT * FROM visit_starts"),
        "first_seen": _app("SELECT * FROM first_starts"),
        "milestones": _app(f"SELECT session_id, {milestones} FROM reached"),
        "milestone_durations": _app(f"SELECT session_id, {durations} FROM durations"),
        "app_session_model": _app("SELECT * FROM app_visits"),
        "linked_app_session_model": linked_app_sql(),
        "outcomes_after": research_sql(),
        "incremental_refresh": refreshed,
        "stored_watermark": with_ctes(web_adapters_sql())
            + "\nSELECT max(CAST(session_start_time AS DATE)) - 1 AS high_water_mark FROM web_sessions",
        "stored_refresh": refreshed,
        "touched_refresh": _site("SELECT * FROM site"),
    }
