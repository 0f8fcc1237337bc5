"""Every ordered rule table evaluated by Spark and by DuckDB on the same rows.

Rows are built from the literals that appear in the rule predicates (as
is, inside longer text, upper-cased, with '_' replaced, or NULL), so most
rules fire and the NULL / LIKE-wildcard / AND-OR precedence cases are
exercised in bulk.  Both engines must classify every row identically.
"""

import random
import re

from inline_tables import register
from oracle_compare import compare
from sessionlens.functions.rules import classify_sql
from sessionlens.operators.classify import classify_columns
from sessionlens.plans import site_config as S

COLUMNS = ["utm_source", "utm_campaign", "utm_medium", "utm_term", "referrer", "landing_page",
           "browser", "platform", "ad_intention"]
TABLES = {
    "channel": (S.CHANNEL_RULES, S.CHANNEL_DEFAULT),
    "email_stream": (S.EMAIL_STREAM_RULES, S.EMAIL_STREAM_DEFAULT),
    "browser_class": (S.BROWSER_RULES, S.BROWSER_DEFAULT),
    "platform_class": (S.PLATFORM_RULES, S.PLATFORM_DEFAULT),
}


def _pool():
    lits = set()
    for rules, _ in TABLES.values():
        for _, pred in rules:
            lits |= set(re.findall(r"'([^']*)'", pred))
    out = [None]
    for lit in sorted(lits):
        core = lit.strip("%")
        out += [core, f"x{core}y", core.upper(), core.replace("_", "Q")]
    return out


def _targets():
    """(column, literal) pairs named by each rule's predicate."""
    out = []
    for rules, _ in TABLES.values():
        for _, pred in rules:
            pairs = re.findall(r"(\w+) (?:=|LIKE|NOT LIKE) '([^']*)'", pred)
            for col, group in re.findall(r"(\w+) IN \(([^)]*)\)", pred):
                pairs += [(col, lit) for lit in re.findall(r"'([^']*)'", group)]
            out.append(pairs)
    return out


def _variant(rnd, lit):
    core = lit.strip("%")
    return rnd.choice([core, core, f"x{core}y", core.upper(), core.replace("_", "Q")])


def _rows(n=3000, seed=7):
    """Half the rows target one rule (its own column/literal pairs, other
    columns NULL or random); the rest are random."""
    rnd = random.Random(seed)
    pool = _pool()
    targets = _targets()
    rows = []
    for i in range(n):
        vals = {c: (rnd.choice(pool) if rnd.random() < 0.4 else None) for c in COLUMNS}
        vals["ad_intention"] = rnd.choice(["retargeting", "prospecting", None])
        if i % 2 == 0:
            if rnd.random() < 0.5:
                vals = {c: None for c in COLUMNS}
            for col, lit in targets[rnd.randrange(len(targets))]:
                if col in vals:
                    vals[col] = _variant(rnd, lit)
        rows.append((str(i), *[vals[c] for c in COLUMNS]))
    return rows


def test_rule_tables_agree_across_engines(spark):
    cols = [("row_id", "string")] + [(c, "string") for c in COLUMNS]
    con, frames = register(spark, {"sessions": (cols, _rows())})
    got = classify_columns(frames["sessions"], TABLES).select("row_id", *TABLES)
    sql = "SELECT row_id, " + ", ".join(
        f"{classify_sql(rules, default)} AS {name}" for name, (rules, default) in TABLES.items()
    ) + " FROM sessions"
    problems, n = compare(got, con, sql)
    assert not problems, problems
    assert n == 3000
    reached = {r[0] for r in got.select("channel").distinct().collect()}
    assert len(reached) >= 40, sorted(reached)


def test_url_param_matches_literal_extraction_on_random_strings(spark):
    from sessionlens.functions.columns import url_param
    from sessionlens.plans.oracle import parameter
    rnd = random.Random(11)
    pieces = ["accountId=", "accountId", "Id=", "a", "1", "&", "%", "%26", "=", "x=2", "&accountId=", ""]
    rows = [(str(i), None if i % 97 == 0 else "".join(rnd.choice(pieces) for _ in range(rnd.randrange(0, 7))))
            for i in range(1000)]
    con, frames = register(spark, {"urls": ([("row_id", "string"), ("q", "string")], rows)})
    got = frames["urls"].select("row_id", url_param("q", "accountId=").alias("v"))
    problems, n = compare(got, con, f"SELECT row_id, {parameter('q', 'accountId=')} AS v FROM urls")
    assert not problems, problems
    assert n == 1000


def test_second_boundaries_match_duckdb_on_random_timestamps(spark):
    import datetime as dt

    from sessionlens.functions.columns import minutes_between, seconds_between
    rnd = random.Random(12)
    base = dt.datetime(1969, 12, 31, 23, 0, 0)

    def ts():
        if rnd.random() < 0.03:
            return None
        return base + dt.timedelta(seconds=rnd.randrange(0, 2 * 86400), microseconds=rnd.randrange(0, 10**6))

    rows = [(str(i), ts(), ts()) for i in range(2000)]
    con, frames = register(spark, {"pairs": ([("row_id", "string"), ("a", "timestamp_ntz"),
                                              ("b", "timestamp_ntz")], rows)})
    got = frames["pairs"].select("row_id", seconds_between("a", "b").alias("s"),
                                 minutes_between("a", "b").alias("m"))
    sql = "SELECT row_id, date_diff('second', a, b) AS s, date_diff('second', a, b) / 60 AS m FROM pairs"
    problems, n = compare(got, con, sql)
    assert not problems, problems


def test_surrogate_key_matches_duckdb_md5(spark):
    import datetime as dt

    from sessionlens.functions.columns import surrogate_key
    rnd = random.Random(13)

    def ts():
        r = rnd.random()
        if r < 0.1:
            return None
        micro = rnd.choice([0, 170000, 123456, 500000, 1])
        return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rnd.randrange(0, 86400 * 30), microseconds=micro)

    rows = [(str(i), rnd.choice([None, rnd.randrange(10**9)]), rnd.choice([None, rnd.randrange(10**6)]), ts())
            for i in range(1000)]
    con, frames = register(spark, {"keys": ([("row_id", "string"), ("session_id", "bigint"),
                                             ("user_id", "bigint"), ("start", "timestamp_ntz")], rows)})
    got = frames["keys"].select("row_id", surrogate_key("session_id", "user_id", "start").alias("k"))
    sql = ("SELECT row_id, md5(coalesce(CAST(session_id AS VARCHAR), '') || '-' || coalesce(CAST(user_id AS VARCHAR), '')"
           " || '-' || coalesce(CAST(start AS VARCHAR), '')) AS k FROM keys")
    problems, n = compare(got, con, sql)
    assert not problems, problems
