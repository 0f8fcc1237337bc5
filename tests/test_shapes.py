"""Shaped operators equal the original plan shapes; plans have the intended form."""

import re

from pyspark.sql import functions as F

from conftest import SF_SMALL
from sessionlens.operators.funnel import funnel_flags
from sessionlens.operators.milestones import milestones
from sessionlens.plans import app_config as A
import literal_shapes as L
from sessionlens.plans import models as M
from sessionlens.plans import site_config as S
from sessionlens.plans.catalog import QUERIES
from sessionlens.sources import adapters as AD
from sessionlens.sources.tables import Tables


def _same(a, b):
    cols = sorted(a.columns)
    a, b = a.select(cols), b.select(cols)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() == b.count()


def test_milestones_equal_window_form(spark):
    t = Tables(spark, SF_SMALL)
    ev = M.linked_app_events(AD.app_events(t), AD.app_to_web_links(t)).select(
        "session_id", F.col("time").alias("event_time"), "event_table_name",
        "account_id_user_first_session")
    shaped = milestones(ev, A.MILESTONES, link_time_col="account_id_user_first_session",
                        linked_events=A.CONTACT_INFO_EVENTS)
    assert _same(shaped, L.milestones_literal(ev))


def test_user_flags_equal_count_distinct_form(spark):
    t = Tables(spark, SF_SMALL)
    stg_s, stg_e = M.site_staging(AD.web_sessions(t), AD.web_events(t))
    sess = stg_s.select("distinct_session_id", "session_id", "user_id").distinct()
    steps = [st for st in S.SITE_STEPS if st[1] == "user"]
    shaped = funnel_flags(sess, stg_e, steps, allow_list=S.SITE_EVENT_ALLOW_LIST, portal=S.PORTAL)
    assert _same(shaped, L.funnel_flags_user_literal(sess, stg_e))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _nodes(txt, name):
    return sum(1 for line in txt.splitlines()
               if re.sub(r"^\*\(\d+\) ", "", line.lstrip(" :|+-")).startswith(name))


#: Windows over bounded groups: the running sum over a company's dates; one user and hour, one row per user and hour.
WINDOWS = {"outcomes_after": 1, "later_link_counts": 2}


def test_no_expand_window_or_python_in_any_query(spark):
    for name, fn in QUERIES.items():
        txt = _plan(fn(spark, SF_SMALL))
        for node in ("Expand", "Window", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                     "BroadcastNestedLoopJoin"):
            assert _nodes(txt, node) == (WINDOWS.get(name, 0) if node == "Window" else 0), (name, node)


def test_time_milestones_use_hash_aggregation(spark):
    ev = spark.createDataFrame([("s", None, "x", None)],
                               "session_id string, event_time timestamp_ntz, event_table_name string, "
                               "link timestamp_ntz")
    specs = [(o, k, e) for o, k, e in A.MILESTONES if k in ("first", "last")]
    txt = _plan(milestones(ev, specs))
    assert _nodes(txt, "SortAggregate") == 0 and _nodes(txt, "HashAggregate") >= 2


def test_scans_read_only_needed_columns(spark):
    txt = _plan(QUERIES["funnel_flags_any"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", txt)
    assert schemas and all("props" not in s and "value" not in s for s in schemas)


def test_refresh_bound_reaches_the_scan(spark):
    t = Tables(spark, SF_SMALL)
    df = M.site_model(AD.web_sessions(t), AD.web_events(t), "2024-01-25")
    txt = _plan(df)
    assert "GreaterThan(ts,2024-01-25T00:00)" in txt


def test_models_compute_each_input_once(spark):
    # No Union in the model plans: a union branch per key case would make
    # Spark compute the left side of a join twice.
    for name in ("site_model", "app_session_model", "bounded_identity_join"):
        assert _nodes(_plan(QUERIES[name](spark, SF_SMALL)), "Union") == 0, name


def test_events_are_shuffled_only_as_partial_flag_aggregates(spark):
    steps = [st for st in S.SITE_STEPS]
    t = Tables(spark, SF_SMALL)
    ev = AD.web_events(t)
    flags = funnel_flags(ev.select("session_id", "user_id").distinct(), ev, steps,
                         allow_list=S.SITE_EVENT_ALLOW_LIST, portal=S.PORTAL)
    lines = [re.sub(r"^\*\(\d+\) ", "", line.lstrip(" :|+-")) for line in _plan(flags).splitlines()]
    # Below the per-session exchange sits the map-side partial aggregate
    # (events never cross the network as rows).
    idx = [i for i, line in enumerate(lines) if line.startswith("Exchange hashpartitioning(session_id")]
    below = [lines[i + 1] for i in idx]
    assert any("partial_bit_or" in b for b in below), below
    for i in idx:
        assert lines[i + 1].startswith(("HashAggregate", "Project", "Filter")), lines[i + 1]


def test_unique_sessions_skips_the_distinct_with_the_same_result(spark):
    t = Tables(spark, SF_SMALL)
    # The adapter sessions have one row per distinct_session_id.
    s = AD.web_sessions(t)
    exact = M.site_model(s, AD.web_events(t))
    fast = M.site_model(s, AD.web_events(t), unique_sessions=True)
    assert s.count() == s.select("distinct_session_id").distinct().count()
    cols = sorted(exact.columns)
    assert exact.select(cols).exceptAll(fast.select(cols)).count() == 0
    assert fast.select(cols).exceptAll(exact.select(cols)).count() == 0
