"""A hot key holding about a third of all rows.

With broadcast disabled and AQE's skew thresholds scaled down to the test
data, the per-session flag join must be planned as a shuffle join that AQE
can split (no aggregate depends on its partitioning), and the results must
still equal the literal join-then-COUNT(DISTINCT) form.
"""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from sessionlens.operators.funnel import funnel_flags
from sessionlens.operators.identity import bounded_identity_join
import literal_shapes as L
from sessionlens.plans import models as M
from sessionlens.plans import site_config as S
from sessionlens.sources import adapters as AD
from sessionlens.sources.tables import Tables

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _hot(df, key, every=3, hot_value=0):
    """Send every third row (by a row id) to one key value."""
    return df.withColumn(key, F.when(F.pmod(F.col("_rid"), F.lit(every)) == 0, F.lit(hot_value))
                         .otherwise(F.col(key))).drop("_rid")


def _final_plan(df):
    df.collect()  # runs this DataFrame's own query execution, so AQE's final plan is recorded
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_session_flags(spark, skew_conf):
    t = Tables(spark, SF_SMALL)
    ev = AD.web_events(t).withColumn("_rid", F.monotonically_increasing_id())
    ev = _hot(ev, "session_id")
    sess = (AD.web_sessions(t).select("distinct_session_id", "session_id", "user_id")
            .withColumn("_rid", F.monotonically_increasing_id()))
    sess = _hot(sess, "session_id").cache()
    ev = ev.cache()
    hot_share = ev.where(F.col("session_id") == 0).count() / ev.count()
    assert hot_share > 0.3
    steps = [st for st in S.SITE_STEPS if st[1] == "user"]
    shaped = funnel_flags(sess, ev, steps, allow_list=S.SITE_EVENT_ALLOW_LIST, portal=S.PORTAL)
    plan = _final_plan(shaped)
    assert "SortMergeJoin" in plan and "skew=true" in plan, plan
    literal = L.funnel_flags_user_literal(sess, ev)
    cols = sorted(shaped.columns)
    assert shaped.select(cols).exceptAll(literal.select(cols)).count() == 0
    assert literal.select(cols).exceptAll(shaped.select(cols)).count() == 0


def test_hot_user_identity_join(spark, skew_conf):
    t = Tables(spark, SF_SMALL)
    ev = AD.app_events(t).withColumn("_rid", F.monotonically_increasing_id())
    # AQE splits a skewed partition along map outputs; spread the single
    # input file over several map tasks, as a multi-file table would be.
    ev = _hot(ev, "user_id", hot_value=1).repartition(8).cache()
    links = M.simplified_links(AD.app_to_web_links(t)).cache()
    out = bounded_identity_join(ev, links, event_key="user_id", link_key="acs_user_id",
                                time_col="time", bound_col="account_id_user_first_session")
    plan = _final_plan(out)
    assert "SortMergeJoin" in plan and "skew=true" in plan, plan
    # Same rows as a join without skew handling.
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        plain = bounded_identity_join(ev, links, event_key="user_id", link_key="acs_user_id",
                                      time_col="time", bound_col="account_id_user_first_session")
        assert out.exceptAll(plain).count() == 0 and plain.exceptAll(out).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def test_hot_campaign_lookup(spark, skew_conf):
    from sessionlens.operators.classify import campaign_intent
    from sessionlens.plans import site_config as S
    t = Tables(spark, SF_SMALL)
    s = (AD.web_sessions(t).select("distinct_session_id", "utm_campaign")
         .withColumn("_rid", F.monotonically_increasing_id()))
    # A third of the sessions carry one campaign.
    s = s.withColumn("utm_campaign", F.when(F.pmod(F.col("_rid"), F.lit(3)) == 0, F.lit("rtg"))
                     .otherwise(F.col("utm_campaign"))).drop("_rid").repartition(8).cache()
    out = campaign_intent(s, s, S.RETARGETING_CAMPAIGNS)
    plan = _final_plan(out)
    assert "SortMergeJoin" in plan and "skew=true" in plan, plan
    got = {r["distinct_session_id"]: r["ad_intention"] for r in out.collect()}
    raw = {r[0] for r in s.select("utm_campaign").distinct().collect() if r[0] is not None}
    for r in s.collect():
        c = r["utm_campaign"]
        want = None if c is None or c not in raw else (
            "retargeting" if c.lower() in S.RETARGETING_CAMPAIGNS else "prospecting")
        assert got[r["distinct_session_id"]] == want


def test_hot_account_in_the_linking_model(spark, skew_conf):
    from sessionlens.operators.identity import link_identities
    t = Tables(spark, SF_SMALL)
    # A third of the app ids belong to one account, which also has contact keys and an e-mail.
    hist = (AD.id_history(t).unionByName(spark.range(1200).select(
        F.when(F.col("id") % 3 == 0, F.lit("acct-0")).otherwise(F.concat(F.lit("acct-x"), "id")).alias("primary_account_id"),
        F.lit("2024-01-05 00:00:00").cast("timestamp_ntz").alias("date_created"),
        F.concat(F.lit("app-x"), "id").alias("primary_reference_number"))).repartition(8).cache())
    out = link_identities(hist, AD.contact_keys(t), AD.emails(t), AD.app_web_lookup(t), AD.web_session_facts(t),
                          AD.page_views(t).where("utm_source != 'sfmc'"))
    plan = _final_plan(out)
    assert "SortMergeJoin(skew=true)" in plan, plan
    assert out.where("primary_account_id = 'acct-0'").select("acs_user_id").distinct().count() >= 400


def test_hot_company_outcomes(spark):
    from sessionlens.operators.outcomes import outcomes_after
    deals = spark.range(900).select(F.lit(7).alias("account_id"), F.date_add(F.lit("2024-01-01").cast("date"),
                                    (F.col("id") % 30).cast("int")).alias("close_date"))
    decks = spark.range(60).select(F.lit(1).alias("main_company_identifier"), F.date_add(
        F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("deck_presented_date"))
    companies = spark.createDataFrame([(1, 7), (2, 8)], "main_company_identifier int, account_id int")
    got = {r["main_company_identifier"]: r["closed"] for r in outcomes_after(
        companies, deals, decks, {"closed": F.lit(True)}).collect()}
    assert got == {1: sum(30 * (day + 1) for day in range(30)), 2: 0}
