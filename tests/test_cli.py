"""The command line runs each model from parquet inputs to a written table."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from sessionlens import cli
from sessionlens.plans import models as M
from sessionlens.sources import adapters as AD
from sessionlens.sources.tables import Tables


def _write(df, path):
    df.write.mode("overwrite").parquet(path)
    return path


def _same(a, b):
    cols = sorted(a.columns)
    return a.select(cols).exceptAll(b.select(cols)).count() == 0 and \
        b.select(cols).exceptAll(a.select(cols)).count() == 0


def test_cli_models(spark, scratch):
    t = Tables(spark, SF_SMALL)
    ws = _write(AD.web_sessions(t), f"{scratch}/in/web_sessions")
    we = _write(AD.web_events(t), f"{scratch}/in/web_events")
    cli.main(["site", "--sessions", ws, "--events", we, "--out", f"{scratch}/out/site"], spark=spark)
    cli.main(["site", "--sessions", ws, "--events", we, "--out", f"{scratch}/out/site"], spark=spark)
    site = spark.read.parquet(f"{scratch}/out/site")
    assert _same(site, M.site_model(spark.read.parquet(ws), spark.read.parquet(we)))

    paths = {n: _write(getattr(AD, n)(t), f"{scratch}/in/{n}") for n in
             ("app_sessions", "app_events", "app_to_web_links", "app_account_map",
              "accounts", "opportunities", "research_log")}
    cli.main(["app", "--sessions", paths["app_sessions"], "--events", paths["app_events"],
              "--links", paths["app_to_web_links"], "--account-map", paths["app_account_map"],
              "--out", f"{scratch}/out/app"], spark=spark)
    assert spark.read.parquet(f"{scratch}/out/app").count() > 0
    cli.main(["app", "--sessions", paths["app_sessions"], "--events", paths["app_events"],
              "--links", paths["app_to_web_links"], "--account-map", paths["app_account_map"],
              "--one-row-per-session", "--out", f"{scratch}/out/app1"], spark=spark)
    one = spark.read.parquet(f"{scratch}/out/app1")
    assert one.count() == one.select("distinct_session_id").distinct().count() > 0
    cli.main(["research", "--accounts", paths["accounts"], "--opportunities", paths["opportunities"],
              "--research-log", paths["research_log"], "--out", f"{scratch}/out/research"], spark=spark)
    assert spark.read.parquet(f"{scratch}/out/research").count() == \
        spark.read.parquet(paths["accounts"]).select("main_company_identifier").distinct().count()


def test_cli_link_model(spark, scratch):
    from sessionlens.operators.identity import link_identities
    t = Tables(spark, SF_SMALL)
    names = ("id_history", "contact_keys", "emails", "app_web_lookup", "web_session_facts", "page_views")
    paths = {n: _write(getattr(AD, n)(t), f"{scratch}/in/{n}") for n in names}
    cli.main(["link", "--id-history", paths["id_history"], "--contact-keys", paths["contact_keys"],
              "--emails", paths["emails"], "--lookup", paths["app_web_lookup"],
              "--session-facts", paths["web_session_facts"], "--page-views", paths["page_views"],
              "--out", f"{scratch}/out/link"], spark=spark)
    want = link_identities(*[spark.read.parquet(paths[n]) for n in names])
    assert _same(spark.read.parquet(f"{scratch}/out/link"), want)
    # What ``link`` wrote is what ``app --links`` reads.
    named = F.concat(F.lit("app-"), F.col("user_id").cast("string"))
    for n in ("app_sessions", "app_events"):
        paths[n] = _write(getattr(AD, n)(t).withColumn("user_id", named), f"{scratch}/in/named_{n}")
    paths["map"] = _write(AD.app_account_map(t).withColumn(
        "reference_number", F.concat(F.lit("app-"), "reference_number")), f"{scratch}/in/named_map")
    cli.main(["app", "--sessions", paths["app_sessions"], "--events", paths["app_events"],
              "--links", f"{scratch}/out/link", "--account-map", paths["map"], "--out", f"{scratch}/out/linked"],
             spark=spark)
    linked = spark.read.parquet(f"{scratch}/out/linked")
    assert linked.count() > 0 and linked.filter("primary_account_id IS NOT NULL").count() > 0


def test_scale_settings():
    from sessionlens.session import scale_settings
    big = scale_settings(100 << 40, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    small = scale_settings(50 << 20, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    assert int(big["spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"]) == 4 * (256 << 20)
