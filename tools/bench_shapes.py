"""Literal (original) plan shapes vs the shaped operators, on Spark.

usage: python tools/bench_shapes.py [sf_dir] [runs]
Prints one JSON line with median seconds per (metric, form).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

import literal_shapes as L  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from sessionlens.operators.funnel import funnel_flags  # noqa: E402
from sessionlens.operators.milestones import milestones  # noqa: E402
from sessionlens.plans import app_config as A  # noqa: E402
from sessionlens.plans import models as M  # noqa: E402
from sessionlens.plans import site_config as S  # noqa: E402
from sessionlens.session import get_spark  # noqa: E402
from sessionlens.sources import adapters as AD  # noqa: E402
from sessionlens.sources.tables import Tables  # noqa: E402


def timed(make, runs):
    make().write.format("noop").mode("overwrite").save()
    ts = []
    for _ in range(runs):
        t0 = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        ts.append(time.perf_counter() - t0)
    return round(statistics.median(ts), 3)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    runs = int(sys.argv[2]) if len(sys.argv) > 2 else 5
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark("shapes", master=f"local[{cpus}]", shuffle_partitions=cpus,
                      **{"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    t = Tables(spark, sf)
    # Materialise the adapters once (written to the checkpoint folder) so
    # only the operator is timed.
    base = checkpoint_base(spark)
    ev_path, s_path, w_path = f"{base}/ms_events", f"{base}/web_sessions", f"{base}/web_events"
    (M.linked_app_events(AD.app_events(t), AD.app_to_web_links(t))
     .select("session_id", F.col("time").alias("event_time"), "event_table_name",
             "account_id_user_first_session")
     .write.mode("overwrite").parquet(ev_path))
    AD.web_sessions(t).write.mode("overwrite").parquet(s_path)
    AD.web_events(t).write.mode("overwrite").parquet(w_path)
    ev = lambda: spark.read.parquet(ev_path)
    ws = lambda: spark.read.parquet(s_path)
    we = lambda: spark.read.parquet(w_path)

    def sess():
        stg_s, _ = M.site_staging(ws(), we())
        return stg_s.select("distinct_session_id", "session_id", "user_id").distinct()

    user_steps = [st for st in S.SITE_STEPS if st[1] == "user"]
    out = {
        "milestones_literal": timed(lambda: L.milestones_literal(ev()), runs),
        "milestones_shaped": timed(lambda: milestones(
            ev(), A.MILESTONES, link_time_col="account_id_user_first_session",
            linked_events=A.CONTACT_INFO_EVENTS), runs),
        "funnel_flags_user_literal": timed(lambda: L.funnel_flags_user_literal(sess(), we()), runs),
        "funnel_flags_user_shaped": timed(lambda: funnel_flags(
            sess(), we(), user_steps, allow_list=S.SITE_EVENT_ALLOW_LIST, portal=S.PORTAL), runs),
        "site_model_full_build": timed(lambda: M.site_model(ws(), we()), runs),
        # One refresh batch: the last day and a half of a 30-day table.
        "site_model_refresh_batch": timed(lambda: M.site_model(ws(), we(), "2024-01-29"), runs),
    }
    print(json.dumps({"sf": sf, "runs": runs, "cpus": cpus, "median_sec": out}))


def checkpoint_base(spark):
    """A new folder for this run under the shared checkpoint folder (the
    cluster's setting; a local scratch folder only when it is unset)."""
    import tempfile
    import uuid

    from sessionlens.session import checkpoint_dir
    root = checkpoint_dir(spark, None if spark.conf.get("spark.checkpoint.dir", None)
                          else tempfile.mkdtemp(prefix="shapes-", dir="/tmp"))
    return f"{root.rstrip('/')}/bench-shapes-{uuid.uuid4().hex}"


if __name__ == "__main__":
    main()
