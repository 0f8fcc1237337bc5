"""Run a model against parquet tables and write its output.

    python -m sessionlens.cli site     --sessions P --events P --out P
    python -m sessionlens.cli app      --sessions P --events P --links P --account-map P --out P
    python -m sessionlens.cli link     --id-history P --contact-keys P --emails P --lookup P \\
                                       --session-facts P --page-views P --out P
    python -m sessionlens.cli research --accounts P --opportunities P --research-log P --out P

``site`` is incremental: the first run builds the table (partitioned by
``DATE``); later runs rebuild from the high-water mark and replace only
the recent partitions.  The other models replace their table; the table
that ``link`` writes is what ``app --links`` reads.  The inputs must have the columns the models read (see FIXTURES.md part A).  Spark
settings come from spark-submit / the cluster; ``--shuffle-bytes`` sizes
shuffle partitions with ``session.scale_settings``.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from sessionlens.operators.identity import link_identities
from sessionlens.operators.refresh import refresh_partitioned
from sessionlens.plans import models as M
from sessionlens.session import get_spark, scale_settings
from sessionlens.sources.sinks import write_table


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sessionlens")
    p.add_argument("--shuffle-bytes", type=int, default=None,
                   help="widest shuffle of the job, to size shuffle partitions")
    p.add_argument("--total-cores", type=int, default=None)
    sub = p.add_subparsers(dest="model", required=True)
    site = sub.add_parser("site", help="web site funnel (incremental)")
    for a in ("--sessions", "--events", "--out"):
        site.add_argument(a, required=True)
    site.add_argument("--lookback-days", type=int, default=1)
    site.add_argument("--unique-sessions", action="store_true",
                      help="input has one row per distinct_session_id: skip the DISTINCT shuffle")
    app = sub.add_parser("app", help="app funnel sessions")
    for a in ("--sessions", "--events", "--links", "--account-map", "--out"):
        app.add_argument(a, required=True)
    app.add_argument("--unique-sessions", action="store_true",
                     help="sessions has no duplicate rows: skip its DISTINCT shuffle")
    app.add_argument("--one-row-per-session", action="store_true",
                     help="keep only the first view time of each session")
    link = sub.add_parser("link", help="app account to web identities")
    for a in ("--id-history", "--contact-keys", "--emails", "--lookup", "--session-facts",
              "--page-views", "--out"):
        link.add_argument(a, required=True)
    research = sub.add_parser("research", help="outcomes after research presentations")
    for a in ("--accounts", "--opportunities", "--research-log", "--out"):
        research.add_argument(a, required=True)
    return p


def main(argv: Sequence[str] | None = None, spark=None) -> None:
    args = _parser().parse_args(argv)
    if spark is None:
        conf = {}
        if args.shuffle_bytes and args.total_cores:
            conf = scale_settings(args.shuffle_bytes, args.total_cores)
        spark = get_spark(f"sessionlens-{args.model}", **conf)
    read = spark.read.parquet
    if args.model == "site":
        sessions, events = read(args.sessions), read(args.events)
        refresh_partitioned(spark, args.out,
                            lambda bound: M.site_model(sessions, events, bound, args.unique_sessions),
                            key="distinct_session_id", date_col="DATE",
                            lookback_days=args.lookback_days)
    elif args.model == "app":
        write_table(M.app_session_model(read(args.sessions), read(args.events), read(args.links),
                                        read(args.account_map), args.unique_sessions,
                                        args.one_row_per_session), args.out)
    elif args.model == "link":
        write_table(link_identities(read(args.id_history), read(args.contact_keys), read(args.emails),
                                    read(args.lookup), read(args.session_facts),
                                    read(args.page_views)), args.out)
    else:
        write_table(M.research_effects(read(args.accounts), read(args.opportunities),
                                       read(args.research_log)), args.out)


if __name__ == "__main__":
    main()
