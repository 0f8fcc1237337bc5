"""Time the literal-shape oracle SQL on DuckDB (single node) for comparison.

usage: python tools/bench_oracle.py [sf_dir] [runs]
Prints one JSON line like bench.py (median of warm runs per query).
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

from oracle_compare import duck  # noqa: E402
from sessionlens.plans.oracle import oracle_queries  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    runs = int(sys.argv[2]) if len(sys.argv) > 2 else 3
    con = duck(sf)
    con.execute(f"SET threads = {int(os.environ.get('BENCH_CPUS', '8'))}")
    out = {}
    for name, sql in oracle_queries().items():
        q = f"CREATE OR REPLACE TEMP TABLE result AS {sql}"  # every column of every row is computed
        con.execute(q).fetchall()
        ts = []
        for _ in range(runs):
            t0 = time.perf_counter()
            con.execute(q).fetchall()
            ts.append(time.perf_counter() - t0)
        out[name] = round(statistics.median(ts), 3)
    print(json.dumps({"metric": "duckdb_literal_sum_of_median_query_seconds",
                      "value": round(sum(out.values()), 3), "unit": "sec", "queries": out, "sf": sf}))


if __name__ == "__main__":
    main()
