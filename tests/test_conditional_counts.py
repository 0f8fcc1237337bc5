"""A5: conditional distinct counts against COUNT(DISTINCT CASE), nulls, many conditions, a hot group."""

import random

from inline_tables import register
from oracle_compare import compare
from pyspark.sql import functions as F

from sessionlens.operators import funnel
from sessionlens.operators.funnel import conditional_distinct_counts


def _rows(n=1500):
    rng = random.Random(3)
    return [(str(i), rng.choice(["hot", "hot", "a", "b", None]), rng.choice([None, 1, 2]),
             rng.choice([None, *range(40)]), rng.choice([None, *"abcdefgh"])) for i in range(n)] + [("x", "no ids", 1, None, "a")]


def test_counts_match_count_distinct(spark, monkeypatch):
    con, frames = register(spark, {"rows": ([("row_id", "string"), ("g", "string"), ("h", "bigint"), ("id", "bigint"),
                                             ("name", "string")], _rows())})
    conditions = {f"c{k}": F.col("name") == v for k, v in enumerate("abcdefghz")}
    conditions |= {"any_name": F.col("name").isNotNull(), "never": F.lit(False), "unknown": F.lit(None).cast("boolean")}
    sql = ("SELECT g, h, " + ", ".join(f"count(DISTINCT CASE WHEN name = '{v}' THEN id END) AS c{k}" for k, v in enumerate("abcdefghz"))
           + ", count(DISTINCT CASE WHEN name IS NOT NULL THEN id END) AS any_name, 0::BIGINT AS never, 0::BIGINT AS unknown"
             " FROM rows GROUP BY g, h")
    for bits in (62, 5):
        monkeypatch.setattr(funnel, "MASK_BITS", bits)
        got = conditional_distinct_counts(frames["rows"], ["g", "h"], "id", conditions)
        problems, n = compare(got, con, sql)
        assert not problems and n > 10, problems


def test_plan_repeats_no_rows(spark):
    rows = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    got = conditional_distinct_counts(rows, ["g"], "id", {f"c{k}": F.col("id") > k for k in range(16)})
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("HashAggregate") >= 4
    assert {r["c0"] for r in got.collect()} == {33}


def test_empty_rows(spark):
    rows = spark.createDataFrame([], "g long, id long")
    assert conditional_distinct_counts(rows, ["g"], "id", {"c": F.col("id") > 0}).collect() == []
