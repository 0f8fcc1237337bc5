"""The rule index against the plain CASE, on random tables and on the models' own."""

import random

import pytest
from pyspark.sql import functions as F

from sessionlens.functions.rule_index import FEW_RULES, RuleIndex, classify_by_index, fixed_to, terms_of
from sessionlens.functions.rules import classify
from sessionlens.plans import site_config as S
from test_rules_differential import COLUMNS, TABLES, _rows

VALUES = ["a", "b", "c", "it's", "", "abc", "xbx"]


def _random_rules(rng, n):
    def quoted(v):
        return "'" + v.replace("'", "''") + "'"

    def test():
        col = rng.choice(["p", "p", "p", "q", "r"])
        kind = rng.randrange(7)
        if kind < 3:
            return f"{col} = {quoted(rng.choice(VALUES))}"
        if kind == 3:
            return f"{col} IN ({', '.join(quoted(rng.choice(VALUES)) for _ in range(rng.randint(1, 3)))})"
        if kind == 4:
            return f"{col} {rng.choice(['LIKE', 'NOT LIKE'])} '%{rng.choice('abx')}%'"
        return f"{col} IS {rng.choice(['NULL', 'NOT NULL'])}"

    def predicate(depth=0):
        if depth == 2 or rng.random() < 0.4:
            return test()
        parts = [predicate(depth + 1) for _ in range(rng.randint(2, 3))]
        joined = rng.choice([" AND ", " OR "]).join(parts)
        return f"({joined})" if depth else joined

    return [(f"label{rng.randrange(n)}", predicate()) for _ in range(n)]


@pytest.mark.parametrize("seed", range(6))
def test_random_tables(spark, seed):
    rng = random.Random(seed)
    rows = [tuple(rng.choice([None, *VALUES]) for _ in range(3)) for _ in range(400)] + [(None, None, None)]
    df = spark.createDataFrame(rows, "p string, q string, r string")
    for _ in range(4):
        rules, default = _random_rules(rng, rng.randint(1, 30)), rng.choice([None, "other"])
        both = df.select("*", RuleIndex(rules, default).column().alias("got"), classify(rules, default).alias("want"))
        assert both.where(~F.col("got").eqNullSafe(F.col("want"))).collect() == [], rules


def test_models_tables(spark):
    df = spark.createDataFrame(_rows(2000, 3), "row_id string, " + ", ".join(f"{c} string" for c in COLUMNS))
    got = classify_by_index(df, TABLES)
    want = df.withColumns({name: classify(rules, default) for name, (rules, default) in TABLES.items()})
    assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_channel_lists_are_short():
    index = RuleIndex(S.CHANNEL_RULES, S.CHANNEL_DEFAULT)
    assert index.key == "utm_source"
    assert len(index.lists) > 20 and max(len(rules) for rules, _ in index.lists.values()) < len(S.CHANNEL_RULES) / 5
    assert index.lists["snapchat"] == ([S.CHANNEL_RULES[0]], True)
    assert len(S.CHANNEL_RULES) >= FEW_RULES


def test_large_tables_stay_out_of_the_fused_method(spark):
    df = spark.range(10).select(*[F.col("id").cast("string").alias(c) for c in COLUMNS])
    plan = classify_by_index(df, {"channel": TABLES["channel"]})._jdf.queryExecution().executedPlan().toString()
    assert plan.lstrip().startswith("Project"), plan         # compiled parts of a plan are marked *(n)


def test_what_is_read_and_refused():
    terms = terms_of("a = 'x' AND (b IN ('it''s', 'z') OR c LIKE '%AND%') OR d IS NULL")
    assert [[t.column for t in term] for term in terms] == [["a", "b"], ["a", "c"], ["d"]]
    assert terms[0][1].values == {"it's", "z"} and terms[2][0].is_null and terms[1][1].values is None
    assert fixed_to(terms[:2], "a") == {"x"} and fixed_to(terms, "a") is None
    assert fixed_to(terms_of("a = 'x' AND a IN ('x', 'y') OR a = 'z'"), "a") == {"x", "z"}
    for wrong in ("NOT (a = 'x')", "a = b", "lower(a) = 'x'", "a = 'x' XOR b = 'y'"):
        with pytest.raises(ValueError, match="not a rule"):
            terms_of(wrong)
