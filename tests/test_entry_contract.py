"""The driver contract in a driver-like process: plain SparkSession (Spark's
defaults, non-UTC time zone), module loaded by file path."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = r"""
import importlib.util, sys
sys.path.insert(0, TESTS)
spec = importlib.util.spec_from_file_location("entry_under_test", ENTRY)
m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)
from pyspark.sql import SparkSession
from oracle_compare import compare, duck
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "America/Los_Angeles").getOrCreate())
df = m.entry(spark)
assert df.count() > 0 and len(df.columns) == 83
qs, oracle = m.queries(), m.oracle_sql()
from sessionlens.plans.catalog import QUERIES
assert set(QUERIES) <= set(oracle) <= set(qs) and len(QUERIES) >= 22
con = duck("/root/testdata/sf0.001")
for name in ("milestone_durations", "site_model", "outcomes_after"):
    problems, n = compare(qs[name](spark, "/root/testdata/sf0.001"), con, oracle[name])
    assert not problems, (name, problems)
print("CONTRACT-OK")
"""


def test_driver_like_process():
    code = SCRIPT.replace("TESTS", repr(os.path.join(ROOT, "tests"))).replace(
        "ENTRY", repr(os.path.join(ROOT, "__spark_entry__.py")))
    out = subprocess.run([sys.executable, "-c", code], cwd="/tmp", capture_output=True, text=True, timeout=900)
    assert "CONTRACT-OK" in out.stdout, (out.stdout[-1000:], out.stderr[-3000:])


WITHOUT_LLM = r"""
import sys
sys.path.insert(0, ROOT)
import __spark_entry__ as m
assert m.__file__.startswith(ROOT), m.__file__
from sessionlens.plans.catalog import QUERIES
assert set(m.queries()) == set(QUERIES) and set(QUERIES) <= set(m.oracle_sql()) <= set(QUERIES)
print("WITHOUT-OK")
"""


@pytest.mark.parametrize("pipeline_too", [True, False])
def test_entry_without_the_training_data_subpackage(tmp_path, pipeline_too):
    gone = {os.path.join(ROOT, "sessionlens", "llm"), os.path.join(ROOT, "tests", "llm")}
    if pipeline_too:
        gone.add(os.path.join(ROOT, "corpus_pipeline.py"))

    def left_out(folder, names):
        return [n for n in names if os.path.join(folder, n) in gone or n in (".git", "__pycache__")]

    copy = str(tmp_path / "copy")
    shutil.copytree(ROOT, copy, ignore=left_out)
    code = WITHOUT_LLM.replace("ROOT", repr(copy))
    out = subprocess.run([sys.executable, "-c", code], cwd="/tmp", capture_output=True, text=True, timeout=300,
                         env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert "WITHOUT-OK" in out.stdout, (out.stdout[-1000:], out.stderr[-3000:])
