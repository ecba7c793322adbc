import os
import subprocess
import sys

import __spark_entry__ as entry

from tests.oracle_check import compare

SMALL = "/root/testdata/sf0.001"


def test_entry_returns_rows(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"k", "sa", "da", "tpkt", "line"} <= set(df.columns)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_registry_imports_without_a_jvm_or_jars():
    """Importing every query module reads no file of the Spark install and starts no JVM."""
    code = """
import builtins, glob, os, subprocess, zipfile
def refuse(*a, **k): raise AssertionError("touched the Spark install at import")
zipfile.ZipFile = glob.glob = subprocess.Popen = refuse
import __spark_entry__ as e
assert len(e.queries()) > 40 and len(e.oracle_sql()) > 30
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "SPARK_HOME"}
    run = subprocess.run([sys.executable, "-c", code], cwd=root, env=env, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr[-2000:]


def test_flow_queries_match_oracle_small(spark):
    names = ["flow_features_all", "flow_rejects", "policy_match_any_bucket", "anonymize_with_mapping",
             "order_by_key", "syslog_tfidf"]
    res = compare(spark, SMALL, names, verbose=False)
    assert all(v[0] == "OK" for v in res.values()), res
