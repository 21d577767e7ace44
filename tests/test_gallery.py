"""Every named run against its SQL at the smallest scale, and the entry point."""

import json
import os
import re
import subprocess
import sys

import oracle
import pytest

import __spark_entry__ as spark_entry

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = spark_entry.QUERIES, spark_entry.SQL


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(spark_entry.queries()) and set(SQL) <= set(spark_entry.oracle_sql())


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert "sk_txn_kpi" in df.columns and df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, plan_of, name):
    df = QUERIES[name](spark, FOLDER)
    plan = plan_of(df)
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan)
    assert not re.search("PythonUDF|EvalPython|MapInPandas|FlatMapGroups", plan)
    assert oracle.differences(df, duck, SQL[name]) == []


def test_session_zone_does_not_matter(spark, duck):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert oracle.differences(QUERIES["fact_payments"](spark, FOLDER), duck, SQL["fact_payments"]) == []
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_bench_prints_one_json_line():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "BENCH_SF_DIR": FOLDER, "BENCH_CPUS": "2"}
    out = subprocess.run([sys.executable, "bench.py", "net_of_reversals"], cwd=root, env=env, capture_output=True, text=True, timeout=300)
    result = json.loads(out.stdout.strip().splitlines()[-1])
    assert result["sf"] == 0.001 and set(result["queries"]) == {"net_of_reversals"}
