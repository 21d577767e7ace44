import re

import oracle
import pytest

import __spark_entry__ as spark_entry
import corpus_pipeline
from tierstone.llm.queries import QUERIES
from tierstone.llm.sql import SQL

FOLDER = "/root/testdata/sf0.001"
NATIVE = ("op6", "op7")


def test_all_are_registered():
    assert [sum(name.startswith(f"op{n}_") for name in QUERIES) for n in range(1, 14)] == [1] * 13
    assert {*QUERIES, "pipeline"} <= set(spark_entry.queries()) and set(SQL) <= set(spark_entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    assert oracle.differences(QUERIES[name](spark, FOLDER), oracle.connect(FOLDER), SQL[name]) == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_whole_tables(spark, plan_of, name):
    df = QUERIES[name](spark, FOLDER)
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan_of(df))
    if name.startswith(NATIVE):
        assert not re.search("Python|Pandas|Arrow|MapIn", plan_of(df))
    elif not name.startswith(("op5", "op1_", "op11", "op13")):
        assert df.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()


def test_pipeline_keeps_the_columns_and_packs_what_is_left(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    left = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, FOLDER)
        assert left.columns == docs.columns
    kept = {r[0] for r in left.select("doc_id").collect()}
    pieces = corpus_pipeline.run(spark, FOLDER)
    assert {r[0] for r in pieces.select("doc_id").collect()} == kept and 0 < len(kept) < docs.count()
