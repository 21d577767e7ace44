import re
from collections import defaultdict

import frames
import pytest
from pyspark.sql import functions as F

from tierstone.llm import block_naming as B


def brute(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(i)
    return groups


def check(rows, found):
    groups = brute(rows)
    assert len(found) == len(rows)
    by_text = defaultdict(list)
    for r in found:
        by_text[(r["keep_id"], r["group_size"], bytes(r["sha"]))].append(r)
    assert len(by_text) == len(groups)
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        members = [rs for (k, n, _), rs in by_text.items() if k == keep and n == len(ids) and sorted(map(repr, ids)) == sorted(repr(r["doc_id"]) for r in rs)]
        assert members, text
        assert sum(r["kept"] for r in members[0]) == 1


@pytest.mark.parametrize("block", [4, 4096])
def test_groups_equal_brute_force(spark, block):
    rows = frames.ODD + [(20 + k, "ab" * n + tail) for k, (n, tail) in enumerate([(50, ""), (50, ""), (50, "x"), (49, "xx"), (51, ""), (2, ""), (50, " \n")])]
    check(rows, B.groups_of_equal_texts(frames.docs(spark, rows), block).collect())


def test_equal_fingerprints_are_told_apart_by_content(spark):
    rows = [(1, "aaaa bbbb"), (2, "aaaa cccc"), (3, "aaaa bbbb"), (4, "dddd")]
    found = B.groups_of_equal_texts(frames.docs(spark, rows), 4, fingerprint=lambda b: F.octet_length(b).cast("bigint")).collect()
    check(rows, found)


def test_drop_keeps_one_row_and_all_columns(spark):
    table = frames.docs(spark, frames.ODD)
    left = B.drop_exact_copies(table)
    assert left.columns == table.columns
    assert left.count() == len(brute(frames.ODD))
    assert frames.rows_of(left.where("text like 'one%'").select("doc_id", "text")) == [(5, "one two three")]


def test_empty_table(spark):
    empty = frames.docs(spark, [])
    assert B.groups_of_equal_texts(empty).collect() == [] and B.drop_exact_copies(empty).collect() == []


def test_no_python_in_the_plan(spark, plan_of):
    assert not re.search("Python|Pandas|Arrow|MapIn", plan_of(B.groups_of_equal_texts(frames.docs(spark, frames.ODD))))
