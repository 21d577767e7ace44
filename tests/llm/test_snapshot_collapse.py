import random
import re
from collections import defaultdict

import frames
import pytest
from pyspark.sql import functions as F

from tierstone.llm import snapshot_collapse as S

SCHEMA = "conv_id bigint, turn bigint, role string, text string, n int, at string, copies int"


def brute(rows):
    by_conv = defaultdict(list)
    none = lambda v: (v is not None, v)
    for c, turn, role, text in rows:
        by_conv[c].append((turn, role, text))
    logs = {c: tuple(t[1:] for t in sorted(ts, key=lambda t: tuple(map(none, t)))) for c, ts in by_conv.items()}
    whole = defaultdict(list)
    for c, log in logs.items():
        whole[log].append(c)
    shorter = {log[:k] for log in logs.values() for k in range(len(log))}
    out = []
    for log, ids in whole.items():
        if log not in shorter:
            text = "".join(f"<|im_start|>{r or ''}\n{t or ''}<|im_end|>\n" for r, t in log)
            out.append((min((i for i in ids if i is not None), default=None), len(log), len(ids), text))
    return sorted(out, key=repr)


def test_maximal_conversations_equal_brute_force(spark, plan_of):
    rng, rows = random.Random(5), []
    base = [[(rng.choice(["user", "assistant"]), f"t{rng.randrange(3)}") for _ in range(9)] for _ in range(6)]
    for c in range(60):
        log = rng.choice(base)[: rng.randrange(1, 9)]
        if rng.random() < 0.2:
            log = [*log, ("user", f"own {c}")]
        rows += [(c, k, role, text) for k, (role, text) in enumerate(log)]
    rows += [(100, 0, None, "x"), (101, 0, "", "x"), (102, 0, "user", None), (103, 0, "user", ""), (103, 0, "user", ""), (104, None, "user", "a"), (None, 0, "user", "n")]
    rows += [(105, k, "user", "long " * 2000) for k in range(300)]
    table = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    found = S.collapse_and_render(table)
    assert frames.rows_of(found.select("conv_id", "n_turns", "copies", "text")) == brute(rows)
    assert not re.search("Python|Pandas|Arrow|MapIn", plan_of(found))


def test_empty_table(spark):
    assert S.collapse_and_render(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("texts", [("ab", "c"), ("a", "bc")])
def test_field_borders_matter(spark, texts):
    rows = [(1, 0, "user", texts[0]), (1, 1, "user", texts[1]), (2, 0, "user", texts[0] + "|"), (2, 1, "user", texts[1]), (2, 2, "x", "y")]
    table = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    assert frames.rows_of(S.collapse_and_render(table).select("conv_id", "n_turns", "copies", "text")) == brute(rows)


def test_one_conversation_of_a_third_of_all_turns_is_dealt_out(spark):
    rows = [(7, k // 3, "user", f"word {k % 50}") for k in range(1500)] + [(None, 0, "user", "same")] * 1500
    rows += [(100 + c, k, "user", f"word {k}") for c in range(500) for k in range(3)]
    table = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    slots = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = S.collapse_and_render(table)
        assert frames.rows_of(found.select("conv_id", "n_turns", "copies", "text")) == brute(rows)
        dealt = table.withColumn("copy", F.monotonically_increasing_id()).repartitionByRange("conv_id", "turn", "role", "text", "copy")
        sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 0.4 * len(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", slots)
