import random
import re

import frames
import pytest
from pyspark.sql import functions as F

from tierstone.llm import wu_manber as W


def brute(text, items, window=10):
    words = [w for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))]
    hit, names = set(), set()
    for name, item in items:
        parts = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), item or ""))
        size = min(window, len(parts))
        for k in range(len(parts) - size + 1 if size else 0):
            for at in range(len(words) - size + 1):
                if words[at : at + size] == parts[k : k + size]:
                    hit |= set(range(at, at + size))
                    names.add("null" if name is None else str(name))
    return len(words), len(hit), sorted(names)


def tables(spark):
    rng = random.Random(4)
    small = lambda n: [rng.choice("aa bb cc dd é".split()) for _ in range(n)]
    items = [(k, " ".join(frames.sentence(rng, rng.choice([3, 10, 14, 25])))) for k in range(12)]
    items += [(50, " ".join(small(4))), (51, "AA bb"), (52, None), (53, "?!"), (None, "zz yy xx"), (54, "zz yy"), (54, "ww vv")]
    rows = list(frames.ODD)
    for k in range(40):
        words = frames.sentence(rng, rng.randrange(60)) + small(rng.randrange(12))
        if k % 2:
            part = items[rng.randrange(len(items))][1] or ""
            words[len(words) // 2 : len(words) // 2] = part.upper().split()
        rows.append((100 + k, " ".join(words)))
    rows.append((200, " ".join(["zz"] * 3000 + ["yy"] + ["ww vv"] * 50)))
    bench = spark.createDataFrame([(i, t, 1, "d") for i, t in items], "item_id bigint, text string, n_words int, doc_id string")
    return rows, items, frames.docs(spark, rows), bench


@pytest.mark.parametrize("pass_bytes", [1 << 20, 300])
def test_hits_equal_brute_force(spark, pass_bytes):
    rows, items, docs, bench = tables(spark)
    found = W.find_benchmark(docs, bench, pass_bytes=pass_bytes)
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in found.collect()), key=repr)
    assert got == sorted(((i, *brute(t, items)) for i, t in rows), key=repr)
    assert {r["n_hit"] for r in found.collect()} != {0}


@pytest.mark.parametrize("pass_bytes", [1 << 20, 300])
def test_drop_keeps_clean_documents_whole(spark, pass_bytes):
    rows, items, docs, bench = tables(spark)
    left = W.drop_contaminated(docs, bench, pass_bytes=pass_bytes)
    assert left.columns == docs.columns
    assert sorted(repr((r["doc_id"], r["text"])) for r in left.collect()) == sorted(repr(r) for r in rows if not brute(r[1], items)[1])


def test_empty_tables(spark):
    _, _, docs, bench = tables(spark)
    assert W.find_benchmark(docs.limit(0), bench).collect() == []
    assert {r["n_hit"] for r in W.find_benchmark(docs, bench.limit(0)).collect()} == {0}


def test_copies_of_a_benchmark_text_are_searched_once(spark):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(str(k), text) for k in range(60)] + [(f"o{k}", " ".join(f"x{k}y{j}" for j in range(40))) for k in range(5)]
    bench = spark.createDataFrame(rows, "item_id string, text string")
    size = len(text) + 200
    parts = W._parts(W._keyed(bench), size)
    sizes = [sum(len(r["text"]) for r in part.collect()) for part in parts]
    assert max(sizes) <= size and sum(sizes) == sum(len(t) for t in {t for _, t in rows})
    found = W.find_benchmark(frames.docs(spark, [(1, text), (2, "nothing")]), bench, pass_bytes=size).collect()
    assert {r["doc_id"]: r["items"] for r in found} == {1: sorted(str(k) for k in range(60)), 2: []}


def test_clean_documents_stay_spread_out(spark):
    """All of them have the same empty list of items, and must not meet in one task."""
    rows = [(k, f"clean text number {k} of many that hit nothing") for k in range(400)] + [(1000, " ".join(f"w{k}" for k in range(12)))]
    bench = spark.createDataFrame([("i", " ".join(f"w{k}" for k in range(12)))], "item_id string, text string")
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = W.find_benchmark(frames.docs(spark, rows).repartition(8), bench)
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 401 and max(sizes) < 150
        assert [r["doc_id"] for r in found.where("n_hit > 0").collect()] == [1000]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
