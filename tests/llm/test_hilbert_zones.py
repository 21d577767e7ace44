import random
from math import floor, isfinite

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierstone.llm import hilbert_zones as hz


def brute_force(rows, anchors, positives=5, negatives=3, window=(50, 95)):
    """rows of (vec_id, label, vector), taken as they are."""
    kept = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not isfinite(x) for x in v):
            continue
        whole = (label, [floor(256 * float(x)) for x in v])
        kept[i] = min(whole, kept.get(i, whole))
    out = set()
    for a in filter(anchors, kept):
        label, v = kept[a]
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, (other, w) in kept.items() if i != a)
        best = [(-s, i) for s, i, other in scored if other == label][:positives]
        for score, i in best:
            found = [(j, -s) for s, j, other in scored if other != label and window[0] * score <= -100 * s <= window[1] * score]
            out |= {(a, i, rank, j, score, s) for rank, (j, s) in enumerate(found[:negatives], 1)}
    return out


def run(spark, rows, **how):
    df = spark.createDataFrame([(*r, 7, 8) for r in rows], "vec_id bigint, label int, embedding array<float>, low int, score int")
    found = [tuple(r) for r in hz.hard_negatives(df, F.col("vec_id") % 5 == 0, **how).collect()]
    assert len(found) == len(set(found))
    return set(found)


def vectors(n, dims, seed, labels=4, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dims))
    return [(i, int(k := rng.integers(labels)), (centres[k] * spread + rng.normal(size=dims) * spread).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("dims, labels", [(3, 4), (16, 3)])
def test_equals_brute_force(spark, dims, labels):
    rows = vectors(300, dims, dims, labels)
    assert run(spark, rows, block=8, shelf=4, chunk=5) == brute_force(rows, lambda i: i % 5 == 0) != set()


def test_defined_cases(spark):
    rows = vectors(60, 4, 1)
    nan, inf = float("nan"), float("inf")
    rows += [(100, None, [1.0] * 4), (101, 1, None), (102, 1, [1.0, None, 1.0, 1.0]), (103, 1, [nan] * 4), (105, 1, [inf, 1.0, 1.0, 1.0]),
             (None, 1, [1.0] * 4), (0, 1, [9.0] * 4), (3, 2, rows[3][2]), (3, 2, rows[3][2]), (110, 1, []), (111, 1, [1.0]), (115, 9, [1.0, 1.0])]
    rows += [(200 + i, i % 3, rows[1][2]) for i in range(90)]  # equal vectors tie
    assert run(spark, rows) == brute_force(rows, lambda i: i % 5 == 0)


def test_scores_that_doubles_cannot_hold(spark):
    rng = random.Random(5)
    rows = [(i, i % 2, [rng.choice([3.0e5, 3.0e5 + 1, -3.0e5, 2.5]) for _ in range(8)]) for i in range(80)]
    assert run(spark, rows) == brute_force(rows, lambda i: i % 5 == 0)


def test_huge_components_saturate(spark):
    rows = [(i, i % 2, [3e38 if i % 3 else -3e38, float(i)]) for i in range(20)]
    assert all(abs(r[4]) < 1 << 63 for r in run(spark, rows))


def test_other_numbers_of_answers(spark):
    rows = vectors(200, 6, 8)
    assert run(spark, rows, positives=2, negatives=7, window=(-20, 60)) == brute_force(rows, lambda i: i % 5 == 0, 2, 7, (-20, 60))


def test_nothing_to_find(spark):
    assert run(spark, []) == set() == run(spark, [(1, 1, [1.0])]) == run(spark, [(5, 1, [1.0])])
    assert run(spark, [(5, 1, [1.0]), (6, 1, [1.0])]) == set() == run(spark, [(5, 1, []), (6, 1, []), (7, 2, [])]) - {(5, 6, 1, 7, 0, 0)}


def test_neighbours_on_the_curve_differ_by_one_step():
    side = np.arange(8)
    cells = np.stack(np.meshgrid(side, side, side), axis=-1).reshape(-1, 3)
    keys = [k.tobytes() for k in hz.curve_keys(cells, 3)]
    assert len(set(keys)) == 512
    path = cells[sorted(range(512), key=keys.__getitem__)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_and_skip_blocks(spark):
    """Where vectors form clusters, most blocks are never read."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 8))
    rows = [(i, i % 2, (centres[i % 40] + rng.normal(size=8) * 0.02).astype(np.float32).tolist()) for i in range(8000)]
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>")
    index = hz.Index(hz.materialise(hz.prepared(df), "vectors"), block=64)
    n_blocks = index.blocks.count()
    anchors = index.rows.where("vec_id % 400 = 0").select(F.col("vec_id").alias("anchor_id"), "label", "place", "vector")
    near = anchors.withColumns({"positive_id": F.lit(0), "low": F.lit(1 << 18), "high": F.lit(1 << 40)})
    chunks = hz.materialise(near.mapInArrow(hz._chunks(100), hz.CHUNKS), "chunks")
    dealt = chunks.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(index.deals - 1).cast("bigint"))))
    pairs = dealt.join(index.shelves, "deal").mapInArrow(hz._chosen(True, 0), hz.PAIRS)
    reads = pairs.select((F.length("members") / 4).alias("n")).agg(F.sum("n")).first()[0] or 0
    assert reads < 0.5 * 20 * n_blocks
    v = rng.integers(-50, 50, (30, 6))
    low, high = v.min(axis=0)[None], v.max(axis=0)[None]
    a = rng.integers(-50, 50, (10, 6))
    smallest, largest = hz.bounds(a, low, high)
    assert (smallest <= a @ v.T).all() and (a @ v.T <= largest).all()


def test_what_is_broadcast_does_not_grow_with_the_pairs(spark, plan_of):
    """Files of (chunk, block) pairs are small, what a task or the driver holds of them is not."""
    df = spark.createDataFrame(vectors(600, 8, 3), "vec_id bigint, label int, embedding array<float>")
    index = hz.Index(hz.materialise(hz.prepared(df), "vectors"), block=8, chunk=4)
    anchors = index.rows.where("vec_id % 5 = 0").select(F.col("vec_id").alias("anchor_id"), "label", "place", "vector")
    queries = anchors.withColumns({"positive_id": F.col("anchor_id"), "low": F.lit(hz.LOWEST), "high": F.lit(hz.HIGHEST)})
    plan = plan_of(index.search(queries, True, 3))
    assert "members" not in plan and plan.count("FlatMapCoGroupsInArrow") == 1


def test_chunks_hold_a_vector_once_for_all_queries_of_an_anchor(spark):
    rows = [(anchor, positive, 1, 0, 9, bytes([anchor] * 8)) for anchor in (1, 2) for positive in range(5)]
    df = spark.createDataFrame(rows, "anchor_id bigint, positive_id bigint, label int, low bigint, high bigint, vector binary").coalesce(1)
    (chunk,) = df.sortWithinPartitions("anchor_id").mapInArrow(hz._chunks(100), hz.CHUNKS).collect()
    vectors_, of = hz._anchors_of(chunk.asDict())
    assert vectors_.shape == (2, 2) and of.tolist() == [0] * 5 + [1] * 5
