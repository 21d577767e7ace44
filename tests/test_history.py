import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tierstone.functions.times import open_end
from tierstone.operators import history, timeline

KEYS = ["k", "country_code"]
LOG = "k string, country_code string, changed timestamp, attr string"
OPEN = datetime(9999, 12, 31)
BASE = datetime(2024, 1, 1)


def hours(n):
    return BASE + timedelta(hours=n)


def spans(df):
    return sorted(((r.k, r.country_code, r.attr, r.valid_from, r.valid_to) for r in df.collect()), key=repr)


def history_in_python(log):
    out, seen = [], {}
    for k, c, t, a in log:
        if t is not None:
            seen.setdefault((k, c), {}).setdefault(t, []).append(a)
    for (k, c), at in seen.items():
        times = sorted(at)
        for t, until in zip(times, times[1:] + [OPEN]):
            out.append((k, c, max(at[t]), t, until))
    return sorted(out, key=repr)


def random_log(seed, size=80, keys=4, span=30):
    rng = random.Random(seed)
    log = [(f"k{int(rng.random() ** 3 * keys)}", rng.choice(["de", "at"]), hours(rng.randrange(span)), f"a{i}") for i in range(size)]
    return [*log, (None, "de", hours(1), "n"), (None, "de", hours(3), "n"), ("k0", "de", None, "never")]


@pytest.mark.parametrize("rows_per_slot", [3, 1_000_000])
def test_build_history_matches_brute_force(spark, rows_per_slot):
    log = random_log(rows_per_slot)
    df = history.build_history(spark.createDataFrame(log, LOG), KEYS, "changed", rows_per_slot)
    assert spans(df) == history_in_python(log)
    assert df.select("scd_id").distinct().count() == df.count()
    assert spans(history.current_rows(df)) == [s for s in history_in_python(log) if s[4] == OPEN]


def step(spark, stored, source, **how):
    df = history.snapshot(stored, spark.createDataFrame(source, LOG), KEYS, "changed", run_at="2024-06-01 00:00:00", **how)
    return spark.createDataFrame(df.collect(), df.schema)


def start(spark, log):
    df = history.build_history(spark.createDataFrame(log, LOG), KEYS, "changed")
    return spark.createDataFrame(df.collect(), df.schema)


RUN = datetime(2024, 6, 1)


def test_snapshot_cases(spark):
    stored = start(spark, [("same", "de", hours(1), "a"), ("changed", "de", hours(1), "a"), ("stale", "de", hours(5), "a"),
                           ("chain", "de", hours(1), "a"), ("gone", "de", hours(1), "a"), ("past", "de", hours(0), "a"),
                           ("past", "de", hours(1), "b")])
    source = [("same", "de", hours(1), "a"), ("changed", "de", hours(2), "b"), ("stale", "de", hours(4), "z"),
              ("chain", "de", hours(3), "c"), ("chain", "de", hours(2), "b"), ("past", "de", hours(1), "b"),
              ("new", "de", hours(7), "a"), ("changed", "at", hours(2), "other")]
    expected = [
        ("same", "de", "a", hours(1), OPEN),
        ("changed", "de", "a", hours(1), hours(2)), ("changed", "de", "b", hours(2), OPEN),
        ("stale", "de", "a", hours(5), OPEN),
        ("chain", "de", "a", hours(1), hours(2)), ("chain", "de", "b", hours(2), hours(3)), ("chain", "de", "c", hours(3), OPEN),
        ("gone", "de", "a", hours(1), RUN),
        ("past", "de", "a", hours(0), hours(1)), ("past", "de", "b", hours(1), OPEN),
        ("new", "de", "a", hours(7), OPEN), ("changed", "at", "other", hours(2), OPEN),
    ]
    after = step(spark, stored, source)
    assert spans(after) == sorted(expected, key=repr)
    assert spans(step(spark, after, source)) == spans(after), "a rerun changes nothing"
    kept = step(spark, stored, source, hard_deletes=False)
    assert ("gone", "de", "a", hours(1), OPEN) in spans(kept)
    assert spans(step(spark, stored, source, rows_per_slot=1)) == spans(after)


def test_reappearance_after_a_hard_delete(spark):
    stored = start(spark, [("x", "de", hours(1), "a"), ("y", "de", hours(1), "a")])
    without = step(spark, stored, [("y", "de", hours(1), "a")])
    back = step(spark, without, [("x", "de", hours(9000), "b"), ("y", "de", hours(1), "a")])
    assert spans(back) == sorted([("x", "de", "a", hours(1), RUN), ("x", "de", "b", hours(9000), OPEN),
                                  ("y", "de", "a", hours(1), OPEN)], key=repr)


def test_stepwise_equals_batch_without_deletes(spark):
    log = [r for r in random_log(11, size=40) if r[0] is not None and r[2] is not None]
    log.sort(key=lambda r: r[2])
    cut = hours(15)
    stored = start(spark, [r for r in log if r[2] < cut])
    after = step(spark, stored, [r for r in log if r[2] >= cut], hard_deletes=False)
    assert spans(after) == history_in_python(log)


# --- look-ups on the timeline ---------------------------------------------------------


def as_of_in_python(events, log):
    rows = history_in_python(log)
    out = []
    for e in events:
        hit = [r for r in rows if r[0] == e[1] and r[1] == e[2] and e[3] is not None and r[3] <= e[3] < r[4] and r[0] is not None]
        out.append((e[0], hit[0][2] if hit else None))
    return sorted(out)


EVENTS = "id int, k string, country_code string, t timestamp"


def random_events(seed, size=120, crowd=0):
    rng = random.Random(seed + 100)
    rows = [(i, f"k{int(rng.random() ** 3 * 4)}", rng.choice(["de", "at"]), hours(rng.randrange(-3, 35))) for i in range(size)]
    rows += [(size + i, "k0", "de", hours(10)) for i in range(crowd)]
    n = len(rows)
    return [*rows, (n, None, "de", hours(2)), (n + 1, "k0", "de", None), (n + 2, "unknown", "de", hours(2))]


@pytest.mark.parametrize("rows_per_slot, crowd", [(4, 200), (25, 60), (1_000_000, 0)])
def test_as_of_join_matches_brute_force(spark, rows_per_slot, crowd):
    log, events = random_log(rows_per_slot + crowd), random_events(rows_per_slot, crowd=crowd)
    stored = start(spark, log)
    out = timeline.as_of_join(spark.createDataFrame(events, EVENTS).repartition(3), stored, KEYS, "t", ["attr"], rows_per_slot=rows_per_slot)
    assert sorted((r.id, r.attr) for r in out.collect()) == as_of_in_python(events, log)


@pytest.mark.parametrize("rows_per_slot, crowd", [(4, 200), (1_000_000, 0)])
def test_active_flags_match_brute_force(spark, rows_per_slot, crowd):
    rng = random.Random(rows_per_slot)
    intervals = []
    for i in range(60):
        a = rng.randrange(30)
        intervals.append((f"k{rng.randrange(3)}", rng.choice(["de", "at"]), rng.choice(["A", "B", "C"]), hours(a),
                          rng.choice([hours(a + rng.randrange(1, 9)), OPEN, None])))
    events = random_events(rows_per_slot, crowd=crowd)
    expected = []
    for e in events:
        def on(label):
            return int(any(r[0] == e[1] and r[1] == e[2] and r[2] == label and e[3] is not None and r[3] <= e[3]
                           and (r[4] is None or e[3] < r[4]) for r in intervals))
        expected.append((e[0], on("A"), on("B")))
    df = spark.createDataFrame(intervals, "k string, country_code string, label string, valid_from timestamp, valid_to timestamp")
    out = timeline.active_flags_at(spark.createDataFrame(events, EVENTS), df, KEYS, "t", "label", {"A": "a", "B": "b"},
                                   rows_per_slot=rows_per_slot)
    assert sorted((r.id, r.a, r.b) for r in out.collect()) == sorted(expected)


def test_hot_key_is_cut_into_even_slots(spark):
    """A third of all rows on one key: no (key, slot) may keep them together."""
    points = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id").cast("string"))).alias("k"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * F.col("id")).alias("t"))
    slots = timeline.find_slots(points, ["k"], "t", rows_per_slot=100)
    assert slots.cuts.count() == 1
    sizes = slots.place(points, "t").groupBy("k", timeline.SLOT).count()
    biggest = sizes.agg(F.max("count")).first()[0]
    assert biggest <= 150
    assert timeline.find_slots(points, ["k"], "t", rows_per_slot=1000).cuts is None


def test_crowded_instant_is_dealt_out(spark):
    points = spark.range(4000).select(F.lit("hot").alias("k"), "id",
                                      F.timestamp_seconds(F.when(F.col("id") < 3000, 1000).otherwise(F.col("id"))).alias("t"))
    slots = timeline.find_slots(points.select("k", "t"), ["k"], "t", rows_per_slot=250)
    sizes = slots.place(points, "t", spread_by=["id"]).groupBy(timeline.SLOT).count()
    assert sizes.agg(F.max("count")).first()[0] <= 800


def test_open_end_literal(spark):
    assert spark.range(1).select(open_end().alias("t")).first().t == OPEN
