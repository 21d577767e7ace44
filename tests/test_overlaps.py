"""Intervals in force at events, against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from test_history import OPEN, hours

from tierstone.operators.overlaps import rows_in_force

EVENTS = "id int, k string, country_code string, t timestamp"
SPANS = "name string, k string, country_code string, valid_from timestamp, valid_to timestamp, id long"
KEYS = ["k", "country_code"]


def brute_force(events, spans):
    return sorted((e[0], s[0]) for e in events for s in spans if None not in (e[1], e[2], e[3], s[1], s[2], s[3])
                  and e[1:3] == s[1:3] and s[3] <= e[3] and (s[4] is None or e[3] < s[4]))


def found(spark, events, spans):
    out = rows_in_force(spark.createDataFrame(events, EVENTS), spark.createDataFrame([(*s, 1) for s in spans], SPANS), KEYS, "t", ["name"])
    assert out.columns == ["id", "k", "country_code", "t", "name"]
    return sorted((r.id, r.name) for r in out.collect())


@pytest.mark.parametrize("seed", range(2))
def test_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    spans = []
    for i in range(120):
        start = rng.choice([None, *map(hours, range(-50, 200))])
        end = rng.choice([None, OPEN, *[start and start + (hours(x) - hours(0)) for x in (0, 1, 2, 7, 30, 500, -4)]])
        spans.append((f"s{i}", rng.choice(["a", "b", None]), "de", start, end))
    events = [(i, rng.choice(["a", "b", "c", None]), "de", rng.choice([None, *map(hours, range(100))])) for i in range(80)]
    assert found(spark, events, spans) == brute_force(events, spans) != []


def test_edges_and_empty_sides(spark):
    spans = [("one", "a", "de", hours(1), hours(2)), ("two", "a", "de", hours(1), hours(2))]
    events = [(1, "a", "de", hours(1)), (2, "a", "de", hours(2)), (3, "a", "at", hours(1)), (4, "a", "de", hours(1))]
    assert found(spark, events, spans) == [(1, "one"), (1, "two"), (4, "one"), (4, "two")]
    assert found(spark, [], spans) == found(spark, events, []) == []


def test_long_intervals_are_not_spelt_out(spark):
    events = spark.range(1000).select(F.lit("a").alias("k"), F.timestamp_seconds(F.col("id") * 3600).alias("t"))
    spans = spark.range(50).select(F.lit("a").alias("k"), F.col("id").alias("n"), F.timestamp_seconds(F.col("id")).alias("valid_from"),
                                   F.lit(None).cast("timestamp").alias("valid_to"))
    out = rows_in_force(events, spans, ["k"], "t", ["n"])
    assert out.count() == 50 * 1000 - 49
