"""The stored history: runs, what they write, crashes."""

import random

import pytest

from test_history import KEYS, LOG, RUN, hours, random_log, spans, start, step

from tierstone.operators.history import build_history
from tierstone.operators.history_table import HistoryTable
from tierstone.session import scratch_dir
from tierstone.sources import heads
from tierstone.sources.tables import child_names, folder_bytes

@pytest.fixture()
def table(spark):
    return HistoryTable(spark, f"{scratch_dir(spark, 'test-history')}/t", KEYS, "changed", spark.createDataFrame([], LOG).schema, buckets=4)


def run(table, rows, **how):
    return table.step(table.spark.createDataFrame(rows, LOG), RUN, **how)


@pytest.mark.parametrize("hard_deletes", [True, False])
def test_runs_equal_snapshots(spark, table, hard_deletes):
    rng = random.Random(4)
    log = [r for r in random_log(21, size=60) if r[0] is not None and r[2] is not None]
    expected = build_history(spark.createDataFrame([], LOG), KEYS, "changed")
    for _ in range(4):
        source = rng.sample(log, 25)
        expected = step(spark, expected, source, hard_deletes=hard_deletes)
        expected = spark.createDataFrame(expected.select(*table.schema.fieldNames()).collect(), table.schema)
        run(table, source, hard_deletes=hard_deletes)
        assert spans(table.read()) == spans(expected)
    assert spans(table.current()) == [r for r in spans(expected) if r[4].year == 9999]
    assert set(table.read().columns) == set(start(spark, log).columns)


def files(spark, folder):
    return {(n, f, folder_bytes(spark, f"{folder}/{n}/{f}")) for n in child_names(spark, folder) for f in child_names(spark, f"{folder}/{n}")}


def test_closed_files_and_other_buckets_are_not_touched(spark, table):
    rows = [(f"k{i}", "de", hours(1), "a") for i in range(400)]
    run(table, rows)
    run(table, [*rows[1:], ("k0", "de", hours(2), "b")])
    closed, first = files(spark, f"{table.path}/closed"), heads.newest(spark, table.path)
    assert run(table, [*rows[2:], ("k0", "de", hours(2), "b"), ("k1", "de", hours(3), "c")])
    assert closed < files(spark, f"{table.path}/closed")
    second = heads.newest(spark, table.path)
    assert sum(second.generations[b] != g for b, g in first.generations.items()) == 1
    assert table.closed().count() == 2 and table.current().count() == 400
    again = files(spark, f"{table.path}/closed")
    assert not run(table, [*rows[2:], ("k0", "de", hours(2), "b"), ("k1", "de", hours(3), "c")])
    assert files(spark, f"{table.path}/closed") == again


def test_delete_and_return(spark, table):
    run(table, [("x", "de", hours(1), "a"), ("y", "de", hours(1), "a")])
    run(table, [("y", "de", hours(1), "a")])
    assert [r[0] for r in spans(table.current())] == ["y"]
    run(table, [])
    assert table.current().count() == 0
    run(table, [("x", "de", hours(9000), "b")])
    assert [r[:3] for r in spans(table.current())] == [("x", "de", "b")] and table.closed().count() == 2


def test_a_run_that_breaks_off_changes_nothing(spark, table, monkeypatch):
    run(table, [("x", "de", hours(1), "a")])
    before = spans(table.read())

    def crash(*_):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as broken:
        broken.setattr(heads, "publish", crash)
        with pytest.raises(RuntimeError):
            run(table, [("x", "de", hours(2), "b"), ("z", "de", hours(2), "b")])
    assert spans(table.read()) == before
    run(table, [("x", "de", hours(2), "c")])
    assert [r[2] for r in spans(table.read())] == ["a", "c"]


def test_the_closed_part_is_not_read_by_a_run(spark, table, plan_of):
    run(table, [("x", "de", hours(1), "a")])
    run(table, [("x", "de", hours(2), "b")])
    assert "/closed" not in plan_of(table.current()) + plan_of(table.changed_keys(table.current(), spark.createDataFrame([], LOG), True))
