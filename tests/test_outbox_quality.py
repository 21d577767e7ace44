from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tierstone.operators import outbox, quality

SENT, RETRY, DEAD = outbox.SENT, outbox.RETRY, outbox.DEAD


@pytest.mark.parametrize("status, attempts", [
    (200, [(SENT, None), (SENT, None), (SENT, None)]),
    (201, [(RETRY, 2), (RETRY, 4), (DEAD, None)]),
    (302, [(RETRY, 2), (RETRY, 4), (DEAD, None)]),
    (401, [(RETRY, 0), (RETRY, 0), (DEAD, None)]),
    (403, [(RETRY, 0), (RETRY, 0), (DEAD, None)]),
    (404, [(DEAD, None), (DEAD, None), (DEAD, None)]),
    (500, [(RETRY, 2), (RETRY, 4), (DEAD, None)]),
    (0, [(RETRY, 2), (RETRY, 4), (DEAD, None)]),
])
def test_classify(spark, status, attempts):
    df = spark.createDataFrame([(status, n) for n in (1, 2, 3)], "status int, attempt int")
    rows = outbox.classify_attempts(df).orderBy("attempt").collect()
    assert [(r.outcome, r.retry_after_s) for r in rows] == attempts


BOX = ("online_customer_id string, country_code string, payload_json string, source_updated_at timestamp, "
       "dispatched_at timestamp, dispatch_error string")


def box(spark):
    d = datetime(2024, 1, 1)
    return spark.createDataFrame([
        ("ok", "de", "{}", d, None, "earlier error"), ("fail", "de", "{}", datetime(2023, 1, 1), None, None),
        ("quiet", "de", "{}", datetime(2022, 1, 1), None, "old"), ("done", "de", "{}", d, d, None), ("ok", "at", "{}", d, None, None)], BOX)


def test_outbox_cycle(spark):
    results = spark.createDataFrame([("ok", "de", True, "ignored"), ("fail", "de", False, "e" * 3000)],
                                    "online_customer_id string, country_code string, ok boolean, error string")
    after = outbox.apply_results(box(spark), results, now="2024-02-01 00:00:00")
    rows = {(r.online_customer_id, r.country_code): r for r in after.collect()}
    assert (rows["ok", "de"].dispatched_at, rows["ok", "de"].dispatch_error) == (datetime(2024, 2, 1), None)
    assert rows["fail", "de"].dispatched_at is None and len(rows["fail", "de"].dispatch_error) == 2000
    assert rows["quiet", "de"].dispatch_error == "old" and rows["ok", "at"].dispatched_at is None
    assert rows["done", "de"].dispatched_at == datetime(2024, 1, 1)
    assert {r.online_customer_id for r in outbox.dead_letters(after).collect()} == {"fail", "quiet"}
    assert [r.online_customer_id for r in outbox.pending(after).collect()] == ["quiet", "fail", "ok"]
    assert [r.country_code for r in outbox.pending(after, include_failed=False).collect()] == ["at"]
    s = outbox.dispatch_summary(results, elapsed_seconds=0.5).first()
    assert (s.processed, s.succeeded, s.failed, s.rows_per_second) == (2, 1, 1, 4.0)
    assert outbox.reset_dispatch(after).filter("dispatched_at is not null or dispatch_error is not null").isEmpty()


def table(spark):
    return spark.createDataFrame([(1, "a", 5.0, 2026010110), (1, "A", 0.0, 2026010211), (2, "x", -1.0, 2026010312), (None, None, None, None)],
                                 "id int, kind string, amount double, sk_date_time int")


def collected(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_checks(spark):
    df = table(spark)
    assert quality.not_null(df, "id").count() == 1
    assert collected(quality.unique(df, "id")) == [(1, 2)]
    assert quality.unique(df, ["id", "kind"]).isEmpty()
    assert collected(quality.accepted_values(df, "kind", ["a"])) == [("A", 1), ("x", 1)]
    assert collected(quality.accepted_values(df, "kind", ["A"], ignore_case=True)) == [("x", 1)]
    parent = spark.createDataFrame([(1,)], "key int")
    assert collected(quality.relationships(df, "id", parent, "key")) == [(2, 1)]
    assert quality.not_positive(df, "amount").count() == 2
    assert [r.sk_date_time for r in quality.future_hour_keys(df, as_of="2026-01-02").collect()] == [2026010312]
    assert quality.empty_table(df).isEmpty() and quality.empty_table(df.limit(0)).count() == 1
    assert quality.bad_share(df, F.col("amount") < 0, limit=0.3).isEmpty()
    assert quality.bad_share(df, F.col("amount") < 0).first().bad_rows == 1
    assert quality.bad_share(df.limit(0), F.col("amount") < 0).isEmpty()
    assert quality.column_contract(df, ["kind", "id", "amount", "sk_date_time"]) == ["columns are in another order"]
    assert quality.column_contract(df, ["id", "kind", "amount", "sk_date_time", "z"]) == ["missing: z"]


def test_formula_order_and_maps(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, {"a": "1"}), (2.0, 1.0, 3.0, {"a": "1", "b": "2"}), (1.0, 4.0, 3.0, None)],
                               "lo double, mid double, hi double, m map<string,string>")
    assert quality.out_of_order(df, "lo", "mid", "hi").count() == 2
    assert quality.missing_map_keys(df, "m", ["a", "b"]).count() == 2
    bad = quality.formula_mismatch(df, "hi", F.col("lo") + F.col("mid"))
    assert [(r.expected, r.deviation) for r in bad.collect()] == [(5.0, 2.0)]


def test_report(spark):
    df = table(spark)
    report = quality.run_row_checks(df, [quality.RowCheck("id_filled", F.col("id").isNull(), "warn"),
                                         quality.RowCheck("positive", F.col("amount") <= 0)])
    assert collected(report) == [("id_filled", "warn", 1), ("positive", "error", 2)]
    with pytest.raises(ValueError, match="positive"):
        quality.require_clean(report)
    quality.require_clean(report.filter("severity = 'warn'"))
    assert collected(quality.tally({"u": ("error", quality.unique(df, "id"))})) == [("u", "error", 1)]
