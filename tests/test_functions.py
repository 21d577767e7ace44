import hashlib
import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tierstone.functions import kpi
from tierstone.functions.keys import NULL_TOKEN, surrogate_key
from tierstone.functions.payload import player_payload
from tierstone.functions.text import clean_str, is_filled, truncated
from tierstone.functions.times import (
    hour_key, hour_key_date, hour_key_floor, iso_utc, null_if_sentinel, with_date, with_duration_minutes,
)


def at(text):
    return datetime.fromisoformat(text)


@pytest.mark.parametrize("start, end, minutes", [
    ("2025-04-10 10:00:00", "2025-04-10 10:10:00", 10.0),
    ("2025-04-10 10:00:00", "2025-04-10 10:30:00", 30.0),
    ("2025-04-10 10:00:00", "2025-04-10 10:00:00", 0.0),
    ("2025-04-10 10:10:00", "2025-04-10 10:00:00", -10.0),
    ("2025-04-10 10:00:00.000", "2025-04-10 10:00:59.999", 59 / 60),
])
def test_duration(spark, start, end, minutes):
    df = spark.createDataFrame([(start, end)], "s string, e string").select(
        F.col("s").cast("timestamp").alias("s"), F.col("e").cast("timestamp").alias("e"))
    assert with_duration_minutes(df, "s", "e", "m").first().m == pytest.approx(minutes)


def test_date_is_taken_in_utc(spark):
    df = spark.sql("select explode(array(timestamp'2025-04-10 22:45:00', timestamp'2025-04-11 00:05:00')) as t")
    assert [r.d for r in with_date(df, "t", "d").orderBy("t").collect()] == [date(2025, 4, 10), date(2025, 4, 11)]


def test_hour_key_follows_daylight_saving(spark):
    times = ["2025-01-15 23:30:00", "2025-07-15 22:30:00", "2025-03-30 00:59:59", "2025-03-30 01:00:00",
             "2025-10-26 00:30:00", "2025-10-26 01:30:00"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "i int, t string").withColumn("t", F.col("t").cast("timestamp"))
    rows = df.select("i", hour_key("t").alias("v"), hour_key("t", "UTC").alias("u")).orderBy("i").collect()
    assert [r.v for r in rows] == [2025011600, 2025071600, 2025033001, 2025033003, 2025102602, 2025102602]
    assert rows[0].u == 2025011523


def test_hour_key_and_date_convert_back(spark):
    df = spark.createDataFrame([(2025033003,)], "k int")
    row = df.select(hour_key_date("k").alias("d"), hour_key_floor(hour_key_date("k")).alias("f")).first()
    assert (row.d, row.f) == (date(2025, 3, 30), 2025033000)


def test_sentinel_and_iso(spark):
    row = spark.sql("select timestamp'9999-12-31' as a, timestamp'9999-12-31' + interval 1 day as b, "
                    "timestamp'2024-05-06 07:08:09.5' as c").select(
        null_if_sentinel("a").isNotNull().alias("a"), null_if_sentinel("b").isNull().alias("b"), iso_utc("c").alias("c")).first()
    assert row.a and row.b and row.c == "2024-05-06T07:08:09.000Z"


def clean_in_python(value):
    if value is None:
        return None
    for ch in "\r\n\t\u2028\u2029":
        value = value.replace(ch, "")
    value = value.strip()
    return None if value == "" or value.lower() == "null" else value


def test_clean_str_strips_what_python_strips(spark):
    spaces = [chr(i) for i in range(0x10000) if chr(i).isspace()]
    cases = [f"{s}a{s}b{s}" for s in spaces] + spaces + [None, "", " null ", "NULL", "nullable", "a\r\nb", "\u200bx\u200b", " ü "]
    df = spark.createDataFrame(list(enumerate(cases)), "i int, v string")
    got = [r.c for r in df.select("i", clean_str("v").alias("c")).orderBy("i").collect()]
    assert got == [clean_in_python(v) for v in cases]


def test_is_filled_and_truncated(spark):
    df = spark.createDataFrame([("a" * 3000,), (" ",), (None,)], "v string")
    rows = df.select(is_filled("v").alias("f"), F.length(truncated("v", 2000)).alias("n")).collect()
    assert [(r.f, r.n) for r in rows] == [(True, 2000), (False, 1), (False, None)]


def test_surrogate_key(spark):
    df = spark.createDataFrame([(7, "de", None)], "a int, b string, c string")
    expected = hashlib.md5(f"7-de-{NULL_TOKEN}".encode()).hexdigest()
    assert df.select(surrogate_key("a", "b", "c").alias("k")).first().k == expected
    assert df.select(surrogate_key("a", "b", "c", null_token="~").alias("k")).first().k == hashlib.md5(b"7-de-~").hexdigest()


def test_payload(spark):
    df = spark.createDataFrame(
        [("1", "de", " null ", None, "\tJörg \n", 1, at("2024-01-02 03:04:05"))],
        "player_id string, country_code string, region_code string, account_tier string, player_alias string, "
        "is_verified tinyint, created_at timestamp")
    got = json.loads(df.select(player_payload(sent_at="2024-02-01 00:00:00").alias("p")).first().p)
    assert got == {
        "collection": "PlayerSummary", "playerId": "1",
        "summary": {"eventType": "profile_refresh", "country": "de", "region": None, "accountTier": None,
                    "playerAlias": "Jörg", "isVerified": 1, "createdOn": "2024-01-02T03:04:05.000Z"},
        "sentAt": "2024-02-01T00:00:00.000Z",
    }


def test_net_of_reversals_by_type(spark):
    kinds = [*kpi.BET_TYPES, *kpi.BET_REVERSALS, *kpi.WIN_TYPES, *kpi.WIN_REVERSALS, "OTHER"]
    df = spark.createDataFrame([(k, i + 1) for i, k in enumerate(kinds)] + [("BET", None), (None, 50)],
                               "transaction_type string, n int")
    df = df.select("transaction_type", F.col("n").cast("decimal(34,4)").alias("a"), F.lit(1).alias("is_promotional"))
    row = df.agg(kpi.net_bets("a").alias("b"), kpi.net_wins("a").alias("w"), kpi.promo_wins("a").alias("p")).first()
    assert (float(row.b), float(row.w), float(row.p)) == (1 + 2 - 3 - 4 - 5, 6 + 7 + 8 - 9 - 10, 21.0)


def test_ratio_and_count_keep_null(spark):
    df = spark.createDataFrame([(0.0, 1)], "b double, p int")
    row = df.agg(kpi.safe_ratio(F.sum("b"), F.sum("b")).alias("r"), kpi.count_when(F.col("p") == 2).alias("n"),
                 kpi.count_when(F.col("p") == 2, zero_fill=True).alias("z")).first()
    assert (row.r, row.n, row.z) == (None, None, 0)
