"""The silver contracts as projections of the TPC-H-like tables in one folder.

Stand-ins for the bike and gaming landings: rows of a given table become rows of a
contract table, with branches (failed, blank, promotional, retried, ...) chosen by the
row's own values. Limits, classifications and purchases are logs of some event types
only: each type plays one part, and the log takes all rows that play it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstone.session import prepare

FIRST_ORDER_DAY = "1995-01-01"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def country_of(key: Column | str) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.when(k % 3 == 0, "de").when(k % 3 == 1, "at").otherwise("dk")


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _instant(name: str) -> Column:
    return F.col(name).cast("timestamp")


def _cents(name: str) -> Column:
    return F.col(name).cast("decimal(12,2)")


def _money(value: Column) -> Column:
    return value.cast("decimal(34,4)")


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with the number in their properties parsed once, as ``k``."""
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, folder, "events").withColumn("k", k)


def trips(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as trips from order date to ship date."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("ride_id"),
        F.lit("classic_bike").alias("rideable_type"),
        _instant("o_orderdate").alias("started_at"),
        _instant("l_shipdate").alias("ended_at"),
        F.when(F.col("l_suppkey") % 10 != 0, F.concat(F.lit("Station "), _text("l_suppkey"))).alias("start_station_name"),
        _text("l_suppkey").alias("start_station_id"),
        F.concat(F.lit("Station "), _text("l_partkey")).alias("end_station_name"),
        _text("l_partkey").alias("end_station_id"),
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Events as game transactions."""
    n = F.col("k")
    value = _cents("value")
    real = value * F.lit("0.75").cast("decimal(3,2)")

    def pick(event: str, divisor: int, kinds: list[str]) -> Column:
        chosen = F.element_at(F.array(*[F.lit(x) for x in kinds]), n % divisor + 1)
        return F.when(F.col("event_type") == event, chosen)

    kind = F.coalesce(
        pick("purchase", 2, ["BET", "RESERVED_BET"]),
        pick("click", 2, ["WIN", "CASHOUT"]),
        pick("view", 2, ["PAYOUT", "ROLLBACK_CASHOUT"]),
        pick("error", 3, ["ROLLBACK_BET", "ROLLBACK_RESERVED_BET", "ROLLBACK_ROUND"]),
        pick("signup", 2, ["ROLLBACK_WIN", "ADJUSTMENT"]),
    )
    return events(spark, folder).select(
        _text("event_id").alias("transaction_id"),
        _text("user_id").alias("player_id"),
        F.when(n == 0, "  ").when(n < 50, F.concat(F.lit(" "), _text("k"), F.lit(" "))).otherwise(_text("k")).alias("game_id"),
        country_of("user_id").alias("country_code"),
        F.when(F.col("user_id") % 2 == 0, "EUR").otherwise("DKK").alias("currency_code"),
        kind.alias("transaction_type"),
        F.when(F.col("value") < 5, "FAILED").otherwise("SUCCEEDED").alias("transaction_status"),
        F.lit(1).alias("record_version"),
        _instant("ts").alias("created_at"),
        _instant("ts").alias("updated_at"),
        _money(value).alias("amount_eur"),
        _money(real).alias("amount_real_eur"),
        _money(F.when(n % 7 != 0, value - real)).alias("amount_bonus_eur"),
        F.when(n % 5 == 0, 1).otherwise(0).alias("is_promotional"),
    )


def payments(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as payments."""
    price = _cents("o_totalprice")
    fee = price * F.lit("0.01").cast("decimal(3,2)")
    day = _instant("o_orderdate")
    paid_after = F.make_interval(hours=F.col("o_orderkey") % 48)
    return table(spark, folder, "orders").select(
        _text("o_orderkey").alias("payment_id"),
        _text("o_custkey").alias("player_id"),
        country_of("o_custkey").alias("country_code"),
        F.lit("EUR").alias("currency_code"),
        F.when(F.col("o_totalprice") < 250000, "DEPOSIT").when(F.col("o_totalprice") < 400000, "WITHDRAWAL")
        .otherwise("Refund").alias("payment_type"),
        F.col("o_orderpriority").alias("payment_method"),
        F.concat(F.lit("PSP_"), (F.col("o_custkey") % 7).cast("string")).alias("provider_name"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.concat(F.lit("GATE_"), (F.col("o_orderkey") % 3).cast("string")))
        .alias("gateway_name"),
        F.when(F.col("o_orderstatus") == "F", "SUCCEEDED").when(F.col("o_orderstatus") == "O", "PENDING")
        .otherwise("FAILED").alias("status_code"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 1).when(F.col("o_orderpriority") == "2-HIGH", 0)
        .cast("tinyint").alias("first_of_type"),
        _money(price).alias("amount_eur"),
        _money(F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", fee)).alias("fee_eur"),
        _money(price * F.lit("1.10").cast("decimal(3,2)")).alias("converted_amount_eur"),
        F.lit("DKK").alias("converted_currency_code"),
        day.alias("created_at"),
        F.when(F.col("o_orderkey") % 5 != 0, day + paid_after).alias("succeeded_at"),
        F.when(F.col("o_totalprice") < 25000, F.concat(F.lit("D-"), _text("o_orderkey"))).alias("declined_deposit_id"),
        F.lit(1).alias("version"),
    )


def rounds_log(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as versions of game rounds; (order, line) repeats, so rounds have several."""
    day = _instant("l_shipdate")
    price = _cents("l_extendedprice")
    promo = F.col("l_returnflag") == "R"

    def rate(name: str) -> Column:
        return F.col(name).cast("decimal(3,2)")

    return table(spark, folder, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("round_id"),
        _text("l_suppkey").alias("player_id"),
        _text("l_partkey").alias("game_id"),
        country_of("l_suppkey").alias("country_code"),
        F.lit("EUR").alias("currency_code"),
        F.when(promo, 1).otherwise(0).alias("is_promotional"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("is_closed"),
        _money(F.when(F.col("l_quantity") == 1, F.lit(0)).otherwise(price)).alias("bet_amount_eur"),
        _money(price * rate("l_discount")).alias("win_amount_eur"),
        _money(F.when(promo, price * F.lit("0.10").cast("decimal(3,2)")).otherwise(F.lit(0))).alias("bonus_bet_amount_eur"),
        _money(_cents("l_quantity")).alias("bonus_win_amount_eur"),
        _money(price * rate("l_tax")).alias("tax_amount_eur"),
        F.col("l_linenumber").alias("bet_count"),
        F.floor("l_quantity").cast("int").alias("win_count"),
        day.alias("created_at"),
        (day + F.make_interval(mins=F.col("l_linenumber"))).alias("finished_at"),
        (day + F.make_interval(hours=F.col("l_linenumber"))).alias("updated_at"),
        (day + F.make_interval(hours=F.col("l_partkey") % 24)).alias("ingested_at"),
        F.date_diff(F.to_date("l_shipdate"), F.lit(FIRST_ORDER_DAY).cast("date")).alias("version"),
    )


def games(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as the game catalogue."""
    released = F.lit("2020-01-01").cast("timestamp") + F.make_interval(days=F.col("p_size"))
    return table(spark, folder, "part").select(
        _text("p_partkey").alias("game_id"),
        country_of("p_partkey").alias("country_code"),
        F.col("p_name").alias("game_name"),
        F.col("p_brand").alias("game_studio"),
        F.when(F.col("p_size") % 3 == 0, "Casino").when(F.col("p_size") % 3 == 1, "Sports").alias("game_vertical"),
        F.col("p_type").alias("game_type"),
        (F.col("p_size") % 2).cast("tinyint").alias("is_live"),
        _money(F.col("p_size").cast("decimal(12,2)") * F.lit("0.01").cast("decimal(3,2)")).alias("rtp"),
        _money(_cents("p_retailprice")).alias("max_bet"),
        released.alias("released_at"),
        released.alias("updated_at"),
        released.alias("ingested_at"),
    )


def brand_games(spark: SparkSession, folder: str) -> DataFrame:
    """Offered (part, supplier) pairs as brand settings of a game, several per game."""
    offers = table(spark, folder, "lineitem").groupBy("l_partkey", "l_suppkey").agg(
        F.min(_instant("l_shipdate")).alias("_first"), F.max(_instant("l_shipdate")).alias("_last"))
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    never = F.lit("9999-12-31").cast("timestamp") + F.make_interval(days=F.lit(1))
    return offers.join(suppliers, offers.l_suppkey == suppliers.s_suppkey).select(
        F.concat_ws("-", "l_partkey", "l_suppkey").alias("brand_game_id"),
        _text("l_partkey").alias("game_id"),
        country_of("l_partkey").alias("country_code"),
        F.col("s_name").alias("provider_name"),
        F.when(F.col("s_acctbal") > 0, 1).otherwise(0).cast("tinyint").alias("is_enabled"),
        F.lit("OPEN").alias("private_status"),
        F.col("_first").alias("enabled_at"),
        F.col("_first").alias("first_enabled_at"),
        F.when(F.col("s_acctbal") < 0, never).otherwise(F.col("_last")).alias("disabled_at"),
        F.col("_last").alias("updated_at"),
    )


def players_log(spark: SparkSession, folder: str) -> DataFrame:
    """Every order as a change of its customer's player profile."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey")
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    nation = F.col("c_nationkey")
    return orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        _text("o_custkey").alias("player_id"),
        country_of("o_custkey").alias("country_code"),
        (F.lit(FIRST_ORDER_DAY).cast("timestamp") + F.make_interval(days=nation)).alias("created_at"),
        _instant("o_orderdate").alias("changed_at"),
        F.concat(F.lit("\t "), F.col("c_name"), F.lit(" \n")).alias("player_alias"),
        F.when(nation % 5 == 0, " null ").otherwise(nation.cast("string")).alias("region_code"),
        F.col("o_orderpriority").alias("account_tier"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).cast("tinyint").alias("is_verified"),
    )


def tags_log(spark: SparkSession, folder: str) -> DataFrame:
    """Every order as a change of one of its customer's tags."""
    level = F.substring("o_orderpriority", 1, 1)
    category = (
        F.when(level == "1", "TEST").when(level == "2", "CASINO_PLAYER").when(level == "3", "SPORTS_PLAYER")
        .when(level == "4", "VIP").otherwise("NEWSLETTER")
    )
    return table(spark, folder, "orders").select(
        F.concat_ws("-", F.col("o_custkey").cast("string"), level).alias("tag_id"),
        _text("o_custkey").alias("player_id"),
        country_of("o_custkey").alias("country_code"),
        F.when(level == "4", "Entity").otherwise("User").alias("target_type"),
        category.alias("tag_category"),
        F.when(F.col("o_orderstatus") != "F", 1).otherwise(0).cast("tinyint").alias("is_active"),
        _instant("o_orderdate").alias("modified_at"),
    )


def limits_log(spark: SparkSession, folder: str) -> DataFrame:
    """Signup and error events as changes of a player's limit."""
    return table(spark, folder, "events").filter(F.col("event_type").isin("signup", "error")).select(
        _text("user_id").alias("limit_id"),
        _text("user_id").alias("player_id"),
        country_of("user_id").alias("country_code"),
        _money(_cents("value")).alias("limit_value"),
        _instant("ts").alias("modified_at"),
    )


def classifications_log(spark: SparkSession, folder: str) -> DataFrame:
    """Click and view events switching one of three classifications of a player on and off."""
    level = F.col("k") % 3
    return events(spark, folder).filter(F.col("event_type").isin("click", "view")).select(
        F.concat_ws("-", F.col("user_id").cast("string"), level.cast("string")).alias("tag_id"),
        _text("user_id").alias("player_id"),
        country_of("user_id").alias("country_code"),
        F.concat(F.lit("CLASS_"), level.cast("string")).alias("tag_category"),
        F.when(F.col("event_type") == "click", 1).otherwise(0).cast("tinyint").alias("is_active"),
        _instant("ts").alias("modified_at"),
    )


def purchases(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").filter(F.col("event_type") == "purchase").select(
        "event_id",
        _text("user_id").alias("player_id"),
        country_of("user_id").alias("country_code"),
        _instant("ts").alias("happened_at"),
        _cents("value").alias("amount"),
    )


def attempts(spark: SparkSession, folder: str) -> DataFrame:
    """Events as delivery attempts for their user's outbox row."""
    n = F.col("k")
    kind = F.col("event_type")
    status = (
        F.when(kind == "purchase", 200).when(kind == "click", F.when(n % 2 == 0, 201).otherwise(403))
        .when(kind == "view", 404).when(kind == "error", 503).otherwise(F.when(n % 2 == 0, 401).otherwise(0))
    )
    return events(spark, folder).select(
        "event_id",
        _text("user_id").alias("online_customer_id"),
        country_of("user_id").alias("country_code"),
        status.alias("status"),
        (n % 3 + 1).alias("attempt"),
        F.repeat("props", 300).alias("body"),
        _instant("ts").alias("attempted_at"),
    )
