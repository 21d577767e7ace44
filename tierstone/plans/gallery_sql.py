"""The gallery's runs as plain SQL over the same tables, for comparison in another engine."""

from __future__ import annotations

from tierstone.functions.keys import NULL_TOKEN
from tierstone.plans.gallery import EVENTS_AS_OF, NOW, ORDERS_AS_OF, SPLIT

OPEN = "TIMESTAMP '9999-12-31 00:00:00'"


def country(key: str) -> str:
    return f"CASE {key} % 3 WHEN 0 THEN 'de' WHEN 1 THEN 'at' ELSE 'dk' END"


def vienna(ts: str) -> str:
    return f"timezone('Europe/Vienna', timezone('UTC', {ts}))"


def hour_key(ts: str) -> str:
    return f"CAST(strftime({vienna(ts)}, '%Y%m%d%H') AS INTEGER)"


def key(*parts: str) -> str:
    texts = ", ".join(f"coalesce(CAST({p} AS VARCHAR), '{NULL_TOKEN}')" for p in parts)
    return f"md5(concat_ws('-', {texts}))"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


TRIPS = """trips AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS ride_id,
         o_orderdate AS started_at, l_shipdate AS ended_at,
         CASE WHEN l_suppkey % 10 <> 0 THEN 'Station ' || l_suppkey END AS start_station_name,
         CAST(l_suppkey AS VARCHAR) AS start_station_id,
         'Station ' || l_partkey AS end_station_name,
         CAST(l_partkey AS VARCHAR) AS end_station_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
trip_silver AS (
  SELECT ride_id, CAST(started_at AS DATE) AS trip_start_date, started_at, ended_at,
         start_station_name, end_station_name,
         (floor(epoch(ended_at)) - floor(epoch(started_at))) / 60 AS trip_duration_mins
  FROM trips)"""

DAILY = """SELECT trip_start_date, round(max(trip_duration_mins), 2) AS max_trip_duration_mins,
  round(min(trip_duration_mins), 2) AS min_trip_duration_mins,
  round(avg(trip_duration_mins), 2) AS avg_trip_duration_mins, count(ride_id) AS total_trips
FROM trip_silver GROUP BY trip_start_date"""

TXN = f"""ev AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS n,
         CAST(value AS DECIMAL(12,2)) AS v FROM events),
txn AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id, CAST(user_id AS VARCHAR) AS player_id,
    CASE WHEN n = 0 THEN '  ' WHEN n < 50 THEN ' ' || n || ' ' ELSE CAST(n AS VARCHAR) END AS game_id,
    {country('user_id')} AS country_code,
    CASE WHEN user_id % 2 = 0 THEN 'EUR' ELSE 'DKK' END AS currency_code,
    CASE event_type
      WHEN 'purchase' THEN CASE n % 2 WHEN 0 THEN 'BET' ELSE 'RESERVED_BET' END
      WHEN 'click' THEN CASE n % 2 WHEN 0 THEN 'WIN' ELSE 'CASHOUT' END
      WHEN 'view' THEN CASE n % 2 WHEN 0 THEN 'PAYOUT' ELSE 'ROLLBACK_CASHOUT' END
      WHEN 'error' THEN CASE n % 3 WHEN 0 THEN 'ROLLBACK_BET' WHEN 1 THEN 'ROLLBACK_RESERVED_BET' ELSE 'ROLLBACK_ROUND' END
      ELSE CASE n % 2 WHEN 0 THEN 'ROLLBACK_WIN' ELSE 'ADJUSTMENT' END END AS transaction_type,
    CASE WHEN value < 5 THEN 'FAILED' ELSE 'SUCCEEDED' END AS transaction_status,
    ts AS created_at,
    CAST(v AS DECIMAL(18,4)) AS amount_eur,
    CAST(v * 0.75 AS DECIMAL(18,4)) AS amount_real_eur,
    CAST(CASE WHEN n % 7 <> 0 THEN v - v * 0.75 END AS DECIMAL(18,4)) AS amount_bonus_eur,
    CASE WHEN n % 5 = 0 THEN 1 ELSE 0 END AS is_promotional
  FROM ev),
game_txn AS (
  SELECT * EXCLUDE (game_id), trim(game_id) AS game_id, {hour_key('created_at')} AS sk_date_time
  FROM txn WHERE transaction_status = 'SUCCEEDED' AND game_id IS NOT NULL AND trim(game_id) <> '')"""

TAGS_LOG = f"""tags_log AS (
  SELECT o_custkey || '-' || o_orderpriority[1] AS tag_id, CAST(o_custkey AS VARCHAR) AS player_id,
    {country('o_custkey')} AS country_code,
    CASE WHEN o_orderpriority[1] = '4' THEN 'Entity' ELSE 'User' END AS target_type,
    CASE o_orderpriority[1] WHEN '1' THEN 'TEST' WHEN '2' THEN 'CASINO_PLAYER' WHEN '3' THEN 'SPORTS_PLAYER'
      WHEN '4' THEN 'VIP' ELSE 'NEWSLETTER' END AS tag_category,
    CASE WHEN o_orderstatus <> 'F' THEN 1 ELSE 0 END AS is_active,
    o_orderdate AS modified_at
  FROM orders)"""

TAGS = TAGS_LOG + """,
tags AS (
  SELECT * FROM tags_log
  QUALIFY row_number() OVER (PARTITION BY tag_id, country_code ORDER BY modified_at DESC, is_active DESC) = 1)"""

FLAGS = """flags AS (
  SELECT player_id, country_code,
    max(CASE WHEN tag_category = 'TEST' AND is_active = 1 THEN 1 ELSE 0 END) AS is_test,
    max(CASE WHEN tag_category = 'CASINO_PLAYER' AND is_active = 1 THEN 1 ELSE 0 END) AS is_casino_player,
    max(CASE WHEN tag_category = 'SPORTS_PLAYER' AND is_active = 1 THEN 1 ELSE 0 END) AS is_sports_player
  FROM tags WHERE target_type = 'User' AND tag_category IN ('TEST', 'CASINO_PLAYER', 'SPORTS_PLAYER')
  GROUP BY player_id, country_code)"""

GAMES = f"""games AS (
  SELECT CAST(p_partkey AS VARCHAR) AS game_id, {country('p_partkey')} AS country_code, p_name AS name,
    p_brand AS studio, CASE p_size % 3 WHEN 0 THEN 'Casino' WHEN 1 THEN 'Sports' END AS vertical,
    p_type AS type, p_size % 2 AS live, CAST(p_size AS DECIMAL(12,2)) * 0.01 AS rtp, p_retailprice AS max_bet,
    TIMESTAMP '2020-01-01 00:00:00' + to_days(p_size) AS released_at
  FROM part)"""


def net(column: str, plus: str, minus: str) -> str:
    return (f"round(sum(CASE WHEN transaction_type IN ({plus}) THEN coalesce({column}, 0) ELSE 0 END)"
            f" - sum(CASE WHEN transaction_type IN ({minus}) THEN coalesce({column}, 0) ELSE 0 END), 4)")


def bets(column: str) -> str:
    return net(column, "'BET','RESERVED_BET'", "'ROLLBACK_BET','ROLLBACK_RESERVED_BET','ROLLBACK_ROUND'")


def wins(column: str) -> str:
    return net(column, "'WIN','PAYOUT','CASHOUT'", "'ROLLBACK_WIN','ROLLBACK_CASHOUT'")


PROMO = "is_promotional = 1 AND transaction_type IN ('WIN','PAYOUT','CASHOUT')"
PROMO_BONUS = f"round(sum(CASE WHEN {PROMO} THEN coalesce(amount_bonus_eur, 0) ELSE 0 END), 4)"
PROMO_TOTAL = (f"round(sum(CASE WHEN {PROMO} THEN coalesce(amount_real_eur, 0) + coalesce(amount_bonus_eur, 0)"
               " ELSE 0 END), 4)")


def kpi_ctes(where: str = "TRUE") -> list[str]:
    return [TXN, TAGS, FLAGS, GAMES, f"""agg AS (
  SELECT sk_date_time, player_id, game_id, currency_code, country_code,
    {bets('amount_eur')} AS bets_eur, {wins('amount_eur')} AS wins_eur,
    {bets('amount_real_eur')} AS bets_real_eur, {wins('amount_real_eur')} AS wins_real_eur,
    {bets('amount_bonus_eur')} AS bets_bonus_eur, {wins('amount_bonus_eur')} AS wins_bonus_eur,
    {PROMO_BONUS} AS promo_wins_bonus_eur, {PROMO_TOTAL} AS total_promo_wins_eur,
    count(transaction_id) AS src_row_count
  FROM game_txn t
  WHERE {where} AND NOT EXISTS (SELECT 1 FROM tags g WHERE g.player_id = t.player_id
    AND g.country_code = t.country_code AND target_type = 'User' AND tag_category = 'TEST' AND is_active = 1)
  GROUP BY ALL),
kpi AS (
  SELECT {key('a.sk_date_time', 'a.player_id', 'a.game_id', 'a.currency_code', 'a.country_code')} AS sk_txn_kpi,
    a.sk_date_time, a.player_id, a.game_id, a.currency_code, a.country_code,
    coalesce(g.vertical, 'UNKNOWN') AS vertical, coalesce(g.studio, 'UNKNOWN') AS studio,
    coalesce(g.type, 'UNKNOWN') AS game_type,
    CAST(bets_eur AS DOUBLE) AS bets_eur, CAST(wins_eur AS DOUBLE) AS wins_eur,
    CAST(bets_eur - wins_eur AS DOUBLE) AS ggr_eur,
    CAST(bets_real_eur AS DOUBLE) AS bets_real_eur, CAST(wins_real_eur AS DOUBLE) AS wins_real_eur,
    CAST(bets_real_eur - wins_real_eur AS DOUBLE) AS ggr_real_eur,
    CAST(bets_bonus_eur AS DOUBLE) AS bets_bonus_eur, CAST(wins_bonus_eur AS DOUBLE) AS wins_bonus_eur,
    CAST(bets_bonus_eur - wins_bonus_eur AS DOUBLE) AS ggr_bonus_eur,
    CAST(promo_wins_bonus_eur AS DOUBLE) AS promo_wins_bonus_eur,
    CAST(total_promo_wins_eur AS DOUBLE) AS total_promo_wins_eur,
    coalesce(f.is_casino_player, 0) AS is_casino_player, coalesce(f.is_sports_player, 0) AS is_sports_player,
    src_row_count, TIMESTAMP '{NOW}' AS last_update
  FROM agg a
  LEFT JOIN flags f ON f.player_id = a.player_id AND f.country_code = a.country_code
  LEFT JOIN games g ON g.game_id = a.game_id AND g.country_code = a.country_code)"""]


def kpi_sql(where: str = "TRUE") -> str:
    return with_(*kpi_ctes(where)) + "SELECT * FROM kpi"


SINCE_EVENTS = f"created_at >= TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 2 DAY"

PAY = f"""pay AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS payment_id, CAST(o_custkey AS VARCHAR) AS player_id,
    {country('o_custkey')} AS country_code, 'EUR' AS currency_code,
    CASE WHEN o_totalprice < 250000 THEN 'DEPOSIT' WHEN o_totalprice < 400000 THEN 'WITHDRAWAL' ELSE 'Refund' END AS payment_type,
    o_orderpriority AS payment_method, 'PSP_' || (o_custkey % 7) AS provider_name,
    CASE WHEN o_orderpriority <> '5-LOW' THEN 'GATE_' || (o_orderkey % 3) END AS gateway_name,
    CASE o_orderstatus WHEN 'F' THEN 'SUCCEEDED' WHEN 'O' THEN 'PENDING' ELSE 'FAILED' END AS status_code,
    CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 0 END AS first_of_type,
    CAST(o_totalprice AS DECIMAL(12,2)) AS amount_eur,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 0.01 AS DECIMAL(18,4)) END AS fee_eur,
    CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 1.10 AS DECIMAL(18,4)) AS converted_amount_eur,
    'DKK' AS converted_currency_code, o_orderdate AS created_at,
    CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate + to_hours(o_orderkey % 48) END AS succeeded_at,
    CASE WHEN o_totalprice < 25000 THEN 'D-' || o_orderkey END AS declined_deposit_id
  FROM orders)"""

METHODS = f"""methods AS (
  SELECT DISTINCT {key('payment_method', 'provider_name', 'gateway_name', 'payment_type')} AS sk_payment_method,
    payment_method, payment_type, provider_name, gateway_name
  FROM pay WHERE payment_method IS NOT NULL AND provider_name IS NOT NULL AND gateway_name IS NOT NULL
    AND payment_type IS NOT NULL)"""

PAY_FACT = PAY + ",\n" + METHODS + f""",
pay_fact AS (
  SELECT {key('p.payment_id', 'p.country_code')} AS sk_payment, p.payment_id,
    {hour_key('coalesce(p.succeeded_at, p.created_at)')} AS sk_date_time, p.player_id, p.country_code, p.currency_code,
    m.sk_payment_method, p.payment_type, p.payment_method, p.provider_name, p.gateway_name,
    coalesce(p.first_of_type, 0) AS is_first_deposit,
    CAST(p.amount_eur AS DOUBLE) AS amount_eur, CAST(p.fee_eur AS DOUBLE) AS fee_eur,
    CAST(round(coalesce(p.amount_eur, 0) - coalesce(p.fee_eur, 0), 4) AS DOUBLE) AS net_amount_eur,
    CAST(p.converted_amount_eur AS DOUBLE) AS converted_amount_eur, p.converted_currency_code,
    CAST(NULL AS DOUBLE) AS balance_before_eur, CAST(NULL AS DOUBLE) AS balance_after_eur,
    CAST(NULL AS DOUBLE) AS balance_before_real_eur, CAST(NULL AS DOUBLE) AS balance_after_real_eur,
    CAST(NULL AS DOUBLE) AS balance_before_bonus_eur, CAST(NULL AS DOUBLE) AS balance_after_bonus_eur,
    p.created_at, p.succeeded_at, TIMESTAMP '{NOW}' AS last_update
  FROM pay p LEFT JOIN methods m ON m.payment_method = p.payment_method AND m.provider_name = p.provider_name
    AND m.gateway_name = p.gateway_name AND m.payment_type = p.payment_type
  WHERE p.status_code = 'SUCCEEDED' AND p.declined_deposit_id IS NULL)"""

ROUNDS_LOG = f"""rounds_log AS (
  SELECT l_orderkey || '-' || l_linenumber AS round_id, CAST(l_suppkey AS VARCHAR) AS player_id,
    CAST(l_partkey AS VARCHAR) AS game_id, {country('l_suppkey')} AS country_code, 'EUR' AS currency_code,
    CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_promotional,
    CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS is_closed,
    CAST(CASE WHEN l_quantity = 1 THEN 0 ELSE price END AS DECIMAL(18,4)) AS bet_amount_eur,
    CAST(price * CAST(l_discount AS DECIMAL(3,2)) AS DECIMAL(18,4)) AS win_amount_eur,
    CAST(CASE WHEN l_returnflag = 'R' THEN price * 0.10 ELSE 0 END AS DECIMAL(18,4)) AS bonus_bet_amount_eur,
    CAST(l_quantity AS DECIMAL(18,4)) AS bonus_win_amount_eur,
    CAST(price * CAST(l_tax AS DECIMAL(3,2)) AS DECIMAL(18,4)) AS tax_amount_eur,
    l_linenumber AS bet_count, CAST(floor(l_quantity) AS INTEGER) AS win_count,
    l_shipdate AS created_at, l_shipdate + to_minutes(l_linenumber) AS finished_at,
    l_shipdate + to_hours(l_linenumber) AS updated_at, l_shipdate + to_hours(l_partkey % 24) AS ingested_at,
    CAST(date_diff('day', TIMESTAMP '1995-01-01', l_shipdate) AS INTEGER) AS version
  FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(12,2)) AS price FROM lineitem))"""

ROUND_ORDER = ("version DESC, bet_amount_eur DESC, bet_count DESC, bonus_bet_amount_eur DESC, bonus_win_amount_eur DESC, "
               "created_at DESC, currency_code DESC, finished_at DESC, game_id DESC, ingested_at DESC, is_closed DESC, "
               "is_promotional DESC, player_id DESC, tax_amount_eur DESC, updated_at DESC, win_amount_eur DESC, win_count DESC")


def latest_rounds(name: str, where: str = "TRUE") -> str:
    return f"""{name} AS (
  SELECT * FROM rounds_log WHERE {where}
  QUALIFY row_number() OVER (PARTITION BY round_id, country_code ORDER BY {ROUND_ORDER}) = 1)"""


ROUNDS = ROUNDS_LOG + ",\n" + latest_rounds("rounds")
EARLY = f"created_at < TIMESTAMP '{SPLIT}'"
SPLIT_ROUNDS = (ROUNDS_LOG + ",\n" + latest_rounds("before_split", EARLY) + ",\n"
                + latest_rounds("after_split", f"NOT ({EARLY})"))

MONEY_COLUMNS = ("bet_amount_eur", "win_amount_eur", "bonus_bet_amount_eur", "bonus_win_amount_eur", "tax_amount_eur")
AS_DOUBLE = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in MONEY_COLUMNS)
ROUND_COLUMNS = ("round_id, player_id, game_id, country_code, currency_code, is_promotional, is_closed, "
                 f"{AS_DOUBLE}, bet_count, win_count, created_at, finished_at, updated_at, ingested_at, version")

ROUND_FACT = ROUNDS + f""",
round_fact AS (
  SELECT round_id, {hour_key('ingested_at')} AS sk_date_time, {key('player_id', 'country_code')} AS sk_player,
    {key('game_id', 'country_code')} AS sk_game, country_code, currency_code, is_promotional,
    bet_amount_eur, win_amount_eur, bonus_bet_amount_eur, bonus_win_amount_eur, tax_amount_eur,
    bet_amount_eur - win_amount_eur AS ggr_eur, bet_count, win_count, created_at, finished_at, updated_at
  FROM rounds WHERE is_closed = 1)"""


def mart(source: str = "round_fact", where: str = "TRUE", promo: str = "sum(CASE WHEN is_promotional = 1 THEN 1 END)") -> str:
    return f"""SELECT sk_date_time, sk_game, country_code, count(round_id) AS rounds,
    count(DISTINCT sk_player) AS active_players, CAST(sum(bet_count) AS BIGINT) AS total_bet_count,
    CAST(sum(win_count) AS BIGINT) AS total_win_count, CAST({promo} AS BIGINT) AS promo_rounds,
    CAST(round(sum(bet_amount_eur), 4) AS DOUBLE) AS bet_eur, CAST(round(sum(win_amount_eur), 4) AS DOUBLE) AS win_eur,
    CAST(round(sum(bonus_bet_amount_eur), 4) AS DOUBLE) AS bonus_bet_eur,
    CAST(round(sum(bonus_win_amount_eur), 4) AS DOUBLE) AS bonus_win_eur,
    CAST(round(sum(tax_amount_eur), 4) AS DOUBLE) AS tax_eur,
    CAST(round(sum(bet_amount_eur) - sum(win_amount_eur), 4) AS DOUBLE) AS ggr_eur,
    CAST(round(sum(bet_amount_eur) - sum(win_amount_eur) - sum(bonus_win_amount_eur) - sum(tax_amount_eur), 4) AS DOUBLE) AS ngr_eur,
    round(CAST(sum(bonus_bet_amount_eur) AS DOUBLE) / nullif(CAST(sum(bet_amount_eur) AS DOUBLE), 0), 6) AS bonus_bet_ratio,
    round(CAST(sum(win_amount_eur) AS DOUBLE) / nullif(CAST(sum(bet_amount_eur) AS DOUBLE), 0), 6) AS win_rate,
    round(CAST(sum(bet_amount_eur) AS DOUBLE) / nullif(count(DISTINCT sk_player), 0), 6) AS revenue_per_player
  FROM {source} WHERE {where} GROUP BY sk_date_time, sk_game, country_code"""


BRAND = f"""brand AS (
  SELECT l_partkey || '-' || l_suppkey AS brand_game_id, CAST(l_partkey AS VARCHAR) AS game_id,
    {country('l_partkey')} AS country_code, s_name AS provider_name,
    CASE WHEN s_acctbal > 0 THEN 1 ELSE 0 END AS is_enabled, first_day, last_day, s_acctbal
  FROM (SELECT l_partkey, l_suppkey, min(l_shipdate) AS first_day, max(l_shipdate) AS last_day
        FROM lineitem GROUP BY ALL) JOIN supplier ON l_suppkey = s_suppkey),
newest_brand AS (
  SELECT * FROM brand
  QUALIFY row_number() OVER (PARTITION BY game_id, country_code ORDER BY last_day DESC, brand_game_id DESC) = 1)"""

CALENDAR = """bounds AS (SELECT min(o_orderdate) AS a, max(o_orderdate) AS b FROM orders),
utc_hours AS (SELECT unnest(generate_series(date_trunc('day', a), date_trunc('day', b) + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS ts_utc
              FROM bounds),
local_hours AS (
  SELECT 'UTC' AS timezone, ts_utc, ts_utc AS t FROM utc_hours
  UNION ALL
  SELECT 'Europe/Vienna', ts_utc, timezone('Europe/Vienna', timezone('UTC', ts_utc)) FROM utc_hours),
calendar AS (
  SELECT CAST(strftime(t, '%Y%m%d%H') AS INTEGER) AS sk_date_time, CAST(t AS DATE) AS date,
    CAST(hour(t) AS INTEGER) AS hour, CAST(day(t) AS INTEGER) AS day, CAST(month(t) AS INTEGER) AS month,
    CAST(year(t) AS INTEGER) AS year, CAST(quarter(t) AS INTEGER) AS quarter, timezone, ts_utc
  FROM local_hours)"""

PLAYERS_LOG = f"""players_log AS (
  SELECT CAST(o_custkey AS VARCHAR) AS player_id, {country('o_custkey')} AS country_code,
    TIMESTAMP '1995-01-01' + to_days(c_nationkey) AS created_at, o_orderdate AS changed_at,
    chr(9) || ' ' || c_name || ' ' || chr(10) AS player_alias,
    CASE WHEN c_nationkey % 5 = 0 THEN ' null ' ELSE CAST(c_nationkey AS VARCHAR) END AS region_code,
    o_orderpriority AS account_tier, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_verified
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def versions(name: str, log: str, keys: str, at: str, order: str, columns: str, where: str = "TRUE") -> str:
    key_list = keys.split(", ")
    return f"""{name}_v AS (
  SELECT * FROM {log} WHERE {where}
  QUALIFY row_number() OVER (PARTITION BY {keys}, {at} ORDER BY {order}) = 1),
{name} AS (
  SELECT {columns}, {at} AS updated_at, {at} AS valid_from, {key(*key_list, at)} AS scd_id,
    coalesce(lead({at}) OVER (PARTITION BY {keys} ORDER BY {at}), {OPEN}) AS valid_to
  FROM {name}_v)"""


TAG_COLUMNS = "tag_id, player_id, country_code, target_type, tag_category, is_active, modified_at"
TAG_HISTORY = TAGS + ",\n" + versions("tag_history", "tags_log", "tag_id, country_code", "modified_at",
                                      "is_active DESC", TAG_COLUMNS)
PLAYER_HISTORY = PLAYERS_LOG + ",\n" + versions(
    "player_history", "players_log", "player_id, country_code", "changed_at", "account_tier DESC, is_verified DESC",
    "player_id, country_code, created_at, changed_at, player_alias, region_code, account_tier, is_verified")

LIMITS_LOG = f"""limits_log AS (
  SELECT CAST(user_id AS VARCHAR) AS limit_id, CAST(user_id AS VARCHAR) AS player_id, {country('user_id')} AS country_code,
    CAST(value AS DOUBLE) AS limit_value, ts AS modified_at
  FROM events WHERE event_type IN ('signup', 'error'))"""
LIMIT_HISTORY = LIMITS_LOG + ",\n" + versions("limit_history", "limits_log", "limit_id, country_code", "modified_at",
                                             "limit_value DESC", "limit_id, player_id, country_code, limit_value, modified_at")

PURCHASES = f"""purchases AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS player_id, {country('user_id')} AS country_code,
    ts AS happened_at, value AS amount FROM events WHERE event_type = 'purchase')"""


CLASS_SPANS = ",\n".join([PURCHASES, f"""class_log AS (
      SELECT user_id || '-' || n AS tag_id, CAST(user_id AS VARCHAR) AS player_id, {country('user_id')} AS country_code,
        'CLASS_' || n AS tag_category, CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS is_active, ts AS modified_at
      FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 AS n FROM events)
      WHERE event_type IN ('click', 'view'))""",
        versions("spans", "class_log", "tag_id, country_code", "modified_at", "is_active DESC",
                 "tag_id, player_id, country_code, tag_category, is_active")])


def snapshot(source_where: str) -> str:
    """Rules of one snapshot run written out per case."""
    return with_(TAGS, versions("stored", "tags_log", "tag_id, country_code", "modified_at", "is_active DESC",
                                TAG_COLUMNS, f"modified_at < TIMESTAMP '{SPLIT}'"),
                 f"src AS (SELECT * FROM tags WHERE {source_where})",
                 f"open_rows AS (SELECT * FROM stored WHERE valid_to = {OPEN})") + f"""
SELECT * FROM stored WHERE valid_to <> {OPEN}
UNION ALL
SELECT o.* REPLACE (CASE WHEN s.tag_id IS NULL THEN TIMESTAMP '{NOW}'
    WHEN s.modified_at > o.updated_at THEN s.modified_at ELSE {OPEN} END AS valid_to)
FROM open_rows o LEFT JOIN src s ON s.tag_id = o.tag_id AND s.country_code = o.country_code
UNION ALL
SELECT s.*, s.modified_at AS updated_at, s.modified_at AS valid_from,
  {key('s.tag_id', 's.country_code', 's.modified_at')} AS scd_id, {OPEN} AS valid_to
FROM src s LEFT JOIN open_rows o ON s.tag_id = o.tag_id AND s.country_code = o.country_code
WHERE o.tag_id IS NULL OR s.modified_at > o.updated_at"""


GAME_REVENUE = f"""SELECT transaction_id, sk_date_time, {key('player_id', 'country_code')} AS sk_player,
      {key('game_id', 'country_code')} AS sk_game, country_code, currency_code, transaction_type,
      CAST(bet AS DOUBLE) AS bet_eur, CAST(win AS DOUBLE) AS win_eur, CAST(bet - win AS DOUBLE) AS ggr_eur, created_at
      FROM (SELECT *,
        CASE WHEN transaction_type IN ('BET','RESERVED_BET') THEN coalesce(amount_eur, 0)
          WHEN transaction_type IN ('ROLLBACK_BET','ROLLBACK_RESERVED_BET','ROLLBACK_ROUND') THEN -coalesce(amount_eur, 0)
          ELSE 0 END AS bet,
        CASE WHEN transaction_type IN ('WIN','PAYOUT','CASHOUT') THEN coalesce(amount_eur, 0)
          WHEN transaction_type IN ('ROLLBACK_WIN','ROLLBACK_CASHOUT') THEN -coalesce(amount_eur, 0)
          ELSE 0 END AS win FROM game_txn)"""

PAYMENT_CHECKS = """
      SELECT 'sk_payment_not_null' AS check_name, 'error' AS severity, count(*) FILTER (sk_payment IS NULL) AS failures FROM pay_fact
      UNION ALL SELECT 'amount_positive', 'error', count(*) FILTER (amount_eur <= 0) FROM pay_fact
      UNION ALL SELECT 'country_accepted', 'error', count(*) FILTER (country_code NOT IN ('de', 'at', 'dk')) FROM pay_fact
      UNION ALL SELECT 'method_known', 'warn', count(*) FILTER (sk_payment_method IS NULL) FROM pay_fact"""


def stored_tag_history() -> str:
    """Three runs: the early state, the later active tags, all later tags."""
    sk = key("tag_id", "country_code", "modified_at")
    same = "l.tag_id = e.tag_id AND l.country_code = e.country_code"
    versioned = f"modified_at AS updated_at, modified_at AS valid_from, {sk} AS scd_id"
    return with_(TAGS, f"""early AS (
  SELECT * FROM tags_log WHERE modified_at < TIMESTAMP '{SPLIT}'
  QUALIFY row_number() OVER (PARTITION BY tag_id, country_code ORDER BY modified_at DESC, is_active DESC) = 1)""") + f"""
SELECT e.*, e.modified_at AS updated_at, e.modified_at AS valid_from, {key('e.tag_id', 'e.country_code', 'e.modified_at')} AS scd_id,
  CASE WHEN l.tag_id IS NULL THEN TIMESTAMP '{NOW}' WHEN l.modified_at > e.modified_at THEN l.modified_at ELSE {OPEN} END AS valid_to
FROM early e LEFT JOIN tags l ON {same} AND l.is_active = 1
UNION ALL
SELECT *, {versioned}, {OPEN} AS valid_to FROM tags l
WHERE is_active = 1 AND NOT EXISTS (SELECT 1 FROM early e WHERE {same} AND e.modified_at >= l.modified_at)
UNION ALL
SELECT *, {versioned}, {OPEN} AS valid_to FROM tags WHERE is_active <> 1"""


WHITESPACE = r"\x09-\x0D\x1C-\x20\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def clean(text: str) -> str:
    dropped = f"translate({text}, chr(13) || chr(10) || chr(9) || chr(8232) || chr(8233), '')"
    trimmed = f"regexp_replace({dropped}, '^[{WHITESPACE}]+|[{WHITESPACE}]+$', '', 'g')"
    return f"CASE WHEN {trimmed} <> '' AND lower({trimmed}) <> 'null' THEN {trimmed} END"


SUMMARY = TAG_HISTORY + ",\n" + PLAYER_HISTORY + f""",
rollup AS (
  SELECT player_id, country_code, string_agg(DISTINCT tag_category, ',' ORDER BY tag_category) AS tag_categories,
    max(updated_at) AS tag_updated_at
  FROM tag_history WHERE valid_to = {OPEN} AND target_type = 'User' AND is_active = 1
  GROUP BY player_id, country_code),
tag_marks AS (
  SELECT player_id, country_code, max(updated_at) AS tag_changed_at
  FROM tag_history WHERE valid_to = {OPEN} AND target_type = 'User' GROUP BY player_id, country_code),
summary AS (
  SELECT p.player_id AS online_customer_id, p.country_code,
    json_object('collection', 'PlayerSummary', 'playerId', p.player_id,
      'summary', json_object('eventType', 'profile_refresh', 'country', p.country_code,
        'region', {clean('region_code')}, 'accountTier', {clean('account_tier')},
        'playerAlias', {clean('player_alias')}, 'isVerified', is_verified,
        'createdOn', strftime(created_at, '%Y-%m-%dT%H:%M:%S.000Z')),
      'sentAt', strftime(TIMESTAMP '{NOW}', '%Y-%m-%dT%H:%M:%S.000Z')) AS payload_json,
    p.updated_at AS source_updated_at, r.tag_updated_at, m.tag_changed_at,
    {clean('player_alias')} AS player_alias, {clean('region_code')} AS region_code,
    {clean('account_tier')} AS account_tier, is_verified
  FROM player_history p LEFT JOIN rollup r ON r.player_id = p.player_id AND r.country_code = p.country_code
    LEFT JOIN tag_marks m ON m.player_id = p.player_id AND m.country_code = p.country_code
  WHERE p.valid_to = {OPEN})"""

CHANGED = f"""changed AS (
  SELECT player_id, country_code FROM player_history WHERE valid_to = {OPEN}
    AND coalesce(updated_at > (SELECT max(updated_at) FROM player_history WHERE updated_at < TIMESTAMP '{SPLIT}'), true)
  UNION
  SELECT player_id, country_code FROM tag_history WHERE valid_to = {OPEN} AND target_type = 'User'
    AND coalesce(updated_at > (SELECT max(t.updated_at) FROM tag_history t
      WHERE t.updated_at < TIMESTAMP '{SPLIT}' AND t.valid_to >= TIMESTAMP '{SPLIT}' AND t.target_type = 'User'
        AND EXISTS (SELECT 1 FROM player_history p WHERE p.player_id = t.player_id AND p.country_code = t.country_code
          AND p.updated_at < TIMESTAMP '{SPLIT}')), true))"""

ATTEMPTS = f"""attempts AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS online_customer_id, {country('user_id')} AS country_code,
    CASE event_type WHEN 'purchase' THEN 200 WHEN 'click' THEN CASE n % 2 WHEN 0 THEN 201 ELSE 403 END
      WHEN 'view' THEN 404 WHEN 'error' THEN 503 ELSE CASE n % 2 WHEN 0 THEN 401 ELSE 0 END END AS status,
    n % 3 + 1 AS attempt, repeat(props, 300) AS body, ts AS attempted_at
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS n FROM events)),
results AS (
  SELECT online_customer_id, country_code, status = 200 AS ok, body AS error FROM attempts
  QUALIFY row_number() OVER (PARTITION BY online_customer_id, country_code ORDER BY attempted_at DESC, event_id DESC) = 1)"""

OUTBOX = SUMMARY + ",\n" + ATTEMPTS + f""",
delivered AS (
  SELECT s.*, CASE WHEN r.ok THEN TIMESTAMP '{NOW}' END AS dispatched_at,
    CASE WHEN NOT r.ok THEN substr(r.error, 1, 2000) END AS dispatch_error
  FROM summary s LEFT JOIN results r ON r.online_customer_id = s.online_customer_id AND r.country_code = s.country_code)"""

FINAL_STATUS = "(status >= 400 AND status < 500 AND status NOT IN (401, 403)) OR attempt >= 3"

SQL: dict[str, str] = {
    "trip_silver": with_(TRIPS) + f"""SELECT *, 'trips' AS pipeline_id, 'run-1' AS run_id, 'silver' AS task_id,
      '{NOW}' AS processed_timestamp FROM trip_silver""",
    "daily_ride_summary": with_(TRIPS) + DAILY,
    "station_performance": with_(TRIPS) + """SELECT trip_start_date, start_station_name,
      round(avg(trip_duration_mins), 2) AS avg_trip_duration_mins, count(ride_id) AS total_trips
      FROM trip_silver GROUP BY ALL""",
    "csv_bronze": with_(TRIPS) + """SELECT ride_id, 'classic_bike' AS rideable_type, started_at,
      CASE WHEN e % 17 <> 0 THEN ended_at END AS ended_at, start_station_name, start_station_id, end_station_name, end_station_id,
      CASE WHEN s % 13 <> 0 THEN CAST(40 AS DOUBLE) + CAST(s AS DOUBLE) / 1000 END AS start_lat,
      CAST(-74 AS DOUBLE) + CAST(s AS DOUBLE) / 1000 AS start_lng, CAST(40 AS DOUBLE) + CAST(e AS DOUBLE) / 1000 AS end_lat,
      CAST(-74 AS DOUBLE) + CAST(e AS DOUBLE) / 1000 AS end_lng, CASE WHEN e % 2 = 0 THEN 'member' ELSE 'casual' END AS member_casual,
      'bronze' AS task_id, nullif(concat_ws(';', CASE WHEN e % 17 = 0 THEN 'ended_at=n/a' END,
        CASE WHEN s % 13 = 0 THEN 'start_lat=unknown' END), '') AS rescued
      FROM (SELECT *, CAST(start_station_id AS INTEGER) AS s, CAST(end_station_id AS INTEGER) AS e FROM trips)""",
    "overwrite_roundtrip": with_(TRIPS) + DAILY,
    "fact_txn_kpi": kpi_sql(),
    "fact_txn_kpi_lookback": kpi_sql(SINCE_EVENTS),
    "fact_txn_kpi_window": with_(*kpi_ctes()) + f"""SELECT * REPLACE (
      CASE WHEN sk_date_time >= {hour_key(f"TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 2 DAY")} THEN TIMESTAMP '{NOW}'
        ELSE TIMESTAMP '2024-01-01' END AS last_update) FROM kpi""",
    "kpi_table": kpi_sql(),
    "net_of_reversals": with_(TXN) + f"""SELECT player_id, country_code, CAST({bets('amount_eur')} AS DOUBLE) AS bets_eur,
      CAST({wins('amount_eur')} AS DOUBLE) AS wins_eur FROM txn GROUP BY ALL""",
    "promo_wins": with_(TXN) + f"""SELECT player_id, country_code, CAST({PROMO_BONUS} AS DOUBLE) AS promo_wins_bonus_eur,
      CAST({PROMO_TOTAL} AS DOUBLE) AS total_promo_wins_eur FROM txn GROUP BY ALL""",
    "player_flags": with_(TAGS, FLAGS) + "SELECT * FROM flags",
    "exclude_tagged": with_(TXN, TAGS) + """SELECT transaction_id, player_id, country_code,
      CAST(amount_eur AS DOUBLE) AS amount_eur FROM txn t
      WHERE NOT EXISTS (SELECT 1 FROM tags g WHERE g.player_id = t.player_id AND g.country_code = t.country_code
        AND target_type = 'User' AND tag_category = 'TEST' AND is_active = 1)""",
    "safe_ratio": with_(ROUNDS) + """SELECT game_id, win_count,
      round(CAST(sum(win_amount_eur) AS DOUBLE) / nullif(CAST(sum(bet_amount_eur) AS DOUBLE), 0), 6) AS win_rate
      FROM rounds GROUP BY ALL""",
    "fact_payments": with_(PAY_FACT) + "SELECT * FROM pay_fact",
    "fact_payments_lookback": with_(PAY_FACT) + f"""SELECT * FROM pay_fact WHERE created_at >= TIMESTAMP '{ORDERS_AS_OF}' - INTERVAL 30 DAY""",
    "fact_gameround": with_(ROUND_FACT) + f"""SELECT * REPLACE ({AS_DOUBLE}, CAST(ggr_eur AS DOUBLE) AS ggr_eur) FROM round_fact""",
    "fact_gameround_increment": with_(ROUND_FACT) + f"""SELECT * REPLACE ({AS_DOUBLE}, CAST(ggr_eur AS DOUBLE) AS ggr_eur) FROM round_fact
      WHERE updated_at < TIMESTAMP '{SPLIT}'
        OR updated_at > (SELECT max(updated_at) FROM round_fact WHERE updated_at < TIMESTAMP '{SPLIT}')""",
    "fact_gameround_table": with_(ROUND_FACT) + f"""SELECT * REPLACE ({AS_DOUBLE}, CAST(ggr_eur AS DOUBLE) AS ggr_eur)
      FROM round_fact CROSS JOIN (SELECT unnest([0, 1]) AS refreshed)""",
    "fact_game_revenue": with_(TXN) + GAME_REVENUE,
    "game_revenue_table": with_(TXN) + f"SELECT * FROM ({GAME_REVENUE}) CROSS JOIN (SELECT unnest([0, 1]) AS refreshed)",
    "mart_hourly": with_(ROUND_FACT) + f"SELECT * EXCLUDE (revenue_per_player) FROM ({mart()})",
    "active_players_rollup": with_(ROUND_FACT) + """SELECT CAST(sk_date_time // 10000 AS INTEGER) AS month, country_code,
      count(round_id) AS rounds, CAST(round(sum(bet_amount_eur), 4) AS DOUBLE) AS bet_eur,
      CAST(round(sum(ggr_eur), 4) AS DOUBLE) AS ggr_eur, count(DISTINCT sk_player) AS players, TRUE AS estimate_is_near
      FROM round_fact GROUP BY ALL""",
    "fact_payments_late": with_(PAY_FACT) + "SELECT * FROM pay_fact",
    "kpi_late_tags": kpi_sql(),
    "mart_hourly_late": with_(ROUND_FACT) + f"SELECT * EXCLUDE (revenue_per_player) FROM ({mart()})",
    "mart_hourly_increment": with_(
        ROUND_FACT, f"earlier AS ({mart(where=f'''created_at < TIMESTAMP '{ORDERS_AS_OF}' ''')})",
        f"late AS ({mart(where='sk_date_time >= 2001053000')})") + """
      SELECT * EXCLUDE (revenue_per_player) FROM (
        SELECT * FROM earlier e WHERE NOT EXISTS (SELECT 1 FROM late l WHERE l.sk_date_time = e.sk_date_time
          AND l.sk_game = e.sk_game AND l.country_code = e.country_code)
        UNION ALL SELECT * FROM late)""",
    "revenue_per_player": with_(ROUND_FACT) + f"""SELECT sk_date_time, sk_game, country_code, promo_rounds, active_players,
      revenue_per_player FROM ({mart(promo='count(*) FILTER (is_promotional = 1)')})""",
    "dim_date_time": with_(CALENDAR) + "SELECT * FROM calendar",
    "distinct_hours": with_(CALENDAR) + """SELECT DISTINCT sk_date_time, date, hour, day, month, year, quarter
      FROM calendar WHERE timezone = 'Europe/Vienna'""",
    "dim_game": with_(GAMES, BRAND) + f"""SELECT {key('g.game_id', 'g.country_code')} AS sk_game, g.game_id, g.country_code,
      g.name, g.studio, g.vertical, g.type, CAST(NULL AS VARCHAR) AS class, CAST(NULL AS VARCHAR) AS slug,
      CAST(NULL AS VARCHAR) AS table_id, g.live, CAST(NULL AS INTEGER) AS enabled, CAST(NULL AS INTEGER) AS branded,
      CAST(NULL AS INTEGER) AS free_games, CAST(NULL AS INTEGER) AS gamble, CAST(NULL AS INTEGER) AS progressive_jackpot,
      CAST(NULL AS INTEGER) AS login_required, CAST(NULL AS INTEGER) AS bonus_game, CAST(NULL AS INTEGER) AS private,
      CAST(NULL AS INTEGER) AS discardable, CAST(g.rtp AS DOUBLE) AS rtp, CAST(NULL AS VARCHAR) AS volatility,
      CAST(NULL AS DOUBLE) AS min_bet, g.max_bet, CAST(NULL AS VARCHAR) AS jackpot_id,
      CAST(NULL AS VARCHAR) AS allowed_wallet_type, CASE WHEN b.game_id IS NOT NULL THEN 'OPEN' END AS private_status,
      b.provider_name AS game_provider_id, b.is_enabled AS brand_game_enabled, g.released_at,
      b.first_day AS brand_enabled_at, b.first_day AS brand_first_enabled_at,
      CASE WHEN b.s_acctbal >= 0 THEN b.last_day END AS brand_disabled_at,
      g.released_at AS created_at, g.released_at AS updated_at
      FROM games g LEFT JOIN newest_brand b ON b.game_id = g.game_id AND b.country_code = g.country_code""",
    "dim_payment_method": with_(PAY, METHODS) + "SELECT * FROM methods",
    "hour_keys": f"""SELECT event_id, {hour_key('ts')} AS vienna_key, CAST(strftime(ts, '%Y%m%d%H') AS INTEGER) AS utc_key,
      (floor(epoch(ts)) - epoch(date_trunc('day', ts))) / 60 AS minutes_of_day,
      strftime(ts, '%Y-%m-%dT%H:%M:%S.000Z') AS iso_text FROM events""",
    "surrogate_keys": with_(PAY) + f"""SELECT payment_id, {key('payment_id', 'country_code')} AS sk_payment,
      {key('payment_method', 'provider_name', 'gateway_name', 'payment_type')} AS sk_method FROM pay""",
    "clean_text": f"""SELECT doc_id, md5(c) AS cleaned_md5, CAST(length(c) AS INTEGER) AS cleaned_length,
      md5(substr(c, 1, 2000)) AS head_md5
      FROM (SELECT doc_id, {clean("' ' || chr(9) || text || chr(10) || ' '")} AS c FROM documents)""",
    "enforced_schema": with_(ROUNDS_LOG) + f"""SELECT {ROUND_COLUMNS.replace('finished_at', 'CAST(NULL AS TIMESTAMP) AS finished_at')},
      TIMESTAMP '{NOW}' AS last_update FROM rounds_log""",
    "dedup_latest": with_(ROUNDS) + f"SELECT {ROUND_COLUMNS} FROM rounds",
    "upsert_versioned": with_(ROUNDS) + f"SELECT {ROUND_COLUMNS} FROM rounds",
    "upsert_stale": with_(SPLIT_ROUNDS) + f"""SELECT {ROUND_COLUMNS} FROM (
        SELECT * FROM after_split UNION ALL
        SELECT * FROM before_split b WHERE NOT EXISTS (SELECT 1 FROM after_split a
          WHERE a.round_id = b.round_id AND a.country_code = b.country_code))""",
    "upsert_counts": with_(SPLIT_ROUNDS) + """SELECT count(*) FILTER (b.round_id IS NULL) AS inserted,
      count(*) FILTER (a.version > b.version) AS updated, count(*) FILTER (a.version <= b.version) AS unchanged
      FROM after_split a LEFT JOIN before_split b ON a.round_id = b.round_id AND a.country_code = b.country_code""",
    "keyed_merge": with_(SPLIT_ROUNDS) + f"""SELECT {ROUND_COLUMNS} FROM (SELECT * FROM after_split UNION ALL
        SELECT * FROM before_split b WHERE NOT EXISTS (SELECT 1 FROM after_split a
          WHERE a.round_id = b.round_id AND a.country_code = b.country_code))""",
    "scd2_history": with_(TAG_HISTORY) + "SELECT * FROM tag_history",
    "scd2_players": with_(PLAYER_HISTORY) + "SELECT * FROM player_history",
    "scd2_limits": with_(LIMIT_HISTORY) + "SELECT * FROM limit_history",
    "scd2_step": snapshot("TRUE"),
    "scd2_hard_delete": snapshot("is_active = 1"),
    "scd2_table": stored_tag_history(),
    "current_rows": with_(PLAYER_HISTORY) + f"""SELECT player_id, country_code, account_tier, valid_from
      FROM player_history WHERE valid_to = {OPEN}""",
    "point_in_time_join": with_(PURCHASES, LIMIT_HISTORY) + """SELECT p.*, h.limit_value, h.valid_from
      FROM purchases p LEFT JOIN limit_history h ON h.player_id = p.player_id AND h.country_code = p.country_code
        AND h.valid_from <= p.happened_at AND p.happened_at < h.valid_to""",
    "rows_in_force": with_(LIMIT_HISTORY, CLASS_SPANS) + """
      SELECT p.*, i.in_force, i.valid_from FROM purchases p JOIN (
        SELECT player_id, country_code, tag_category AS in_force, valid_from, valid_to FROM spans WHERE is_active = 1
        UNION ALL SELECT player_id, country_code, 'LIMIT', valid_from, valid_to FROM limit_history
      ) i ON i.player_id = p.player_id AND i.country_code = p.country_code AND i.valid_from <= p.happened_at AND p.happened_at < i.valid_to""",
    "classification_at": with_(PURCHASES, f"""class_log AS (
      SELECT user_id || '-' || n AS tag_id, CAST(user_id AS VARCHAR) AS player_id, {country('user_id')} AS country_code,
        'CLASS_' || n AS tag_category, CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS is_active, ts AS modified_at
      FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 AS n FROM events)
      WHERE event_type IN ('click', 'view'))""",
        versions("spans", "class_log", "tag_id, country_code", "modified_at", "is_active DESC",
                 "tag_id, player_id, country_code, tag_category, is_active")) + "SELECT p.*, " + ", ".join(
        f"""max(CASE WHEN s.tag_category = 'CLASS_{i}' THEN 1 ELSE 0 END) AS class_{i}""" for i in range(3)) + """
      FROM purchases p LEFT JOIN spans s ON s.is_active = 1 AND s.player_id = p.player_id
        AND s.country_code = p.country_code AND s.valid_from <= p.happened_at AND p.happened_at < s.valid_to
      GROUP BY ALL""",
    "high_water_mark": with_(PAY) + f"""SELECT payment_id, created_at FROM pay
      WHERE created_at > (SELECT max(created_at) FROM pay WHERE created_at < TIMESTAMP '{SPLIT}')""",
    "high_water_mark_empty": with_(PAY) + """SELECT payment_id, CASE right(payment_id, 1) WHEN '3' THEN NULL
      WHEN '7' THEN TIMESTAMP '1960-05-01' ELSE created_at END AS created_at FROM pay""",
    "lookback_timestamp": with_(TXN) + f"""SELECT transaction_id, created_at, CAST(amount_eur AS DOUBLE) AS amount_eur
      FROM txn WHERE {SINCE_EVENTS}""",
    "lookback_hour_key": with_(PAY_FACT) + f"""SELECT sk_payment, sk_date_time, amount_eur FROM pay_fact
      WHERE floor(sk_date_time / 100) >= CAST(strftime(TIMESTAMP '{ORDERS_AS_OF}' - INTERVAL 30 DAY, '%Y%m%d') AS INTEGER)""",
    "tag_rollup": with_(SUMMARY) + "SELECT * FROM rollup",
    "changed_entities": with_(SUMMARY, CHANGED) + "SELECT * FROM changed",
    "player_summary": with_(SUMMARY) + """SELECT *, CAST(NULL AS TIMESTAMP) AS dispatched_at,
      CAST(NULL AS VARCHAR) AS dispatch_error FROM summary""",
    "player_summary_increment": with_(SUMMARY, CHANGED) + """SELECT s.*, CAST(NULL AS TIMESTAMP) AS dispatched_at,
      CAST(NULL AS VARCHAR) AS dispatch_error FROM summary s JOIN changed c ON c.player_id = s.online_customer_id AND c.country_code = s.country_code""",
    "outbox_cycle": with_(OUTBOX, CHANGED) + f"""SELECT s.*,
      CASE WHEN c.player_id IS NULL AND r.ok THEN TIMESTAMP '{NOW}' END AS dispatched_at,
      CASE WHEN c.player_id IS NULL AND NOT r.ok THEN substr(r.error, 1, 2000) END AS dispatch_error, CAST(0 AS BIGINT) AS staged_again
      FROM summary s LEFT JOIN results r ON r.online_customer_id = s.online_customer_id AND r.country_code = s.country_code
      LEFT JOIN changed c ON c.player_id = s.online_customer_id AND c.country_code = s.country_code""",
    "outbox_classify": with_(ATTEMPTS) + f"""SELECT event_id, online_customer_id, country_code, status, attempt, attempted_at,
      CASE WHEN status = 200 THEN 'sent' WHEN {FINAL_STATUS} THEN 'dead_letter' ELSE 'retry' END AS outcome,
      CASE WHEN status = 200 OR {FINAL_STATUS} THEN NULL WHEN status IN (401, 403) THEN 0
        ELSE CAST(2 * power(2, attempt - 1) AS INTEGER) END AS retry_after_s FROM attempts""",
    "outbox_pending": with_(OUTBOX) + """SELECT online_customer_id, country_code, source_updated_at, dispatched_at
      FROM delivered WHERE dispatched_at IS NULL AND dispatch_error IS NULL""",
    "outbox_apply": with_(OUTBOX) + """SELECT online_customer_id, country_code, dispatched_at, md5(dispatch_error) AS error_md5,
      CAST(length(dispatch_error) AS INTEGER) AS error_length FROM delivered""",
    "dead_letters": with_(OUTBOX) + """SELECT online_customer_id, country_code, source_updated_at FROM delivered
      WHERE dispatch_error IS NOT NULL AND dispatched_at IS NULL""",
    "dispatch_summary": with_(ATTEMPTS) + """SELECT count(*) AS processed, count(*) FILTER (ok) AS succeeded,
      count(*) FILTER (NOT ok) AS failed, round(count(*) / 10.0, 1) AS rows_per_second FROM results""",
    "dq_not_null": with_(PAY) + "SELECT payment_id, payment_method FROM pay WHERE gateway_name IS NULL",
    "dq_unique": with_(ROUNDS_LOG) + """SELECT round_id, country_code, count(*) AS row_count FROM rounds_log
      GROUP BY ALL HAVING count(*) > 1""",
    "dq_accepted": with_(PAY) + """SELECT payment_type AS failing_value, count(*) AS row_count FROM pay
      WHERE payment_type NOT IN ('DEPOSIT', 'WITHDRAWAL', 'REFUND') GROUP BY ALL""",
    "dq_accepted_ci": with_(PAY) + """SELECT payment_type AS failing_value, count(*) AS row_count FROM pay
      WHERE upper(payment_type) NOT IN (upper('deposit'), upper('Refund')) GROUP BY ALL""",
    "dq_relationships": with_(TXN, GAMES) + f"""SELECT sk_game AS failing_value, count(*) AS row_count
      FROM (SELECT {key('game_id', 'country_code')} AS sk_game FROM game_txn)
      WHERE sk_game NOT IN (SELECT {key('game_id', 'country_code')} FROM games) GROUP BY ALL""",
    "dq_formula": with_(ROUND_FACT) + """SELECT round_id, country_code, CAST(ggr_eur + tax_amount_eur AS DOUBLE) AS ggr_eur,
      CAST(bet_amount_eur - win_amount_eur AS DOUBLE) AS expected, CAST(abs(tax_amount_eur) AS DOUBLE) AS deviation
      FROM round_fact WHERE abs(tax_amount_eur) > 0.0001""",
    "dq_positive": with_(ROUNDS) + """SELECT round_id, country_code, CAST(bet_amount_eur AS DOUBLE) AS bet_amount_eur
      FROM rounds WHERE bet_amount_eur <= 0""",
    "dq_future": with_(PAY_FACT) + f"""SELECT sk_payment, sk_date_time, created_at FROM pay_fact
      WHERE strptime(CAST(CAST(floor(sk_date_time / 100) AS INTEGER) AS VARCHAR), '%Y%m%d') > TIMESTAMP '{ORDERS_AS_OF}'""",
    "dq_ratio": with_(TRIPS) + """SELECT * FROM (SELECT count(*) AS row_count, count(*) FILTER (started_at > ended_at) AS bad_rows,
      count(*) FILTER (started_at > ended_at) / nullif(count(*), 0) AS bad_share FROM trips) WHERE bad_share >= 0.01""",
    "dq_order": with_(TRIPS) + f"""SELECT * FROM (SELECT * REPLACE (avg_trip_duration_mins * 3 AS avg_trip_duration_mins) FROM ({DAILY}))
      WHERE max_trip_duration_mins < avg_trip_duration_mins OR avg_trip_duration_mins < min_trip_duration_mins""",
    "dq_map_keys": with_(TRIPS) + "SELECT ride_id, start_station_id FROM trips WHERE start_station_name IS NULL",
    "dq_observed": with_(PAY_FACT) + PAYMENT_CHECKS,
    "dq_report": with_(PAY_FACT, CALENDAR) + PAYMENT_CHECKS + """
      UNION ALL SELECT 'sk_payment_unique', 'error', count(*) FROM (SELECT sk_payment FROM pay_fact GROUP BY 1 HAVING count(*) > 1)
      UNION ALL SELECT 'hour_in_calendar', 'warn', count(DISTINCT sk_date_time) FROM pay_fact
        WHERE sk_date_time NOT IN (SELECT sk_date_time FROM calendar WHERE timezone = 'Europe/Vienna')
      UNION ALL SELECT 'table_not_empty', 'error', CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM pay_fact""",
    "stream_bronze": with_(ROUNDS_LOG) + f"""SELECT * REPLACE (CASE WHEN NOT ({EARLY}) THEN win_count END AS win_count)
      FROM (SELECT {ROUND_COLUMNS} FROM rounds_log)""",
    "stream_evolution": with_(ROUNDS_LOG) + f"""SELECT * REPLACE (CASE WHEN NOT ({EARLY}) THEN win_count END AS win_count,
        CASE WHEN NOT ({EARLY}) THEN is_closed END AS is_closed, CAST(bet_count AS BIGINT) AS bet_count),
        CASE WHEN {EARLY} THEN 'closed ' || is_closed END AS is_closed_as_text
      FROM (SELECT {ROUND_COLUMNS} FROM rounds_log)""",
    "stream_silver": with_(ROUNDS) + f"SELECT {ROUND_COLUMNS}, TIMESTAMP '{NOW}' AS last_update FROM rounds",
    "stream_silver_rewrite": with_(ROUNDS) + f"SELECT {ROUND_COLUMNS}, TIMESTAMP '{NOW}' AS last_update FROM rounds",
    "silver_log": with_(ROUNDS) + f"""
      SELECT {ROUND_COLUMNS}, TIMESTAMP '{NOW}' AS last_update, compacted
      FROM rounds CROSS JOIN (SELECT unnest([0, 1]) AS compacted)""",
    "stream_metrics": with_(SPLIT_ROUNDS) + f"""
      SELECT 1 AS landing, b.country_code, CAST(1 AS BIGINT) AS files_ingested, (SELECT count(*) FROM rounds_log r WHERE {EARLY} AND r.country_code = b.country_code) AS rows_ingested,
        count(*) AS inserted, CAST(0 AS BIGINT) AS updated, CAST(0 AS BIGINT) AS unchanged FROM before_split b GROUP BY b.country_code
      UNION ALL
      SELECT 2, a.country_code, CAST(1 AS BIGINT), (SELECT count(*) FROM rounds_log r WHERE NOT ({EARLY}) AND r.country_code = a.country_code),
        count(*) FILTER (b.round_id IS NULL), count(*) FILTER (a.version > b.version), count(*) FILTER (a.version <= b.version)
      FROM after_split a LEFT JOIN before_split b ON a.round_id = b.round_id AND a.country_code = b.country_code
      GROUP BY a.country_code""",
}
