"""The registered queries in DuckDB's SQL, over the same tables."""

_PICKS = """
picks AS (
    SELECT concat('fobj__sb_user_profile__', CAST(user_id AS varchar)) AS user_fkey,
           CAST(82 AS int) AS type,
           CAST(CASE WHEN event_id % 4 = 0 THEN 331 ELSE 333 END AS int) AS currency_code,
           CAST(round(value * 100) AS int) AS risk_amount,
           CAST(CASE event_type WHEN 'purchase' THEN 511 WHEN 'click' THEN 512
                                WHEN 'view' THEN 513 ELSE 501 END AS int) AS settlement_state,
           ts, user_id, event_id
    FROM events
)"""

_USER_ID = "CAST(string_split(user_fkey, '__')[-1] AS bigint)"

_CONTRIBUTION = {
    "total_picks": "CASE WHEN currency_code = 333 THEN 1 ELSE 0 END",
    "total_risk_amount": "CASE WHEN currency_code = 333 THEN risk_amount ELSE 0 END",
    "won": "CASE WHEN currency_code = 333 AND settlement_state = 511 THEN 1 ELSE 0 END",
    "loss": "CASE WHEN currency_code = 333 AND settlement_state = 512 THEN 1 ELSE 0 END",
    "push": "CASE WHEN currency_code = 333 AND settlement_state = 513 THEN 1 ELSE 0 END",
}

_TOTAL_COLUMNS = ",\n       ".join(
    f"CAST(sum({sql}) AS bigint) AS "
    + ("total_coins_staked" if name == "total_risk_amount" else name)
    for name, sql in _CONTRIBUTION.items()
)


def _totals(source: str = "picks", where: str = "true") -> str:
    return (
        f"SELECT {_USER_ID} AS user_id, {_TOTAL_COLUMNS} FROM {source} WHERE {where} GROUP BY 1"
    )


_CONTRIBUTIONS = f"""WITH {_PICKS}
SELECT {_USER_ID} AS user_id,
       {", ".join(f"CAST({sql} AS int) AS {name}" for name, sql in _CONTRIBUTION.items())}
FROM picks"""

_USER_STATS = f"WITH {_PICKS} {_totals()}"

# Every fourth user bets in another currency only, and still gets a row.
_ZERO_ROWS = f"""WITH {_PICKS}, by_user AS (
    SELECT * REPLACE (CAST(CASE WHEN user_id % 4 = 0 THEN 331 ELSE 333 END AS int)
                      AS currency_code) FROM picks)
{_totals("by_user")}"""

_STATS_JSON = """concat('{"won":', won, ',"loss":', loss, ',"push":', push,
       ',"total_coins_staked":', total_coins_staked, ',"total_settled_picks":', total_picks, '}')"""

_USER_STATS_JSON = f"""WITH {_PICKS}, totals AS ({_totals()})
SELECT user_id, {_STATS_JSON} AS general_stats FROM totals"""

# Keys in order, as the merged maps are written.
_SORTED_JSON = """concat('{"loss":', loss, ',"push":', push,
       ',"total_coins_staked":', total_coins_staked, ',"total_settled_picks":', total_picks,
       ',"won":', won, '}')"""

_STATS_TABLE = f"""WITH {_PICKS}, totals AS ({_totals()})
SELECT concat('fobj__sb_user_profile__', CAST(user_id AS varchar)) AS user_fkey, user_id,
       {_SORTED_JSON} AS general_stats, CAST(1 AS int) AS version, '{{}}' AS details,
       '{{}}' AS this_week, '{{}}' AS last_week, '{{}}' AS last_30_days, '{{}}' AS last_90_days
FROM totals"""


def _counter_sums(where: str = "true") -> str:
    return f"""
SELECT user_id, u.key AS key,
       CAST(sum(CAST(json_extract_string(props, '$.' || u.key) AS bigint)) AS bigint) AS total
FROM (SELECT user_id, props, unnest(json_keys(props)) AS key
      FROM events WHERE {where}) u
GROUP BY 1, 2"""


def _counter_json(sums: str) -> str:
    return f"""
SELECT user_id,
       '{{' || string_agg('"' || key || '":' || total, ',' ORDER BY key) || '}}' AS general_stats
FROM ({sums}) GROUP BY 1"""


_CUT = "ts < TIMESTAMP '2024-01-16'"
_AFTER = "ts >= TIMESTAMP '2024-01-16'"

_GENERAL_STATS = _counter_json(_counter_sums())

_LOOKUP = f"""
WITH delta AS ({_counter_json(_counter_sums("ts >= TIMESTAMP '2024-01-02'"))}),
     stored AS ({_counter_json(_counter_sums("ts < TIMESTAMP '2024-01-02'"))})
SELECT delta.user_id, delta.general_stats, stored.general_stats AS stored
FROM delta LEFT JOIN stored ON delta.user_id = stored.user_id"""

# The merge writes back only users that have new rows.
_MERGE = f"""
WITH delta AS (SELECT DISTINCT user_id FROM events WHERE {_AFTER})
{_counter_json(_counter_sums("user_id IN (SELECT user_id FROM delta)"))}"""

_BAG_UNION = f"""
SELECT user_id, general_stats FROM ({_counter_json(_counter_sums(_CUT))})
UNION ALL
SELECT user_id, general_stats FROM ({_counter_json(_counter_sums(_AFTER))})"""

_CTE = f"""
WITH aggregated AS ({_counter_sums()}),
     per_user AS (SELECT user_id, count(*) AS keys, sum(total) AS total
                  FROM aggregated GROUP BY user_id)
SELECT user_id, CAST(keys AS bigint) AS keys, CAST(total AS bigint) AS total FROM per_user"""


def _tumble(size: str, total: str = "CAST(sum(risk_amount) AS float)") -> str:
    return f"""WITH {_PICKS}
SELECT user_fkey,
       time_bucket(INTERVAL '{size}', ts, TIMESTAMP '1970-01-01') AS window_start,
       time_bucket(INTERVAL '{size}', ts, TIMESTAMP '1970-01-01') + INTERVAL '{size}' AS window_end,
       {total} AS total_risk_amount
FROM picks GROUP BY 1, 2, 3"""


_BIGINT = "CAST(sum(risk_amount) AS bigint)"

# Which windows a row falls into depends on the clock; what a user's windows
# add up to does not.
_CLOSED = f"""WITH {_PICKS}
SELECT user_fkey, {_BIGINT} AS total_risk_amount FROM picks GROUP BY 1"""

_PARSED = f"""WITH {_PICKS}
SELECT user_fkey, user_id, risk_amount, settlement_state, currency_code,
       epoch_us(ts) // 1000 AS created_stamp_millis_utc
FROM picks"""

_TABLE = f"""WITH {_PICKS}
SELECT user_fkey, type, currency_code, risk_amount, CAST(NULL AS int) AS us_coeff,
       CAST(NULL AS int) AS expected_payout_amount, CAST(NULL AS int) AS selections_count,
       CAST(NULL AS int) AS stake_category, settlement_state,
       CAST(NULL AS bigint) AS settlement_stamp_millis_utc,
       CAST(NULL AS int) AS settlement_payout_amount
FROM picks"""

_PROJECT = f"WITH {_PICKS} SELECT user_fkey, risk_amount FROM picks"

_FLUSHED = f"WITH {_PICKS} SELECT user_fkey, risk_amount, true AS all_repeated FROM picks"

_RIDES = """
SELECT event_id AS rideId, user_id AS taxiId, event_type = 'signup' AS isStart,
       CAST(value AS float) AS lon, CAST(-value AS float) AS lat,
       CAST(user_id % 5 AS int) AS psgCnt,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS rideTime
FROM events"""

# A copy in order has no step back; the first ride to arrive is the least.
_ORDERED = """
SELECT user_id AS "taxiId", count(*) AS rows, CAST(0 AS bigint) AS steps_back,
       min(event_id) AS first_seen, max(event_id) AS last_seen
FROM events GROUP BY 1"""

_KEYED = f"""WITH {_PICKS}
SELECT user_fkey AS key,
       concat('{{"user_fkey":"', user_fkey, '","risk_amount":', risk_amount, '}}') AS value
FROM picks"""

_FLAWED = """
WITH verdict AS (
    SELECT event_type,
           event_type IN ('purchase', 'click', 'view') AS lenient_ok,
           event_type IN ('purchase', 'view') AS strict_ok
    FROM events)
SELECT event_type,
       CAST(count(*) FILTER (WHERE lenient_ok) AS bigint) AS lenient_good,
       CAST(count(*) FILTER (WHERE NOT lenient_ok) AS bigint) AS lenient_bad,
       CAST(count(*) FILTER (WHERE strict_ok) AS bigint) AS strict_good,
       CAST(count(*) FILTER (WHERE NOT strict_ok) AS bigint) AS strict_bad
FROM verdict GROUP BY 1"""

_RAW = """
SELECT concat('fobj__sb_user_profile__', CAST(user_id AS varchar)) AS key, props AS value,
       'picks' AS topic, CAST(user_id % 4 AS int) AS partition, event_id AS "offset",
       ts AS timestamp, CAST(0 AS int) AS timestampType
FROM events"""

_UNNESTED = """
SELECT user_id, u.key AS key, json_extract_string(props, '$.' || u.key) AS value
FROM (SELECT user_id, props, unnest(json_keys(props)) AS key FROM events) u"""

# Rows before the cut come second; most of their windows are closed by then.
_EVENT_TIME = f"""
WITH {_PICKS}, placed AS (
    SELECT user_fkey, risk_amount, ts,
           time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') AS window_start,
           time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') + INTERVAL '1 hour' AS window_end
    FROM picks
), marks AS (
    SELECT max(ts) FILTER ({_AFTER}) - INTERVAL '1 day' AS first_mark,
           max(ts) - INTERVAL '1 day' AS last_mark
    FROM picks
), judged AS (
    SELECT placed.*, {_CUT} AND coalesce(window_end <= first_mark, false) AS is_late,
           window_end <= last_mark AS is_closed
    FROM placed, marks
)
SELECT user_fkey, window_start, window_end, CAST(sum(risk_amount) AS bigint) AS total_risk_amount,
       CAST(count(*) FILTER (NOT is_late) AS bigint) AS in_time,
       CAST(count(*) FILTER (is_late) AS bigint) AS late
FROM judged WHERE is_late OR is_closed GROUP BY 1, 2, 3"""

_QUARANTINED = """
WITH verdict AS (
    SELECT concat('fobj__sb_user_profile__', CAST(user_id AS varchar)) AS user_fkey, event_type FROM events
), texts AS (
    SELECT *, concat('{"user_fkey":"', user_fkey, '"', CASE event_type
        WHEN 'purchase' THEN ',"risk_amount":5}' WHEN 'click' THEN '}'
        WHEN 'view' THEN ',"risk_amount":null}' WHEN 'error' THEN ',"risk_amount":5'
        ELSE ',"risk_amount":"5"}' END) AS value,
        event_type IN ('purchase', 'view') AS is_good
    FROM verdict)
SELECT CASE WHEN is_good THEN user_fkey END AS user_fkey,
       CAST(CASE WHEN event_type = 'purchase' THEN 5 END AS int) AS risk_amount,
       CASE WHEN NOT is_good THEN value END AS corrupt_record,
       CASE WHEN is_good THEN NULL WHEN event_type = 'click' THEN 'missing field'
            ELSE 'malformed' END AS reason,
       CASE WHEN is_good THEN 'good' ELSE 'bad' END AS part
FROM texts"""

ORACLE_SQL: dict[str, str] = {
    "pick_parse_json": _PARSED,
    "pick_table": _TABLE,
    "pick_project": _PROJECT,
    "pick_project_insert": _PROJECT,
    "print_stream": _PROJECT,
    "flush_stream": _FLUSHED,
    "pick_contributions": _CONTRIBUTIONS,
    "user_stats": _USER_STATS,
    "user_stats_zero_rows": _ZERO_ROWS,
    "user_stats_merge": _USER_STATS,
    "user_stats_stream": _USER_STATS,
    "user_stats_upsert": _USER_STATS,
    "user_stats_from_topic": _USER_STATS,
    "user_stats_lost_checkpoint": _USER_STATS,
    "user_stats_json": _USER_STATS_JSON,
    "counter_unnest": _UNNESTED,
    "counter_union": _BAG_UNION,
    "counter_sum": _counter_sums(),
    "counter_cte": _CTE,
    "general_stats": _GENERAL_STATS,
    "stored_lookup": _LOOKUP,
    "stored_lookup_buckets": _LOOKUP,
    "general_stats_merge": _MERGE,
    "general_stats_upsert": _GENERAL_STATS,
    "user_stats_table_upsert": _STATS_TABLE,
    "tumble_sql": _tumble("30 seconds"),
    "tumble_fluent": _tumble("30 seconds"),
    "tumble_sql_hour": _tumble("1 hour"),
    "tumble_fluent_day": _tumble("1 day"),
    "tumble_messages": _tumble("30 seconds"),
    "tumble_stream": _tumble("30 seconds", _BIGINT),
    "tumble_event_time": _EVENT_TIME,
    "windows_messages": _CLOSED,
    "windows_append": _CLOSED,
    "windows_append_sql": _CLOSED,
    "ride_copy": _RIDES,
    "ride_copy_stream": _RIDES,
    "ride_copy_order": _ORDERED,
    "publish_keyed_json": _KEYED,
    "strict_missing": _FLAWED,
    "quarantine_stream": _QUARANTINED,
    "raw_records": _RAW,
    "tail_stream": _RAW,
}
