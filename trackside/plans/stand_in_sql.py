"""The queries of `stand_ins` as SQL over the same tables, for checking."""

from __future__ import annotations

_VALUE_MEASURES = """
       sum(value::DECIMAL(18,2))::DOUBLE / count(value) AS avg_value,
       min(value) AS min_value, max(value) AS max_value,
       sum(value::DECIMAL(18,2))::DOUBLE AS sum_value, count(value) AS n"""


def _sliding(size: int, copies: int) -> str:
    return f"""
WITH listed AS (
  SELECT event_type, value, ts,
         time_bucket(INTERVAL '10 seconds', ts, TIMESTAMP '1970-01-01')
           - to_seconds(10 * k) AS ws
  FROM events, range({copies}) AS r(k))
SELECT event_type, ws AS window_start, ws + INTERVAL '{size} seconds' AS window_end,
       {_VALUE_MEASURES}
FROM listed WHERE ts < ws + INTERVAL '{size} seconds'
GROUP BY event_type, ws"""


_LAPS = """
views AS (
  SELECT user_id, event_id AS lap_id, ts AS lap_start,
         row_number() OVER w - 1 AS lap, lead(ts) OVER w AS lap_end
  FROM events WHERE event_type = 'view'
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
laps AS (SELECT * FROM views WHERE lap_end IS NOT NULL)"""

_RACE = f"""
WITH {_LAPS},
timed AS (
  SELECT *, epoch(lap_end - lap_start) AS seconds,
         min(epoch(lap_end - lap_start)) OVER (PARTITION BY user_id) AS best
  FROM laps),
quick AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY lap_start, lap) - 1 AS idx
  FROM timed WHERE seconds <= best * 100),
chosen AS (
  SELECT user_id, lap, lap_start, lap_end, seconds::REAL AS lap_time
  FROM quick WHERE idx >= 1),
samples AS (
  SELECT user_id, ts, value::REAL AS air, (props->>'k')::INTEGER::REAL AS wet
  FROM events WHERE event_type = 'error'),
sky AS (
  SELECT c.*,
         CASE WHEN f.ts < c.lap_end THEN f.air ELSE b.air END AS air,
         CASE WHEN f.ts < c.lap_end THEN f.wet ELSE b.wet END AS wet
  FROM chosen c
  ASOF LEFT JOIN samples b ON c.user_id = b.user_id AND c.lap_start >= b.ts
  ASOF LEFT JOIN samples f ON c.user_id = f.user_id AND c.lap_start <= f.ts),
points AS (
  SELECT c.user_id, c.lap, e.ts, e.value::REAL AS speed,
         (e.props->>'k')::INTEGER AS k
  FROM chosen c JOIN events e
    ON e.user_id = c.user_id AND e.ts >= c.lap_start AND e.ts < c.lap_end
  WHERE e.event_type = 'click')"""


def _car_summary(source: str) -> str:
    """Over columns lap, speed (REAL) and k (INTEGER)."""
    return f"""
gears AS (
  SELECT lap, k % 8 AS gear,
         row_number() OVER (PARTITION BY lap ORDER BY count(*) DESC, k % 8) AS place
  FROM {source} GROUP BY lap, k % 8)
SELECT p.lap::INTEGER AS "LapNumber", sum(k)::DOUBLE / count(k) AS avg_throttle,
       sum(speed::DECIMAL(18,6))::DOUBLE / count(speed) AS avg_speed,
       sum(k * 100)::DOUBLE / count(k) AS avg_rpm,
       any_value(g.gear) AS mode_gear, max(speed) AS max_speed
FROM {source} p JOIN gears g ON g.lap = p.lap AND g.place = 1
GROUP BY p.lap"""


_WEATHER_MEASURES = """
       sum(air::DECIMAL(18,6))::DOUBLE / count(air) AS avg_airtemp,
       sum(wet::DECIMAL(18,6))::DOUBLE / count(wet) AS avg_humidity,
       sum(air::DECIMAL(18,6))::DOUBLE / count(air) AS avg_tracktemp,
       sum(wet::DECIMAL(18,6))::DOUBLE / count(wet) AS avg_windspeed"""


def _nested(max_items: int) -> str:
    return f"""
WITH numbered AS (
  SELECT l.*, row_number() OVER (
           PARTITION BY l_orderkey
           ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                    l_shipdate) - 1 AS idx
  FROM lineitem l),
parts AS (
  SELECT l_orderkey, idx // {max_items} AS part, count(*) AS n,
         sum(l_quantity) AS quantity, arg_min(l_partkey, idx) AS first_part
  FROM numbered GROUP BY l_orderkey, idx // {max_items})
SELECT o_orderkey AS orderkey, coalesce(part, 0) AS part,
       o_custkey,
       coalesce(n, 0) AS n, coalesce(quantity, 0.0) AS quantity, first_part
FROM orders LEFT JOIN parts ON l_orderkey = o_orderkey"""


_SPOILT = """(
  SELECT event_id,
         try_cast(replace(props, '69', '"none"')::JSON->>'k' AS INTEGER) AS k
  FROM events)"""


SQL: dict[str, str] = {
    "json_parse": "SELECT event_id, (props->>'k')::INTEGER AS k FROM events",
    "required_gate": f"SELECT event_id, k FROM {_SPOILT} WHERE k IS NOT NULL",
    "rejected": f"SELECT event_id FROM {_SPOILT} WHERE k IS NULL",
    "entity_filter": """
SELECT event_id, user_id, value FROM events WHERE event_type = 'error'""",
    "quick_filter": """
SELECT event_id, user_id, value FROM events
QUALIFY value <= 1.07::DOUBLE * min(value) OVER (PARTITION BY user_id)""",
    "quick_filter_overall": """
SELECT event_id, user_id, value FROM events
WHERE value <= 20 * (SELECT min(value) FROM events)""",
    "row_index": """
SELECT event_id, user_id, idx FROM (
  SELECT event_id, user_id,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS idx
  FROM events)
WHERE idx >= 1""",
    "typed_projection": """
SELECT event_id AS id, value::REAL AS reading, trunc(value)::INTEGER AS whole,
       (event_type = 'error')::INTEGER AS flag, 'Grand Prix' AS race FROM events""",
    "duration_seconds": """
SELECT event_id, epoch(ts - date_trunc('day', ts)) AS seconds FROM events""",
    "duration_text_clean": """
SELECT event_id, replace(event_id || ' days 00:01:02', '0 days ', '') AS text
FROM events""",
    "event_time_text": """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS text FROM events""",
    "batch_car_summary": """
WITH kinds AS (
  SELECT user_id, event_type, row_number() OVER (
           PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS place
  FROM events GROUP BY user_id, event_type)
SELECT e.user_id, sum(value::DECIMAL(18,2))::DOUBLE / count(value) AS avg_value,
       max(value) AS max_value,
       sum(value::REAL::DECIMAL(18,6))::DOUBLE / count(value) AS avg_reading,
       max(value::REAL) AS max_reading, any_value(k.event_type) AS mode_event_type
FROM events e JOIN kinds k ON k.user_id = e.user_id AND k.place = 1
GROUP BY e.user_id""",
    "batch_stint_summary": """
SELECT l_suppkey, l_returnflag, l_linestatus,
       sum(l_extendedprice::DECIMAL(18,2))::DOUBLE / count(l_extendedprice) AS avg_price,
       min(l_extendedprice) AS best_price, max(l_extendedprice) AS max_price
FROM lineitem GROUP BY ALL""",
    "batch_weather_summary": """
SELECT nullif(c_mktsegment, 'BUILDING') AS segment,
       sum(c_acctbal::DECIMAL(18,2))::DOUBLE / count(c_acctbal) AS avg_balance,
       avg(c_nationkey) AS avg_c_nationkey
FROM customer GROUP BY 1""",
    "mode_by_count": """
SELECT l_suppkey, l_partkey AS mode_l_partkey FROM (
  SELECT l_suppkey, l_partkey, row_number() OVER (
           PARTITION BY l_suppkey ORDER BY count(*) DESC, l_partkey) AS place
  FROM lineitem GROUP BY l_suppkey, l_partkey)
WHERE place = 1""",
    "tumbling_window": f"""
SELECT event_type, ws AS window_start, ws + INTERVAL '65 seconds' AS window_end,
       {_VALUE_MEASURES}
FROM (SELECT *, time_bucket(INTERVAL '65 seconds', ts, TIMESTAMP '1970-01-01') AS ws
      FROM events)
GROUP BY event_type, ws""",
    "sliding_window": _sliding(50, 5),
    "stint_window": _sliding(65, 7),
    "stint_window_mode": """
WITH listed AS (
  SELECT event_type, (props->>'k')::INTEGER % 8 AS gear, ts,
         time_bucket(INTERVAL '10 seconds', ts, TIMESTAMP '1970-01-01')
           - to_seconds(10 * k) AS ws
  FROM events, range(7) AS r(k)),
counted AS (
  SELECT event_type, ws, gear, count(*) AS c
  FROM listed WHERE ts < ws + INTERVAL '65 seconds' GROUP BY event_type, ws, gear)
SELECT event_type, ws AS window_start, ws + INTERVAL '65 seconds' AS window_end,
       arg_max(gear, c * 100 - gear) AS mode_gear, sum(c)::BIGINT AS n
FROM counted GROUP BY event_type, ws""",
    "interval_join": f"""
WITH {_LAPS}
SELECT lap_id, l.user_id, lap, count(*) AS points,
       sum(value::DECIMAL(18,2))::DOUBLE AS sum_value
FROM laps l JOIN events e
  ON e.user_id = l.user_id AND e.ts >= lap_start AND e.ts < lap_end
GROUP BY lap_id, l.user_id, lap""",
    "asof_join": """
SELECT e.event_id AS error_id, e.user_id, v.event_id AS view_id,
       v.value AS view_value
FROM (SELECT * FROM events WHERE event_type = 'error') e
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v
  ON e.user_id = v.user_id AND e.ts >= v.ts""",
    "asof_join_first_inside": f"""
WITH {_LAPS},
errors AS (SELECT * FROM events WHERE event_type = 'error')
SELECT lap_id, l.user_id,
       CASE WHEN f.ts < lap_end THEN f.event_id ELSE b.event_id END AS error_id,
       CASE WHEN f.ts < lap_end THEN f.value ELSE b.value END AS error_value
FROM laps l
ASOF LEFT JOIN errors b ON l.user_id = b.user_id AND l.lap_start >= b.ts
ASOF LEFT JOIN errors f ON l.user_id = f.user_id AND l.lap_start <= f.ts""",
    "nest_records": _nested(5000),
    "nest_records_parts": _nested(3),
    "explode_records": """
SELECT l_orderkey AS orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
       l_extendedprice, l_shipdate
FROM lineitem SEMI JOIN orders ON l_orderkey = o_orderkey""",
    "publish_topic": "SELECT * FROM events",
    "append_sentinel": """
SELECT event_type AS topic, props AS value FROM events
UNION ALL
SELECT unnest(['car', 'lap', 'weather', 'dbstore']), '{"end": "end"}'""",
    "sentinel_cut": """
SELECT user_id AS partition, event_id AS "offset", props AS value FROM events
QUALIFY event_id < coalesce(
  min(event_id) FILTER (event_type = 'error') OVER (PARTITION BY user_id),
  9223372036854775807)""",
    "topic_source": """
SELECT event_id, ts, user_id, value, props FROM events WHERE event_type = 'error'""",
    "load_session": """
SELECT event_id, ts, user_id, value FROM events WHERE event_type = 'error'""",
    "race_lap_messages": _RACE
    + """
SELECT user_id::VARCHAR AS "Driver", (lap // 5)::INTEGER AS "Stint",
       CASE WHEN lap % 2 = 0 THEN 'SOFT' ELSE 'HARD' END AS "Compound",
       sum(lap_time::DECIMAL(18,6))::DOUBLE / count(lap_time) AS average_lap_time,
       min(lap_time) AS best_lap_time, max(lap_time) AS max_lap_time
FROM chosen GROUP BY 1, 2, 3""",
    "race_weather_messages": _RACE
    + f"""
SELECT 'Race ' || user_id AS "Race", {_WEATHER_MEASURES}
FROM sky GROUP BY user_id""",
    "nested_parse": _RACE
    + """
SELECT s.user_id::VARCHAR AS "Driver", s.lap::INTEGER AS "LapNumber", any_value(air) AS air,
       count(p.ts) AS points, arg_min(p.speed, p.ts) AS first_speed
FROM sky s LEFT JOIN points p ON p.user_id = s.user_id AND p.lap = s.lap
GROUP BY s.user_id, s.lap""",
    "race_car_messages": _RACE + "," + _car_summary("points"),
    "store_split": _RACE + "," + _car_summary("points"),
    "store_split_laps": _RACE
    + """
SELECT user_id::VARCHAR AS "Driver", lap::INTEGER AS "LapNumber", lap_time AS "LapTime",
       air AS "AirTemp", wet AS "Humidity", 'Race ' || user_id AS "Race" FROM sky""",
    "until_sentinel": "SELECT * FROM events",
    "stream_car_summary": """
WITH points AS (
  SELECT user_id AS lap, value::REAL AS speed, (props->>'k')::INTEGER AS k
  FROM events),"""
    + _car_summary("points"),
    "stream_stint_window": """
WITH listed AS (
  SELECT event_type, value::REAL AS lap_time, date_trunc('second', ts) AS sent,
         CASE WHEN value > 20 THEN 'SOFT' ELSE 'HARD' END AS compound,
         time_bucket(INTERVAL '10 seconds', ts, TIMESTAMP '1970-01-01')
           - to_seconds(10 * k) AS ws
  FROM events, range(7) AS r(k))
SELECT event_type AS "Driver", 1 AS "Stint", compound AS "Compound",
       ws AS window_start, ws + INTERVAL '65 seconds' AS window_end,
       sum(lap_time::DECIMAL(18,6))::DOUBLE / count(lap_time) AS average_lap_time,
       min(lap_time) AS best_lap_time, max(lap_time) AS max_lap_time
FROM listed WHERE sent < ws + INTERVAL '65 seconds'
GROUP BY event_type, compound, ws""",
    "stream_weather_window": f"""
WITH listed AS (
  SELECT nullif(event_type, 'signup') AS race, value::REAL AS air,
         (props->>'k')::INTEGER::REAL AS wet,
         time_bucket(INTERVAL '10 seconds', ts, TIMESTAMP '1970-01-01')
           - to_seconds(10 * k) AS ws
  FROM events, range(5) AS r(k))
SELECT race AS "Race", ws AS window_start, ws + INTERVAL '50 seconds' AS window_end,
       {_WEATHER_MEASURES}
FROM listed GROUP BY race, ws""",
    "late_rows": """
WITH span AS (
  SELECT date_trunc('day', min(ts) + (max(ts) - min(ts)) / 2) AS middle, max(ts) AS last
  FROM events),
hourly AS (
  SELECT *, time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') AS ws
  FROM events, span)
SELECT event_type, ws AS window_start, ws + INTERVAL '1 hour' AS window_end,
       count(value) AS n, max(value) AS max_value
FROM hourly WHERE ts >= middle OR ws + INTERVAL '1 hour' > last
GROUP BY event_type, ws""",
    "ordered_topic": """
SELECT user_id, count(*) AS n, 1::BIGINT AS partitions, 0::BIGINT AS swapped, 0::BIGINT AS gaps
FROM events GROUP BY user_id""",
    "stream_pane_window": """
WITH listed AS (
  SELECT event_type, value::REAL AS lap_time, ts,
         CASE WHEN value > 20 THEN 'SOFT' ELSE 'HARD' END AS compound,
         time_bucket(INTERVAL '10 seconds', ts, TIMESTAMP '1970-01-01')
           - to_seconds(10 * k) AS ws
  FROM events, range(7) AS r(k))
SELECT event_type AS "Driver", 1 AS "Stint", compound AS "Compound",
       ws AS window_start, ws + INTERVAL '65 seconds' AS window_end,
       sum(lap_time::DECIMAL(18,6))::DOUBLE / count(lap_time) AS average_lap_time,
       min(lap_time) AS best_lap_time, max(lap_time) AS max_lap_time
FROM listed WHERE ts < ws + INTERVAL '65 seconds'
GROUP BY event_type, compound, ws""",
    "merged_car_summary": """
WITH points AS (
  SELECT user_id AS lap, value::REAL AS speed, (props->>'k')::INTEGER AS k
  FROM events),"""
    + _car_summary("points"),
    "compacted_versions": """
SELECT user_id, event_id, ts, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "stream_nest_records": f"""
WITH {_LAPS},
held AS (
  SELECT l.user_id, l.lap, l.lap_id, e.event_id, e.ts, round(e.value * 100)::BIGINT AS cents
  FROM laps l LEFT JOIN events e
    ON e.user_id = l.user_id AND e.ts >= l.lap_start AND e.ts < l.lap_end)
SELECT user_id, lap, lap_id, greatest(1, (count(event_id) + 19) // 20) AS parts,
       count(event_id) AS n, sum(cents)::BIGINT AS cents,
       arg_min(event_id, (ts, event_id)) AS first_event
FROM held GROUP BY user_id, lap, lap_id""",
    "stream_batch_rows": """
SELECT row_number() OVER (ORDER BY ts::DATE) - 1 AS batch_id, count(*) AS input_rows,
       count(value) AS readings, max(value) AS top
FROM events GROUP BY ts::DATE""",
    "bucketed_session": """
SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS idx
FROM events""",
    "rejects_by_reason": """
SELECT event_id,
       CASE k WHEN 67 THEN 'sentinel' WHEN 68 THEN 'not JSON' WHEN 64 THEN 'not an object'
         WHEN 69 THEN 'wrong type' WHEN 63 THEN 'wrong type' ELSE 'missing field' END AS reason,
       CASE WHEN k IN (64, 67, 68) THEN NULL ELSE 'k' END AS field
FROM (SELECT event_id, (props->>'k')::INTEGER AS k FROM events) WHERE k BETWEEN 63 AND 69""",
}

# live forms give what the stored ones give
SQL["stream_interval_join"] = SQL["interval_join"]
SQL["stream_asof_join"] = SQL["asof_join"]
