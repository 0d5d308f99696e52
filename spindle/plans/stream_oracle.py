"""DuckDB twins of the registered stream runs: the same results from the whole
table at once."""

from __future__ import annotations

from spindle.plans.oracle import _SENSOR, _SENSOR_BATCHES, ORACLE_SQL, _jsplit, _lines

# Batches of the stream runs: two hours of the day.
_BY_HOUR = _SENSOR_BATCHES.replace("date_trunc('hour', ts) AS batch", "CAST(hour(ts) // 2 AS INTEGER) AS batch")

_HOUR_STATES = _BY_HOUR + """,
st AS (SELECT session_id, batch,
         CAST(sum(CASE WHEN is_reset THEN 0 ELSE hr END) OVER w AS BIGINT) AS total_hr,
         CAST(sum(CASE WHEN is_reset THEN 0 ELSE cal END) OVER w AS BIGINT) AS total_cal,
         CAST(sum(CASE WHEN is_reset THEN 1 ELSE n END) OVER w AS BIGINT) AS total_n
       FROM flag WINDOW w AS (PARTITION BY session_id, epoch ORDER BY batch ROWS UNBOUNDED PRECEDING)),
av AS (SELECT *, CASE WHEN total_n <> 0 THEN total_hr // total_n END AS avg_hr,
              CASE WHEN total_n <> 0 THEN total_cal // total_n END AS avg_cal FROM st)"""

STREAM_SQL: dict[str, str] = {
    "stream_sensor_avg": _HOUR_STATES + "\nSELECT session_id, batch, total_hr, total_cal, total_n, avg_hr, avg_cal FROM av",
    "stream_sensor_totals": _HOUR_STATES + "\nSELECT session_id, batch, total_hr, total_cal FROM av",
    "stream_sensor_state": _HOUR_STATES + """
SELECT session_id, total_hr, total_cal, total_n, avg_hr, avg_cal
FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY batch DESC) AS rn FROM av) WHERE rn = 1""",
    "stream_word_count": f"""
WITH l AS (SELECT conv_id % 12 AS batch, unnest({_lines('text')}) AS line FROM conversations),
w AS (SELECT batch, unnest({_jsplit('line', "' '")}) AS word FROM l),
per AS (SELECT word, batch, count(*) AS n FROM w GROUP BY word, batch)
SELECT word, batch, CAST(sum(n) OVER (PARTITION BY word ORDER BY batch ROWS UNBOUNDED PRECEDING) AS BIGINT) AS n FROM per""",
    # The last watermark is ten minutes before the last event.
    "stream_sliding_count": f"""
SELECT * FROM ({ORACLE_SQL["sliding_count_1s"]})
WHERE window_end <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL '10 minutes' FROM events)""",
    "stream_sessions": _SENSOR + """,
w AS (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL '10 minutes' AS mark FROM events),
o AS (SELECT r.*, lag(ts) OVER k AS before, lag(is_marker) OVER k AS after_marker
      FROM r, w WHERE ts <= mark WINDOW k AS (PARTITION BY session_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(CASE WHEN before IS NOT NULL AND (after_marker OR ts - before > INTERVAL '6 hours') THEN 1 ELSE 0 END)
                  OVER (PARTITION BY session_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session_no FROM o),
g AS (SELECT session_id, CAST(session_no AS BIGINT) AS session_no, min(ts) AS first_ts, max(ts) AS last_ts,
             count(*) FILTER (NOT is_marker) AS n, CAST(coalesce(sum(heart_rate) FILTER (NOT is_marker), 0) AS BIGINT) AS total_hr,
             CAST(coalesce(sum(calorie) FILTER (NOT is_marker), 0) AS BIGINT) AS total_cal, bool_or(is_marker) AS marked
      FROM s GROUP BY session_id, session_no)
SELECT session_id, session_no, first_ts, last_ts, n, total_hr, total_cal, CASE WHEN marked THEN 'marker' ELSE 'idle' END AS closed_by
FROM g, w WHERE marked OR last_ts + INTERVAL '6 hours' < mark""",
    "stream_tweet_upsert": ORACLE_SQL["tweet_upsert_by_id"],
    "stream_offset_ranges": """
SELECT CAST(hour(ts) // 2 AS INTEGER) AS batch, 'events' AS topic, CAST(user_id % 4 AS INTEGER) AS "partition",
       min(event_id) AS from_offset, max(event_id) + 1 AS until_offset, count(*) AS n_records
FROM events GROUP BY 1, 2, 3""",
}
