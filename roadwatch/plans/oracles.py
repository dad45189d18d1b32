"""The queries of `queries.py` in SQL over the given tables."""

_LIMIT = "CASE event_type WHEN 'view' THEN 110 WHEN 'click' THEN 110 WHEN 'purchase' THEN 90 END"
_DIST = "CASE event_type WHEN 'view' THEN 660 WHEN 'click' THEN 540 WHEN 'purchase' THEN 0 END"
_CAM = "CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 END"

_SIGHT = f"""
sight AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS car_plate,
         CAST({_CAM} AS INTEGER) AS camera_id, ts, value AS speed_reading,
         CAST({_LIMIT} AS INTEGER) AS speed_limit, CAST({_DIST} AS INTEGER) AS dist_next
  FROM events WHERE event_type IN ('view', 'click', 'purchase')
)"""


def _joined(how, window, name="pairs", source="sight"):
    """All segments: sightings of one camera against those of the next."""
    return f"""
starts AS (SELECT * FROM {source} WHERE camera_id IN (1, 2)),
ends AS (SELECT * FROM {source} WHERE camera_id IN (2, 3)),
{name} AS (
  SELECT s.car_plate AS car_plate_start, e.car_plate AS car_plate_end,
         s.ts AS timestamp_start, e.ts AS timestamp_end,
         s.camera_id AS camera_id_start, e.camera_id AS camera_id_end,
         s.event_id AS event_id_start, e.event_id AS event_id_end,
         s.dist_next AS dist_next, e.speed_limit AS speed_limit,
         CASE WHEN coalesce(s.camera_id, e.camera_id - 1) = 1 THEN '1-2' ELSE '2-3' END AS segment
  FROM starts s {how} JOIN ends e
    ON s.car_plate = e.car_plate AND e.camera_id = s.camera_id + 1
   AND s.ts BETWEEN e.ts - INTERVAL {window} AND e.ts
)"""


_INSTANT = "instant AS (SELECT * FROM sight WHERE speed_reading >= speed_limit)"

_TRIPS = """
trips AS (
  SELECT car_plate_start AS car_plate, timestamp_start, timestamp_end, camera_id_start,
         camera_id_end, dist_next, speed_limit,
         epoch(timestamp_end) - epoch(timestamp_start) AS duration
  FROM pairs WHERE timestamp_start IS NOT NULL AND timestamp_end IS NOT NULL
),
average AS (
  SELECT *, CAST(dist_next AS DOUBLE) / nullif(duration / 3600, 0) AS average_speed
  FROM trips WHERE duration <= (3600 * CAST(dist_next AS DOUBLE)) / speed_limit
)"""

_RECORDS = f"""
stream_records AS (
  SELECT car_plate, CAST(ts AS DATE) AS date, 'instant' AS type,
         CAST(NULL AS INTEGER) AS camera_id_start, camera_id AS camera_id_end,
         CAST(NULL AS TIMESTAMP) AS timestamp_start, ts AS timestamp_end,
         speed_reading, ts + INTERVAL 5 SECOND AS updated_at, 'stream' AS origin
  FROM instant
  UNION ALL
  SELECT car_plate, CAST(timestamp_end AS DATE), 'average', camera_id_start, camera_id_end,
         timestamp_start, timestamp_end, average_speed, timestamp_end + INTERVAL 5 SECOND,
         'stream'
  FROM average
)"""

# Slash dates keep whole seconds only.
_HISTORIC = """
history AS (
  SELECT CAST(user_id AS VARCHAR) AS car_plate, value,
         CASE WHEN value < 50 THEN ts ELSE date_trunc('second', ts) END AS timestamp_end,
         CASE WHEN value < 50 THEN ts - INTERVAL 10 MINUTE
              ELSE date_trunc('second', ts - INTERVAL 10 MINUTE) END AS timestamp_start
  FROM events WHERE event_type = 'signup'
),
historic AS (
  SELECT car_plate, CAST(timestamp_start AS DATE) AS date, 'average' AS type,
         1 AS camera_id_start, 2 AS camera_id_end, timestamp_start, timestamp_end,
         value AS speed_reading, timestamp_end AS updated_at, 'historic' AS origin
  FROM history
)"""

_ALL = """
all_records AS (SELECT * FROM stream_records UNION ALL SELECT * FROM historic)"""

_STREAM_RECORDS = ",".join([_SIGHT, _INSTANT, _joined("INNER", "21600 SECOND"), _TRIPS, _RECORDS])
_ALL_RECORDS = ",".join([_STREAM_RECORDS, _HISTORIC, _ALL])

_DROPPED = """
dropped AS (
  SELECT CASE WHEN coalesce(event_id_end, '') = '' THEN event_id_start ELSE event_id_end END
           AS event_id,
         CASE WHEN coalesce(event_id_end, '') = '' THEN car_plate_start ELSE car_plate_end END
           AS car_plate,
         CASE WHEN coalesce(event_id_end, '') = '' THEN camera_id_start ELSE camera_id_end END
           AS camera_id,
         CASE WHEN coalesce(event_id_end, '') = '' THEN timestamp_start ELSE timestamp_end END
           AS "timestamp",
         coalesce(timestamp_end, timestamp_start) + INTERVAL 5 SECOND AS ingested_at
  FROM pairs WHERE timestamp_start IS NULL OR timestamp_end IS NULL
)"""

_PAIR_COLUMNS = """car_plate_start, car_plate_end, timestamp_start, timestamp_end,
camera_id_start, camera_id_end, event_id_start, event_id_end, dist_next, speed_limit"""
_RECORD_COLUMNS = """car_plate, date, type, camera_id_start, camera_id_end, timestamp_start,
timestamp_end, speed_reading, updated_at, origin"""

_CAMERAS = """
cameras(camera_id, latitude, longitude, position, speed_limit) AS (
  VALUES (1, CAST(2.157730731 AS DOUBLE), CAST(102.6601002 AS DOUBLE), CAST(152.5 AS DOUBLE), 110),
         (2, CAST(2.162418757 AS DOUBLE), CAST(102.6524549 AS DOUBLE), CAST(153.5 AS DOUBLE), 110),
         (3, CAST(2.167352891 AS DOUBLE), CAST(102.6449144 AS DOUBLE), CAST(154.5 AS DOUBLE), 90)
)"""

# Last value by date, then order key, skipping gaps.
_VEHICLES = """
register AS (
  SELECT CAST(o_custkey AS VARCHAR) AS car_plate,
         nullif(o_orderpriority, '5-LOW') AS owner_name,
         CAST(o_orderkey AS VARCHAR) AS owner_addr,
         nullif(o_orderstatus, 'P') AS vehicle_type,
         o_orderdate AS registration_date, o_orderkey AS entry
  FROM orders
),
vehicles AS (
  SELECT car_plate,
         last(owner_name ORDER BY registration_date, entry) FILTER (owner_name IS NOT NULL)
           AS owner_name,
         last(owner_addr ORDER BY registration_date, entry) FILTER (owner_addr IS NOT NULL)
           AS owner_addr,
         last(vehicle_type ORDER BY registration_date, entry) FILTER (vehicle_type IS NOT NULL)
           AS vehicle_type,
         max(registration_date) AS registration_date
  FROM register WHERE car_plate IS NOT NULL GROUP BY car_plate
)"""

_SINCE = "TIMESTAMP '2024-01-20 00:00:00'"

_CHANGED = f"""
changed AS (
  SELECT r.* FROM all_records r
  WHERE EXISTS (
    SELECT 1 FROM all_records t
    WHERE t.car_plate = r.car_plate AND t.date = r.date
      AND t.origin = 'stream' AND t.updated_at > {_SINCE}
  )
)"""

_ARRIVALS = """
arrivals AS (
  SELECT camera_id_end AS camera_id, time_bucket(INTERVAL 5 MINUTE, timestamp_end) AS arrival_time,
         updated_at, speed_reading, type
  FROM changed
),
recent AS (
  SELECT a.* FROM arrivals a
  JOIN (SELECT camera_id, max(arrival_time) AS latest FROM arrivals GROUP BY camera_id) m
    ON a.camera_id = m.camera_id AND a.arrival_time >= m.latest - INTERVAL 12 HOUR
)"""

_POINTS = """
stats AS (
  SELECT camera_id_end AS camera_id, type,
         time_bucket(INTERVAL 6 HOUR, timestamp_end) AS start_time,
         CAST(count(*) AS DOUBLE) AS total_violations,
         round(avg(speed_reading), 8) AS avg_speed
  FROM stream_records GROUP BY ALL
),
points AS (
  SELECT camera_id, type, start_time, 'total_violations' AS measure, total_violations AS value
  FROM stats
  UNION ALL
  SELECT camera_id, type, start_time, 'avg_speed', avg_speed FROM stats WHERE type = 'instant'
)"""

_HOUR_RANGE = "date >= DATE '2024-01-05' AND date < DATE '2024-01-25'"

_CAMERA_CELLS = f"""
cells AS (
  SELECT CAST(hour(timestamp_end) AS INTEGER) AS hour, camera_id_end AS camera_id,
         count(*) AS violation_count, avg(speed_reading) AS exceeded_speed
  FROM stream_records WHERE {_HOUR_RANGE} GROUP BY ALL
)"""

_SEGMENT_CELLS = f"""
cells AS (
  SELECT CAST(hour(timestamp_end) AS INTEGER) AS hour, camera_id_start, camera_id_end, type,
         count(*) AS violation_count, avg(speed_reading) AS exceeded_speed
  FROM stream_records WHERE {_HOUR_RANGE} AND type = 'average' GROUP BY ALL
)"""


def _watermark(cameras, source="sight"):
    """The slowest stream's latest time, in whole milliseconds, less half an hour."""
    return f"""
mark AS (
  SELECT min(latest) - INTERVAL 30 MINUTE AS wm FROM (
    SELECT date_trunc('millisecond', max(ts)) AS latest FROM {source}
    WHERE camera_id IN ({cameras}) GROUP BY camera_id)
)"""


# Lone rows come out of a stream once no partner can arrive any more.
_EMITTED = """(timestamp_start IS NOT NULL AND timestamp_end IS NOT NULL)
   OR (timestamp_end IS NULL AND timestamp_start <= wm - INTERVAL 21600 SECOND)
   OR (timestamp_start IS NULL AND timestamp_end <= wm)"""

_FULL = ",".join([_SIGHT, _joined("FULL OUTER", "21600 SECOND")])
_FIRST = "segment = '1-2'"

# Each upload is a run of its own. A run starts from the watermark reached so far and moves it
# on to what the slower side of this upload allows.
_UPLOADS = """
arrived AS (
  SELECT *, CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 15) AS INTEGER)
            + CASE WHEN speed_reading < 20 THEN 1 ELSE 0 END AS upload
  FROM sight WHERE camera_id IN (1, 2)
),
side_marks AS (
  SELECT upload, camera_id, date_trunc('millisecond', max(ts)) AS latest
  FROM arrived GROUP BY upload, camera_id
),
own_marks AS (
  SELECT upload, min(latest) - INTERVAL 30 MINUTE AS wm
  FROM side_marks GROUP BY upload HAVING count(*) = 2
),
marks AS (
  SELECT u.upload, max(o.wm) AS wm
  FROM (SELECT DISTINCT upload FROM arrived) u JOIN own_marks o ON o.upload <= u.upload
  GROUP BY u.upload
),
mark AS (SELECT max(wm) AS wm FROM marks),
kept AS (
  SELECT a.* FROM arrived a LEFT JOIN marks m ON m.upload = a.upload - 1
  WHERE m.wm IS NULL OR a.ts > m.wm
)"""


def _json_value():
    day = "CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS VARCHAR)"
    return f"""'{{"event_id":"' || CAST(event_id AS VARCHAR) || '","batch_id":' || {day}
|| ',"car_plate":"' || CAST(user_id AS VARCHAR) || '","camera_id":1,"timestamp":"'
|| strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z","speed_reading":' || CAST(value AS VARCHAR) || '}}'"""


ORACLES = {
    "envelope_decode": """
SELECT CASE WHEN ok THEN CAST(event_id AS VARCHAR) END AS event_id,
       CASE WHEN ok AND event_type <> 'signup'
            THEN CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) END
         AS batch_id,
       CASE WHEN ok THEN CAST(user_id AS VARCHAR) END AS car_plate,
       CASE WHEN ok THEN 1 END AS camera_id,
       CASE WHEN ok THEN ts END AS "timestamp",
       CASE WHEN ok THEN value END AS speed_reading,
       1 AS producer_id,
       CASE WHEN ok THEN 110 END AS speed_limit,
       CASE WHEN event_type <> 'signup' THEN 1 END AS dist_next,
       CASE WHEN ok THEN ts + INTERVAL 5 SECOND END AS processing_timestamp
FROM (SELECT *, event_type <> 'error' AS ok FROM events)
""",
    "envelope_rejects": """
SELECT event_type AS topic, CASE event_type
         WHEN 'error' THEN 'no JSON; bad header speed_limit; bad header processing_timestamp'
         WHEN 'signup' THEN 'missing header dist_next' ELSE '' END AS reasons, count(*) AS n_messages
FROM events GROUP BY event_type
""",
    "envelope_roundtrip": f"""
SELECT 'jsondata' AS message_key, {_json_value()} AS message_value,
       'producer_id=1;speed_limit=110;dist_next=1;processing_timestamp='
       || strftime(ts + INTERVAL 5 SECOND, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS message_headers,
       'camera_' || event_type AS topic
FROM events WHERE event_type <> 'signup'
""",
    "camera_dim": f"""
WITH {_SIGHT}, {_CAMERAS}
SELECT c.camera_id AS id, c.latitude, c.longitude, c.position, c.speed_limit, n.sightings
FROM cameras c LEFT JOIN (SELECT camera_id, count(*) AS sightings FROM sight GROUP BY 1) n
  USING (camera_id)
""",
    "vehicle_latest": f"WITH {_VEHICLES} SELECT * FROM vehicles",
    "historic_load": f"WITH {_HISTORIC} SELECT {_RECORD_COLUMNS} FROM historic",
    "violation_upsert": f"WITH {_STREAM_RECORDS} SELECT {_RECORD_COLUMNS} FROM stream_records",
    "dropped_pairs_log": f"WITH {_FULL}, {_DROPPED} SELECT DISTINCT * FROM dropped",
    "retention_filter": f"""
WITH {_FULL}, {_DROPPED}
SELECT DISTINCT * FROM dropped
WHERE ingested_at >= TIMESTAMP '2025-01-16 00:00:00' - INTERVAL 1 YEAR
""",
    "retention_drop": f"""
WITH {_FULL}, {_DROPPED},
gone AS (SELECT count(DISTINCT CAST(ingested_at AS DATE)) AS days_gone FROM dropped WHERE ingested_at < DATE '2024-01-16'),
newest AS (
  SELECT * FROM dropped WHERE ingested_at >= DATE '2024-01-16'
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingested_at DESC) = 1
)
SELECT newest.*, days_gone FROM newest, gone
""",
    "instant_violation": f"""
WITH {_SIGHT}, {_INSTANT}
SELECT event_id, car_plate, camera_id, ts AS "timestamp", speed_reading, speed_limit FROM instant
""",
    "segment_match": f"""
WITH {_SIGHT}, {_joined("INNER", "21600 SECOND")}, {_TRIPS}
SELECT car_plate, timestamp_start, timestamp_end, camera_id_start, camera_id_end, dist_next,
       speed_limit FROM trips WHERE camera_id_start = 1
""",
    "average_violation": f"""
WITH {_SIGHT}, {_joined("INNER", "86400 SECOND")}, {_TRIPS} SELECT * FROM average
""",
    "dropped_pairs": f"WITH {_FULL}, {_DROPPED} SELECT * FROM dropped",
    "segment_boundary": f"""
WITH {_SIGHT}
SELECT event_id,
       CAST(ceil(CAST(dist_next AS DOUBLE) / speed_limit * 3600) AS BIGINT) AS window_seconds,
       CAST(ceil(speed_reading * CAST(0.1 AS DOUBLE) / speed_limit * 3600) AS BIGINT)
         AS boundary_seconds
FROM sight
""",
    "segment_full_outer": f"WITH {_FULL} SELECT {_PAIR_COLUMNS} FROM pairs WHERE {_FIRST}",
    "segment_chain": f"WITH {_FULL} SELECT segment, {_PAIR_COLUMNS} FROM pairs",
    "hotspots": f"""
WITH {_STREAM_RECORDS}, {_CAMERAS}, {_CAMERA_CELLS}
SELECT hour, camera_id, latitude, longitude, violation_count,
       round(exceeded_speed, 2) AS exceeded_speed,
       CASE WHEN violation_count > 10 THEN 'hotspot' WHEN violation_count < 10 THEN 'normal' END
         AS class
FROM cells JOIN cameras USING (camera_id)
""",
    "segment_midpoint": f"""
WITH {_STREAM_RECORDS}, {_CAMERAS}, {_SEGMENT_CELLS}
SELECT hour, c.camera_id_start, c.camera_id_end, type, violation_count,
       round(exceeded_speed, 2) AS exceeded_speed,
       (s.latitude + e.latitude) / 2 AS mid_lat, (s.longitude + e.longitude) / 2 AS mid_lon
FROM cells c JOIN cameras s ON s.camera_id = c.camera_id_start
JOIN cameras e ON e.camera_id = c.camera_id_end
""",
    "hourly_camera_stats": f"""
WITH {_STREAM_RECORDS}, {_CAMERA_CELLS}
SELECT hour, camera_id, violation_count, round(exceeded_speed, 6) AS exceeded_speed FROM cells
""",
    "hourly_segment_stats": f"""
WITH {_STREAM_RECORDS}, {_SEGMENT_CELLS}
SELECT hour, camera_id_start, camera_id_end, type, violation_count,
       round(exceeded_speed, 6) AS exceeded_speed FROM cells
""",
    "changed_documents": f"WITH {_ALL_RECORDS}, {_CHANGED} SELECT {_RECORD_COLUMNS} FROM changed",
    "violation_owner": f"""
WITH {_STREAM_RECORDS}, {_VEHICLES}
SELECT r.*, v.owner_name, v.owner_addr, v.vehicle_type, v.registration_date
FROM (SELECT {_RECORD_COLUMNS} FROM stream_records) r LEFT JOIN vehicles v USING (car_plate)
""",
    "violation_owner_bucketed": f"""
WITH {_STREAM_RECORDS}, {_VEHICLES}
SELECT r.*, v.owner_name, v.owner_addr, v.vehicle_type, v.registration_date
FROM (SELECT {_RECORD_COLUMNS} FROM stream_records) r LEFT JOIN vehicles v USING (car_plate)
""",
    "vehicle_deregister": f"""
WITH {_VEHICLES}
SELECT * FROM vehicles WHERE car_plate NOT IN
  (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal < 0)
""",
    "orphan_cameras": f"""
WITH {_STREAM_RECORDS}, {_CAMERAS}
SELECT camera_id, count(*) AS violation_count FROM (
  SELECT camera_id_start AS camera_id FROM stream_records
  UNION ALL SELECT camera_id_end FROM stream_records)
WHERE camera_id IS NOT NULL
  AND camera_id NOT IN (SELECT camera_id FROM cameras WHERE position < 154)
GROUP BY camera_id
""",
    "live_stats": f"""
WITH {_ALL_RECORDS}, {_CHANGED}, {_ARRIVALS}
SELECT camera_id, type, count(*) AS total_violations, round(avg(speed_reading), 8) AS avg_speed,
       quantile_disc(speed_reading, 0.9) AS p90_speed, arrival_time AS start_time,
       arrival_time + INTERVAL 5 MINUTE AS end_time
FROM recent GROUP BY camera_id, type, arrival_time
""",
    "trailing_hour": f"WITH {_ALL_RECORDS}, {_CHANGED}, {_ARRIVALS} SELECT * FROM recent",
    "daily_document": f"""
WITH {_ALL_RECORDS}
SELECT car_plate, date, count(*) AS entries,
       string_agg(
         strftime(timestamp_end, '%Y-%m-%d %H:%M:%S.%f') || '|' || type || '|'
         || coalesce(CAST(camera_id_start AS VARCHAR), '-') || '|' || camera_id_end || '|' || origin,
         ';' ORDER BY timestamp_end, type, camera_id_start NULLS FIRST, camera_id_end,
                      timestamp_start NULLS FIRST, speed_reading, origin) AS violations,
       max(updated_at) AS updated_at
FROM all_records GROUP BY car_plate, date
""",
    "daily_explode": f"""
WITH {_ALL_RECORDS},
entries AS (
  SELECT car_plate, date, type, camera_id_start, camera_id_end, timestamp_start, timestamp_end,
         origin FROM all_records
)
SELECT 'drop empty' AS mode, * FROM entries
UNION ALL SELECT 'keep empty', * FROM entries
UNION ALL
SELECT 'keep empty', 'quiet-' || c_custkey, DATE '2024-01-01', NULL, NULL, NULL, NULL, NULL, NULL
FROM customer
""",
    "camera_bounds": f"""
WITH {_STREAM_RECORDS}, {_CAMERAS}
SELECT min(latitude) AS min_lat, max(latitude) AS max_lat, min(longitude) AS min_lon,
       max(longitude) AS max_lon, (min(latitude) + max(latitude)) / 2 AS center_lat,
       (min(longitude) + max(longitude)) / 2 AS center_lon
FROM cameras WHERE camera_id IN (SELECT camera_id_end FROM stream_records)
""",
    "high_water_mark": f"""
WITH {_ALL_RECORDS}, {_CHANGED}
SELECT {_SINCE} AS since, greatest(max(updated_at), {_SINCE}) AS next_since FROM changed
""",
    "series_peak_low": f"""
WITH {_STREAM_RECORDS}, {_POINTS}
SELECT camera_id, type, measure, max(value) AS peak,
       first(start_time ORDER BY value DESC, start_time) AS peak_time,
       min(value) AS low, first(start_time ORDER BY value, start_time) AS low_time
FROM points GROUP BY camera_id, type, measure
""",
    "series_spikes": f"""
WITH {_STREAM_RECORDS}, {_POINTS},
steps AS (
  SELECT *, value - lag(value) OVER w AS diff,
         coalesce(lag(start_time) OVER w, start_time) AS before,
         coalesce(lead(start_time) OVER w, start_time) AS after
  FROM points WINDOW w AS (PARTITION BY camera_id, type, measure ORDER BY start_time)
),
judged AS (
  SELECT *, 2 * stddev_samp(diff) OVER (PARTITION BY camera_id, type, measure) AS threshold
  FROM steps
)
SELECT camera_id, type, measure, start_time, value, round(diff, 6) AS diff,
       round(threshold, 6) AS threshold,
       coalesce(diff > threshold, false) AS spike, coalesce(diff < -threshold, false) AS drop,
       CASE WHEN abs(diff) > threshold THEN before END AS region_start,
       CASE WHEN abs(diff) > threshold THEN after END AS region_end
FROM judged
""",
    "store_life_cycle": f"WITH {_STREAM_RECORDS} SELECT {_RECORD_COLUMNS} FROM stream_records",
    "live_refresh_stream": f"""
WITH {_STREAM_RECORDS}, changed AS (SELECT * FROM stream_records WHERE type = 'instant'), {_ARRIVALS}
SELECT camera_id, type, count(*) AS total_violations, round(avg(speed_reading), 8) AS avg_speed,
       quantile_disc(speed_reading, 0.9) AS p90_speed, arrival_time AS start_time,
       arrival_time + INTERVAL 5 MINUTE AS end_time
FROM (
  SELECT a.* FROM arrivals a
  JOIN (SELECT camera_id, max(arrival_time) AS latest FROM arrivals GROUP BY camera_id) m
    ON a.camera_id = m.camera_id AND a.arrival_time >= m.latest - INTERVAL 1 HOUR
) GROUP BY camera_id, type, arrival_time
""",
    "bootstrap_vehicles": """
SELECT CAST(o_custkey AS VARCHAR) AS car_plate, max(date_trunc('day', o_orderdate::TIMESTAMP)) AS registration_date,
       count(*) AS entries
FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey
""",
    "bootstrap_history": f"""
WITH {_ALL_RECORDS}
SELECT {_RECORD_COLUMNS} FROM all_records
""",
    "unique_key_check": f"""
WITH {_ALL_RECORDS}
SELECT 'vehicle' AS entity, CAST(o_custkey AS VARCHAR) AS car_plate, CAST(NULL AS DATE) AS date,
       count(*) AS copies
FROM orders GROUP BY o_custkey HAVING count(*) > 1
UNION ALL
SELECT 'document', car_plate, date, count(*) FROM (
  SELECT car_plate, date FROM all_records GROUP BY car_plate, date
) GROUP BY car_plate, date HAVING count(*) > 1
""",
    "segment_full_outer_stream": f"""
WITH {_FULL}, {_watermark("1, 2")}
SELECT {_PAIR_COLUMNS} FROM pairs, mark WHERE {_FIRST} AND ({_EMITTED})
""",
    "segment_chain_stream": f"""
WITH {_SIGHT}, {_joined("FULL OUTER", "21600 SECOND", "every_pair")}, {_watermark("1, 2, 3")},
pairs AS (SELECT every_pair.* FROM every_pair, mark WHERE {_EMITTED}), {_TRIPS}, {_DROPPED}
SELECT 'average' AS output, CAST(NULL AS VARCHAR) AS event_id, car_plate, camera_id_start,
       camera_id_end AS camera_id, timestamp_start, timestamp_end AS "timestamp",
       average_speed AS speed_reading
FROM average
UNION ALL
SELECT DISTINCT 'dropped', event_id, car_plate, CAST(NULL AS INTEGER), camera_id,
       CAST(NULL AS TIMESTAMP), "timestamp", CAST(NULL AS DOUBLE)
FROM dropped
""",
    "late_rows_stream": f"""
WITH {_SIGHT}, {_UPLOADS}, {_joined("FULL OUTER", "21600 SECOND", "every_pair", "kept")}
SELECT {_PAIR_COLUMNS} FROM every_pair, mark WHERE {_FIRST} AND ({_EMITTED})
""",
    "late_count_stream": f"""
WITH {_SIGHT}, {_UPLOADS}
SELECT count(*) AS late_rows FROM arrived a JOIN marks m ON m.upload = a.upload - 1 WHERE a.ts <= m.wm
""",
    "state_rows_stream": f"""
WITH {_SIGHT}, {_watermark("1, 2")}
SELECT CASE camera_id WHEN 1 THEN 'left' ELSE 'right' END AS side, count(*) AS held FROM sight, mark
WHERE car_plate IS NOT NULL AND (camera_id = 1 AND ts > wm - INTERVAL 21600 SECOND OR camera_id = 2 AND ts > wm)
GROUP BY camera_id
""",
    "silent_camera_stream": f"""
WITH {_SIGHT}, {_joined("FULL OUTER", "21600 SECOND", "every_pair")},
latest AS (
  SELECT camera_id, date_trunc('millisecond', max(ts)) - INTERVAL 30 MINUTE AS wm FROM sight
  WHERE camera_id < 3 OR ts < {_SINCE} GROUP BY camera_id
),
forms AS (
  SELECT 'joint' AS form, min(wm) AS wm FROM latest
  UNION ALL
  SELECT 'per segment', min(wm) FROM latest WHERE camera_id < 3
)
SELECT form, count(DISTINCT event_id_start) AS lone_rows FROM forms LEFT JOIN every_pair
  ON camera_id_start = 1 AND timestamp_end IS NULL
  AND (car_plate_start IS NULL OR timestamp_start <= wm - INTERVAL 21600 SECOND)
GROUP BY form
""",
    "instant_violation_stream": f"""
WITH {_SIGHT}, {_INSTANT}
SELECT car_plate, CAST(ts AS DATE) AS date, 'instant' AS type,
       CAST(NULL AS INTEGER) AS camera_id_start, camera_id AS camera_id_end,
       CAST(NULL AS TIMESTAMP) AS timestamp_start, ts AS timestamp_end, speed_reading,
       TIMESTAMP '2024-03-01 00:00:00' AS updated_at, 'stream' AS origin
FROM instant
""",
    "live_stats_stream": f"""
WITH {_SIGHT}, {_INSTANT},
binned AS (
  SELECT camera_id, 'instant' AS type, time_bucket(INTERVAL 6 HOUR, ts) AS start_time,
         time_bucket(INTERVAL 5 MINUTE, ts) AS arrival, speed_reading
  FROM instant
),
mark AS (SELECT max(arrival) - INTERVAL 30 MINUTE AS wm FROM binned)
SELECT camera_id, type, count(*) AS total_violations, round(avg(speed_reading), 8) AS avg_speed,
       quantile_disc(speed_reading, 0.9) AS p90_speed, start_time,
       start_time + INTERVAL 6 HOUR AS end_time
FROM binned, mark
WHERE start_time + INTERVAL 6 HOUR <= wm
GROUP BY camera_id, type, start_time
""",
}
