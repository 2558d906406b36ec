"""SQL text of the derived views (same definitions as ``kestrel.sources.derived``),
for composing oracle queries as ``WITH <views> SELECT …``."""

from __future__ import annotations

FEATURES = """features AS (
  SELECT printf('user_%04d', user_id) AS entity_id,
         TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS age,
         value AS income, event_type AS category, ts AS feature_timestamp
  FROM events)"""

PERIODS = FEATURES + """,
periods AS (
  SELECT *, CASE WHEN feature_timestamp < TIMESTAMP '2024-01-16 00:00:00' THEN 'baseline'
                 WHEN feature_timestamp >= TIMESTAMP '2024-01-16 00:00:00' THEN 'current' END AS period
  FROM features)"""

SNAPSHOTS = FEATURES + """,
snapshots AS (
  SELECT *, date_trunc('week', feature_timestamp) AS snapshot_ts FROM features)"""

MEASUREMENTS = """measurements AS (
  SELECT date_trunc('hour', ts) AS ts, event_type AS name, min(value) AS min, max(value) AS max
  FROM events GROUP BY 1, 2)"""

SENSORS = """sensors AS (
  SELECT CAST(row_number() OVER (ORDER BY name) - 1 AS INTEGER) AS pos, name
  FROM (SELECT DISTINCT event_type AS name FROM events WHERE event_type IS NOT NULL))"""

# every (hour present, sensor) cell of the series documents, null point when absent
SERIES_CELLS = MEASUREMENTS + ",\n" + SENSORS + """,
hours AS (SELECT DISTINCT ts FROM measurements),
cells AS (
  SELECT strftime(h.ts, '%Y%m%d') AS doc_id, h.ts, s.pos, s.name, m.min, m.max
  FROM hours h CROSS JOIN sensors s
  LEFT JOIN measurements m ON m.ts = h.ts AND m.name = s.name)"""

OBJECTS = """objects AS (
  SELECT page_id,
         regexp_replace(regexp_replace(url, '^https?://', ''), '[?#].*$', '') AS name,
         'pages' AS bucket,
         CAST(octet_length(encode(html)) AS BIGINT) AS size,
         'text/html' AS content_type,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(page_id) AS created,
         CASE WHEN page_id % 13 = 0 THEN NULL
              ELSE TIMESTAMP '2024-01-01 00:00:00' + to_hours(page_id % 50) END AS updated,
         substr(md5(html), 1, 16) AS etag,
         md5(html) AS md5_hash
  FROM pages)"""

MESSAGES = OBJECTS + """,
messages AS (
  SELECT 'p' || CAST(page AS VARCHAR) AS message_id, to_json({'path': path})::VARCHAR AS body
  FROM (SELECT path, unnest(list_distinct([min(page_id), max(page_id)])) AS page
        FROM (SELECT page_id, CASE WHEN page_id % 10 = 0 THEN split_part(name, '/', 1) || '/zz'
                                   ELSE split_part(name, '/', 1) || '/' || split_part(name, '/', 2) END AS path FROM objects)
        GROUP BY path)
  UNION ALL
  SELECT 'c' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR), text FROM conversations)"""

RUNS_LOG = """runs_per AS (
  SELECT event_type AS experiment, printf('run_%04d', user_id) AS run, user_id, avg(value) AS avg_v
  FROM events GROUP BY event_type, user_id),
runs_log AS (
  SELECT event_type AS experiment, printf('run_%04d', user_id) AS run, 'step_metric' AS kind,
         'loss' AS key, event_id AS step, value, CAST(NULL AS VARCHAR) AS text FROM events
  UNION ALL
  SELECT experiment, run, 'param', 'n_estimators', NULL, CAST(50 + (user_id % 4) * 50 AS DOUBLE),
         CAST(50 + (user_id % 4) * 50 AS VARCHAR) FROM runs_per
  UNION ALL
  SELECT experiment, run, 'param', 'max_depth', NULL, CAST(5 + (user_id % 3) * 5 AS DOUBLE),
         CAST(5 + (user_id % 3) * 5 AS VARCHAR) FROM runs_per
  UNION ALL
  SELECT experiment, run, 'metric', 'score', NULL, floor(avg_v / 500.0e0 * 10000.0e0 + 0.5e0) / 10000.0e0, NULL FROM runs_per)"""

RUN_TABLE = """run_g AS (
  SELECT event_type, user_id, min(ts) AS start_time, max(ts) AS last_ts, max(event_id) AS last_id
  FROM events GROUP BY event_type, user_id),
run_table AS (
  SELECT event_type AS experiment, printf('run_%04d', user_id) AS run,
         CASE WHEN last_id % 4 = 1 THEN 'RUNNING' WHEN last_id % 4 = 2 THEN 'FAILED' ELSE 'SUCCEEDED' END AS state,
         start_time,
         CASE WHEN last_id % 4 = 1 THEN NULL ELSE last_ts END AS end_time,
         'templates/' || event_type || '-train' AS template_uri,
         'v' || CAST(user_id % 3 + 1 AS VARCHAR) AS template_version
  FROM run_g)"""

PREDICTIONS = """predictions AS (
  SELECT l.doc_id, CAST(l.quality AS BIGINT) AS y,
         CAST(CASE WHEN d.n_chars BETWEEN 500 AND 5000 THEN 1 ELSE 0 END AS BIGINT) AS p,
         CAST(d.n_chars AS DOUBLE) AS score
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""

EDGES = """edges AS (
  SELECT 'region:' || CAST(n_regionkey AS VARCHAR) AS src, 'nation:' || CAST(n_nationkey AS VARCHAR) AS dst FROM nation
  UNION ALL
  SELECT 'nation:' || CAST(c_nationkey AS VARCHAR), 'customer:' || CAST(c_custkey AS VARCHAR) FROM customer
  UNION ALL
  SELECT 'customer:' || CAST(o_custkey AS VARCHAR), 'order:' || CAST(o_orderkey AS VARCHAR) FROM orders)"""


def with_(*views: str) -> str:
    return "WITH " + ",\n".join(views) + "\n"
