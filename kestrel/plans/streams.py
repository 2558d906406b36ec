"""Streaming queries run to completion with availableNow; each returns the sink read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.functions import scalars as X
from kestrel.plans.common import rounded
from kestrel.plans.oracle import FEATURES, RUNS_LOG, with_
from kestrel.plans.registry import query
from kestrel.session import scratch_path
from kestrel.sources.derived import DELAY_MINUTES, PROCESSED_TS, anomaly_doc, features, runs_log
from kestrel.sources.tables import table
from kestrel.streaming import monitors as T

_EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"


def _exact_mean(df, s="sum", n="n", out="mean"):
    """Mean for display from the rounded sum: the values carry two decimals, so the sum
    rounded to 6 places is exact in any engine, and dividing equal doubles gives equal
    results (a raw average can sit on a decimal tie and round differently)."""
    return df.withColumn(out, X.round_half_away(F.col(s), 6) / F.col(n))


def _stage(df, spark, name, parts=4):
    path = scratch_path(spark, name)
    df.repartition(parts).write.mode("overwrite").parquet(path)
    return path


@query("stream_windowed_monitor", """
WITH w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n,
                  round(round(sum(value), 6) / count(*), 6) AS mean, min(value) AS min, max(value) AS max,
                  round(stddev_samp(value), 6) AS std
           FROM events GROUP BY 1, 2),
wm AS (SELECT max(ts) - INTERVAL 1 HOUR AS watermark FROM events)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type, n, mean, min, max, std
FROM w, wm WHERE window_start + INTERVAL 1 HOUR <= watermark""")
def q_stream_windowed_monitor(spark, sf):
    """Hourly per-type statistics of the event stream; append mode emits closed windows."""
    src = _stage(table(spark, sf, "events", "event_id", "ts", "user_id", "event_type", "value"), spark, "ev")
    out = T.run_windowed_monitor(spark, src, _EVENTS_SCHEMA, scratch_path(spark, "win"),
                                 scratch_path(spark, "ckpt"), "1 hour", ["event_type"])
    return rounded(_exact_mean(spark.read.parquet(out)).drop("sum"))


@query("stream_windowed_drift", """
WITH w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n,
                  avg(value) AS mean, round(sum(value), 6) / count(*) AS shown_mean,
                  stddev_samp(value) AS std FROM events GROUP BY 1, 2),
wm AS (SELECT max(ts) - INTERVAL 1 HOUR AS watermark FROM events),
c AS (SELECT w.* FROM w, wm WHERE window_start + INTERVAL 1 HOUR <= watermark)
SELECT c.window_start, c.window_start + INTERVAL 1 HOUR AS window_end, c.event_type, c.n,
       round(c.shown_mean, 6) AS mean, round(c.std, 6) AS std, round(p.shown_mean, 6) AS prev_mean,
       round(p.std, 6) AS prev_std,
       round(abs(c.mean - p.mean) / nullif(p.std, 0), 6) AS deviation,
       coalesce(abs(c.mean - p.mean) / nullif(p.std, 0) > 0.3e0, false) AS drift_detected
FROM c LEFT JOIN c p ON p.event_type = c.event_type AND p.window_start = c.window_start - INTERVAL 1 HOUR""")
def q_stream_windowed_drift(spark, sf):
    """T2 + D1: hourly windows per event type, each closed window compared with the previous hour."""
    src = _stage(table(spark, sf, "events", "event_id", "ts", "user_id", "event_type", "value"), spark, "ev", parts=6)
    out = T.run_windowed_drift(spark, src, _EVENTS_SCHEMA, scratch_path(spark, "wdrift"), scratch_path(spark, "ckpt"),
                               60, ["event_type"])
    res = _exact_mean(_exact_mean(spark.read.parquet(out).drop("window_date")), "prev_sum", "prev_n", "prev_mean")
    return rounded(res.drop("batch_id", "sum", "prev_sum", "prev_n"))


@query("stream_monitor_cadences", """
WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS age FROM events),
wm AS (SELECT max(ts) - INTERVAL 1 HOUR AS watermark FROM events),
h AS (SELECT 'hourly_income' AS monitor, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
             time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, event_type, count(value) AS n,
             round(round(sum(value), 6) / count(value), 6) AS mean, min(value) AS min, max(value) AS max,
             round(stddev_samp(value), 6) AS std
      FROM e GROUP BY ALL),
d AS (SELECT 'daily_age', time_bucket(INTERVAL 1 DAY, ts), time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY, event_type,
             count(age), round(round(sum(age), 6) / count(age), 6), min(age), max(age), round(stddev_samp(age), 6)
      FROM e GROUP BY ALL)
SELECT x.* FROM (SELECT * FROM h UNION ALL SELECT * FROM d) x, wm WHERE x.window_end <= wm.watermark""")
def q_stream_monitor_cadences(spark, sf):
    """An hourly monitor on income and a daily monitor on age over the same event
    stream, each with its own state and sink; append mode emits closed windows only."""
    src = _stage(table(spark, sf, "events", "event_id", "ts", "user_id", "event_type", "value", "props"), spark, "ev")
    schema = _EVENTS_SCHEMA + ", props string"

    def prepare(stream):
        return stream.withColumn("age", F.get_json_object("props", "$.k").try_cast("bigint").cast("double"))
    out = T.run_cadence_monitors(spark, src, schema, scratch_path(spark, "cad"), scratch_path(spark, "ckpt"),
                                 [("hourly_income", "1 hour", "value"), ("daily_age", "1 day", "age")],
                                 ["event_type"], prepare)
    res = _exact_mean(spark.read.parquet(out))
    return rounded(res.select("monitor", "window_start", "window_end", "event_type", "n", "mean", "min", "max", "std"))


RANGES = {"value": (0.0, 500.0), "age": (0.0, 100.0)}        # configured ranges of the monitored features


def _distribution_sql(name: str, unit: str) -> str:
    return f"""
{name}_h AS (SELECT time_bucket(INTERVAL 1 {unit}, ts) AS w, feature, kind, bucket, count(*) AS n FROM long GROUP BY ALL),
{name}_c AS (SELECT h.* FROM {name}_h h, wm WHERE w + INTERVAL 1 {unit} <= wm.watermark),
{name}_b AS (SELECT w, feature, kind, bucket, sum(n) AS n, sum(m) AS m FROM (
    SELECT w, feature, kind, bucket, n, 0 AS m FROM {name}_c
    UNION ALL SELECT w + INTERVAL 1 {unit}, feature, kind, bucket, 0, n FROM {name}_c) GROUP BY ALL),
{name}_s AS (SELECT *, sum(n) OVER k AS tn, sum(m) OVER k AS tm FROM {name}_b WINDOW k AS (PARTITION BY w, feature, kind)),
{name}_p AS (SELECT w, feature, kind, tn, tm, CASE WHEN tm > 0 THEN m / tm ELSE 0.0e0 END AS p, n / tn AS q FROM {name}_s WHERE tn > 0),
{name} AS (SELECT '{name}' AS monitor, w AS window_start, w + INTERVAL 1 {unit} AS window_end, feature, kind,
    CAST(tn AS BIGINT) AS n, CAST(tm AS BIGINT) AS prev_n,
    CASE WHEN tm = 0 THEN NULL WHEN kind = 'nominal' THEN max(abs(p - q))
         ELSE 0.5e0 * sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END)
            + 0.5e0 * sum(CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) END AS deviation
  FROM {name}_p GROUP BY w, feature, kind, tn, tm)"""


@query("stream_distribution_drift", """
WITH e AS (SELECT ts, event_type, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS age FROM events),
wm AS (SELECT max(ts) - INTERVAL 1 HOUR AS watermark FROM events),
long AS (SELECT ts, 'event_type' AS feature, 'nominal' AS kind, event_type AS bucket FROM e WHERE event_type IS NOT NULL
  UNION ALL SELECT ts, 'value', 'numeric', CAST(CAST(least(greatest(floor(value / 500.0e0 * 10), 0), 9) AS INT) AS VARCHAR) FROM e WHERE value IS NOT NULL
  UNION ALL SELECT ts, 'age', 'numeric', CAST(CAST(least(greatest(floor(age / 100.0e0 * 10), 0), 9) AS INT) AS VARCHAR) FROM e WHERE age IS NOT NULL),"""
       + _distribution_sql("hourly", "HOUR") + "," + _distribution_sql("daily", "DAY") + """
SELECT monitor, window_start, window_end, feature, kind, n, prev_n, round(deviation, 6) AS deviation,
       coalesce(deviation > 0.3e0, false) AS drift_detected
FROM (SELECT * FROM hourly UNION ALL SELECT * FROM daily)""")
def q_stream_distribution_drift(spark, sf):
    """T2 + D3 + D4 at two cadences: every closed hour (and day) against the one before it."""
    src = _stage(table(spark, sf, "events", "ts", "event_type", "value", "props"), spark, "ev", parts=6)

    def prepare(stream):
        return stream.withColumn("age", F.get_json_object("props", "$.k").try_cast("double"))
    rows = []
    for name, minutes in (("hourly", 60), ("daily", 1440)):
        out = T.run_distribution_drift(spark, src, "ts timestamp_ntz, event_type string, value double, props string",
                                       scratch_path(spark, "dist"), scratch_path(spark, "ckpt"), RANGES, ["event_type"], minutes, prepare=prepare)
        rows.append(spark.read.parquet(out).withColumn("monitor", F.lit(name)))
    return rounded(rows[0].unionByName(rows[1]).select(
        "monitor", "window_start", "window_end", "feature", "kind", "n", "prev_n", "deviation", "drift_detected"))


@query("stream_feature_import", with_(FEATURES) + """
SELECT entity_id, age, income, category, feature_timestamp FROM (
  SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY feature_timestamp DESC) AS rk FROM features) WHERE rk = 1""")
def q_stream_feature_import(spark, sf):
    """Streaming import; the serving table after the last batch holds the newest row per entity."""
    f = features(spark, sf)
    src = _stage(f, spark, "feat", parts=6)
    schema = "entity_id string, age bigint, income double, category string, feature_timestamp timestamp_ntz"
    path = T.run_feature_import(spark, src, schema, scratch_path(spark, "serving"), scratch_path(spark, "ckpt"),
                                ["entity_id"], "feature_timestamp", max_files_per_trigger=2)
    return T.serving_table(spark, path, ["entity_id"], "feature_timestamp")


@query("stream_result_append", """
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, hour(ts) AS block, stddev_samp(value) AS sd,
                  arg_max(value, (ts, event_id)) AS last_value, max(ts) AS last_ts FROM events GROUP BY 1, 2, 3),
r AS (SELECT *, (user_id % 10 NOT IN (0, 3, 6)) AND sd IS NOT NULL AS valid,
             CAST(user_id AS VARCHAR) || ':' || strftime(day, '%Y-%m-%d') || ':' || CAST(block AS VARCHAR) AS fkey FROM d),
res AS (SELECT CASE WHEN valid THEN last_ts ELSE TIMESTAMP '2024-02-01 08:50:44' END AS event_ts,
               CASE WHEN valid THEN last_value
                    ELSE CAST(('0x' || substr(md5(fkey), 1, 8)) AS BIGINT) / 4294967296.0e0 END AS inference_value FROM r)
SELECT CAST(CAST(event_ts AS DATE) AS TIMESTAMP) AS p_date, count(*) AS n, round(sum(inference_value), 6) AS total
FROM res GROUP BY 1""")
def q_stream_result_append(spark, sf):
    """T4: responses as JSON files -> result rows -> day partitions; a restart adds nothing."""
    src = scratch_path(spark, "resp")
    anomaly_doc(spark, sf).repartition(4).write.mode("overwrite").json(src)
    out, ck = scratch_path(spark, "results"), scratch_path(spark, "ckpt")
    T.run_result_append(spark, src, out, ck, PROCESSED_TS, DELAY_MINUTES)
    T.run_result_append(spark, src, out, ck, PROCESSED_TS, DELAY_MINUTES)
    back = spark.read.parquet(out)
    return rounded(back.groupBy("p_date").agg(F.count(F.lit(1)).alias("n"), F.sum("inference_value").alias("total")))


@query("stream_run_metrics", with_(RUNS_LOG) + """
SELECT experiment, run, key, arg_max(value, step) AS last_value, max(step) AS last_step,
       min(value) AS min_value, max(value) AS max_value, count(*) AS n_steps
FROM runs_log WHERE kind = 'step_metric' GROUP BY ALL""")
def q_stream_run_metrics(spark, sf):
    """T5: step metrics as a stream, per-run summary in update mode."""
    src = _stage(runs_log(spark, sf), spark, "log")
    out = T.run_step_metrics(spark, src, "experiment string, run string, kind string, key string, step bigint, "
                                         "value double, text string", scratch_path(spark, "steps"),
                             scratch_path(spark, "ckpt"))
    return T.step_summary(spark, out)
