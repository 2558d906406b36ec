"""Anomaly-response and sink queries: responses per (user, day) built from events,
decoded strictly, reduced to one result row each, appended to day partitions."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import anomaly as A
from kestrel.operators import sinks as K
from kestrel.plans.common import rounded
from kestrel.plans.oracle import FEATURES, with_
from kestrel.plans.registry import query
from kestrel.session import scratch_path
from kestrel.sources.derived import DELAY_MINUTES, PROCESSED_TS, anomaly_doc, features
from kestrel.sources.tables import read_step, table

CONFIG_THRESHOLD = 0.5

_RESP = """d AS (
  SELECT user_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day, hour(ts) AS block, count(*) AS n, avg(value) AS mu,
         stddev_samp(value) AS sd, arg_max(value, (ts, event_id)) AS last_value, max(ts) AS last_ts
  FROM events GROUP BY 1, 2, 3),
r AS (
  SELECT *, (user_id % 10 NOT IN (0, 3, 6)) AND sd IS NOT NULL AS valid,
         CAST(user_id AS VARCHAR) || ':' || strftime(day, '%Y-%m-%d') || ':' || CAST(block AS VARCHAR) AS fkey
  FROM d),
res AS (
  SELECT user_id, day, block,
         CASE WHEN valid THEN last_ts ELSE TIMESTAMP '2024-02-01 08:50:44' END AS event_ts,
         CASE WHEN valid THEN last_value
              ELSE CAST(('0x' || substr(md5(fkey), 1, 8)) AS BIGINT) / 4294967296.0e0 END AS inference_value,
         NOT valid AS is_fallback, TIMESTAMP '2024-02-01 09:00:00' AS processed_ts,
         CASE WHEN valid THEN mu + 2 * sd ELSE 0.5e0 END AS sigma2,
         CASE WHEN valid THEN mu + 3 * sd ELSE 0.5e0 END AS sigma3
  FROM r)"""


def _parsed(spark, sf):
    return A.parse_response(anomaly_doc(spark, sf))


def _key():
    return F.concat_ws(":", F.col("user_id").cast("string"), F.date_format("day", "yyyy-MM-dd"),
                       F.col("block").cast("string"))


def _results(spark, sf):
    return A.latest_inference(_parsed(spark, sf), _key(), PROCESSED_TS, DELAY_MINUTES, CONFIG_THRESHOLD)


@query("scan_anomaly_response", with_(_RESP) + """
SELECT user_id, day, block, CAST(n AS INTEGER) AS n_results,
       CASE WHEN user_id % 10 <> 6 THEN round(mu + 2 * sd, 6) END AS sigma2,
       CASE WHEN user_id % 10 <> 6 THEN round(mu + 3 * sd, 6) END AS sigma3
FROM r""")
def q_scan_anomaly_response(spark, sf):
    p = _parsed(spark, sf)
    return rounded(p.select("user_id", "day", "block", F.size("results").alias("n_results"),
                            F.col("sigma2_text").try_cast("double").alias("sigma2"),
                            F.col("sigma3_text").try_cast("double").alias("sigma3")))


@query("strict_cast_poison", with_(_RESP) + "SELECT user_id, day, block, valid FROM r")
def q_strict_cast_poison(spark, sf):
    p = _parsed(spark, sf)
    return p.select("user_id", "day", "block",
                    A.response_valid(F.col("results"), F.col("sigma2_text"), F.col("sigma3_text")).alias("valid"))


@query("latest_inference", with_(_RESP) + """
SELECT user_id, day, block, event_ts, round(inference_value, 6) AS inference_value, is_fallback, processed_ts,
       round(sigma2, 6) AS sigma2, round(sigma3, 6) AS sigma3 FROM res""")
def q_latest_inference(spark, sf):
    return rounded(_results(spark, sf))


@query("fallback_value", with_(_RESP) + "SELECT user_id, day, block, inference_value FROM res WHERE is_fallback")
def q_fallback_value(spark, sf):
    return _results(spark, sf).where("is_fallback").select("user_id", "day", "block", "inference_value")


@query("build_result_row", with_(_RESP) + """
SELECT strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%g') || '+00:00' AS timestamp, inference_value FROM res""")
def q_build_result_row(spark, sf):
    r = _results(spark, sf)
    return r.select(F.concat(F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+00:00")).alias("timestamp"),
                    "inference_value")


@query("null_response_row", with_(_RESP) + f"""
SELECT user_id, day, block, TIMESTAMP '2024-02-01 08:50:44' AS timestamp, CAST(NULL AS DOUBLE) AS reconstruction_error,
       {CONFIG_THRESHOLD}e0 AS sigma2, {CONFIG_THRESHOLD}e0 AS sigma3
FROM r WHERE NOT valid""")
def q_null_response_row(spark, sf):
    return A.null_response(_parsed(spark, sf), PROCESSED_TS, DELAY_MINUTES, CONFIG_THRESHOLD)


@query("sink_partitioned_append", with_(_RESP) + """
SELECT CAST(CAST(event_ts AS DATE) AS TIMESTAMP) AS p_date, count(*) AS n, round(sum(inference_value), 6) AS total
FROM res GROUP BY 1""")
def q_sink_partitioned_append(spark, sf):
    """K2: append the result rows per day partition; the same batch written twice
    (a retry) and an empty batch leave the table unchanged."""
    rows = _results(spark, sf).select("event_ts", "inference_value")
    path = scratch_path(spark, "results")
    K.append_partitioned(rows, path, "event_ts", ["event_ts", "inference_value"], batch_id="0")
    K.append_partitioned(rows, path, "event_ts", ["event_ts", "inference_value"], batch_id="0")
    K.append_partitioned(rows.limit(0), path, "event_ts", ["event_ts", "inference_value"], batch_id="1")
    back = spark.read.parquet(path)
    return rounded(back.groupBy("p_date").agg(F.count(F.lit(1)).alias("n"), F.sum("inference_value").alias("total")))


# ------------------------------------------------------------------ K3-K6, K8, S9, S10
@query("sink_append", with_(FEATURES) + """
SELECT category, count(*) AS n FROM (SELECT * FROM features WHERE feature_timestamp < TIMESTAMP '2024-01-16'
                                     UNION ALL SELECT * FROM features WHERE feature_timestamp >= TIMESTAMP '2024-01-16')
GROUP BY category""")
def q_sink_append(spark, sf):
    f = features(spark, sf)
    split = F.lit("2024-01-16").cast("timestamp_ntz")
    path = scratch_path(spark, "append")
    K.append(f.where(F.col("feature_timestamp") < split), path)
    K.append(f.where(F.col("feature_timestamp") >= split), path)
    return spark.read.parquet(path).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@query("sink_replace", with_(FEATURES) + """
SELECT category, count(*) AS n FROM features WHERE feature_timestamp >= TIMESTAMP '2024-01-16' GROUP BY category""")
def q_sink_replace(spark, sf):
    f = features(spark, sf)
    path = scratch_path(spark, "replace")
    K.replace(f, path)
    K.replace(f.where(F.col("feature_timestamp") >= F.lit("2024-01-16").cast("timestamp_ntz")), path)
    return spark.read.parquet(path).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@query("table_create_if_missing", with_(_RESP) + """
SELECT CAST(CAST(event_ts AS DATE) AS TIMESTAMP) AS p_date, count(*) AS n FROM res GROUP BY 1""")
def q_table_create_if_missing(spark, sf):
    db = f"kestrel_{abs(hash(scratch_path(spark, 'db'))) % 10**8}"
    loc = scratch_path(spark, "warehouse")
    ddl = "event_ts TIMESTAMP_NTZ NOT NULL, inference_value DOUBLE NOT NULL, p_date DATE"
    K.create_if_missing(spark, db, "inference_results", ddl, loc, "p_date")
    K.create_if_missing(spark, db, "inference_results", ddl, loc, "p_date")    # exists: no-op
    rows = K.require_not_null(_results(spark, sf).select("event_ts", "inference_value"),
                              ["event_ts", "inference_value"]).withColumn("p_date", F.to_date("event_ts"))
    rows.select("event_ts", "inference_value", "p_date").write.insertInto(f"{db}.inference_results")
    summary = scratch_path(spark, "summary")                 # kept apart from the table that is dropped next
    spark.table(f"{db}.inference_results").groupBy("p_date").agg(F.count(F.lit(1)).alias("n")) \
        .write.mode("overwrite").parquet(summary)
    out = spark.read.parquet(summary)
    K.drop(spark, db, "inference_results")
    K.drop(spark, db, "missing_table")                        # missing: success
    K.drop(spark, db)
    return out


@query("sink_parquet_step", with_(FEATURES) + "SELECT * FROM features")
def q_sink_parquet_step(spark, sf):
    path = K.write_step(features(spark, sf), scratch_path(spark, "step"))
    return read_step(spark, path)


@query("scan_parquet_step", with_(FEATURES) + "SELECT entity_id, age, income FROM features WHERE category = 'purchase'")
def q_scan_parquet_step(spark, sf):
    """A later step reads the previous step's Parquet (filter and projection reach the scan)."""
    path = K.write_step(features(spark, sf), scratch_path(spark, "step"))
    return read_step(spark, path).where(F.col("category") == "purchase").select("entity_id", "age", "income")


@query("scan_csv_json_dataset", with_(FEATURES) + "SELECT entity_id, age, income, category, feature_timestamp FROM features")
def q_scan_csv_json_dataset(spark, sf):
    """A dataset artifact written as JSON lines, read back with an explicit schema."""
    path = scratch_path(spark, "json")
    K.write_text_dataset(features(spark, sf), path, "json")
    schema = "entity_id string, age bigint, income double, category string, feature_timestamp timestamp_ntz"
    return K.read_text_dataset(spark, path, schema, "json")


@query("table_drop", "SELECT CAST(0 AS BIGINT) AS tables_left, count(*) AS rows_written FROM events")
def q_table_drop(spark, sf):
    """K6: drop a table and the whole database with its contents; dropping again succeeds."""
    db = f"kestrel_drop_{abs(hash(scratch_path(spark, 'db'))) % 10**8}"
    loc = scratch_path(spark, "warehouse")
    K.create_if_missing(spark, db, "events_copy", "event_id BIGINT, value DOUBLE", loc)
    table(spark, sf, "events", "event_id", "value").write.insertInto(f"{db}.events_copy")
    written = spark.table(f"{db}.events_copy").count()
    K.drop(spark, db, "events_copy")
    K.drop(spark, db, "events_copy")
    K.drop(spark, db)
    K.drop(spark, db)
    left = len([t for t in spark.catalog.listDatabases() if t.name == db])
    return spark.createDataFrame([(left, written)], "tables_left bigint, rows_written bigint")
