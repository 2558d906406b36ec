"""Scalar-function queries (F2–F11) over events, pages and the series documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.functions import scalars as X
from kestrel.operators import series as S
from kestrel.plans.oracle import SERIES_CELLS, with_
from kestrel.plans.registry import query
from kestrel.sources.derived import series_doc
from kestrel.sources.tables import table


def _events(spark, sf, *cols):
    return table(spark, sf, "events", *cols)


@query("str_concat_tag", """
SELECT event_id, 'Processed: ' || event_type || ' at ' || strftime(ts, '%Y-%m-%dT%H:%M:%S.000Z') AS tagged FROM events""")
def q_str_concat_tag(spark, sf):
    e = _events(spark, sf, "event_id", "event_type", "ts")
    return e.select("event_id", X.tag_processed(F.col("event_type"), F.col("ts")).alias("tagged"))


@query("str_bar_and_truncate", """
WITH c AS (SELECT event_type, count(*) AS n, min(ts) AS first_ts FROM events GROUP BY event_type),
p AS (SELECT *, floor(n * 100.0e0 / sum(n) OVER () * 100.0e0 + 0.5e0) / 100.0e0 AS pct FROM c)
SELECT event_type, pct, repeat('█', CAST(floor(pct / 5) AS INTEGER)) AS bar,
       substr(CAST(first_ts AS VARCHAR), 1, 19) AS first_ts_text FROM p""")
def q_str_bar_and_truncate(spark, sf):
    e = _events(spark, sf, "event_type", "ts")
    c = e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"))
    total = c.select(F.sum("n")).scalar()
    p = c.withColumn("pct", X.round_half_up(F.col("n").cast("double") * 100.0 / total, 2))
    return p.select("event_type", "pct", X.bar(F.col("pct")).alias("bar"),
                    X.first_chars(F.col("first_ts").cast("string"), 19).alias("first_ts_text"))


@query("str_column_names", """
SELECT c_custkey, printf('user_%04d', c_custkey) AS entity_id, c_mktsegment || '_min' AS col_min,
       c_mktsegment || '_max' AS col_max FROM customer""")
def q_str_column_names(spark, sf):
    c = table(spark, sf, "customer", "c_custkey", "c_mktsegment")
    mn, mx = X.sensor_columns(F.col("c_mktsegment"))
    return c.select("c_custkey", X.entity_id(F.col("c_custkey")).alias("entity_id"), mn.alias("col_min"),
                    mx.alias("col_max"))


@query("date_ops", """
SELECT event_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day, strftime(ts, '%Y-%m-%dT%H:%M:%S.000Z') AS iso,
       strftime(ts, '%Y%m%d_%H%M%S') AS compact,
       strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%dT%H:%M:%S') || '+09:00' AS local_jst,
       date_trunc('minute', ts - INTERVAL 10 MINUTE) + INTERVAL 44 SECOND AS shifted,
       floor((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 1e6 * 100.0e0 + 0.5e0) / 100.0e0 AS elapsed_s
FROM events""")
def q_date_ops(spark, sf):
    e = _events(spark, sf, "event_id", "ts")
    t = F.col("ts")
    return e.select("event_id", F.to_date(t).alias("day"), X.iso_z(t).alias("iso"), X.compact_stamp(t).alias("compact"),
                    X.to_offset(t, 9).alias("local_jst"), X.shift_to_second(t, 10).alias("shifted"),
                    X.elapsed_seconds(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), t).alias("elapsed_s"))


@query("math_ops", """
SELECT event_id, floor(value * 1.5e0 * 100.0e0 + 0.5e0) / 100.0e0 AS rounded, abs(value - 250.0e0) AS dist,
       round(abs(value - 100.0e0) / 50.0e0, 6) AS norm_diff,
       greatest(least(value, 200.0e0), 20.0e0) AS clipped, CAST(trunc(value) AS INTEGER) AS truncated
FROM events""")
def q_math_ops(spark, sf):
    e = _events(spark, sf, "event_id", "value")
    v = F.col("value")
    return e.select("event_id", X.round_half_up(v * 1.5, 2).alias("rounded"), F.abs(v - 250.0).alias("dist"),
                    X.round_half_away(X.normalized_difference(v, F.lit(100.0), F.lit(50.0)), 6).alias("norm_diff"),
                    X.clip(v, 20.0, 200.0).alias("clipped"), X.truncate_int(v).alias("truncated"))


def _ts_rows(spark, sf):
    return S.timestamps(S.parse_series(series_doc(spark, sf)))


@query("array_ops", with_(SERIES_CELLS) + """
SELECT doc_id, ts, CAST(count(*) AS INTEGER) AS n_points,
       max(max) FILTER (WHERE pos = 4) AS last_max, CAST(count(*) FILTER (WHERE pos < 2) AS INTEGER) AS first2
FROM cells GROUP BY doc_id, ts""")
def q_array_ops(spark, sf):
    t = _ts_rows(spark, sf)
    return t.select("doc_id", "ts", F.size("points").alias("n_points"),
                    X.last_element(F.col("points"))["max"].alias("last_max"),
                    F.size(F.slice("points", 1, 2)).alias("first2"))


@query("map_ops", with_(SERIES_CELLS) + """
SELECT doc_id, ts, coalesce(max(min) FILTER (WHERE name = 'click'), -1.0e0) AS click_min,
       -1.0e0 AS missing_min FROM cells GROUP BY doc_id, ts""")
def q_map_ops(spark, sf):
    t = _ts_rows(spark, sf)
    m = F.map_from_arrays(F.transform("series", lambda s: s["name"]), F.transform("points", lambda p: p["min"]))
    return t.select("doc_id", "ts", X.lookup(m, "click", -1.0).alias("click_min"),
                    X.lookup(m, "zz", -1.0).alias("missing_min"))


@query("json_ops", """
SELECT event_id, json_extract_string(props, '$.k') AS k,
       to_json({'event': event_type, 'k': CAST(json_extract_string(props, '$.k') AS INTEGER)})::VARCHAR AS doc
FROM events""")
def q_json_ops(spark, sf):
    e = _events(spark, sf, "event_id", "event_type", "props")
    k = F.get_json_object("props", "$.k")
    return e.select("event_id", k.alias("k"),
                    F.to_json(F.struct(F.col("event_type").alias("event"), k.cast("int").alias("k"))).alias("doc"))


@query("encode_ops", """
SELECT page_id, to_base64(encode(html)) AS b64, md5(html) AS md5 FROM pages""")
def q_encode_ops(spark, sf):
    p = table(spark, sf, "pages", "page_id", "html")
    return p.select("page_id", X.base64_text(F.col("html")).alias("b64"), F.md5("html").alias("md5"))


@query("cond_status", """
WITH per_day AS (SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS batch, count_if(event_type = 'error') AS n_err
                 FROM events GROUP BY 1)
SELECT batch, CASE WHEN n_err % 3 = 0 THEN 500 WHEN n_err % 7 = 0 THEN 404 ELSE 200 END AS status,
       CASE WHEN n_err % 3 = 0 THEN 'error' WHEN n_err % 7 = 0 THEN 'warning' ELSE 'success' END AS label
FROM per_day""")
def q_cond_status(spark, sf):
    e = _events(spark, sf, "ts", "event_type")
    d = e.groupBy(F.to_date("ts").alias("batch")).agg(F.count_if(F.col("event_type") == "error").alias("n_err"))
    code = F.when(F.col("n_err") % 3 == 0, 500).when(F.col("n_err") % 7 == 0, 404).otherwise(200)
    return d.select("batch", code.alias("status"), X.http_status_label(code).alias("label"))
