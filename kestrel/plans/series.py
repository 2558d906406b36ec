"""Sensor-series queries: decode daily JSON documents built from events and
compare with the same cells computed straight from events."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from kestrel.operators import series as S
from kestrel.plans.oracle import MEASUREMENTS, SERIES_CELLS, with_
from kestrel.plans.oracle import SENSORS as SENSORS_SQL
from kestrel.plans.registry import query
from kestrel.session import scratch_path
from kestrel.sources.derived import PROCESSED_TS, SENSORS, measurements, sensor_names, series_doc
from kestrel.sources.tables import table


def _parsed(spark, sf, corrupt=False):
    return S.parse_series(series_doc(spark, sf, corrupt))


@query("scan_series_json", with_(SERIES_CELLS) + """
SELECT doc_id, ts, CAST(pos AS BIGINT) AS pos, name, 'value' AS unit, 'double' AS type, min, max FROM cells""")
def q_scan_series_json(spark, sf):
    return S.points_by_position(_parsed(spark, sf))


@query("join_series_position", with_(SERIES_CELLS) + "SELECT doc_id, ts, name, CAST(pos AS BIGINT) AS pos FROM cells")
def q_join_series_position(spark, sf):
    return S.points_by_position(_parsed(spark, sf)).select("doc_id", "ts", "name", "pos")


@query("flatten_measurements", with_(SERIES_CELLS) + "SELECT doc_id, ts, name, min, max FROM cells")
def q_flatten_measurements(spark, sf):
    return S.points_by_position(_parsed(spark, sf)).select("doc_id", "ts", "name", "min", "max")


@query("filter_time_range", """
SELECT event_id, ts, event_type, value FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-11 00:00:00'""")
def q_filter_time_range(spark, sf):
    ev = table(spark, sf, "events", "event_id", "ts", "event_type", "value")
    return S.filter_time_range(ev, "ts", "2024-01-10 00:00:00", "2024-01-11 00:00:00")


_DOC_STATUS = with_(MEASUREMENTS, SENSORS_SQL) + """,
days AS (SELECT strftime(ts, '%Y%m%d') AS doc_id, day(ts) AS dom, count(DISTINCT ts) AS n_ts
         FROM measurements GROUP BY 1, 2),
status AS (
  SELECT doc_id, CAST(CASE WHEN dom = 30 THEN 0 ELSE (SELECT count(*) FROM sensors) END AS BIGINT) AS n_sensors, CAST(n_ts AS BIGINT) AS n_timestamps,
         CASE WHEN dom = 30 THEN 'no sensors' WHEN dom IN (4, 13, 22) THEN 'arity mismatch' END AS reason
  FROM days)"""


@query("validate_series", _DOC_STATUS + "SELECT doc_id, n_sensors, n_timestamps, reason, reason IS NULL AS valid FROM status")
def q_validate_series(spark, sf):
    return S.validate_series(_parsed(spark, sf, corrupt=True)).select(
        "doc_id", "n_sensors", "n_timestamps", "reason", "valid")


@query("validated_write_gate", _DOC_STATUS + """
SELECT CASE WHEN reason IS NULL THEN 'written' ELSE 'rejected' END AS status, count(*) AS n_docs,
       CAST(sum(n_timestamps) AS BIGINT) AS n_timestamps
FROM status GROUP BY 1""")
def q_validated_write_gate(spark, sf):
    ok, bad = S.write_gate(_parsed(spark, sf, corrupt=True))
    # only documents that pass are written; they are counted from the table
    path = scratch_path(spark, "valid-documents")
    ok.write.parquet(path)
    ok = spark.read.parquet(path)
    a = ok.agg(F.lit("written").alias("status"), F.count(F.lit(1)).alias("n_docs"),
               F.sum(F.size("values")).cast("bigint").alias("n_timestamps"))
    b = bad.agg(F.lit("rejected").alias("status"), F.count(F.lit(1)).alias("n_docs"),
                F.sum("n_timestamps").cast("bigint").alias("n_timestamps"))
    return a.unionByName(b)


@query("series_summary", with_(SERIES_CELLS) + """
SELECT doc_id, CAST((SELECT count(*) FROM sensors) AS BIGINT) AS sensor_count, count(DISTINCT ts) AS timestamp_count,
       count(min) AS non_null_points, min(ts) AS first_timestamp, max(ts) AS last_timestamp
FROM cells GROUP BY doc_id""")
def q_series_summary(spark, sf):
    return S.series_summary(_parsed(spark, sf))


@query("measurement_min_max", with_(MEASUREMENTS) + "SELECT * FROM measurements")
def q_measurement_min_max(spark, sf):
    ev = table(spark, sf, "events", "ts", "event_type", "value")
    return S.measurement_min_max(ev, "ts", "event_type", "value")


def _wide_sql(with_doc: bool) -> str:
    cols = ", ".join(f"max(min) FILTER (WHERE name = '{n}') AS {n}_min, max(max) FILTER (WHERE name = '{n}') AS {n}_max"
                     for n in SENSORS)
    key = "doc_id, " if with_doc else ""
    return with_(SERIES_CELLS) + f"SELECT {key}ts, {cols} FROM cells GROUP BY {key}ts"


@query("series_wide", _wide_sql(True))
def q_series_wide(spark, sf):
    return S.wide_from_documents(_parsed(spark, sf), sensor_names(spark, sf))


@query("pivot_series_wide", _wide_sql(False))
def q_pivot_series_wide(spark, sf):
    long = S.points_by_position(_parsed(spark, sf))
    return S.pivot_wide(long, sensor_names(spark, sf), ["ts"])


@query("sensor_preview", with_(SERIES_CELLS) + """
SELECT DISTINCT doc_id, CAST(pos AS BIGINT) AS pos, name, 'value' AS unit, 'double' AS type FROM cells WHERE pos < 10""")
def q_sensor_preview(spark, sf):
    return S.sensor_preview(_parsed(spark, sf), 10)


@query("first_timestamp_sample", with_(SERIES_CELLS) + """,
f AS (SELECT doc_id, min(ts) AS first_ts FROM cells GROUP BY doc_id)
SELECT c.doc_id, f.first_ts, CAST(c.pos AS BIGINT) AS pos, c.min, c.max
FROM cells c JOIN f ON c.doc_id = f.doc_id AND c.ts = f.first_ts WHERE c.pos < 5""")
def q_first_timestamp_sample(spark, sf):
    return S.first_timestamp_sample(_parsed(spark, sf), 5)


@query("sink_wide_csv", _wide_sql(True))
def q_sink_wide_csv(spark, sf):
    """K1 then S4: write the wide CSV, read it back."""
    names = sensor_names(spark, sf)
    wide = S.wide_from_documents(_parsed(spark, sf), names)
    stamp = datetime.strptime(PROCESSED_TS, "%Y-%m-%d %H:%M:%S").strftime("%Y%m%d_%H%M%S")
    path, size = S.write_wide_csv(wide, scratch_path(spark, "csv"), stamp)
    if size <= 0:
        raise RuntimeError("empty CSV output")
    return S.read_wide_csv(spark, path, names)


@query("scan_csv", with_(MEASUREMENTS) + "SELECT ts, name, min, max, min AS json_min, max AS json_max FROM measurements")
def q_scan_csv(spark, sf):
    """A dataset written as CSV and as JSON, read back with explicit schemas."""
    m = measurements(spark, sf)
    base = scratch_path(spark, "dataset")
    m.write.mode("overwrite").option("header", True).csv(base + "/csv")
    m.write.mode("overwrite").json(base + "/json")
    schema = "ts timestamp_ntz, name string, min double, max double"
    c = spark.read.schema(schema).option("header", True).csv(base + "/csv")
    j = spark.read.schema(schema).json(base + "/json")
    # both round trips side by side; a row that did not survive one of them shows as nulls
    return c.join(j.select("ts", "name", F.col("min").alias("json_min"), F.col("max").alias("json_max")),
                  ["ts", "name"], "full_outer")


@query("source_interface", with_(SERIES_CELLS) + """
SELECT doc_id, ts, CAST(pos AS BIGINT) AS pos, name, 'value' AS unit, 'double' AS type, min, max FROM cells
WHERE doc_id BETWEEN '20240105' AND '20240112'""")
def q_source_interface(spark, sf):
    """Z3: documents from one source implementation stored and re-read through another."""
    from kestrel.sources.interface import DerivedSeriesSource, FileSeriesSource, FileStorage
    store = FileStorage(scratch_path(spark, "docs"))
    path = store.upload(DerivedSeriesSource(spark, sf).fetch("00000000", "99999999"), "series")
    docs = FileSeriesSource(spark, path).fetch("20240105", "20240112")
    return S.points_by_position(S.parse_series(docs))
