"""Sensor series documents.

A document is ``{series:[{name,unit,type}], values:{iso_ts:[{min,max}|null,…]}}``;
position i of every value list belongs to ``series[i]``.  Everything is a
narrow transformation of one document row (explode / zip by position) except
the explicit long-to-wide pivot, which shuffles by timestamp only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, MapType, StringType, StructField,
                               StructType)

from kestrel.fixed import CSV_FOLDER, SAMPLE_POINTS, SENSOR_PREVIEW
from kestrel.functions.scalars import iso_timestamp

SENSOR = StructType([StructField("name", StringType()), StructField("unit", StringType()),
                     StructField("type", StringType())])
POINT = StructType([StructField("min", DoubleType()), StructField("max", DoubleType())])
DOC_SCHEMA = StructType([StructField("series", ArrayType(SENSOR)),
                         StructField("values", MapType(StringType(), ArrayType(POINT)))])


def parse_series(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """Decode documents; a missing ``series`` / ``values`` becomes empty."""
    d = F.from_json(F.col(doc_col), DOC_SCHEMA)
    return docs.withColumn("_d", d).select(
        *[c for c in docs.columns if c != doc_col],
        F.coalesce(F.col("_d.series"), F.array().cast(ArrayType(SENSOR))).alias("series"),
        F.coalesce(F.col("_d.values"), F.create_map().cast(MapType(StringType(), ArrayType(POINT)))).alias("values"))


def timestamps(parsed: DataFrame) -> DataFrame:
    """One row per (document, timestamp) with its point list (F8: map entries).  A key that is no
    ISO 8601 instant gives a null ``ts``; ``validate_series`` rejects such a document."""
    keep = [c for c in parsed.columns if c != "values"]
    return parsed.select(*keep, F.explode("values").alias("ts_text", "points")).withColumn(
        "ts", iso_timestamp("ts_text"))


def points_by_position(parsed: DataFrame) -> DataFrame:
    """J1 + P2: one row per (document, timestamp, position) with the sensor of that
    position and the point flattened to min/max (null point -> two nulls).  A list
    shorter or longer than the sensor list pads with nulls (arrays_zip)."""
    t = timestamps(parsed)
    keep = [c for c in t.columns if c not in ("series", "points", "ts_text")]
    z = t.select(*keep, F.posexplode_outer(F.arrays_zip(F.col("series").alias("s"), F.col("points").alias("p"))))
    return z.select(*keep, F.col("pos").cast("bigint").alias("pos"), F.col("col.s.name").alias("name"),
                    F.col("col.s.unit").alias("unit"), F.col("col.s.type").alias("type"),
                    F.col("col.p.min").alias("min"), F.col("col.p.max").alias("max"))


def filter_time_range(df: DataFrame, ts_col: str, start: str, end: str) -> DataFrame:
    """Keep rows with start <= ts <= end (both ends inclusive)."""
    return df.where(F.col(ts_col).between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")))


def validate_series(parsed: DataFrame) -> DataFrame:
    """Reason the document is invalid (no sensors / no timestamps / a point list that is
    null or whose length differs from the sensor count / a key that is no instant), null when valid."""
    n = F.size("series")
    reason = (F.when(n == 0, "no sensors")
               .when(F.size("values") == 0, "no timestamps")
               .when(F.exists(F.map_values("values"), lambda x: x.isNull() | (F.size(x) != n)), "arity mismatch")
               .when(F.exists(F.map_keys("values"), lambda k: iso_timestamp(k).isNull()), "bad timestamp"))
    return parsed.withColumn("n_sensors", n.cast("bigint")).withColumn(
        "n_timestamps", F.size("values").cast("bigint")).withColumn("reason", reason).withColumn(
        "valid", F.col("reason").isNull())


def write_gate(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid documents, rejected documents with {success:false, error})."""
    v = validate_series(parsed)
    ok = v.where(F.col("valid")).drop("reason", "valid")
    bad = v.where(~F.col("valid")).select(*[c for c in v.columns if c not in ("series", "values")]) \
        .withColumn("success", F.lit(False)).withColumnRenamed("reason", "error")
    return ok, bad


def series_summary(parsed: DataFrame, key: str = "doc_id") -> DataFrame:
    """sensor_count, timestamp_count, non-null point count, first/last timestamp per document."""
    t = timestamps(parsed)
    return t.groupBy(key).agg(
        F.max(F.size("series")).cast("bigint").alias("sensor_count"),
        F.count(F.lit(1)).alias("timestamp_count"),
        F.sum(F.size(F.filter("points", lambda x: x.isNotNull()))).cast("bigint").alias("non_null_points"),
        F.min("ts").alias("first_timestamp"), F.max("ts").alias("last_timestamp"))


def measurement_min_max(df: DataFrame, ts_col: str, sensor_col: str, value_col: str, unit: str = "hour") -> DataFrame:
    """{min, max} per sensor per time bucket."""
    return df.groupBy(F.date_trunc(unit, ts_col).cast("timestamp_ntz").alias("ts"), F.col(sensor_col).alias("name")) \
             .agg(F.min(value_col).alias("min"), F.max(value_col).alias("max"))


def wide_column_names(sensors: list[str] | list[tuple[str, str]]) -> list[str]:
    """Column stem per sensor: its name, ``name_type`` when sensors share a name, and a number
    after that when they share the type too (the wide table must not repeat a column name)."""
    pairs = [(s, "") if isinstance(s, str) else tuple(s) for s in sensors]
    names = [n for n, _ in pairs]
    stems = [f"{n}_{t}" if t and names.count(n) > 1 else n for n, t in pairs]
    return [f"{x}_{stems[:i].count(x) + 1}" if x in stems[:i] else x for i, x in enumerate(stems)]


def wide_from_documents(parsed: DataFrame, sensors: list[str] | list[tuple[str, str]], key: str = "doc_id") -> DataFrame:
    """A9 without a shuffle: each (document, timestamp) row already holds every point.  The
    sensors are names or (name, type); the k-th sensor of a name takes the k-th point of
    that name in the document's order, so sensors that share a name stay apart."""
    t = timestamps(parsed)
    z = F.arrays_zip(F.col("series").alias("s"), F.col("points").alias("p"))
    names = [s if isinstance(s, str) else s[0] for s in sensors]
    out = t.select(key, "ts", z.alias("_z"))
    cols = [F.col(key), F.col("ts")]
    for i, (n, stem) in enumerate(zip(names, wide_column_names(sensors))):
        hit = F.try_element_at(F.filter("_z", _named(n)), F.lit(names[:i].count(n) + 1))
        cols += [hit["p"]["min"].alias(f"{stem}_min"), hit["p"]["max"].alias(f"{stem}_max")]
    return out.select(*cols)


def _named(n: str):
    return lambda x: x["s"]["name"] == F.lit(n)


def pivot_wide(long: DataFrame, names: list[str], keys: list[str]) -> DataFrame:
    """A9 on long rows: groupBy(keys).pivot(name, explicit names) -> {name}_min, {name}_max."""
    return long.groupBy(*keys).pivot("name", names).agg(F.first("min").alias("min"), F.first("max").alias("max"))


def sensor_preview(parsed: DataFrame, n: int = SENSOR_PREVIEW, key: str = "doc_id") -> DataFrame:
    """The first n sensors of each document by position."""
    return parsed.select(key, F.posexplode(F.slice("series", 1, n))).select(
        key, F.col("pos").cast("bigint").alias("pos"), "col.name", "col.unit", "col.type")


def first_timestamp_sample(parsed: DataFrame, n: int = SAMPLE_POINTS, key: str = "doc_id") -> DataFrame:
    """The earliest timestamp of each document and its first n points.
    (Map order is not document order in Spark; "first" is the earliest time.)"""
    t = timestamps(parsed)
    first = t.groupBy(key).agg(F.min_by(F.struct("ts", "points"), "ts").alias("f"))
    return first.select(key, F.col("f.ts").alias("first_ts"),
                        F.posexplode_outer(F.slice("f.points", 1, n))).select(
        key, "first_ts", F.col("pos").cast("bigint").alias("pos"), F.col("col.min").alias("min"),
        F.col("col.max").alias("max"))


def write_wide_csv(wide: DataFrame, base: str, stamp: str) -> tuple[str, int]:
    """K1: write the wide table as CSV with a header (null -> empty cell) under
    ``<base>/timeseries_data/<stamp>``; returns (path, bytes written)."""
    path = f"{base.rstrip('/')}/{CSV_FOLDER}/{stamp}"
    wide.write.mode("overwrite").option("header", True).option("emptyValue", "").option("nullValue", "").csv(path)
    # size from the file listing (binaryFile prunes the content column, only metadata is read)
    listing = wide.sparkSession.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path)
    return path, int(listing.select(F.coalesce(F.sum("length"), F.lit(0))).first()[0])


def read_wide_csv(spark, path: str, names: list[str], key: str = "doc_id") -> DataFrame:
    """Read the wide CSV back with an explicit schema (no inference)."""
    fields = [StructField(key, StringType()), StructField("ts", StringType())]
    for n in names:
        fields += [StructField(f"{n}_min", DoubleType()), StructField(f"{n}_max", DoubleType())]
    df = spark.read.schema(StructType(fields)).option("header", True).csv(path)
    return df.withColumn("ts", F.to_timestamp_ntz("ts"))
