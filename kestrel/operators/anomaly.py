"""Anomaly-detector responses to result rows.

Decoding keeps every value as text first: permissive JSON parsing would turn a
bad number into null silently, so strictness (one bad value voids the whole
response) is checked explicitly with ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from kestrel.fixed import PLACEHOLDER_SECOND as SECOND_MARK
from kestrel.functions.scalars import iso_timestamp

RESULT = StructType([StructField("timestamp", StringType()), StructField("reconstructionError", StringType())])
RESPONSE = StructType([
    StructField("results", ArrayType(RESULT)),
    StructField("threshold", StructType([StructField("2sigma", StringType()), StructField("3sigma", StringType())])),
])


def parse_response(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """S3: results (timestamp, error as text) and thresholds (as text)."""
    r = F.from_json(F.col(doc_col), RESPONSE)
    return docs.withColumn("_r", r).select(
        *[c for c in docs.columns if c != doc_col],
        F.col("_r.results").alias("results"),
        F.col("_r.threshold.`2sigma`").alias("sigma2_text"),
        F.col("_r.threshold.`3sigma`").alias("sigma3_text"))


def response_valid(results: Column, s2: Column, s3: Column) -> Column:
    """the response parses only if results and both thresholds are present and
    every element has a timestamp and a numeric error."""
    elems_ok = F.forall(results, lambda x: x["timestamp"].isNotNull()
                        & x["reconstructionError"].try_cast("double").isNotNull())
    return (results.isNotNull() & s2.try_cast("double").isNotNull() & s3.try_cast("double").isNotNull()
            & F.coalesce(elems_ok, F.lit(False)))


def fallback_value(key: Column) -> Column:
    """deterministic pseudo-random value in [0, 1) from md5 of the key."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def placeholder_ts(processed_ts: Column, delay_minutes: int) -> Column:
    """F15 time: processing time minus the delay, at second 44 with zero fraction."""
    t = F.date_trunc("minute", processed_ts - F.make_interval(mins=F.lit(delay_minutes))).cast("timestamp_ntz")
    return t + F.make_interval(secs=F.lit(SECOND_MARK))


def latest_inference(parsed: DataFrame, key: Column, processed_ts: str, delay_minutes: int = 10,
                     fallback_threshold: float | None = None) -> DataFrame:
    """F14 + F12 + F15 + P9: the last result by list order of a valid response, else a
    fallback value at the placeholder time; one result row per response with
    ``is_fallback``, the processing time (Q5, Q7) and the thresholds carried along (Q8:
    the parsed 2σ/3σ, or the configured threshold for both on a fallback row)."""
    valid = response_valid(F.col("results"), F.col("sigma2_text"), F.col("sigma3_text"))
    last = F.try_element_at(F.col("results"), F.lit(-1))
    value = last["reconstructionError"].try_cast("double")
    when = iso_timestamp(last["timestamp"])
    # a time that is no ISO 8601 instant makes the response unusable, not the job
    use = valid & value.isNotNull() & when.isNotNull()
    pts = F.lit(processed_ts).cast("timestamp_ntz")
    return parsed.select(
        *[c for c in parsed.columns if c not in ("results", "sigma2_text", "sigma3_text")],
        F.when(use, when)
         .otherwise(placeholder_ts(pts, delay_minutes)).alias("event_ts"),
        F.when(use, value).otherwise(fallback_value(key)).alias("inference_value"),
        (~use).alias("is_fallback"),
        pts.alias("processed_ts"),
        F.when(use, F.col("sigma2_text").try_cast("double")).otherwise(F.lit(fallback_threshold).cast("double"))
         .alias("sigma2"),
        F.when(use, F.col("sigma3_text").try_cast("double")).otherwise(F.lit(fallback_threshold).cast("double"))
         .alias("sigma3"))


def null_response(parsed: DataFrame, processed_ts: str, delay_minutes: int, threshold: float) -> DataFrame:
    """the placeholder response used when the real one is unusable: one result at
    the placeholder time with no error value, both thresholds = the configured value."""
    valid = response_valid(F.col("results"), F.col("sigma2_text"), F.col("sigma3_text"))
    pts = F.lit(processed_ts).cast("timestamp_ntz")
    return parsed.where(~valid).select(
        *[c for c in parsed.columns if c not in ("results", "sigma2_text", "sigma3_text")],
        placeholder_ts(pts, delay_minutes).alias("timestamp"),
        F.lit(None).cast("double").alias("reconstruction_error"),
        F.lit(float(threshold)).alias("sigma2"), F.lit(float(threshold)).alias("sigma3"))
