"""Derived inputs built from the driver tables (the shapes the operators expect).

Every view is a plain DataFrame function of the base tables, so its work grows
with them; the oracle SQL in ``kestrel.plans.oracle`` defines the same views
with ``WITH`` clauses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.fixed import ENTITY_ID_FORMAT
from kestrel.functions.scalars import round_half_up
from kestrel.sources.tables import table

# Values of the derived views (shared with the oracle SQL text).  SENSORS is the
# sensor set of the driver data; documents take their sensor list from the data itself.
SENSORS = ["click", "error", "purchase", "signup", "view"]
SENSOR_UNIT = "value"
SENSOR_TYPE = "double"
SPLIT_TS = "2024-01-16 00:00:00"        # baseline = first half of January, current = second half
OBJECT_EPOCH = "2024-01-01 00:00:00"
PROCESSED_TS = "2024-02-01 09:00:00"     # processing time passed in, never "now"
DELAY_MINUTES = 10


def _ntz(c):
    return c.cast("timestamp_ntz")


# ---------------------------------------------------------------- features
def features_from_events(events: DataFrame) -> DataFrame:
    """The five-column feature table: entity_id, age, income, category, feature_timestamp."""
    return events.select(
        F.format_string(ENTITY_ID_FORMAT, F.col("user_id")).alias("entity_id"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("age"),
        F.col("value").alias("income"),
        F.col("event_type").alias("category"),
        F.col("ts").alias("feature_timestamp"),
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features_from_events(table(spark, sf_dir, "events", "user_id", "props", "value",
                                      "event_type", "ts"))


def with_period(df: DataFrame, ts_col: str = "feature_timestamp", split_ts: str = SPLIT_TS) -> DataFrame:
    """Label rows 'baseline' (before split_ts) or 'current' (rows without time: neither)."""
    t = F.lit(split_ts).cast("timestamp_ntz")
    return df.withColumn("period", F.when(F.col(ts_col) < t, "baseline").when(F.col(ts_col) >= t, "current"))


def split_periods(df: DataFrame, ts_col: str = "feature_timestamp",
                  split_ts: str = SPLIT_TS) -> tuple[DataFrame, DataFrame]:
    """(baseline, current) as plain time predicates, so they reach the Parquet scan
    as pushed filters (row groups outside the period are skipped)."""
    t = F.lit(split_ts).cast("timestamp_ntz")
    return df.where(F.col(ts_col) < t), df.where(F.col(ts_col) >= t)


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features with a weekly snapshot timestamp (weeks start on Monday)."""
    f = features(spark, sf_dir)
    return f.withColumn("snapshot_ts", _ntz(F.date_trunc("week", "feature_timestamp")))


# ---------------------------------------------------------------- sensor series
def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long sensor points: one {min,max} per (hour, sensor) present in events."""
    ev = table(spark, sf_dir, "events", "ts", "event_type", "value")
    return (ev.groupBy(_ntz(F.date_trunc("hour", "ts")).alias("ts"), F.col("event_type").alias("name"))
              .agg(F.min("value").alias("min"), F.max("value").alias("max")))


def sensor_names(spark: SparkSession, sf_dir: str) -> list[str]:
    """The sensors present in the data, in name order (one small distinct job; the list
    is as long as the number of sensors, so it is fine on the driver)."""
    ev = table(spark, sf_dir, "events", "event_type")
    return [r[0] for r in ev.where(F.col("event_type").isNotNull()).distinct().orderBy("event_type").collect()]


def _sensor_array(names: list[str]):
    return F.array(*[F.struct(F.lit(n).alias("name"), F.lit(SENSOR_UNIT).alias("unit"),
                              F.lit(SENSOR_TYPE).alias("type")) for n in names])


def series_doc(spark: SparkSession, sf_dir: str, corrupt: bool = False, names: list[str] | None = None) -> DataFrame:
    """One JSON series document per day: {series:[{name,unit,type}], values:{iso_ts:[point|null,…]}}.

    Each hour aggregates at most one point per sensor and each day at most 24 hours,
    so the collected lists are bounded by construction.  ``corrupt`` applies the
    invalid-document rules used by the validation operators: days 4, 13, 22 lose
    the last point of their first hour; day 30 has no sensors.
    """
    names = names or sensor_names(spark, sf_dir)
    m = measurements(spark, sf_dir)
    per_hour = (m.groupBy("ts")
                 .agg(F.map_from_entries(F.collect_list(F.struct("name", F.struct("min", "max")))).alias("pm")))
    name_arr = F.array(*[F.lit(n) for n in names])
    per_hour = per_hour.select(
        F.to_date("ts").alias("day"), "ts",
        F.transform(name_arr, lambda s: F.try_element_at(F.col("pm"), s)).alias("points"))
    if corrupt:
        first_hour = F.hour("ts") == F.expr("hour(min(ts) over (partition by day))")
        per_hour = per_hour.withColumn(
            "points",
            F.when(F.dayofmonth("day").isin(4, 13, 22) & first_hour,
                   F.slice("points", 1, len(names) - 1)).otherwise(F.col("points")))
    docs = (per_hour.groupBy("day")
                    .agg(F.map_from_entries(F.collect_list(F.struct(
                        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), "points"))).alias("values")))
    series = _sensor_array(names)
    if corrupt:
        series = F.when(F.dayofmonth("day") == 30, F.slice(series, 1, 0)).otherwise(series)
    return docs.select(F.date_format("day", "yyyyMMdd").alias("doc_id"),
                       F.to_json(F.struct(series.alias("series"), F.col("values"))).alias("doc"))


# ---------------------------------------------------------------- anomaly responses
def anomaly_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One detector response per (user, day, hour of the day): results = those
    events in time order, thresholds = mean + 2/3 sample deviations.

    Poison rules: user_id % 10 = 0 -> first element's error is text;
    = 3 -> first element's error is JSON null; = 6 -> threshold missing.
    The results list is built as JSON text so numbers stay numbers and text stays
    text.  A response covers one window of its user, as the detector is asked for it.
    """
    ev = table(spark, sf_dir, "events", "event_id", "user_id", "ts", "value")
    block = F.hour("ts").cast("bigint").alias("block")
    per_doc = (ev.groupBy("user_id", F.to_date("ts").alias("day"), block)
               .agg(F.sort_array(F.collect_list(F.struct("ts", "event_id", "value"))).alias("items"),
                    F.avg("value").alias("mu"), F.stddev_samp("value").alias("sd")))
    uid = F.col("user_id")

    def elem(x, i):
        err = (F.when((uid % 10 == 0) & (i == 0), F.lit('"n/a"'))
                .when((uid % 10 == 3) & (i == 0), F.lit("null"))
                .otherwise(x["value"].cast("string")))
        return F.concat(F.lit('{"timestamp":"'), F.date_format(x["ts"], "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
                        F.lit('","reconstructionError":'), err, F.lit("}"))

    results = F.concat(F.lit("["), F.array_join(F.transform("items", elem), ","), F.lit("]"))
    thr = F.to_json(F.struct((F.col("mu") + 2 * F.col("sd")).alias("2sigma"),
                             (F.col("mu") + 3 * F.col("sd")).alias("3sigma")))
    doc = (F.when(uid % 10 == 6, F.concat(F.lit('{"results":'), results, F.lit("}")))
            .otherwise(F.concat(F.lit('{"results":'), results, F.lit(',"threshold":'), thr, F.lit("}"))))
    return per_doc.select("user_id", "day", "block", doc.alias("doc"))


# ---------------------------------------------------------------- objects and messages
def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object listing derived from pages: name, bucket, size, content_type, created,
    updated, etag, md5_hash (updated is null when page_id % 13 = 0; ties are common)."""
    p = table(spark, sf_dir, "pages", "page_id", "url", "html")
    name = F.regexp_replace(F.regexp_replace("url", r"^https?://", ""), r"[?#].*$", "")
    return p.select(
        "page_id",
        name.alias("name"),
        F.lit("pages").alias("bucket"),
        F.octet_length("html").cast("bigint").alias("size"),
        F.lit("text/html").alias("content_type"),
        F.expr(f"timestampadd(MINUTE, page_id, TIMESTAMP_NTZ '{OBJECT_EPOCH}')").alias("created"),
        F.when(F.col("page_id") % 13 == 0, F.lit(None).cast("timestamp_ntz"))
         .otherwise(F.expr(f"timestampadd(HOUR, page_id % 50, TIMESTAMP_NTZ '{OBJECT_EPOCH}')")).alias("updated"),
        F.substring(F.md5("html"), 1, 16).alias("etag"),
        F.md5("html").alias("md5_hash"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message stream rows (message_id, body): {"path": host/lang} for every directory, twice where it has
    several objects (so what the messages match grows with the objects, not with their square), a path
    with no objects where page_id % 10 = 0, and every turn of every conversation as a malformed body."""
    o = objects(spark, sf_dir)
    host_lang = F.concat_ws("/", F.split_part("name", F.lit("/"), F.lit(1)),
                            F.split_part("name", F.lit("/"), F.lit(2)))
    path = F.when(F.col("page_id") % 10 == 0,
                  F.concat(F.split_part("name", F.lit("/"), F.lit(1)), F.lit("/zz"))).otherwise(host_lang)
    good = o.groupBy(path.alias("path")).agg(F.min("page_id").alias("first"), F.max("page_id").alias("last")).select(
        "path", F.explode(F.array_distinct(F.array("first", "last"))).alias("page")).select(
        F.concat(F.lit("p"), F.col("page").cast("string")).alias("message_id"),
        F.to_json(F.struct("path")).alias("body"))
    c = table(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    bad = c.select(F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))
                   .alias("message_id"), F.col("text").alias("body"))
    return good.unionByName(bad)


# ---------------------------------------------------------------- run log
def runs_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long run log (experiment, run, kind, key, step, value, text) from events:
    experiment = event_type, run = run_%04d of user_id, one 'loss' step metric per
    event (step = event_id), params from the user id, a 'score' metric per run."""
    ev = table(spark, sf_dir, "events", "event_id", "user_id", "event_type", "value")
    exp = F.col("event_type").alias("experiment")
    run = F.format_string("run_%04d", F.col("user_id")).alias("run")
    steps = ev.select(exp, run, F.lit("step_metric").alias("kind"), F.lit("loss").alias("key"),
                      F.col("event_id").alias("step"), F.col("value"), F.lit(None).cast("string").alias("text"))
    per_run = ev.groupBy("event_type", "user_id").agg(F.avg("value").alias("avg_v"))
    base = per_run.select(exp, run, "user_id", "avg_v")
    n_est = (50 + (F.col("user_id") % 4) * 50).cast("double")
    depth = (5 + (F.col("user_id") % 3) * 5).cast("double")
    params = base.select("experiment", "run", F.lit("param").alias("kind"),
                         F.explode(F.array(F.struct(F.lit("n_estimators").alias("k"), n_est.alias("v")),
                                           F.struct(F.lit("max_depth").alias("k"), depth.alias("v")))).alias("p"))
    params = params.select("experiment", "run", "kind", F.col("p.k").alias("key"),
                           F.lit(None).cast("bigint").alias("step"), F.col("p.v").alias("value"),
                           F.col("p.v").cast("bigint").cast("string").alias("text"))
    score = base.select("experiment", "run", F.lit("metric").alias("kind"), F.lit("score").alias("key"),
                        F.lit(None).cast("bigint").alias("step"),
                        round_half_up(F.col("avg_v") / 500.0, 4).alias("value"),
                        F.lit(None).cast("string").alias("text"))
    return steps.unionByName(params).unionByName(score)


def run_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per pipeline run: experiment, run, state, start_time, end_time,
    template_uri, template_version (state from max(event_id) % 4)."""
    ev = table(spark, sf_dir, "events", "event_id", "user_id", "event_type", "ts")
    g = ev.groupBy("event_type", "user_id").agg(F.min("ts").alias("start_time"), F.max("ts").alias("last_ts"),
                                                F.max("event_id").alias("last_id"))
    state = (F.when(F.col("last_id") % 4 == 1, "RUNNING").when(F.col("last_id") % 4 == 2, "FAILED")
             .otherwise("SUCCEEDED"))
    return g.select(
        F.col("event_type").alias("experiment"),
        F.format_string("run_%04d", F.col("user_id")).alias("run"),
        state.alias("state"),
        F.col("start_time"),
        F.when(state == "RUNNING", F.lit(None).cast("timestamp_ntz")).otherwise(F.col("last_ts")).alias("end_time"),
        F.concat(F.lit("templates/"), F.col("event_type"), F.lit("-train")).alias("template_uri"),
        F.concat(F.lit("v"), (F.col("user_id") % 3 + 1).cast("string")).alias("template_version"),
    )


# ---------------------------------------------------------------- predictions, lineage
def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, y, p, score): truth = labels.quality, prediction = n_chars within
    [500, 5000], score = n_chars."""
    lab = table(spark, sf_dir, "labels", "doc_id", "quality")
    doc = table(spark, sf_dir, "documents", "doc_id", "n_chars")
    j = lab.join(doc, "doc_id")
    return j.select("doc_id", F.col("quality").cast("bigint").alias("y"),
                    F.when(F.col("n_chars").between(500, 5000), 1).otherwise(0).cast("bigint").alias("p"),
                    F.col("n_chars").cast("double").alias("score"))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineage edges (src, dst): region -> nation -> customer -> order."""
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")
    c = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    k = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    return (n.select(k("region:", "n_regionkey").alias("src"), k("nation:", "n_nationkey").alias("dst"))
            .unionByName(c.select(k("nation:", "c_nationkey").alias("src"), k("customer:", "c_custkey").alias("dst")))
            .unionByName(o.select(k("customer:", "o_custkey").alias("src"), k("order:", "o_orderkey").alias("dst"))))
