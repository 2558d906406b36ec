"""Streaming forms of the feature-monitoring, feature-import, result-append and
run-metric operators (T2–T5).  Every query here is idempotent on restart: file
sinks and ``foreachBatch`` writes commit with the checkpoint, and batch-keyed
outputs are overwritten per batch id.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.fixed import DRIFT_THRESHOLD
from kestrel.operators import anomaly as A
from kestrel.operators.drift import N_BINS, chebyshev_from_shares, js_from_shares
from kestrel.operators.features import latest_per_entity
from kestrel.session import delete_path, path_exists

WATERMARK = "1 hour"      # ours: the reference defines no late-data policy


def _run(writer, checkpoint: str):
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


# ---------------------------------------------------------------- T2
def windowed_stats(stream: DataFrame, ts: str, cadence: str, keys: list[str], value: str,
                   watermark: str = WATERMARK) -> DataFrame:
    """Tumbling-window statistics per key with a watermark (closed windows only in append mode).
    The event time must be TIMESTAMP (an NTZ column is cast in the session zone)."""
    s = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    return (s.groupBy(F.window(ts, cadence), *keys)
             .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("sum"), F.avg(value).alias("mean"),
                  F.min(value).alias("min"), F.max(value).alias("max"), F.stddev_samp(value).alias("std"))
             .select(F.col("window.start").cast("timestamp_ntz").alias("window_start"),
                     F.col("window.end").cast("timestamp_ntz").alias("window_end"), *keys, "n", "sum", "mean", "min",
                     "max", "std"))


def run_windowed_monitor(spark: SparkSession, source_dir: str, schema: str, out: str, checkpoint: str,
                         cadence: str = "1 hour", keys: list[str] | None = None, value: str = "value") -> str:
    stream = spark.readStream.schema(schema).parquet(source_dir)
    stats = windowed_stats(stream, "ts", cadence, keys or [], value)
    _run(stats.writeStream.outputMode("append").format("parquet").option("path", out), checkpoint)
    return out


def run_cadence_monitors(spark: SparkSession, source_dir: str, schema: str, out: str, checkpoint: str,
                         monitors: list[tuple[str, str, str]], keys: list[str] | None = None,
                         prepare=None) -> str:
    """T2 with several cadences over one feature stream: each (name, cadence, value
    column) is its own streaming query (own checkpoint, own state), all started before
    any is awaited; results land in ``out/monitor=<name>``."""
    keys = keys or []
    queries = []
    for name, cadence, value in monitors:
        stream = spark.readStream.schema(schema).parquet(source_dir)
        if prepare is not None:
            stream = prepare(stream)
        stats = windowed_stats(stream, "ts", cadence, keys, value)
        queries.append(stats.writeStream.outputMode("append").format("parquet")
                       .option("path", f"{out}/monitor={name}")
                       .option("checkpointLocation", f"{checkpoint}/{name}")
                       .trigger(availableNow=True).start())
    for q in queries:
        q.awaitTermination()
    return out


def run_windowed_drift(spark: SparkSession, source_dir: str, schema: str, out: str, checkpoint: str,
                       cadence_minutes: int = 60, keys: list[str] | None = None, value: str = "value",
                       threshold: float = 0.3) -> str:
    """T2 with drift: every closed window is compared with the window just before it
    (mean shift in units of the earlier window's deviation) inside ``foreachBatch``.
    The earlier window comes from this batch or from earlier batches in the sink.  The sink
    is partitioned by batch and day of the window: only the days one cadence before this
    batch's windows are read, never what this batch itself wrote in an attempt that failed,
    and a retried batch replaces itself."""
    keys = keys or []
    stream = spark.readStream.schema(schema).parquet(source_dir)
    stats = windowed_stats(stream, "ts", f"{cadence_minutes} minutes", keys, value)
    step = F.make_interval(mins=F.lit(cadence_minutes))

    def handle(batch: DataFrame, batch_id: int) -> None:
        cur = batch.select(*keys, "window_start", "window_end", "n", "sum", "mean", "std")
        wanted = cur.select(*keys, (F.col("window_start") - step).alias("window_start")).distinct()
        prev = cur.select(*keys, "window_start", "n", "sum", "mean", "std")
        if path_exists(spark, out):
            days = [r[0] for r in wanted.select(F.to_date("window_start")).distinct().collect()]   # days of one batch
            old = (spark.read.schema(cur.withColumn("batch_id", F.lit(0)).withColumn("window_date", F.current_date()).schema)
                   .parquet(out).where((F.col("batch_id") < int(batch_id)) & F.col("window_date").isin(days))
                   .select(*keys, "window_start", "n", "sum", "mean", "std"))
            prev = prev.unionByName(old.join(wanted, keys + ["window_start"], "left_semi"))
        prev = prev.select(*keys, (F.col("window_start") + step).alias("window_start"),
                           F.col("n").alias("prev_n"), F.col("sum").alias("prev_sum"),
                           F.col("mean").alias("prev_mean"), F.col("std").alias("prev_std"))
        dev = F.abs(F.col("mean") - F.col("prev_mean")) / F.nullif(F.col("prev_std"), F.lit(0.0))
        res = (cur.join(prev, keys + ["window_start"], "left")
                  .withColumn("deviation", dev)
                  .withColumn("drift_detected", F.coalesce(F.col("deviation") > F.lit(threshold), F.lit(False)))
                  .withColumn("batch_id", F.lit(int(batch_id)))
                  .withColumn("window_date", F.to_date("window_start")))
        (res.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id", "window_date").parquet(out))

    _run(stats.writeStream.outputMode("append").foreachBatch(handle), checkpoint)
    return out


def histogram_rows(stream: DataFrame, ts: str, numeric: dict[str, tuple[float, float]], nominal: list[str],
                   bins: int = N_BINS) -> DataFrame:
    """(ts, feature, kind, bucket): one row for each monitored value of a row.  Numeric features have ``bins`` equal
    bins over their configured range, values outside fall into the first or last one; nulls count nowhere."""
    parts = []
    for c, (low, high) in numeric.items():
        v = F.col(c).cast("double")
        place = F.least(F.greatest(F.floor((v - low) / (high - low) * bins), F.lit(0)), F.lit(bins - 1))
        parts.append(F.struct(F.lit(c).alias("feature"), F.lit("numeric").alias("kind"), place.cast("int").cast("string").alias("bucket")))
    parts += [F.struct(F.lit(c).alias("feature"), F.lit("nominal").alias("kind"), F.col(c).cast("string").alias("bucket")) for c in nominal]
    return stream.select(ts, F.inline(F.array(*parts))).where(F.col("bucket").isNotNull())


def run_distribution_drift(spark: SparkSession, source_dir: str, schema: str, out: str, checkpoint: str,
                           numeric: dict[str, tuple[float, float]], nominal: list[str], cadence_minutes: int = 60,
                           threshold: float = DRIFT_THRESHOLD, max_files_per_trigger: int | None = None, prepare=None) -> str:
    """T2 with drift of distributions: every closed window against the window just before it, Jensen-Shannon
    divergence of the histograms of numeric features and Chebyshev distance of the shares of nominal ones.

    The streaming state is one count for each (window, feature, bucket).  Closed windows go to ``out/counts``,
    partitioned by batch and day, and are compared with the earlier window from this batch or from the days that it
    can lie in; results go to ``out/drift``.  Both are replaced by a retry of the batch."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = r.parquet(source_dir)
    if prepare is not None:
        stream = prepare(stream)
    rows = (histogram_rows(stream.withColumn("ts", F.col("ts").cast("timestamp")), "ts", numeric, nominal)
            .withWatermark("ts", WATERMARK))
    counts = rows.groupBy(F.window("ts", f"{cadence_minutes} minutes"), "feature", "kind", "bucket").agg(F.count(F.lit(1)).alias("n")) \
        .select(F.col("window.start").cast("timestamp_ntz").alias("window_start"), "feature", "kind", "bucket", "n")
    step = F.make_interval(mins=F.lit(cadence_minutes))

    def handle(batch: DataFrame, batch_id: int) -> None:
        def write(df: DataFrame, name: str) -> None:
            (df.withColumns({"batch_id": F.lit(int(batch_id)), "window_date": F.to_date("window_start")})
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id", "window_date").parquet(f"{out}/{name}"))
        write(batch, "counts")
        stored = (spark.read.schema(batch.withColumn("batch_id", F.lit(0)).withColumn("window_date", F.current_date()).schema)
                  .parquet(f"{out}/counts"))
        cur = stored.where(F.col("batch_id") == int(batch_id))
        before = cur.select((F.col("window_start") - step).alias("w")).distinct()
        days = [r[0] for r in before.select(F.to_date("w")).distinct().collect()]     # days of one batch
        old = stored.where((F.col("batch_id") <= int(batch_id)) & F.col("window_date").isin(days))
        # windows of this batch, and the ones before them moved up by a step
        wanted = cur.select("window_start").distinct()
        moved = old.withColumn("window_start", F.col("window_start") + step).join(wanted, "window_start", "left_semi")
        keys = ["window_start", "feature", "kind"]
        both = cur.select(*keys, "bucket", "n", F.lit(0).cast("long").alias("m")).unionByName(
            moved.select(*keys, "bucket", F.lit(0).cast("long").alias("n"), F.col("n").alias("m")))
        both = both.groupBy(*keys, "bucket").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
        total = both.groupBy(*keys).agg(F.sum("n").alias("tn"), F.sum("m").alias("tm"))
        pq = both.join(total, keys).select(*keys, "tn", "tm", F.coalesce(F.col("m") / F.nullif("tm", F.lit(0)), F.lit(0.0)).alias("p"),
                                           F.coalesce(F.col("n") / F.nullif("tn", F.lit(0)), F.lit(0.0)).alias("q"))
        js, far = (f(pq.where(F.col("kind") == kind), [*keys, "tn", "tm"]) for f, kind in (
            (js_from_shares, "numeric"), (chebyshev_from_shares, "nominal")))
        # a feature that has no value in the window is not compared
        res = (js.unionByName(far).where("tn > 0").withColumnsRenamed({"tn": "n", "tm": "prev_n"})
               .withColumn("window_end", F.col("window_start") + step)
               .withColumn("drift_detected", F.coalesce(F.col("deviation") > F.lit(threshold), F.lit(False))))
        write(res, "drift")

    _run(counts.writeStream.outputMode("append").foreachBatch(handle), checkpoint)
    return f"{out}/drift"


# ---------------------------------------------------------------- T3
#: Runs of one level that are merged into one of the next.
FAN = 4


def live_runs(spark: SparkSession, serving: str) -> list[dict]:
    """The runs of the newest manifest: level, path and the batch that made it."""
    if not path_exists(spark, f"{serving}/manifest"):
        return []
    newest = spark.read.schema("batch long, runs string").json(f"{serving}/manifest").agg(F.max(F.struct("batch", "runs"))).first()[0]
    return json.loads(newest["runs"]) if newest is not None else []


def merge_latest(spark: SparkSession, batch: DataFrame, batch_id: int, serving: str, keys: list[str], ts: str) -> None:
    """Adds a batch to the serving table (latest row per entity) as a run of its own.

    The table is a few levels of runs, each with one row per entity; FAN runs of a level are merged into one of the
    next, so a row is rewritten once a level and a batch writes in proportion to itself, not to the
    table.  A manifest, written last, says which runs count: a batch that failed on the way is
    repeated from the runs before it, and one that has its manifest is done.  Of equal times the later batch wins."""
    runs = live_runs(spark, serving)
    if any(r["batch"] >= batch_id for r in runs):
        return
    own = latest_per_entity(batch, keys, ts)
    schema = own.withColumn("_batch", F.lit(0).cast("long")).schema

    def write(df: DataFrame, level: int) -> dict:
        path = f"{serving}/runs/l{level}-{batch_id}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return {"level": level, "path": path, "batch": batch_id}
    runs = [*runs, write(own.withColumn("_batch", F.lit(batch_id).cast("long")), 0)]
    level, gone = 0, []
    while len(full := [r for r in runs if r["level"] == level]) >= FAN:
        rows = spark.read.schema(schema).parquet(*[r["path"] for r in full])
        runs = [r for r in runs if r["level"] != level] + [write(latest_per_entity(rows, keys, ts, ["_batch"]), level + 1)]
        gone += full
        level += 1
    (spark.createDataFrame([(batch_id, json.dumps(runs))], "batch long, runs string").coalesce(1)
     .write.mode("overwrite").json(f"{serving}/manifest/b={batch_id}"))
    for b in [m for m in _manifests(spark, serving) if m < batch_id - KEPT_MANIFESTS]:
        delete_path(spark, f"{serving}/manifest/b={b}")
    # a reader of the manifest before this one may still be at the runs that this batch has merged: they go one batch later
    for r in _merged_before(spark, serving, batch_id, gone):
        delete_path(spark, r)


#: Manifests that stay behind the newest one.
KEPT_MANIFESTS = 2


def _manifests(spark: SparkSession, serving: str) -> list[int]:
    t = spark.read.schema("batch long, runs string").json(f"{serving}/manifest").select("batch")
    return sorted(r[0] for r in t.collect())          # KEPT_MANIFESTS and a few


def _merged_before(spark: SparkSession, serving: str, batch_id: int, gone: list[dict]) -> list[str]:
    """Notes the runs that this batch has merged, and returns those noted by earlier batches."""
    note = f"{serving}/merged"
    earlier = []
    if path_exists(spark, note):
        rows = spark.read.schema("batch long, path string").json(note).where(F.col("batch") < batch_id).collect()     # a few runs
        earlier = [r["path"] for r in rows]
    spark.createDataFrame([(batch_id, r["path"]) for r in gone], "batch long, path string").coalesce(1).write.mode("overwrite").json(note)
    return earlier


def serving_table(spark: SparkSession, serving: str, keys: list[str], ts: str) -> DataFrame:
    """The latest row of each entity over the live runs (merge on read)."""
    paths = [r["path"] for r in live_runs(spark, serving)]
    if not paths:
        raise ValueError(f"no batch has been imported to {serving}")
    return latest_per_entity(spark.read.parquet(*paths), keys, ts, ["_batch"]).drop("_batch")


def run_feature_import(spark: SparkSession, source_dir: str, schema: str, serving: str, checkpoint: str,
                       keys: list[str], ts: str, max_files_per_trigger: int | None = None) -> str:
    """Append-only offline history is the source; each micro-batch becomes a run of the
    serving table (newest value per entity) with ``merge_latest``."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = r.parquet(source_dir)

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_latest(spark, batch, int(batch_id), serving, keys, ts)

    _run(stream.writeStream.foreachBatch(merge), checkpoint)
    return serving


# ---------------------------------------------------------------- T4
def run_result_append(spark: SparkSession, source_dir: str, out: str, checkpoint: str, processed_ts: str,
                      delay_minutes: int) -> str:
    """Detector responses arriving as JSON files -> one result row each -> day-partitioned
    Parquet (exactly-once file sink)."""
    stream = spark.readStream.schema("user_id bigint, day date, block bigint, doc string").json(source_dir)
    parsed = A.parse_response(stream)
    key = F.concat_ws(":", F.col("user_id").cast("string"), F.date_format("day", "yyyy-MM-dd"),
                      F.col("block").cast("string"))
    rows = A.latest_inference(parsed, key, processed_ts, delay_minutes).withColumn("p_date", F.to_date("event_ts"))
    _run(rows.writeStream.outputMode("append").format("parquet").option("path", out).partitionBy("p_date"),
         checkpoint)
    return out


# ---------------------------------------------------------------- T5
def run_step_metrics(spark: SparkSession, source_dir: str, schema: str, out: str, checkpoint: str) -> str:
    """Step metrics logged during training: running per-run summary.  A batch writes the runs it
    changed, into a partition of its own that a retry replaces; ``step_summary`` reads the
    newest row of each run."""
    stream = spark.readStream.schema(schema).parquet(source_dir)
    s = stream.where(F.col("kind") == "step_metric")
    summary = s.groupBy("experiment", "run", "key").agg(
        F.max_by("value", "step").alias("last_value"), F.max("step").alias("last_step"),
        F.min("value").alias("min_value"), F.max("value").alias("max_value"), F.count(F.lit(1)).alias("n_steps"))

    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.write.mode("overwrite").option("partitionOverwriteMode", "static")
         .parquet(f"{out.rstrip('/')}/batch_id={int(batch_id)}"))

    _run(summary.writeStream.outputMode("update").foreachBatch(write), checkpoint)
    return out


def step_summary(spark: SparkSession, out: str) -> DataFrame:
    """T5: the summary of every run as of the last batch that changed it."""
    keys = ["experiment", "run", "key"]
    t = spark.read.parquet(out)
    rest = [c for c in t.columns if c not in (*keys, "batch_id")]
    return (t.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("s"))
            .select(*keys, *[F.col(f"s.{c}").alias(c) for c in rest]))
