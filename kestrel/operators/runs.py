"""Experiment run tracking and pipeline-run analytics.

The run log is a long table ``(experiment, run, kind, key, step, value, text)``
appended to Parquet; every analysis is an aggregation or a keyed window over
per-run summaries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.operators.cumulative import last_value, running

LOG_SCHEMA = "experiment string, run string, kind string, key string, step bigint, value double, text string"


# ---------------------------------------------------------------- X1-X5
def log_rows(log: DataFrame, path: str) -> None:
    """Append params, metrics and step metrics (long form) to the run log."""
    log.select("experiment", "run", "kind", "key", "step", "value", "text").write.mode("append").parquet(path)


def log_params_metrics(spark: SparkSession, path: str, experiment: str, run: str,
                       params: dict | None = None, metrics: dict | None = None) -> None:
    """X1 for one run from driver-side values (a handful of rows)."""
    rows = [(experiment, run, "param", k, None, float(v) if isinstance(v, (int, float)) else None, str(v))
            for k, v in (params or {}).items()]
    rows += [(experiment, run, "metric", k, None, float(v), None) for k, v in (metrics or {}).items()]
    spark.createDataFrame(rows, LOG_SCHEMA).write.mode("append").parquet(path)


def upsert_experiments(existing: DataFrame, requested: DataFrame, key: str = "experiment") -> DataFrame:
    """X3 get-or-create: existing rows kept, new keys added once (anti join + union)."""
    new = requested.select(key).distinct().join(existing.select(key), key, "left_anti")
    return existing.select(key).unionByName(new)


def delete_experiment(log: DataFrame, experiment: str) -> DataFrame:
    """X3 delete: the log without that experiment (to be written back with overwrite)."""
    return log.where(~F.col("experiment").eqNullSafe(F.lit(experiment)))


def list_runs(log: DataFrame) -> DataFrame:
    """X3 list: experiments with their number of runs and logged rows."""
    return log.groupBy("experiment").agg(F.count_distinct("run").alias("n_runs"),
                                         F.count(F.lit(1)).alias("n_rows"))


def infer_runs_from_jobs(jobs: DataFrame, params: str = "params", metrics: str = "metrics",
                         outputs: str = "outputs") -> DataFrame:
    """Unpivot the parameter / metric / output maps of a job table into the run log."""
    p = jobs.select("experiment", "run", F.lit("param").alias("kind"), F.explode(params).alias("key", "text")) \
        .select("experiment", "run", "kind", "key", F.lit(None).cast("bigint").alias("step"),
                F.col("text").try_cast("double").alias("value"), "text")
    m = jobs.select("experiment", "run", F.lit("metric").alias("kind"), F.explode(metrics).alias("key", "value")) \
        .select("experiment", "run", "kind", "key", F.lit(None).cast("bigint").alias("step"), "value",
                F.lit(None).cast("string").alias("text"))
    a = jobs.select("experiment", "run", F.lit("artifact").alias("kind"), F.explode(outputs).alias("key", "text")) \
        .select("experiment", "run", "kind", "key", F.lit(None).cast("bigint").alias("step"),
                F.lit(None).cast("double").alias("value"), "text")
    return p.unionByName(m).unionByName(a)


def artifacts(runs: DataFrame, base_uri: str) -> DataFrame:
    """Artifact rows (schema type, name, uri) per run: its dataset and its model."""
    arts = F.array(F.struct(F.lit("system.Dataset").alias("schema_type"), F.lit("train_data").alias("name")),
                   F.struct(F.lit("system.Model").alias("schema_type"), F.lit("model").alias("name")))
    return runs.select("experiment", "run", F.inline(arts)).withColumn(
        "uri", F.concat_ws("/", F.lit(base_uri), "experiment", "run", "name"))


# ---------------------------------------------------------------- A24-A27, W6, P10
def run_state_metrics(runs: DataFrame, keys: list[str]) -> DataFrame:
    """Counts by state and mean duration (seconds) of finished runs."""
    dur = F.unix_timestamp(F.col("end_time").cast("timestamp")) - F.unix_timestamp(F.col("start_time").cast("timestamp"))
    return runs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.count_if(F.col("state") == "SUCCEEDED").alias("completed"),
        F.count_if(F.col("state") == "RUNNING").alias("executing"),
        F.count_if(F.col("state") == "FAILED").alias("failed"),
        F.avg(F.when(F.col("end_time").isNotNull(), dur)).alias("avg_duration_s"))


def runs_pivot(log: DataFrame, params: list[str], metrics: list[str]) -> DataFrame:
    """One row per run, ``param.<k>`` (text) and ``metric.<k>`` (number) columns (explicit key
    lists).  Of a key logged several times the row with the highest step counts, then the largest value."""
    text = F.coalesce(F.col("text"), F.col("value").cast("string"))

    def latest(value):
        return F.max_by(value, F.struct(F.coalesce(F.col("step"), F.lit(-1).cast("bigint")), value))
    pl = log.where(F.col("kind") == "param").groupBy("experiment", "run").pivot("key", params).agg(latest(text))
    ml = log.where(F.col("kind") == "metric").groupBy("experiment", "run").pivot("key", metrics).agg(latest(F.col("value")))
    pl = pl.select("experiment", "run", *[F.col(k).alias(f"param.{k}") for k in params])
    ml = ml.select("experiment", "run", *[F.col(k).alias(f"metric.{k}") for k in metrics])
    return pl.join(ml, ["experiment", "run"], "full_outer")


def step_metrics(log: DataFrame, key: str = "loss") -> DataFrame:
    """Per run and metric key: last value (highest step), min, max, number of steps."""
    s = log.where((F.col("kind") == "step_metric") & (F.col("key") == key))
    return s.groupBy("experiment", "run", "key").agg(
        F.max_by("value", "step").alias("last_value"), F.max("step").alias("last_step"),
        F.min("value").alias("min_value"), F.max("value").alias("max_value"),
        F.count(F.lit(1)).alias("n_steps"))


def best_run(scores: DataFrame, keys: list[str], score: str = "score", run: str = "run") -> DataFrame:
    """Highest score per key group, the first run (by name) wins ties."""
    w = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc(run))
    return scores.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") == 1).drop("_rk")


def running_best(scores: DataFrame, keys: list[str], order: str = "run", score: str = "score") -> DataFrame:
    """Best score among earlier runs, and whether this run strictly improves on it."""
    r = running(scores, keys, order, [score], "max", inclusive=False, prefix="_best_")
    return (r.withColumnRenamed(f"_best_{score}", "best_before")
             .withColumn("improved", F.col("best_before").isNull() | (F.col(score) > F.col("best_before"))))


def filter_runs(runs: DataFrame, states: list[str] | None = None, uri_prefix: str | None = None,
                version: str | None = None) -> DataFrame:
    """P10: runs by state, template URI prefix and template version."""
    c = F.lit(True)
    if states:
        c = c & F.col("state").isin(states)
    if uri_prefix:
        c = c & F.col("template_uri").startswith(uri_prefix)
    if version:
        c = c & (F.col("template_version") == version)
    return runs.where(c)


# ---------------------------------------------------------------- J9-J11
def cache_key(*cols) -> F.Column:
    """Step cache key = md5 over the step's inputs, output definition and component spec, each
    behind its length so that no two lists of values read the same (null: no length)."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.concat(F.length(c), F.lit(":"), c), F.lit("-")) for c in cols]))


def step_cache(requests: DataFrame, executions: DataFrame, key: str = "cache_key",
               pipeline: str = "pipeline", partitions: int | None = None) -> DataFrame:
    """For each requested step (started at ``start_time``), the newest successful execution of
    the same pipeline with the same key that finished before it (hit -> reuse its output; the
    greatest uri among equal times).

    Requests and executions of a key are one ordered stream in which the last output is carried on
    (``last_value``), so a key that is asked for often neither multiplies nor sits in one task."""
    cols = requests.columns
    asked = requests.select(pipeline, key, F.col("start_time").alias("_t"), F.lit(0).alias("_side"),
                            F.struct(*cols).alias("_r"), F.lit(None).cast("string").alias("_uri"))
    done = executions.where(F.col("finished").isNotNull()).select(
        pipeline, key, F.col("finished").alias("_t"), F.lit(1).alias("_side"),
        F.lit(None).cast(asked.schema["_r"].dataType).alias("_r"), F.col("output_uri").alias("_uri"))
    got = last_value(asked.unionByName(done), [pipeline, key], ["_t", "_side", "_uri"], "_uri", "_cached", partitions, "step-cache")
    return (got.where("_side = 0").select(*[F.col(f"_r.{c}").alias(c) for c in cols], F.col("_cached").alias("cached_output"))
            .withColumn("hit", F.col("cached_output").isNotNull()))


def lineage_closure(edges: DataFrame, src: str = "src", dst: str = "dst", upstream: bool = True,
                    max_rounds: int | None = None, artifacts: list[str] | DataFrame | None = None) -> DataFrame:
    """(node, relative, depth) — all ancestors (or descendants) of the named
    artifacts (names, or a table with a column ``node``); of every node only when none are given, whose pairs
    grow with the square of a chain's length.

    Iterative frontier join; each round joins only the newly found pairs, removes
    pairs already known (so cycles end), and is checkpointed to the shared
    checkpoint folder to cut the lineage.  It runs until a round finds nothing new;
    ``max_rounds`` is only a safety stop and raises instead of returning a partial
    closure."""
    from kestrel.session import checkpoint_dir
    checkpoint_dir(edges.sparkSession)
    e = edges.select(F.col(dst).alias("node"), F.col(src).alias("rel")) if upstream else \
        edges.select(F.col(src).alias("node"), F.col(dst).alias("rel"))
    e = e.distinct()
    if artifacts is None:
        start = e
    elif isinstance(artifacts, DataFrame):
        start = e.join(artifacts.select("node").distinct(), "node", "left_semi")
    else:
        start = e.where(F.col("node").isin(artifacts))
    known = start.withColumn("depth", F.lit(1)).checkpoint()
    frontier = known
    d = 1
    while True:
        d += 1
        if max_rounds is not None and d > max_rounds + 1:
            raise RuntimeError(f"lineage deeper than {max_rounds} levels; raise max_rounds")
        step = (frontier.alias("f").join(e.alias("e"), F.col("f.rel") == F.col("e.node"))
                .select(F.col("f.node").alias("node"), F.col("e.rel").alias("rel")).distinct())
        new = step.join(known.select("node", "rel"), ["node", "rel"], "left_anti").withColumn("depth", F.lit(d))
        new = new.checkpoint()
        if new.isEmpty():
            break
        known = known.unionByName(new)          # each round's pairs are written once
        frontier = new
    return known


def batch_gate(attempts: DataFrame, pending: DataFrame, batch: str = "batch") -> DataFrame:
    """Final status of each upstream batch = status of its last attempt; a downstream
    batch runs only when that is 200, else a FAILED row."""
    final = attempts.groupBy(batch).agg(F.max_by("status", "attempt").alias("final_status"),
                                        F.max("attempt").alias("attempts"))
    j = pending.join(final, batch, "left")
    return j.withColumn("downstream", F.when(F.col("final_status") == 200, "RUN").otherwise("FAILED"))
