"""Run-tracking queries over the run log and run table derived from events, and
lineage over region -> nation -> customer -> order edges."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import runs as R
from kestrel.plans.common import rounded
from kestrel.plans.oracle import EDGES, RUN_TABLE, RUNS_LOG, with_
from kestrel.plans.registry import query
from kestrel.session import scratch_path
from kestrel.sources.derived import edges, run_table, runs_log
from kestrel.sources.tables import table


def _logged(spark, sf, kinds=None):
    path = scratch_path(spark, "runlog")
    log = runs_log(spark, sf)
    if kinds:
        log = log.where(F.col("kind").isin(kinds))
    R.log_rows(log, path)
    return spark.read.parquet(path)


@query("log_params_metrics", with_(RUNS_LOG) + """
SELECT experiment, kind, key, count(*) AS n, round(sum(value), 6) AS total FROM runs_log
WHERE kind IN ('param', 'metric') GROUP BY ALL""")
def q_log_params_metrics(spark, sf):
    back = _logged(spark, sf, ["param", "metric"])
    return rounded(back.groupBy("experiment", "kind", "key").agg(F.count(F.lit(1)).alias("n"),
                                                                 F.sum("value").alias("total")))


@query("log_step_metrics", with_(RUNS_LOG) + """
SELECT experiment, run, count(*) AS n_steps, max(step) AS last_step FROM runs_log WHERE kind = 'step_metric' GROUP BY ALL""")
def q_log_step_metrics(spark, sf):
    back = _logged(spark, sf, ["step_metric"])
    return back.groupBy("experiment", "run").agg(F.count(F.lit(1)).alias("n_steps"), F.max("step").alias("last_step"))


@query("experiment_get_or_create", """
SELECT DISTINCT event_type AS experiment FROM events""")
def q_experiment_get_or_create(spark, sf):
    ev = table(spark, sf, "events", "event_type", "ts")
    existing = ev.where(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")).select(
        F.col("event_type").alias("experiment")).distinct()
    requested = ev.select(F.col("event_type").alias("experiment"))
    once = R.upsert_experiments(existing, requested)
    return R.upsert_experiments(once, requested)      # idempotent


@query("experiment_list", with_(RUNS_LOG) + """
SELECT experiment, count(DISTINCT run) AS n_runs, count(*) AS n_rows FROM runs_log GROUP BY experiment""")
def q_experiment_list(spark, sf):
    return R.list_runs(runs_log(spark, sf))


@query("experiment_delete", with_(RUNS_LOG) + """
SELECT experiment, count(*) AS n FROM runs_log WHERE experiment <> 'error' GROUP BY experiment""")
def q_experiment_delete(spark, sf):
    path = scratch_path(spark, "runlog")
    R.log_rows(runs_log(spark, sf), path)
    kept = R.delete_experiment(spark.read.parquet(path), "error")
    path2 = scratch_path(spark, "runlog")
    kept.write.mode("overwrite").parquet(path2)
    return spark.read.parquet(path2).groupBy("experiment").agg(F.count(F.lit(1)).alias("n"))


_JOBS_SQL = with_(RUN_TABLE) + """,
jobs AS (
  SELECT experiment, run, 'param' AS kind, 'template_version' AS key, CAST(NULL AS DOUBLE) AS step,
         TRY_CAST(template_version AS DOUBLE) AS value, template_version AS text FROM run_table
  UNION ALL
  SELECT experiment, run, 'metric', 'duration_s', NULL,
         CAST(epoch(date_trunc('second', end_time)) - epoch(date_trunc('second', start_time)) AS DOUBLE), NULL FROM run_table WHERE end_time IS NOT NULL
  UNION ALL
  SELECT experiment, run, 'artifact', 'model', NULL, NULL, 'store://models/' || experiment || '/' || run FROM run_table)"""


def _job_table(spark, sf):
    rt = run_table(spark, sf)
    dur = (F.unix_timestamp(F.col("end_time").cast("timestamp")) -
           F.unix_timestamp(F.col("start_time").cast("timestamp"))).cast("double")
    return rt.select(
        "experiment", "run",
        F.create_map(F.lit("template_version"), F.col("template_version")).alias("params"),
        F.when(F.col("end_time").isNotNull(), F.create_map(F.lit("duration_s"), dur))
         .otherwise(F.create_map().cast("map<string,double>")).alias("metrics"),
        F.create_map(F.lit("model"), F.concat(F.lit("store://models/"), F.col("experiment"), F.lit("/"), F.col("run")))
         .alias("outputs"))


@query("infer_run_from_job", _JOBS_SQL + "SELECT * FROM jobs")
def q_infer_run_from_job(spark, sf):
    return R.infer_runs_from_jobs(_job_table(spark, sf)).withColumn("step", F.col("step").cast("double"))


@query("log_artifact", with_(RUN_TABLE) + """
SELECT experiment, run, 'system.Dataset' AS schema_type, 'train_data' AS name,
       'store://artifacts/' || experiment || '/' || run || '/train_data' AS uri FROM run_table
UNION ALL
SELECT experiment, run, 'system.Model', 'model', 'store://artifacts/' || experiment || '/' || run || '/model' FROM run_table""")
def q_log_artifact(spark, sf):
    return R.artifacts(run_table(spark, sf), "store://artifacts")


@query("run_state_metrics", with_(RUN_TABLE) + """
SELECT experiment, count(*) AS n_runs, CAST(count_if(state = 'SUCCEEDED') AS BIGINT) AS completed,
       CAST(count_if(state = 'RUNNING') AS BIGINT) AS executing, CAST(count_if(state = 'FAILED') AS BIGINT) AS failed,
       round(avg(CASE WHEN end_time IS NOT NULL THEN epoch(date_trunc('second', end_time)) - epoch(date_trunc('second', start_time)) END), 6) AS avg_duration_s
FROM run_table GROUP BY experiment""")
def q_run_state_metrics(spark, sf):
    rt = run_table(spark, sf).withColumn("start_time", F.date_trunc("second", "start_time").cast("timestamp_ntz")) \
        .withColumn("end_time", F.date_trunc("second", "end_time").cast("timestamp_ntz"))
    return rounded(R.run_state_metrics(rt, ["experiment"]))


@query("runs_pivot", with_(RUNS_LOG) + """
SELECT experiment, run,
       max(text) FILTER (WHERE kind = 'param' AND key = 'n_estimators') AS "param.n_estimators",
       max(text) FILTER (WHERE kind = 'param' AND key = 'max_depth') AS "param.max_depth",
       max(value) FILTER (WHERE kind = 'metric' AND key = 'score') AS "metric.score"
FROM runs_log WHERE kind IN ('param', 'metric') GROUP BY experiment, run""")
def q_runs_pivot(spark, sf):
    return R.runs_pivot(runs_log(spark, sf), ["n_estimators", "max_depth"], ["score"])


@query("step_metrics", with_(RUNS_LOG) + """
SELECT experiment, run, key, arg_max(value, step) AS last_value, max(step) AS last_step,
       min(value) AS min_value, max(value) AS max_value, count(*) AS n_steps
FROM runs_log WHERE kind = 'step_metric' AND key = 'loss' GROUP BY ALL""")
def q_step_metrics(spark, sf):
    return R.step_metrics(runs_log(spark, sf))


def _scores(spark, sf):
    p = R.runs_pivot(runs_log(spark, sf), ["n_estimators", "max_depth"], ["score"])
    return p.select("experiment", "run", F.col("`metric.score`").alias("score"),
                    F.col("`param.n_estimators`").cast("double").alias("n_estimators"),
                    F.col("`param.max_depth`").cast("double").alias("max_depth"))


_SCORES_SQL = with_(RUNS_LOG) + """,
scores AS (SELECT experiment, run,
                  max(value) FILTER (WHERE kind = 'metric' AND key = 'score') AS score,
                  max(value) FILTER (WHERE kind = 'param' AND key = 'n_estimators') AS n_estimators,
                  max(value) FILTER (WHERE kind = 'param' AND key = 'max_depth') AS max_depth
           FROM runs_log WHERE kind IN ('param', 'metric') GROUP BY experiment, run)"""


@query("best_run", _SCORES_SQL + """
SELECT experiment, run, score, n_estimators, max_depth FROM (
  SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY score DESC, run) AS rk FROM scores) WHERE rk = 1""")
def q_best_run(spark, sf):
    return R.best_run(_scores(spark, sf), ["experiment"])


@query("running_best", _SCORES_SQL + """
SELECT experiment, run, score,
       max(score) OVER (PARTITION BY experiment ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before,
       coalesce(score > max(score) OVER (PARTITION BY experiment ORDER BY run
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS improved
FROM scores""")
def q_running_best(spark, sf):
    s = _scores(spark, sf).select("experiment", "run", "score")
    return R.running_best(s, ["experiment"]).select("experiment", "run", "score", "best_before", "improved")


@query("filter_runs", with_(RUN_TABLE) + """
SELECT * FROM run_table WHERE state IN ('SUCCEEDED', 'FAILED') AND starts_with(template_uri, 'templates/click')
  AND template_version = 'v2'""")
def q_filter_runs(spark, sf):
    return R.filter_runs(run_table(spark, sf), ["SUCCEEDED", "FAILED"], "templates/click", "v2")


_CACHE_KEY = """md5(length(template_version) || ':' || template_version || '|5:train')"""


@query("join_step_cache", with_(RUN_TABLE) + f""",
req AS (SELECT experiment AS pipeline, run, start_time, {_CACHE_KEY} AS cache_key FROM run_table),
ex AS (SELECT experiment AS pipeline, {_CACHE_KEY} AS cache_key,
              'store://models/' || run AS output_uri, end_time AS finished
       FROM run_table WHERE state = 'SUCCEEDED'),
best AS (SELECT r.pipeline, r.run, arg_max(e.output_uri, (e.finished, e.output_uri)) AS cached_output
         FROM req r JOIN ex e ON r.pipeline = e.pipeline AND r.cache_key = e.cache_key AND e.finished < r.start_time
         GROUP BY r.pipeline, r.run)
SELECT r.pipeline, r.run, r.start_time, r.cache_key, b.cached_output, b.cached_output IS NOT NULL AS hit
FROM req r LEFT JOIN best b USING (pipeline, run)""")
def q_join_step_cache(spark, sf):
    rt = run_table(spark, sf).withColumnRenamed("experiment", "pipeline")
    key = R.cache_key(F.col("template_version"), F.lit("train")).alias("cache_key")
    req = rt.select("pipeline", "run", "start_time", key)
    ex = rt.where(F.col("state") == "SUCCEEDED").select(
        "pipeline", key, F.concat(F.lit("store://models/"), F.col("run")).alias("output_uri"),
        F.col("end_time").alias("finished"))
    return R.step_cache(req, ex)


_REC = """anc(node, rel, depth) AS (
  SELECT {a}, {b}, 1 FROM edges
  UNION ALL
  SELECT a.node, e.{b}, a.depth + 1 FROM anc a JOIN edges e ON e.{a} = a.rel)"""


@query("lineage_ancestors", "WITH RECURSIVE " + EDGES + ",\n" + _REC.format(a="dst", b="src") + """
SELECT node, rel, CAST(min(depth) AS INTEGER) AS depth FROM anc GROUP BY node, rel""")
def q_lineage_ancestors(spark, sf):
    """What each node comes from."""
    return R.lineage_closure(edges(spark, sf), upstream=True)


@query("lineage_descendants", "WITH RECURSIVE " + EDGES + ",\n" + _REC.format(a="src", b="dst") + """
SELECT node, rel, CAST(min(depth) AS INTEGER) AS depth FROM anc GROUP BY node, rel""")
def q_lineage_descendants(spark, sf):
    """What came from each node."""
    return R.lineage_closure(edges(spark, sf), upstream=False)


LINEAGE_OF = ["nation:3", "customer:1"]        # the artifacts asked for (a parameter, as the caller passes them)


@query("lineage_artifact", "WITH RECURSIVE " + EDGES + ",\n" + _REC.format(a="src", b="dst") + """
SELECT node, rel, CAST(min(depth) AS INTEGER) AS depth FROM anc WHERE node IN ('nation:3', 'customer:1') GROUP BY node, rel""")
def q_lineage_artifact(spark, sf):
    """J10 for named artifacts: only their own closure is followed and written."""
    return R.lineage_closure(edges(spark, sf), upstream=False, artifacts=LINEAGE_OF)


_ATTEMPTS = """per_day AS (SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS batch, count_if(event_type = 'error') AS n_err FROM events GROUP BY 1),
attempts AS (
  SELECT batch, 1 AS attempt, CASE WHEN n_err % 3 = 0 THEN 500 ELSE 200 END AS status FROM per_day
  UNION ALL
  SELECT batch, 2, CASE WHEN day(batch) % 2 = 0 THEN 200 ELSE 500 END FROM per_day WHERE n_err % 3 = 0)"""


@query("join_batch_gate", "WITH " + _ATTEMPTS + """,
final AS (SELECT batch, arg_max(status, attempt) AS final_status, max(attempt) AS attempts FROM attempts GROUP BY batch)
SELECT p.batch, f.final_status, f.attempts, CASE WHEN f.final_status = 200 THEN 'RUN' ELSE 'FAILED' END AS downstream
FROM (SELECT batch FROM per_day) p LEFT JOIN final f USING (batch)""")
def q_join_batch_gate(spark, sf):
    ev = table(spark, sf, "events", "ts", "event_type")
    per_day = ev.groupBy(F.to_date("ts").alias("batch")).agg(F.count_if(F.col("event_type") == "error").alias("n_err"))
    a1 = per_day.select("batch", F.lit(1).alias("attempt"),
                        F.when(F.col("n_err") % 3 == 0, 500).otherwise(200).alias("status"))
    a2 = per_day.where(F.col("n_err") % 3 == 0).select(
        "batch", F.lit(2).alias("attempt"), F.when(F.dayofmonth("batch") % 2 == 0, 200).otherwise(500).alias("status"))
    return R.batch_gate(a1.unionByName(a2), per_day.select("batch"))
