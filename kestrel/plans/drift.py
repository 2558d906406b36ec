"""Drift queries (D1–D10, J5–J7, W3, W4, A21–A23, O2, O3) — baseline = first
half of January, current = second half; weekly snapshots for monitor jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.functions.scalars import round_half_away

from kestrel.operators import drift as D
from kestrel.operators.monitor import monitor_from_counts, schedule_jobs
from kestrel.operators.ml import stratified_split
from kestrel.plans.common import rounded
from kestrel.plans.oracle import FEATURES, PERIODS, SNAPSHOTS, with_
from kestrel.plans.registry import query
from kestrel.session import scratch_path
from kestrel.sources.derived import features, snapshots, split_periods

NUM = ["age", "income"]
CAT = ["category"]
CONFIG = {"age": 0.3, "income": 0.3, "category": None}   # category: default threshold


def _periods(spark, sf):
    return split_periods(features(spark, sf))


def _thr(spark):
    return D.thresholds(spark, NUM + CAT, CONFIG)


# ------------------------------------------------------------------ SQL text builders
def _sql_long(src: str, cols: list[str], side: str, as_string: bool = False, keys: str = "") -> str:
    t = "VARCHAR" if as_string else "DOUBLE"
    return "\n  UNION ALL ".join(
        f"SELECT {keys}{side} AS side, '{c}' AS feature, CAST({c} AS {t}) AS v FROM {src} WHERE {c} IS NOT NULL"
        for c in cols)


def _sql_js(long: str, keys: str) -> str:
    """CTEs rng/binned/cnt/sh/pq/js over a CTE named ``long`` with columns (keys, side, v)."""
    k = ", ".join(keys.split(",")) if keys else ""
    on = " AND ".join(f"b.{x.strip()} = c.{x.strip()}" for x in keys.split(","))
    co = ", ".join(f"coalesce(b.{x.strip()}, c.{x.strip()}) AS {x.strip()}" for x in keys.split(","))
    return f"""
rng AS (SELECT {k}, min(v) AS lo, max(v) AS hi FROM {long} GROUP BY {k}),
binned AS (SELECT {", ".join("l." + x.strip() for x in keys.split(","))}, l.side,
                  CASE WHEN r.hi = r.lo THEN 0
                       ELSE least(9, CAST(floor((l.v - r.lo) / ((r.hi - r.lo) / 10.0e0)) AS BIGINT)) END AS bin
           FROM {long} l JOIN rng r USING ({k})),
cnt AS (SELECT {k}, side, bin, count(*) AS n FROM binned GROUP BY {k}, side, bin),
sh AS (SELECT {k}, side, bin, n / sum(n) OVER (PARTITION BY {k}, side) AS share FROM cnt),
pq AS (SELECT {co}, coalesce(b.bin, c.bin) AS bin,
              coalesce(b.share, 0.0e0) AS p, coalesce(c.share, 0.0e0) AS q
       FROM (SELECT * FROM sh WHERE side = 'base') b
       FULL OUTER JOIN (SELECT * FROM sh WHERE side = 'current') c ON {on} AND b.bin = c.bin),
js AS (SELECT {k}, 'jensen_shannon' AS metric,
              CASE WHEN sum(p) = 0 OR sum(q) = 0 THEN NULL ELSE
              0.5e0 * sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0.0e0 END)
            + 0.5e0 * sum(CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0.0e0 END) END AS deviation
       FROM pq GROUP BY {k})"""


def _sql_cheb(long: str, keys: str) -> str:
    k = keys
    on = " AND ".join(f"b.{x.strip()} = c.{x.strip()}" for x in keys.split(","))
    co = ", ".join(f"coalesce(b.{x.strip()}, c.{x.strip()}) AS {x.strip()}" for x in keys.split(","))
    return f"""
ccnt AS (SELECT {k}, side, v, count(*) AS n FROM {long} GROUP BY {k}, side, v),
csh AS (SELECT {k}, side, v, n / sum(n) OVER (PARTITION BY {k}, side) AS share FROM ccnt),
cpq AS (SELECT {co}, coalesce(b.share, 0.0e0) AS p, coalesce(c.share, 0.0e0) AS q
        FROM (SELECT * FROM csh WHERE side = 'base') b
        FULL OUTER JOIN (SELECT * FROM csh WHERE side = 'current') c ON {on} AND b.v = c.v),
cheb AS (SELECT {k}, 'chebyshev' AS metric,
                CASE WHEN sum(p) = 0 OR sum(q) = 0 THEN NULL ELSE max(abs(p - q)) END AS deviation
         FROM cpq GROUP BY {k})"""


_SIDE = "CASE WHEN period = 'baseline' THEN 'base' ELSE 'current' END"
THR_SQL = "thr AS (SELECT * FROM (VALUES ('age', 0.3e0), ('income', 0.3e0), ('category', 0.3e0)) AS t(feature, threshold))"



def _report_ctes(thr_sql: str = THR_SQL) -> str:
    return with_(PERIODS) + f""",
nlong AS ({_sql_long('periods', NUM, _SIDE)}),
clong AS ({_sql_long('periods', CAT, _SIDE, as_string=True)}),
{thr_sql},""" + _sql_js("nlong", "feature") + "," + _sql_cheb("clong", "feature") + """,
report AS (
  SELECT d.feature, d.metric, round(d.deviation, 9) AS deviation, t.threshold,
         coalesce(round(d.deviation, 9) > t.threshold, false) AS drift_detected
  FROM (SELECT * FROM js UNION ALL SELECT * FROM cheb) d JOIN thr t USING (feature))
"""


REPORT_CTES = _report_ctes()
ONE_THRESHOLD = 0.003
_ONE_THR_SQL = ("thr AS (SELECT * FROM (VALUES ('age', 0.003e0), ('income', 0.003e0), ('category', 0.003e0)) "
                "AS t(feature, threshold))")


# ------------------------------------------------------------------ D5 flagship
@query("drift_report", REPORT_CTES + "SELECT * FROM report")
def q_drift_report(spark, sf):
    base, cur = _periods(spark, sf)
    return D.drift_report(base, cur, NUM, CAT, _thr(spark))


@query("drift_js_numeric", REPORT_CTES + "SELECT feature, round(deviation, 9) AS deviation FROM js")
def q_drift_js_numeric(spark, sf):
    base, cur = _periods(spark, sf)
    return D.js_divergence(base, cur, NUM).select("feature", round_half_away("deviation", 9).alias("deviation"))


@query("drift_chebyshev_categorical", REPORT_CTES + "SELECT feature, round(deviation, 9) AS deviation FROM cheb")
def q_drift_chebyshev(spark, sf):
    base, cur = _periods(spark, sf)
    return D.chebyshev(base, cur, CAT).select("feature", round_half_away("deviation", 9).alias("deviation"))


@query("join_snapshot_pair", REPORT_CTES + "SELECT feature, bin, round(p, 9) AS p, round(q, 9) AS q FROM pq")
def q_join_snapshot_pair(spark, sf):
    base, cur = _periods(spark, sf)
    h = D.histograms(D.sides(base, cur, NUM), ["feature"])
    pq = D.paired_shares(h, ["feature"], "bin")
    return pq.select("feature", "bin", round_half_away("p", 9).alias("p"), round_half_away("q", 9).alias("q"))


@query("validate_anomalies", _report_ctes(_ONE_THR_SQL) + """
SELECT feature AS feature_name,
       CASE WHEN metric = 'jensen_shannon' THEN 'High approximate Jensen-Shannon divergence'
            ELSE 'High Linfty distance' END AS anomaly_short_description,
       printf('The %s between current and previous is %.6f (threshold %.2f)',
              CASE WHEN metric = 'jensen_shannon' THEN 'approximate Jensen-Shannon divergence'
                   ELSE 'Linfty distance' END, deviation, threshold) AS anomaly_long_description
FROM report WHERE drift_detected""")
def q_validate_anomalies(spark, sf):
    base, cur = _periods(spark, sf)
    # one threshold for every feature, passed like the reference's drift_threshold argument
    thr = D.thresholds(spark, NUM + CAT, {c: ONE_THRESHOLD for c in NUM + CAT})
    return D.validate_anomalies(D.drift_report(base, cur, NUM, CAT, thr))


# ------------------------------------------------------------------ D1, D2, J5, J7
@query("drift_mean_shift", with_(PERIODS) + f""",
nlong AS ({_sql_long('periods', NUM, _SIDE)}),
{THR_SQL},
st AS (SELECT feature, avg(v) FILTER (WHERE side = 'base') AS mean_base,
              stddev_samp(v) FILTER (WHERE side = 'base') AS std_base,
              avg(v) FILTER (WHERE side = 'current') AS mean_current FROM nlong GROUP BY feature)
SELECT feature, round(mean_base, 6) AS mean_base, round(std_base, 6) AS std_base,
       round(mean_current, 6) AS mean_current,
       round(abs(mean_current - mean_base) / nullif(std_base, 0), 6) AS deviation, threshold,
       coalesce(abs(mean_current - mean_base) / nullif(std_base, 0) > threshold, false) AS drift_detected
FROM st JOIN thr USING (feature)""")
def q_drift_mean_shift(spark, sf):
    base, cur = _periods(spark, sf)
    return rounded(D.apply_thresholds(D.mean_shift(base, cur, NUM), _thr(spark)))


_BANDS = with_(PERIODS) + """,
banded AS (SELECT *, CAST(floor(income) AS BIGINT) AS income_band FROM periods)"""


@query("join_new_categories", _BANDS + """
SELECT DISTINCT c.income_band FROM banded c
WHERE c.period = 'current' AND c.income_band IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM banded b WHERE b.period = 'baseline' AND b.income_band = c.income_band)""")
def q_join_new_categories(spark, sf):
    base, cur = _periods(spark, sf)
    band = F.floor("income").cast("bigint").alias("income_band")
    return D.new_categories(base.select(band), cur.select(band), "income_band")


@query("drift_new_category", _BANDS + """,
long AS (SELECT DISTINCT 'income_band' AS feature, period, CAST(income_band AS VARCHAR) AS v FROM banded
         UNION ALL SELECT DISTINCT 'category', period, category FROM banded),
nw AS (SELECT feature, count(*) AS n FROM long c WHERE period = 'current'
       AND NOT EXISTS (SELECT 1 FROM long b WHERE b.period = 'baseline' AND b.feature = c.feature AND b.v = c.v)
       GROUP BY feature)
SELECT f.feature, CAST(coalesce(nw.n, 0) AS BIGINT) AS n_new, coalesce(nw.n, 0) > 0 AS drift_detected
FROM (SELECT DISTINCT feature FROM long) f LEFT JOIN nw USING (feature)""")
def q_drift_new_category(spark, sf):
    base, cur = _periods(spark, sf)
    cols = [F.floor("income").cast("bigint").alias("income_band"), F.col("category")]
    return D.new_category_drift(base.select(*cols), cur.select(*cols), ["income_band", "category"])


@query("join_threshold_config", with_(FEATURES) + """,
present AS (SELECT 'age' AS feature, count(age) AS n_values FROM features
            UNION ALL SELECT 'income', count(income) FROM features
            UNION ALL SELECT 'category', count(category) FROM features)
SELECT p.feature, p.n_values, coalesce(t.threshold, 0.3e0) AS threshold
FROM present p LEFT JOIN (VALUES ('age', 0.3e0), ('income', 0.3e0)) AS t(feature, threshold) USING (feature)""")
def q_join_threshold_config(spark, sf):
    """The monitored features found in the data, left-joined to the threshold config
    (a row per feature: broadcast), default 0.3 where the config has none."""
    f = features(spark, sf)
    long = D.unpivot(f, NUM + CAT, as_string=True)
    present = long.groupBy("feature").agg(F.count(F.lit(1)).alias("n_values"))
    thr = D.thresholds(spark, NUM + CAT, CONFIG)
    return present.join(F.broadcast(thr), "feature", "left").select(
        "feature", "n_values", F.coalesce("threshold", F.lit(D.DEFAULT_THRESHOLD)).alias("threshold"))


# ------------------------------------------------------------------ D7 monitor jobs, W3, W4, A21-A23
def _jobs(spark, sf):
    jobs = monitor_from_counts(features(spark, sf), "feature_timestamp", [("weekly", "week", NUM + CAT)], NUM, CAT, _thr(spark))
    return jobs.withColumn("job_id", F.date_format("snapshot_ts", "yyyyMMdd'T'HHmmss"))


def _sql_jobs() -> str:
    """Monitor jobs over weekly snapshots: each snapshot versus the previous one."""
    pair_rows = """
pairs AS (SELECT snapshot_ts, lag(snapshot_ts) OVER (ORDER BY snapshot_ts) AS base_snapshot_ts
          FROM (SELECT DISTINCT snapshot_ts FROM snapshots)),
nx AS (SELECT base_snapshot_ts AS snapshot_ts, snapshot_ts AS pair_ts FROM pairs WHERE base_snapshot_ts IS NOT NULL),
prow AS (SELECT s.*, s.snapshot_ts AS pair_ts, 'current' AS side FROM snapshots s
         UNION ALL SELECT s.*, nx.pair_ts, 'base' AS side FROM snapshots s JOIN nx USING (snapshot_ts)),"""
    nl = " UNION ALL ".join(f"SELECT pair_ts, side, '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM prow "
                            f"WHERE {c} IS NOT NULL" for c in NUM)
    cl = " UNION ALL ".join(f"SELECT pair_ts, side, '{c}' AS feature, CAST({c} AS VARCHAR) AS v FROM prow "
                            f"WHERE {c} IS NOT NULL" for c in CAT)
    stats = " UNION ALL ".join(f"SELECT snapshot_ts, '{c}' AS feature, avg({c}) AS mean, stddev_samp({c}) AS std "
                               f"FROM snapshots WHERE {c} IS NOT NULL GROUP BY snapshot_ts" for c in NUM)
    firsts = " UNION ALL ".join(
        f"SELECT snapshot_ts, base_snapshot_ts, '{c}' AS feature, "
        f"'{'jensen_shannon' if c in NUM else 'chebyshev'}' AS metric, CAST(NULL AS DOUBLE) AS deviation "
        f"FROM pairs WHERE base_snapshot_ts IS NULL" for c in NUM + CAT)
    return with_(SNAPSHOTS) + "," + pair_rows + f"""
nlong AS ({nl}),
clong AS ({cl}),
{THR_SQL},""" + _sql_js("nlong", "pair_ts, feature") + "," + _sql_cheb("clong", "pair_ts, feature") + f""",
devs AS (SELECT pair_ts AS snapshot_ts, feature, metric, deviation FROM js
         UNION ALL SELECT pair_ts, feature, metric, deviation FROM cheb),
alljobs AS (SELECT p.snapshot_ts, p.base_snapshot_ts, d.feature, d.metric, d.deviation
            FROM pairs p JOIN devs d USING (snapshot_ts) WHERE p.base_snapshot_ts IS NOT NULL
            UNION ALL {firsts}),
stats AS ({stats}),
tvl AS (SELECT snapshot_ts, 'category' AS feature, category AS v, count(*) AS n FROM snapshots
        WHERE category IS NOT NULL GROUP BY ALL),
tv AS (SELECT snapshot_ts, feature, string_agg(v, ',' ORDER BY n DESC, v) AS top_values FROM (
         SELECT *, row_number() OVER (PARTITION BY snapshot_ts, feature ORDER BY n DESC, v) AS rk FROM tvl)
       WHERE rk <= 3 GROUP BY ALL),
jobs AS (
  SELECT strftime(a.snapshot_ts, '%Y%m%dT%H%M%S') AS job_id, a.snapshot_ts, a.base_snapshot_ts, a.feature,
         a.metric, round(a.deviation, 9) AS deviation, t.threshold,
         coalesce(round(a.deviation, 9) > t.threshold, false) AS drift_detected,
         round(s.mean, 6) AS mean, round(s.std, 6) AS std, tv.top_values
  FROM alljobs a JOIN thr t USING (feature) LEFT JOIN stats s USING (snapshot_ts, feature)
  LEFT JOIN tv USING (snapshot_ts, feature))
"""


JOBS_SQL = _sql_jobs()
_JOB_COLS = ["job_id", "snapshot_ts", "base_snapshot_ts", "feature", "metric", "deviation", "threshold",
             "drift_detected", "mean", "std", "top_values"]
_JOB_SCHEMA = ("snapshot_ts timestamp_ntz, base_snapshot_ts timestamp_ntz, feature string, metric string, "
               "deviation double, threshold double, drift_detected boolean, mean double, std double, "
               "top_values string, job_id string")


@query("monitor_run", JOBS_SQL + "SELECT * FROM jobs")
def q_monitor_run(spark, sf):
    """Job rows of every snapshot appended to the jobs table (one partition per job id,
    so re-running a job replaces it), read back."""
    path = scratch_path(spark, "jobs")
    jobs = rounded(_jobs(spark, sf).select(*_JOB_COLS))
    for _ in range(2):                      # the second run is a retry: same rows, no duplicates
        (jobs.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("job_id").parquet(path))
    return spark.read.schema(_JOB_SCHEMA).parquet(path).select(*_JOB_COLS)


def _jobs_table(spark, sf):
    """The jobs table that a monitor run has written, for the queries that read jobs."""
    path = scratch_path(spark, "jobs-table")
    _jobs(spark, sf).select(*_JOB_COLS).write.partitionBy("job_id").parquet(path)
    return spark.read.schema(_JOB_SCHEMA).parquet(path).select(*_JOB_COLS)


@query("previous_snapshot", with_(SNAPSHOTS) + """
SELECT snapshot_ts, lag(snapshot_ts) OVER (ORDER BY snapshot_ts) AS base_snapshot_ts
FROM (SELECT DISTINCT snapshot_ts FROM snapshots)""")
def q_previous_snapshot(spark, sf):
    return D.snapshot_pairs(snapshots(spark, sf), [])


@query("latest_n_stats", JOBS_SQL + """
SELECT feature, snapshot_ts, mean, std, deviation, recency FROM (
  SELECT *, row_number() OVER (PARTITION BY feature ORDER BY snapshot_ts DESC) AS recency FROM jobs)
WHERE recency <= 3""")
def q_latest_n_stats(spark, sf):
    j = rounded(_jobs_table(spark, sf))
    return D.latest_n(j, 3, ["feature"]).select("feature", "snapshot_ts", "mean", "std", "deviation", "recency")


@query("job_has_drift", JOBS_SQL + """
SELECT job_id, bool_or(drift_detected) AS has_drift, count(deviation) AS n_results,
       CASE WHEN count(deviation) = 0 THEN 'running/no result'
            WHEN bool_or(drift_detected) THEN 'drift detected' ELSE 'no drift' END AS status
FROM jobs GROUP BY job_id""")
def q_job_has_drift(spark, sf):
    return D.job_status(_jobs_table(spark, sf), ["job_id"])


@query("list_jobs_limit", JOBS_SQL + """
SELECT job_id, snapshot_ts, status FROM (
  SELECT job_id, max(snapshot_ts) AS snapshot_ts,
         CASE WHEN count(deviation) = 0 THEN 'running/no result'
              WHEN bool_or(drift_detected) THEN 'drift detected' ELSE 'no drift' END AS status
  FROM jobs GROUP BY job_id) ORDER BY snapshot_ts DESC, job_id LIMIT 10""")
def q_list_jobs_limit(spark, sf):
    j = _jobs_table(spark, sf)
    st = D.job_status(j, ["job_id", "snapshot_ts"])
    return st.orderBy(F.desc("snapshot_ts"), "job_id").limit(10).select("job_id", "snapshot_ts", "status")


DETAIL_JOB = "20240122T000000"     # the job asked for (a parameter, as in the reference call)


@query("job_detail", JOBS_SQL + f"""
SELECT * FROM jobs WHERE job_id = '{DETAIL_JOB}'""")
def q_job_detail(spark, sf):
    """O3: one job by id with per-feature drift and statistics."""
    return rounded(_jobs_table(spark, sf).where(F.col("job_id") == DETAIL_JOB))


@query("feature_stats_numeric", with_(SNAPSHOTS) + """
SELECT snapshot_ts, 'age' AS feature, round(avg(age), 6) AS mean, round(stddev_samp(age), 6) AS std
FROM snapshots GROUP BY snapshot_ts
UNION ALL SELECT snapshot_ts, 'income', round(avg(income), 6), round(stddev_samp(income), 6)
FROM snapshots GROUP BY snapshot_ts""")
def q_feature_stats_numeric(spark, sf):
    s = D.unpivot(snapshots(spark, sf), NUM, ["snapshot_ts"])
    return rounded(s.groupBy("snapshot_ts", "feature").agg(F.avg("v").alias("mean"),
                                                            F.stddev_samp("v").alias("std")))


@query("feature_top_values", with_(SNAPSHOTS) + """,
long AS (SELECT snapshot_ts, 'category' AS feature, category AS v FROM snapshots WHERE category IS NOT NULL
         UNION ALL SELECT snapshot_ts, 'age', CAST(age AS VARCHAR) FROM snapshots WHERE age IS NOT NULL),
c AS (SELECT snapshot_ts, feature, v, count(*) AS n FROM long GROUP BY ALL)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY snapshot_ts, feature ORDER BY n DESC, v) AS rank FROM c)
WHERE rank <= 3""")
def q_feature_top_values(spark, sf):
    s = D.unpivot(snapshots(spark, sf), ["category", "age"], ["snapshot_ts"], as_string=True)
    return D.top_values(s, ["snapshot_ts", "feature"], 3)


# ------------------------------------------------------------------ D8, D9, D10
@query("drift_gate_append", with_(PERIODS) + f""",
nlong AS ({_sql_long('periods', NUM, _SIDE)}),
{THR_SQL},
st AS (SELECT feature, avg(v) FILTER (WHERE side = 'base') AS mb, stddev_samp(v) FILTER (WHERE side = 'base') AS sb,
              avg(v) FILTER (WHERE side = 'current') AS mc FROM nlong GROUP BY feature),
ms AS (SELECT feature, 'mean_shift' AS check, round(abs(mc - mb) / nullif(sb, 0), 6) AS deviation,
              coalesce(abs(mc - mb) / nullif(sb, 0) > threshold, false) AS drift_detected FROM st JOIN thr USING (feature)),
cats AS (SELECT DISTINCT period, category FROM periods WHERE category IS NOT NULL),
nc AS (SELECT 'category' AS feature, 'new_category' AS check,
              CAST(count(*) AS DOUBLE) AS deviation, count(*) > 0 AS drift_detected
       FROM cats c WHERE period = 'current'
        AND NOT EXISTS (SELECT 1 FROM cats b WHERE b.period = 'baseline' AND b.category = c.category))
SELECT *, false AS written FROM (SELECT * FROM ms UNION ALL SELECT * FROM nc)""")
def q_drift_gate_append(spark, sf):
    from kestrel.operators.monitor import drift_gate
    base, cur = _periods(spark, sf)
    return drift_gate(base, cur, NUM, CAT, _thr(spark), dry_run=True)


@query("drift_gate_write", with_(PERIODS) + """
SELECT count(*) AS n, count(*) FILTER (WHERE period = 'current') AS n_appended, count(DISTINCT category) AS n_categories,
       round(avg(income), 6) AS mean_income, true AS written FROM periods WHERE period IN ('baseline', 'current')""")
def q_drift_gate_write(spark, sf):
    """D8 in write mode: the batch is appended behind the gate (a retry replaces it), and the
    table is profiled again."""
    from kestrel.operators.monitor import drift_gate
    base, cur = _periods(spark, sf)
    path = scratch_path(spark, "gate")
    base.select(*NUM, *CAT).write.parquet(f"{path}/batch_id=stored")
    for _ in range(2):
        report = drift_gate(base, cur, NUM, CAT, _thr(spark), dry_run=False, sink_path=path, batch_id="current")
    t = spark.read.parquet(path)
    done = report.agg(F.min("written")).scalar()
    return rounded(t.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("batch_id") == "current").alias("n_appended"),
                         F.count_distinct("category").alias("n_categories"), F.avg("income").alias("mean_income"))
                   .withColumn("written", done))


@query("training_serving_skew", with_(FEATURES) + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY md5('42:' || entity_id || ':' || CAST(epoch_us(feature_timestamp) AS VARCHAR))) AS rk,
                  count(*) OVER (PARTITION BY category) AS n
           FROM features WHERE feature_timestamp < TIMESTAMP '2024-01-16 00:00:00'),
periods AS (SELECT entity_id, age, income, category, feature_timestamp, 'baseline' AS period FROM ranked WHERE rk > ceil(0.2e0 * n)
            UNION ALL SELECT *, 'current' FROM features WHERE feature_timestamp >= TIMESTAMP '2024-01-16 00:00:00'),
nlong AS (""" + _sql_long('periods', NUM, _SIDE) + """),
clong AS (""" + _sql_long('periods', CAT, _SIDE, as_string=True) + f"""),
{THR_SQL},""" + _sql_js("nlong", "feature") + "," + _sql_cheb("clong", "feature") + """
SELECT d.feature, d.metric, round(d.deviation, 9) AS deviation, t.threshold,
       coalesce(round(d.deviation, 9) > t.threshold, false) AS drift_detected
FROM (SELECT * FROM js UNION ALL SELECT * FROM cheb) d JOIN thr t USING (feature)""")
def q_training_serving_skew(spark, sf):
    f = features(spark, sf)
    split = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    first = f.where(F.col("feature_timestamp") < split)
    key = F.concat_ws(":", F.col("entity_id"), F.unix_micros(F.col("feature_timestamp").cast("timestamp")).cast("string"))
    train, _test = stratified_split(first, "category", 0.2, key, seed=42)
    serving = f.where(F.col("feature_timestamp") >= split)
    return D.drift_report(train, serving, NUM, CAT, _thr(spark))


MONITORS = [("m_daily", "day", NUM), ("m_weekly", "week", CAT)]


@query("monitor_schedule_fanout", with_(FEATURES) + """,
cfg AS (SELECT * FROM (VALUES ('m_daily', 'day'), ('m_weekly', 'week')) AS t(monitor, cadence)),
snap AS (SELECT c.monitor, date_trunc(c.cadence, f.feature_timestamp) AS snapshot_ts, f.*
         FROM features f CROSS JOIN cfg c),
d AS (SELECT monitor, snapshot_ts, 'age' AS feature, avg(age) AS mean, count(age) AS n FROM snap WHERE monitor = 'm_daily' GROUP BY ALL
      UNION ALL SELECT monitor, snapshot_ts, 'income', avg(income), count(income) FROM snap WHERE monitor = 'm_daily' GROUP BY ALL
      UNION ALL SELECT monitor, snapshot_ts, 'category', NULL, count(category) FROM snap WHERE monitor = 'm_weekly' GROUP BY ALL)
SELECT monitor, snapshot_ts, feature, round(mean, 6) AS mean, n,
       lag(snapshot_ts) OVER (PARTITION BY monitor, feature ORDER BY snapshot_ts) AS base_snapshot_ts
FROM d""")
def q_monitor_schedule_fanout(spark, sf):
    from kestrel.operators.monitor import schedule_fanout
    return rounded(schedule_fanout(features(spark, sf), "feature_timestamp", MONITORS))


def _sql_fanout_jobs() -> str:
    """Per-monitor monitor jobs (m_daily: age, income by day; m_weekly: category by week)."""
    snaps = """snapshots AS (
  SELECT 'm_daily' AS monitor, date_trunc('day', feature_timestamp) AS snapshot_ts, age, income,
         CAST(NULL AS VARCHAR) AS category FROM features
  UNION ALL
  SELECT 'm_weekly', date_trunc('week', feature_timestamp), NULL, NULL, category FROM features),
pairs AS (SELECT monitor, snapshot_ts, lag(snapshot_ts) OVER (PARTITION BY monitor ORDER BY snapshot_ts) AS base_snapshot_ts
          FROM (SELECT DISTINCT monitor, snapshot_ts FROM snapshots)),
nx AS (SELECT monitor, base_snapshot_ts AS snapshot_ts, snapshot_ts AS pair_ts FROM pairs WHERE base_snapshot_ts IS NOT NULL),
prow AS (SELECT s.*, s.snapshot_ts AS pair_ts, 'current' AS side FROM snapshots s
         UNION ALL SELECT s.*, nx.pair_ts, 'base' AS side FROM snapshots s JOIN nx USING (monitor, snapshot_ts)),"""
    nl = " UNION ALL ".join(f"SELECT monitor, pair_ts, side, '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM prow "
                            f"WHERE {c} IS NOT NULL" for c in NUM)
    cl = " UNION ALL ".join(f"SELECT monitor, pair_ts, side, '{c}' AS feature, CAST({c} AS VARCHAR) AS v FROM prow "
                            f"WHERE {c} IS NOT NULL" for c in CAT)
    stats = " UNION ALL ".join(f"SELECT monitor, snapshot_ts, '{c}' AS feature, avg({c}) AS mean, "
                               f"stddev_samp({c}) AS std FROM snapshots WHERE {c} IS NOT NULL GROUP BY ALL"
                               for c in NUM)
    return with_(FEATURES) + ",\n" + snaps + f"""
nlong AS ({nl}),
clong AS ({cl}),
{THR_SQL},""" + _sql_js("nlong", "monitor, pair_ts, feature") + "," + _sql_cheb("clong", "monitor, pair_ts, feature") + f""",
devs AS (SELECT monitor, pair_ts AS snapshot_ts, feature, metric, deviation FROM js
         UNION ALL SELECT monitor, pair_ts, feature, metric, deviation FROM cheb),
cfg AS (SELECT * FROM (VALUES ('m_daily', 'age', 'jensen_shannon'), ('m_daily', 'income', 'jensen_shannon'),
                              ('m_weekly', 'category', 'chebyshev')) AS t(monitor, feature, metric)),
alljobs AS (SELECT p.monitor, p.snapshot_ts, p.base_snapshot_ts, d.feature, d.metric, d.deviation
            FROM pairs p JOIN devs d USING (monitor, snapshot_ts) WHERE p.base_snapshot_ts IS NOT NULL
            UNION ALL
            SELECT p.monitor, p.snapshot_ts, p.base_snapshot_ts, c.feature, c.metric, CAST(NULL AS DOUBLE)
            FROM pairs p JOIN cfg c USING (monitor) WHERE p.base_snapshot_ts IS NULL),
stats AS ({stats}),
tvl AS (SELECT monitor, snapshot_ts, 'category' AS feature, category AS v, count(*) AS n FROM snapshots
        WHERE category IS NOT NULL GROUP BY ALL),
tv AS (SELECT monitor, snapshot_ts, feature, string_agg(v, ',' ORDER BY n DESC, v) AS top_values FROM (
         SELECT *, row_number() OVER (PARTITION BY monitor, snapshot_ts, feature ORDER BY n DESC, v) AS rk FROM tvl)
       WHERE rk <= 3 GROUP BY ALL)
SELECT a.monitor || '-' || strftime(a.snapshot_ts, '%Y%m%dT%H%M%S') AS job_id, a.monitor, a.snapshot_ts,
       a.base_snapshot_ts, a.feature, a.metric, round(a.deviation, 9) AS deviation, t.threshold,
       coalesce(round(a.deviation, 9) > t.threshold, false) AS drift_detected,
       round(s.mean, 6) AS mean, round(s.std, 6) AS std, tv.top_values
FROM alljobs a JOIN cfg USING (monitor, feature) JOIN thr t USING (feature)
LEFT JOIN stats s USING (monitor, snapshot_ts, feature) LEFT JOIN tv USING (monitor, snapshot_ts, feature)
"""


@query("monitor_schedule_jobs", _sql_fanout_jobs())
def q_monitor_schedule_jobs(spark, sf):
    """D10 + D7: a daily monitor on age and income and a weekly one on category, each
    running its monitor jobs over its own snapshots of the same feature table."""
    jobs = schedule_jobs(features(spark, sf), "feature_timestamp", MONITORS, NUM, CAT, _thr(spark))
    return rounded(jobs.select("job_id", "monitor", *[c for c in _JOB_COLS if c != "job_id"]))
