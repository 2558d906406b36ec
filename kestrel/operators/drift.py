"""Drift monitoring.

Design for large inputs: features are unpivoted to a long ``(feature, v)`` form
so that every numeric feature shares the same two passes (range, then bin
counts); every step after the bin counts works on tables whose size is
features x bins (x snapshots), never on rows.  Aggregations use partial
(map-side) combine, so one hot entity or category does not end up in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.functions.scalars import round_half_away

from kestrel.fixed import DRIFT_THRESHOLD as DEFAULT_THRESHOLD
from kestrel.fixed import THRESHOLD_MAX, THRESHOLD_MIN, TOP_VALUES

N_BINS = 10          # our choice: equal-width bins over the union range
DIGITS = 9


# ---------------------------------------------------------------- long forms
def unpivot(df: DataFrame, cols: list[str], keys: list[str] | None = None, as_string: bool = False,
            name: str = "feature", value: str = "v") -> DataFrame:
    """(keys..., feature, v) for the given columns; nulls dropped."""
    keys = keys or []
    t = "string" if as_string else "double"
    arr = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast(t).alias(value)) for c in cols])
    return df.select(*keys, F.inline(arr)).where(F.col(value).isNotNull())


def sides(base: DataFrame, current: DataFrame, cols: list[str], as_string: bool = False) -> DataFrame:
    """(side, feature, v) with side 'base' / 'current'."""
    b = unpivot(base, cols, as_string=as_string).withColumn("side", F.lit("base"))
    c = unpivot(current, cols, as_string=as_string).withColumn("side", F.lit("current"))
    return b.unionByName(c)


# ---------------------------------------------------------------- D3 Jensen-Shannon
def bin_index(v, lo, hi, n_bins: int = N_BINS):
    """Equal-width bin of v in [lo, hi]; the top edge goes to the last bin; hi = lo -> bin 0."""
    width = (hi - lo) / F.lit(float(n_bins))
    return F.when(hi == lo, F.lit(0).cast("bigint")).otherwise(
        F.least(F.lit(n_bins - 1).cast("bigint"), F.floor((v - lo) / width).cast("bigint")))


def histograms(long: DataFrame, keys: list[str], n_bins: int = N_BINS) -> DataFrame:
    """Bin counts per (keys..., side, bin) over the union range of both sides.

    ``long`` has (keys..., side, v).  The range table has one row per key
    combination (features x pairs); the planner broadcasts it when its measured size allows."""
    ranges = long.groupBy(*keys).agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    binned = long.join(ranges, keys).select(
        *keys, "side", bin_index(F.col("v"), F.col("lo"), F.col("hi"), n_bins).alias("bin"))
    return binned.groupBy(*keys, "side", "bin").agg(F.count(F.lit(1)).alias("n"))


def paired_shares(counts: DataFrame, keys: list[str], item: str) -> DataFrame:
    """Shares of the base and current side per (keys..., item); absent -> 0."""
    tot = Window.partitionBy(*keys, "side")
    shares = counts.withColumn("share", F.col("n") / F.sum("n").over(tot))
    b = shares.where(F.col("side") == "base").select(*keys, item, F.col("share").alias("p"))
    c = shares.where(F.col("side") == "current").select(*keys, item, F.col("share").alias("q"))
    return (b.join(c, keys + [item], "full_outer")
             .select(*keys, item, F.coalesce("p", F.lit(0.0)).alias("p"), F.coalesce("q", F.lit(0.0)).alias("q")))


def kl_term(x, m):
    return F.when(x > 0, x * F.log(2.0, x / m)).otherwise(F.lit(0.0))


def js_from_shares(pq: DataFrame, keys: list[str]) -> DataFrame:
    """Jensen-Shannon divergence (log base 2, in [0, 1]) per key from paired shares.
    A side with no rows at all gives null."""
    m = (F.col("p") + F.col("q")) / 2
    return pq.groupBy(*keys).agg(
        F.when((F.sum("p") == 0) | (F.sum("q") == 0), F.lit(None).cast("double"))
         .otherwise(0.5 * F.sum(kl_term(F.col("p"), m)) + 0.5 * F.sum(kl_term(F.col("q"), m)))
         .alias("deviation"))


def chebyshev_from_shares(pq: DataFrame, keys: list[str]) -> DataFrame:
    """L-infinity distance of the shares per key."""
    return pq.groupBy(*keys).agg(
        F.when((F.sum("p") == 0) | (F.sum("q") == 0), F.lit(None).cast("double"))
         .otherwise(F.max(F.abs(F.col("p") - F.col("q")))).alias("deviation"))


def js_divergence(base: DataFrame, current: DataFrame, cols: list[str], n_bins: int = N_BINS) -> DataFrame:
    """D3: (feature, deviation) for numeric columns."""
    h = histograms(sides(base, current, cols), ["feature"], n_bins)
    return js_from_shares(paired_shares(h, ["feature"], "bin"), ["feature"])


def category_counts_long(base: DataFrame, current: DataFrame, cols: list[str]) -> DataFrame:
    return sides(base, current, cols, as_string=True).groupBy("feature", "side", "v").agg(
        F.count(F.lit(1)).alias("n"))


def chebyshev(base: DataFrame, current: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, deviation) = max |share_current - share_base| over categories."""
    return chebyshev_from_shares(paired_shares(category_counts_long(base, current, cols), ["feature"], "v"),
                                 ["feature"])


# ---------------------------------------------------------------- D1 / D2
def mean_shift(base: DataFrame, current: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, mean_base, std_base, mean_current, deviation = |Δmean| / std_base)."""
    s = sides(base, current, cols)
    st = s.groupBy("feature").agg(
        F.avg(F.when(F.col("side") == "base", F.col("v"))).alias("mean_base"),
        F.stddev_samp(F.when(F.col("side") == "base", F.col("v"))).alias("std_base"),
        F.avg(F.when(F.col("side") == "current", F.col("v"))).alias("mean_current"))
    return st.withColumn("deviation", F.abs(F.col("mean_current") - F.col("mean_base"))
                         / F.nullif(F.col("std_base"), F.lit(0.0)))


def new_categories(base: DataFrame, current: DataFrame, col: str) -> DataFrame:
    """Distinct values of ``col`` in ``current`` that never occur in ``base`` (anti join)."""
    return (current.select(col).where(F.col(col).isNotNull()).distinct()
            .join(base.select(col).distinct(), col, "left_anti"))


def new_category_drift(base: DataFrame, current: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, n_new, drift_detected = n_new > 0)."""
    s = sides(base, current, cols, as_string=True).select("feature", "side", "v").distinct()
    seen = s.where(F.col("side") == "base").select("feature", "v")
    new = s.where(F.col("side") == "current").select("feature", "v").join(seen, ["feature", "v"], "left_anti")
    feats = s.select("feature").distinct()
    n_new = new.groupBy("feature").agg(F.count(F.lit(1)).alias("n_new"))
    return (feats.join(n_new, "feature", "left")
                 .select("feature", F.coalesce("n_new", F.lit(0)).cast("bigint").alias("n_new"))
                 .withColumn("drift_detected", F.col("n_new") > 0))


# ---------------------------------------------------------------- J7 thresholds
def thresholds(spark, features: list[str], config: dict[str, float | None] | None = None) -> DataFrame:
    """(feature, threshold) — configured value or 0.3; a value outside [0, 1) fails the query."""
    config = config or {}
    rows = [(f, None if config.get(f) is None else float(config[f])) for f in features]
    cfg = spark.createDataFrame(rows, "feature string, thr double")
    thr = F.coalesce("thr", F.lit(DEFAULT_THRESHOLD))
    return cfg.select("feature", F.when((thr >= THRESHOLD_MIN) & (thr < THRESHOLD_MAX), thr)
                      .otherwise(F.raise_error(F.concat(F.lit("drift threshold must be in [0, 1): "),
                                                        F.col("feature")))).alias("threshold"))


def apply_thresholds(dev: DataFrame, thr: DataFrame) -> DataFrame:
    """Strict comparison: drift only when deviation > threshold (null deviation -> false)."""
    return (dev.join(F.broadcast(thr), "feature", "left")
               .withColumn("threshold", F.coalesce("threshold", F.lit(DEFAULT_THRESHOLD)))
               .withColumn("drift_detected", F.coalesce(F.col("deviation") > F.col("threshold"), F.lit(False))))


# ---------------------------------------------------------------- D5 report
def drift_report(base: DataFrame, current: DataFrame, numeric: list[str], categorical: list[str],
                 thr: DataFrame, n_bins: int = N_BINS) -> DataFrame:
    """(feature, metric, deviation, threshold, drift_detected)."""
    parts = []
    if numeric:
        parts.append(js_divergence(base, current, numeric, n_bins).withColumn("metric", F.lit("jensen_shannon")))
    if categorical:
        parts.append(chebyshev(base, current, categorical).withColumn("metric", F.lit("chebyshev")))
    dev = reduce(DataFrame.unionByName, parts)
    dev = dev.withColumn("deviation", round_half_away("deviation", DIGITS))
    return apply_thresholds(dev, thr).select("feature", "metric", "deviation", "threshold", "drift_detected")


def validate_anomalies(report: DataFrame) -> DataFrame:
    """(feature_name, anomaly_short_description, anomaly_long_description) of drifted features."""
    d = report.where(F.col("drift_detected"))
    return d.select(
        F.col("feature").alias("feature_name"),
        F.when(F.col("metric") == "jensen_shannon", "High approximate Jensen-Shannon divergence")
         .otherwise("High Linfty distance").alias("anomaly_short_description"),
        F.format_string("The %s between current and previous is %.6f (threshold %.2f)",
                        F.when(F.col("metric") == "jensen_shannon", "approximate Jensen-Shannon divergence")
                         .otherwise("Linfty distance"),
                        F.col("deviation"), F.col("threshold")).alias("anomaly_long_description"))


# ---------------------------------------------------------------- D7 monitor jobs over snapshots
def snapshot_pairs(snap: DataFrame, keys: list[str], ts: str = "snapshot_ts") -> DataFrame:
    """(keys..., snapshot_ts, base_snapshot_ts) — each snapshot with the previous one."""
    s = snap.select(*keys, ts).distinct()
    w = Window.partitionBy(*keys).orderBy(ts)
    return s.withColumn("base_snapshot_ts", F.lag(ts).over(w))


def pairwise_rows(df: DataFrame, pairs: DataFrame, keys: list[str], ts: str = "snapshot_ts") -> DataFrame:
    """Each row twice: as 'current' of its own snapshot's pair and as 'base' of the next one.
    ``pairs`` has one row per snapshot (and key); the planner broadcasts it when its measured size allows."""
    nxt = pairs.where(F.col("base_snapshot_ts").isNotNull()).select(
        *keys, F.col("base_snapshot_ts").alias(ts), F.col(ts).alias("pair_ts"))
    cur = df.withColumn("pair_ts", F.col(ts)).withColumn("side", F.lit("current"))
    base = df.join(nxt, keys + [ts]).withColumn("side", F.lit("base"))
    return cur.unionByName(base.select(cur.columns))


def monitor_jobs(snap: DataFrame, numeric: list[str], categorical: list[str], thr: DataFrame,
                 keys: list[str] | None = None, n_bins: int = N_BINS) -> DataFrame:
    """One job per snapshot (ordered by snapshot_ts within ``keys``), per feature: mean, std
    (numeric) and deviation against the previous snapshot; the first job has no base."""
    keys = keys or []
    pairs = snapshot_pairs(snap, keys)
    num = unpivot(snap, numeric, keys + ["snapshot_ts"])
    stats = num.groupBy(*keys, "snapshot_ts", "feature").agg(F.avg("v").alias("mean"),
                                                               F.stddev_samp("v").alias("std"))
    pk = keys + ["pair_ts", "feature"]
    devs = []
    if numeric:
        rows = pairwise_rows(num, pairs, keys)
        h = histograms(rows, pk, n_bins)
        devs.append(js_from_shares(paired_shares(h, pk, "bin"), pk).withColumn("metric", F.lit("jensen_shannon")))
    if categorical:
        cat = unpivot(snap, categorical, keys + ["snapshot_ts"], as_string=True)
        counts = (pairwise_rows(cat, pairs, keys).groupBy(*pk, "side", "v").agg(F.count(F.lit(1)).alias("n")))
        devs.append(chebyshev_from_shares(paired_shares(counts, pk, "v"), pk).withColumn("metric", F.lit("chebyshev")))
    dev = reduce(DataFrame.unionByName, devs).withColumnRenamed("pair_ts", "snapshot_ts")
    jobs = pairs.join(dev, keys + ["snapshot_ts"])
    # first job of each monitor: no pair -> no deviation rows; give it one row per feature
    first = pairs.where(F.col("base_snapshot_ts").isNull())
    first_rows = first.select(*keys, "snapshot_ts", "base_snapshot_ts",
                              F.explode(F.array(*[F.struct(F.lit(f).alias("feature"),
                                                           F.lit("jensen_shannon" if f in numeric else "chebyshev")
                                                           .alias("metric")) for f in numeric + categorical]))
                              .alias("fm"))
    first_rows = first_rows.select(*keys, "snapshot_ts", "base_snapshot_ts", "fm.feature", "fm.metric",
                                   F.lit(None).cast("double").alias("deviation"))
    later = jobs.where(F.col("base_snapshot_ts").isNotNull()).select(
        *keys, "snapshot_ts", "base_snapshot_ts", "feature", "metric", "deviation")
    allj = first_rows.unionByName(later).withColumn("deviation", round_half_away("deviation", DIGITS))
    out = apply_thresholds(allj, thr).join(stats, keys + ["snapshot_ts", "feature"], "left")
    if categorical:
        tv = top_values(unpivot(snap, categorical, keys + ["snapshot_ts"], as_string=True),
                        keys + ["snapshot_ts", "feature"])
        tv = tv.groupBy(*keys, "snapshot_ts", "feature").agg(      # at most TOP_VALUES rows per group
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "v"))), lambda x: x["v"]),
                         ",").alias("top_values"))
        out = out.join(tv, keys + ["snapshot_ts", "feature"], "left")
    else:
        out = out.withColumn("top_values", F.lit(None).cast("string"))
    return out.withColumn("job_id", F.concat_ws("-", *[F.col(k).cast("string") for k in keys],
                                                 F.date_format("snapshot_ts", "yyyyMMdd'T'HHmmss")))


def job_status(jobs: DataFrame, job_keys: list[str]) -> DataFrame:
    """Per job, any feature drifted -> 'drift detected' else 'no drift';
    a job without result rows -> 'running/no result'."""
    g = jobs.groupBy(*job_keys).agg(F.bool_or("drift_detected").alias("has_drift"),
                                    F.count("deviation").alias("n_results"))
    return g.withColumn("status", F.when(F.col("n_results") == 0, "running/no result")
                        .when(F.col("has_drift"), "drift detected").otherwise("no drift"))


def top_values(long_str: DataFrame, keys: list[str], k: int = TOP_VALUES) -> DataFrame:
    """The k most frequent values per (keys...), ties by value; partial top-k before the shuffle."""
    c = long_str.groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*keys).orderBy(F.desc("n"), F.asc("v"))
    return c.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k)


def latest_n(jobs: DataFrame, n: int, keys: list[str], ts: str = "snapshot_ts") -> DataFrame:
    """Rows of the n latest jobs per key."""
    w = Window.partitionBy(*keys).orderBy(F.desc(ts))
    return jobs.withColumn("recency", F.row_number().over(w).cast("bigint")).where(F.col("recency") <= n)
