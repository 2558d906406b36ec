"""Monitor orchestration as DataFrame plans: drift gate on a candidate batch
and several monitors with different cadences over one feature table (D10)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.fixed import TOP_VALUES
from kestrel.functions.scalars import round_half_away
from kestrel.operators import drift as D
from kestrel.session import scratch_path


def drift_gate(stored: DataFrame, candidate: DataFrame, numeric: list[str], categorical: list[str],
               thr: DataFrame, dry_run: bool = True, sink_path: str | None = None,
               batch_id: str | None = None) -> DataFrame:
    """Mean-shift (D1) and new-category (D2) checks of a candidate batch against
    the stored table.  Dry run reports only; otherwise the batch is appended (K3)
    to ``sink_path`` and the report says so; with ``batch_id`` a rerun replaces that batch."""
    ms = D.apply_thresholds(D.mean_shift(stored, candidate, numeric), thr).select(
        "feature", F.lit("mean_shift").alias("check"), round_half_away("deviation", 6).alias("deviation"),
        "drift_detected")
    nc = D.new_category_drift(stored, candidate, categorical).select(
        "feature", F.lit("new_category").alias("check"), F.col("n_new").cast("double").alias("deviation"),
        "drift_detected")
    report = ms.unionByName(nc)
    written = False
    if not dry_run:
        if not sink_path:
            raise ValueError("sink_path is required when dry_run is False")
        if batch_id is None:
            candidate.write.mode("append").parquet(sink_path)
        else:
            (candidate.write.mode("overwrite").option("partitionOverwriteMode", "static")
             .parquet(f"{sink_path.rstrip('/')}/batch_id={batch_id}"))
        written = True
    return report.withColumn("written", F.lit(written))


def schedule_fanout(df: DataFrame, ts: str, monitors: list[tuple[str, str, list[str]]]) -> DataFrame:
    """For each (monitor, cadence, features): snapshots by date_trunc(cadence),
    per snapshot and feature the mean (numeric) and count, and the previous snapshot."""
    parts = []
    for name, cadence, feats in monitors:
        snap = df.withColumn("snapshot_ts", F.date_trunc(cadence, ts).cast("timestamp_ntz"))
        num = [c for c in feats if c in {f.name for f in df.schema.fields
                                         if f.dataType.typeName() in ("double", "long", "integer", "float")}]
        long = snap.select("snapshot_ts", F.inline(F.array(*[
            F.struct(F.lit(c).alias("feature"),
                     (F.col(c).cast("double") if c in num else F.lit(None).cast("double")).alias("v"),
                     F.col(c).isNotNull().alias("present")) for c in feats])))
        g = long.groupBy("snapshot_ts", "feature").agg(
            F.avg("v").alias("mean"), F.count(F.when(F.col("present"), 1)).alias("n"))
        parts.append(g.withColumn("monitor", F.lit(name)))
    allm = reduce(DataFrame.unionByName, parts)
    w = Window.partitionBy("monitor", "feature").orderBy("snapshot_ts")
    return allm.withColumn("base_snapshot_ts", F.lag("snapshot_ts").over(w)).select(
        "monitor", "snapshot_ts", "feature", "mean", "n", "base_snapshot_ts")


# ---------------------------------------------------------------- D7 / D10 from mergeable counts
#: Cadences from fine to coarse; counts are kept at "day" or finer, which rolls up to all coarser ones.
_CADENCES = ("minute", "hour", "day", "week", "month", "quarter", "year")


def mergeable_counts(df: DataFrame, ts: str, cadence: str, numeric: list[str], categorical: list[str]) -> DataFrame:
    """(at, feature, v, s, n): how often each value of each feature occurs in each period, from one scan; numbers in
    ``v``, categories in ``s``.  The feature '' counts rows, so a period whose values are all null is there, too."""
    none_v, none_s = F.lit(None).cast("double"), F.lit(None).cast("string")
    values = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v"), none_s.alias("s")) for c in numeric]
    values += [F.struct(F.lit(c).alias("feature"), none_v.alias("v"), F.col(c).cast("string").alias("s")) for c in categorical]
    values.append(F.struct(F.lit("").alias("feature"), none_v.alias("v"), none_s.alias("s")))
    return (df.select(F.date_trunc(cadence, ts).cast("timestamp_ntz").alias("at"), F.inline(F.array(*values)))
            .where("feature = '' OR v IS NOT NULL OR s IS NOT NULL")
            .groupBy("at", "feature", "v", "s").agg(F.count(F.lit(1)).alias("n")))


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def monitor_from_counts(df: DataFrame, ts: str, monitors: list[tuple[str, str, list[str]]], numeric: list[str],
                        categorical: list[str], thr: DataFrame, n_bins: int = D.N_BINS) -> DataFrame:
    """D7 for each of ``monitors`` (name, cadence, features watched): the drift of every snapshot against the one before,
    with mean, deviation and top values.

    The source is scanned once, into counts at the finest cadence that all monitors can be rolled up from
    (``mergeable_counts``).  These are read twice: for the range and mean of each (monitor, snapshot,
    feature), and, with these at hand, for the counts of bins and categories of each pair of snapshots.  What is left
    are two small tables, of snapshots and of bins, from which the jobs follow."""
    spark = df.sparkSession
    finest = min([c for _, c, _ in monitors] + ["day"], key=_CADENCES.index)
    feats = numeric + categorical
    counts = _written(mergeable_counts(df.select(ts, *feats), ts, finest, numeric, categorical), "monitor-counts")

    def rolled() -> DataFrame:
        tags = F.array(*[F.when(F.col("feature").isin(["", *watched]), F.struct(
            F.lit(name).alias("monitor"), F.date_trunc(cadence, "at").cast("timestamp_ntz").alias("snapshot_ts")))
            for name, cadence, watched in monitors])
        return counts.select("feature", "v", "s", "n", F.inline(F.filter(tags, lambda t: t.isNotNull())))
    per = rolled().groupBy("monitor", "snapshot_ts", "feature").agg(
        F.min("v").alias("lo"), F.max("v").alias("hi"), (F.sum(F.col("v") * F.col("n")) / F.sum(F.when(F.col("v").isNotNull(), F.col("n")))).alias("mean"))
    # one row for each snapshot, with the one before it and the figures of each feature
    snaps = per.groupBy("monitor", "snapshot_ts").agg(F.map_from_entries(F.collect_list(F.struct(
        "feature", F.struct("lo", "hi", "mean")))).alias("figures"))          # features watched
    w = Window.partitionBy("monitor").orderBy("snapshot_ts")
    snaps = _written(snaps.select("monitor", "snapshot_ts", "figures", F.lag("snapshot_ts").over(w).alias("base_snapshot_ts"),
                                  F.lag("figures").over(w).alias("base_figures"), F.lead("snapshot_ts").over(w).alias("next_ts"),
                                  F.lead("figures").over(w).alias("next_figures")), "monitor-snapshots")

    # every count as current of its own pair, and as base of the next one
    f = F.col("feature")
    own, before, after = F.col("figures")[f], F.col("base_figures")[f], F.col("next_figures")[f]

    def bucket(other):
        low, high = F.least(own["lo"], other["lo"]), F.greatest(own["hi"], other["hi"])
        return F.coalesce(F.col("s"), D.bin_index(F.col("v"), low, high, n_bins).cast("string"))
    zero = F.lit(0).cast("long")
    current = F.struct(F.col("snapshot_ts").alias("pair_ts"), bucket(before).alias("bucket"), zero.alias("nb"), F.col("n").alias("nc"),
                       (F.col("n") * (F.col("v") - own["mean"]) * (F.col("v") - own["mean"])).alias("m2"))
    base = F.when(F.col("next_ts").isNotNull(), F.struct(F.col("next_ts").alias("pair_ts"), bucket(after).alias("bucket"), F.col("n").alias("nb"),
                                                         zero.alias("nc"), F.lit(None).cast("double").alias("m2")))
    sided = (rolled().where("feature <> ''").join(snaps, ["monitor", "snapshot_ts"])
             .select("monitor", "feature", F.inline(F.filter(F.array(current, base), lambda t: t.isNotNull()))))
    bins = _written(sided.groupBy("monitor", "pair_ts", "feature", "bucket").agg(
        F.sum("nb").alias("nb"), F.sum("nc").alias("nc"), F.sum("m2").alias("m2")), "monitor-bins")

    pair = ["monitor", "pair_ts", "feature"]
    total = Window.partitionBy(*pair)
    rank = F.row_number().over(total.orderBy(F.desc("nc"), F.asc("bucket")))
    shares = bins.withColumns({"tb": F.sum("nb").over(total), "tc": F.sum("nc").over(total), "rank": rank})
    shares = shares.withColumns({"p": F.when(F.col("tb") > 0, F.col("nb") / F.col("tb")).otherwise(0.0),
                                 "q": F.when(F.col("tc") > 0, F.col("nc") / F.col("tc")).otherwise(0.0)})
    middle = (F.col("p") + F.col("q")) / 2
    both = (F.col("tb") > 0) & (F.col("tc") > 0)
    js = 0.5 * F.sum(D.kl_term(F.col("p"), middle)) + 0.5 * F.sum(D.kl_term(F.col("q"), middle))
    nominal = F.col("feature").isin(categorical)
    dev = shares.groupBy(*pair, "tb", "tc").agg(
        js.alias("js"), F.max(F.abs(F.col("p") - F.col("q"))).alias("far"), F.sum("m2").alias("m2"),
        F.sort_array(F.collect_list(F.when((F.col("rank") <= TOP_VALUES) & (F.col("nc") > 0), F.struct("rank", "bucket")))).alias("top")).select(
        "monitor", F.col("pair_ts").alias("snapshot_ts"), "feature", F.when(both, F.when(nominal, F.col("far")).otherwise(F.col("js"))).alias("deviation"),
        F.when(~nominal & (F.col("tc") > 1), F.sqrt(F.col("m2") / (F.col("tc") - 1))).alias("std"),
        F.when(nominal & (F.col("tc") > 0), F.array_join(F.transform("top", lambda t: t["bucket"]), ",")).alias("top_values"), F.lit(True).alias("known"))

    watched = F.create_map(*[x for name, _, own_feats in monitors for x in (F.lit(name), F.array(*map(F.lit, own_feats)))])
    jobs = snaps.select("monitor", "snapshot_ts", "base_snapshot_ts", F.explode(watched[F.col("monitor")]).alias("feature"), "figures")
    # the first job of a monitor has a row for each feature, a later one for each with values on either side
    jobs = (jobs.join(dev, ["monitor", "snapshot_ts", "feature"], "left").where("base_snapshot_ts IS NULL OR known")
            .withColumn("deviation", round_half_away("deviation", D.DIGITS))
            .withColumn("metric", F.when(nominal, "chebyshev").otherwise("jensen_shannon"))
            .withColumn("mean", F.when(~nominal, F.col("figures")[F.col("feature")]["mean"])))
    return D.apply_thresholds(jobs, thr).drop("known", "figures").withColumn(
        "job_id", F.concat_ws("-", "monitor", F.date_format("snapshot_ts", "yyyyMMdd'T'HHmmss")))


def schedule_jobs(df: DataFrame, ts: str, monitors: list[tuple[str, str, list[str]]], numeric: list[str],
                  categorical: list[str], thr: DataFrame) -> DataFrame:
    """D10 with D7 per monitor: every monitor snapshots the same table at its own cadence and runs the
    monitor job on its own features, all from one scan (``monitor_from_counts``)."""
    return monitor_from_counts(df, ts, monitors, numeric, categorical, thr)
