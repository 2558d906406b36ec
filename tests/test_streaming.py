"""Streaming restarts: data arriving in two runs over one checkpoint gives the same
result as one run (the earlier windows are found in the sink; nothing is duplicated)."""

import tempfile

from pyspark.sql import functions as F

from kestrel.sources.tables import table
from kestrel.streaming import monitors as T

SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"


def _stage(df, path):
    df.repartition(2).write.mode("append").parquet(path)


def test_windowed_drift_across_restarts(spark, sf):
    base = tempfile.mkdtemp(prefix="kestrel-stream-")
    ev = table(spark, sf, "events", "event_id", "ts", "user_id", "event_type", "value")
    split = F.lit("2024-01-16").cast("timestamp_ntz")
    # one run over everything
    _stage(ev, f"{base}/all")
    one = T.run_windowed_drift(spark, f"{base}/all", SCHEMA, f"{base}/out1", f"{base}/ck1", 60, ["event_type"])
    # two runs on the same checkpoint: first half, then the second half arrives
    _stage(ev.where(F.col("ts") < split), f"{base}/inc")
    T.run_windowed_drift(spark, f"{base}/inc", SCHEMA, f"{base}/out2", f"{base}/ck2", 60, ["event_type"])
    _stage(ev.where(F.col("ts") >= split), f"{base}/inc")
    two = T.run_windowed_drift(spark, f"{base}/inc", SCHEMA, f"{base}/out2", f"{base}/ck2", 60, ["event_type"])
    cols = ["window_start", "event_type", "n", "prev_n", "drift_detected"]
    a = sorted(tuple(r) for r in spark.read.parquet(one).select(*cols).collect())
    b = sorted(tuple(r) for r in spark.read.parquet(two).select(*cols).collect())
    assert a == b and len(a) > 0
    # a restart with no new files adds nothing
    T.run_windowed_drift(spark, f"{base}/inc", SCHEMA, f"{base}/out2", f"{base}/ck2", 60, ["event_type"])
    assert spark.read.parquet(two).count() == len(b)


def test_distribution_drift_across_restarts(spark, sf):
    """Windows found in the sink of an earlier run compare like those of one run; a retried batch replaces itself."""
    base = tempfile.mkdtemp(prefix="kestrel-stream-")
    ev = table(spark, sf, "events", "event_id", "ts", "user_id", "event_type", "value")
    split = F.lit("2024-01-16 07:30:00").cast("timestamp_ntz")
    args = ({"value": (0.0, 500.0)}, ["event_type"], 180)
    _stage(ev, f"{base}/all")
    one = T.run_distribution_drift(spark, f"{base}/all", SCHEMA, f"{base}/out1", f"{base}/ck1", *args)
    _stage(ev.where(F.col("ts") < split), f"{base}/inc")
    T.run_distribution_drift(spark, f"{base}/inc", SCHEMA, f"{base}/out2", f"{base}/ck2", *args)
    _stage(ev.where(F.col("ts") >= split), f"{base}/inc")
    two = T.run_distribution_drift(spark, f"{base}/inc", SCHEMA, f"{base}/out2", f"{base}/ck2", *args)
    cols = ["window_start", "feature", "kind", "n", "prev_n", F.round("deviation", 9), "drift_detected"]
    a, b = (sorted(tuple(str(x) for x in r) for r in spark.read.parquet(p).select(*cols).collect()) for p in (one, two))
    assert a == b and len(a) > 100
    T.run_distribution_drift(spark, f"{base}/inc", SCHEMA, f"{base}/out2", f"{base}/ck2", *args)
    assert spark.read.parquet(two).count() == len(b)


def test_import_writes_in_proportion_to_the_batch(spark):
    """Batches of 50 entities on a table of 3,000: runs grow with the batches; a retry changes nothing."""
    base = tempfile.mkdtemp(prefix="kestrel-serving-")
    serving, want, written = f"{base}/t", {}, 0
    for b in range(11):
        ids = range(3000) if b == 0 else [(b * 37 + i * 13) % 3000 for i in range(50)]
        rows = [(i, b - (i % 3 == 0) * 2 * (b % 2), f"v{b}-{i}") for i in ids]
        batch = spark.createDataFrame(rows, "id long, t long, v string")
        for r in rows:
            if r[0] not in want or r[1] >= want[r[0]][0]:
                want[r[0]] = r[1:]
        T.merge_latest(spark, batch, b, serving, ["id"], "t")
        if b in (3, 8):
            T.merge_latest(spark, batch, b, serving, ["id"], "t")          # the stream repeats a batch
        got = {r["id"]: (r["t"], r["v"]) for r in T.serving_table(spark, serving, ["id"], "t").collect()}
        assert got == want
        runs = T.live_runs(spark, serving)
        assert max(sum(r["level"] == level for r in runs) for level in range(4)) < T.FAN
        written += sum(spark.read.parquet(r["path"]).count() for r in runs if r["batch"] == b)
    # the first 3,000 rows are written again once, by the merge of the first four runs
    assert written < 2 * 3000 + 10 * 50 * 2 + 200
