"""Hot keys: one entity / stratum / group holds ~40 % of the rows.  Results must stay
exact (checked against brute force in pandas) — nothing is dropped or capped."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kestrel.operators import features as FS
from kestrel.operators import ml as M
from kestrel.operators import cumulative as C
from kestrel.operators import runs as R
from kestrel.operators.cumulative import running


@pytest.fixture(scope="module")
def hot(spark):
    rng = np.random.default_rng(7)
    n = 4000
    ent = np.where(rng.random(n) < 0.4, 0, rng.integers(1, 50, n))
    ts = pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 10 * 86400, n), unit="s")
    pdf = pd.DataFrame({"k": ent.astype("int64"), "t": ts, "v": rng.normal(size=n), "id": np.arange(n)})
    return pdf, spark.createDataFrame(pdf).withColumn("t", F.col("t").cast("timestamp_ntz"))


def test_as_of_hot_entity(spark, hot):
    pdf, df = hot
    labels = df.where(F.col("id") % 3 == 0).select(F.col("id").alias("lid"), "k", "t")
    feats = df.where(F.col("id") % 3 != 0).select("k", F.col("t").alias("ft"), "v", "id")
    got = {r.lid: r.v for r in FS.point_in_time(labels, feats, "k", "t", "ft", ["v"], tie="id").collect()}
    lp = pdf[pdf.id % 3 == 0].sort_values("t")
    fp = pdf[pdf.id % 3 != 0].sort_values(["t", "id"]).rename(columns={"t": "ft"})
    want = pd.merge_asof(lp, fp[["k", "ft", "v"]], left_on="t", right_on="ft", by="k", direction="backward",
                         allow_exact_matches=True)
    want = dict(zip(want.id, want.v_y))
    assert set(got) == set(want)
    for k, v in want.items():
        assert (got[k] is None and np.isnan(v)) or got[k] == pytest.approx(v)


def test_latest_hot_entity(spark, hot):
    pdf, df = hot
    got = {r.k: r.id for r in FS.latest_per_entity(df, ["k"], "t", ["id"]).collect()}
    want = pdf.sort_values(["t", "id"]).groupby("k").tail(1)
    assert got == dict(zip(want.k, want.id))


def test_split_hot_stratum(spark, hot):
    _, df = hot
    train, test = M.stratified_split(df, "k", 0.25, F.col("id").cast("string"), stratify=True)
    sizes = {r.k: r.n for r in df.groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}
    got = {r.k: r.n for r in test.groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {k: int(np.ceil(0.25 * n)) for k, n in sizes.items()}
    assert train.count() + test.count() == df.count()


def test_running_max_hot_group(spark, hot):
    pdf, df = hot
    r = running(df.select("k", "id", "v"), ["k"], "id", ["v"], "max", partitions=7, inclusive=False)
    got = {x.id: x.cum_v for x in r.collect()}
    p = pdf.sort_values(["k", "id"])
    p["prev_max"] = p.groupby("k")["v"].transform(lambda s: s.cummax().shift(1))
    for i, v in zip(p.id, p.prev_max):
        assert (got[i] is None and np.isnan(v)) or got[i] == pytest.approx(v)


def _most_rows_in_a_task(monkeypatch, run):
    """The largest share of rows that one range of the stream gets while ``run`` runs."""
    seen = []
    cut = C.in_ranges

    def spy(*args, **kw):
        out = cut(*args, **kw)
        n = out.groupBy("_pid").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"), F.sum("n")).first()
        seen.append(n[0] / n[1])
        return out
    monkeypatch.setattr(C, "in_ranges", spy)
    result = run()
    return max(seen), result


def test_as_of_hot_entity_spreads(spark, hot, monkeypatch):
    """An entity with 40 % of all rows, all inside one hour."""
    pdf, df = hot
    one = df.withColumn("t", F.when(F.col("k") == 0, F.lit("2024-01-03 10:00:00").cast("timestamp_ntz")
                                    + F.make_dt_interval(secs=(F.col("id") % 3600).cast("decimal(18,6)"))).otherwise(F.col("t")))
    labels = one.where(F.col("id") % 3 == 0).select(F.col("id").alias("lid"), "k", "t")
    feats = one.where(F.col("id") % 3 != 0).select("k", F.col("t").alias("ft"), "v", "id")
    most, got = _most_rows_in_a_task(monkeypatch, lambda: {r.lid: r.v for r in FS.point_in_time(
        labels, feats, "k", "t", "ft", ["v"], tie="id", partitions=16).collect()})
    assert most < 0.15
    p = one.toPandas().sort_values(["t", "id"])
    last: dict = {}
    want = {}
    for t, group in p.groupby("t", sort=True):
        for r in group[group.id % 3 != 0].itertuples():
            last[r.k] = r.v
        for r in group[group.id % 3 == 0].itertuples():
            want[r.id] = last.get(r.k)
    assert got == want


def test_step_cache_hot_key_spreads(spark, monkeypatch):
    """One cache key has 40 % of the requests and of the executions; times tie, outputs may be null."""
    rng = np.random.default_rng(3)
    n = 3000
    key = np.where(rng.random(n) < 0.4, 0, rng.integers(1, 40, n))
    t = rng.integers(0, 2000, n)
    req = [(int(i), "p", f"k{key[i]}" if key[i] != 5 else None, int(t[i])) for i in range(n)]
    ex = [("p", f"k{key[i]}" if key[i] != 5 else None, f"out{i}" if i % 7 else None, int(t[(i * 17) % n]) if i % 11 else None) for i in range(n)]
    requests = spark.createDataFrame(req, "id long, pipeline string, cache_key string, start_time long")
    executions = spark.createDataFrame(ex, "pipeline string, cache_key string, output_uri string, finished long")
    most, got = _most_rows_in_a_task(monkeypatch, lambda: {r.id: (r.cached_output, r.hit) for r in R.step_cache(
        requests, executions, partitions=16).collect()})
    assert most < 0.15
    for i, _, k, start in req:
        done = [(f, u) for _, k2, u, f in ex if k2 == k and u is not None and f is not None and f < start]
        want = max(done)[1] if done else None
        assert got[i] == (want, want is not None)
