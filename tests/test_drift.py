"""Drift operators on hand-built fixtures (FIXTURES.md C8 and the reference's
drift scenario with exact moments)."""

import math

import pytest
from pyspark.sql import functions as F

from kestrel.operators import drift as D

SCHEMA = "age bigint, income double, category string"


def _frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def scenario(spark):
    # baseline: age mean 35 sd 10, income mean 60000 sd 20000; shares A .5 B .3 C .2
    base_num = [(25, 40000.0), (35, 60000.0), (45, 80000.0)]
    cats_b = ["A"] * 5 + ["B"] * 3 + ["C"] * 2
    base = [(base_num[i % 3][0], base_num[i % 3][1], c) for i, c in enumerate(cats_b[:9])] + [(35, 60000.0, "C")]
    # current: age 45, income 80000; shares A .2 B .2 C .3 D .3 (D is new)
    cats_c = ["A"] * 2 + ["B"] * 2 + ["C"] * 3 + ["D"] * 3
    cur = [(45, 80000.0, c) for c in cats_c]
    return _frame(spark, base), _frame(spark, cur)


def test_mean_shift_scenario(spark):
    base = _frame(spark, [(25, 40000.0, "A"), (35, 60000.0, "B"), (45, 80000.0, "C")])
    cur = _frame(spark, [(45, 80000.0, "A")] * 3)
    thr = D.thresholds(spark, ["age", "income"], {})
    r = {x.feature: x for x in D.apply_thresholds(D.mean_shift(base, cur, ["age", "income"]), thr).collect()}
    assert r["age"].deviation == pytest.approx(1.0)
    assert r["income"].deviation == pytest.approx(1.0)
    assert r["age"].drift_detected and r["income"].drift_detected


def test_new_category_and_strict_chebyshev(spark, scenario):
    base, cur = scenario
    nc = {x.feature: x for x in D.new_category_drift(base, cur, ["category"]).collect()}
    assert nc["category"].n_new == 1 and nc["category"].drift_detected
    thr = D.thresholds(spark, ["category"], {"category": 0.3})
    rep = D.drift_report(base, cur, [], ["category"], thr).collect()[0]
    assert rep.deviation == pytest.approx(0.3)
    assert rep.drift_detected is False          # strict '>' at exactly the threshold


def test_js_identical_disjoint_constant_empty(spark):
    a = _frame(spark, [(i, float(i), "A") for i in range(10)])
    assert D.js_divergence(a, a, ["age"]).collect()[0].deviation == pytest.approx(0.0, abs=1e-12)
    lo = _frame(spark, [(0, 0.0, "A")] * 5)
    hi = _frame(spark, [(100, 100.0, "A")] * 5)
    assert D.js_divergence(lo, hi, ["age"]).collect()[0].deviation == pytest.approx(1.0)
    assert D.js_divergence(lo, lo, ["age"]).collect()[0].deviation == pytest.approx(0.0)   # hi == lo
    empty = a.limit(0)
    assert D.js_divergence(a, empty, ["age"]).collect() == [] or \
        D.js_divergence(a, empty, ["age"]).collect()[0].deviation is None


def test_js_bounded(spark):
    a = _frame(spark, [(i % 7, float(i * i % 13), "A") for i in range(50)])
    b = _frame(spark, [(i % 5, float(i % 11), "A") for i in range(40)])
    for r in D.js_divergence(a, b, ["age", "income"]).collect():
        assert 0.0 <= r.deviation <= 1.0 and not math.isnan(r.deviation)


def test_threshold_default_and_rejection(spark):
    t = {r.feature: r.threshold for r in D.thresholds(spark, ["a", "b"], {"a": 0.1}).collect()}
    assert t == {"a": 0.1, "b": 0.3}
    with pytest.raises(Exception):
        D.thresholds(spark, ["a"], {"a": 1.0}).collect()


def test_monitor_first_job_has_no_base(spark):
    rows = [(i % 50, float(i), "A" if i % 2 else "B", f"2024-01-0{1 + i % 3} 00:00:00") for i in range(60)]
    df = spark.createDataFrame(rows, "age bigint, income double, category string, t string") \
        .withColumn("snapshot_ts", F.to_timestamp_ntz("t")).drop("t")
    jobs = D.monitor_jobs(df, ["age", "income"], ["category"], D.thresholds(spark, ["age", "income", "category"]))
    first = jobs.where(F.col("base_snapshot_ts").isNull()).collect()
    assert len(first) == 3 and all(r.deviation is None and r.drift_detected is False for r in first)
    assert jobs.where(F.col("base_snapshot_ts").isNotNull()).count() == 6
