"""Hand-written edge cases of FIXTURES.md section C (series, anomaly, objects,
messages, preprocessing, split, metrics, features, runs, vectors, sinks)."""

import json
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.operators import anomaly as A
from kestrel.operators import features as FS
from kestrel.operators import ml as M
from kestrel.operators import objects as O
from kestrel.operators import runs as R
from kestrel.operators import series as S
from kestrel.operators import sinks as K
from kestrel.operators import vectors as V
from kestrel.operators.quantiles import exact_quantiles


# ------------------------------------------------------------------ C1 series
def test_series_edge_cases(spark):
    sensors = [{"name": "a", "unit": "u", "type": "t"}, {"name": "b", "unit": "u", "type": "t"}]
    docs = [
        ("ok", json.dumps({"series": sensors, "values": {"2024-01-01T00:00:00": [{"min": 1, "max": 2}, None]}})),
        ("minonly", json.dumps({"series": sensors, "values": {"2024-01-01T00:00:00": [{"max": 2}, {"min": 1, "max": 3}]}})),
        ("novalues", json.dumps({"series": sensors})),
        ("noseries", json.dumps({"values": {"2024-01-01T00:00:00": []}})),
        ("short", json.dumps({"series": sensors, "values": {"2024-01-01T00:00:00": [{"min": 1, "max": 2}]}})),
        ("dupts", '{"series": [{"name":"a","unit":"u","type":"t"}], "values": '
                  '{"2024-01-01T00:00:00": [{"min": 1, "max": 1}], "2024-01-01T00:00:00": [{"min": 9, "max": 9}]}}'),
    ]
    parsed = S.parse_series(spark.createDataFrame(docs, "doc_id string, doc string"))
    v = {r.doc_id: r.reason for r in S.validate_series(parsed).collect()}
    assert v == {"ok": None, "minonly": None, "novalues": "no timestamps", "noseries": "no sensors",
                 "short": "arity mismatch", "dupts": None}
    pts = {(r.doc_id, r.name): (r.min, r.max) for r in S.points_by_position(parsed).collect()}
    assert pts[("ok", "b")] == (None, None)           # null point -> two nulls
    assert pts[("minonly", "a")] == (None, 2.0)       # null min only
    assert pts[("short", "b")] == (None, None)        # too few points pads with nulls
    assert pts[("dupts", "a")] == (9.0, 9.0)          # duplicate timestamp key: last wins


# ------------------------------------------------------------------ C2 anomaly
def test_anomaly_edge_cases(spark):
    thr = '"threshold": {"2sigma": 1.0, "3sigma": 2.0}'
    good = '{"timestamp": "2024-01-01T00:00:00.000000", "reconstructionError": 0.5}'
    docs = [
        ("valid", '{"results": [%s], %s}' % (good, thr)),
        ("empty", '{"results": [], %s}' % thr),
        ("nothreshold", '{"results": [%s]}' % good),
        ("text", '{"results": [{"timestamp": "t", "reconstructionError": "abc"}, %s], %s}' % (good, thr)),
        ("nullfirst", '{"results": [{"timestamp": "t", "reconstructionError": null}, %s], %s}' % (good, thr)),
        ("malformed", '{"results": [ nope'),
        ("numeric_text", '{"results": [{"timestamp": "2024-01-01T00:00:00.000000", "reconstructionError": "0.25"}], %s}' % thr),
    ]
    df = A.parse_response(spark.createDataFrame(docs, "k string, doc string"))
    out = {r.k: r for r in A.latest_inference(df, F.col("k"), "2024-02-01 09:00:00", 10).collect()}
    assert not out["valid"].is_fallback and out["valid"].inference_value == 0.5
    assert not out["numeric_text"].is_fallback and out["numeric_text"].inference_value == 0.25
    for k in ["empty", "nothreshold", "text", "nullfirst", "malformed"]:
        assert out[k].is_fallback, k
        assert 0.0 <= out[k].inference_value < 1.0
        assert str(out[k].event_ts) == "2024-02-01 08:50:44"
    # the fallback is deterministic
    again = {r.k: r.inference_value for r in A.latest_inference(df, F.col("k"), "2024-02-01 09:00:00", 10).collect()}
    assert again["empty"] == out["empty"].inference_value


# ------------------------------------------------------------------ C3/C4 objects, messages
@pytest.fixture(scope="module")
def objs(spark):
    rows = [("a/b", None), ("a/b/", "2024-01-01 00:00:00"), ("a/b/x.txt", "2024-01-02 00:00:00"),
            ("a/b/y", "2024-01-02 00:00:00"), ("a/b/sub/z.csv", None), ("a/bc/w", "2024-01-03 00:00:00")]
    return spark.createDataFrame(rows, "name string, u string").select(
        "name", F.to_timestamp_ntz("u").alias("updated"), F.lit(10).cast("bigint").alias("size"))


def test_prefix_semantics(spark, objs):
    rel = sorted(r.relative_path for r in O.filter_prefix(objs, "a/b").collect())
    assert rel == ["sub/z.csv", "x.txt", "y"]               # no marker, no sibling a/bc
    msgs = spark.createDataFrame([("m1", '{"path": "a/b"}'), ("m2", "not json"), ("m3", '{"path": "q/none"}'),
                                  ("m4", '{"path": "a/b/"}')], "message_id string, body string")
    good, bad = O.decode_messages(msgs)
    assert [r.message_id for r in bad.collect()] == ["m2"]
    j = O.join_message_prefix(good, objs)
    got = sorted((r.message_id, r.relative_path) for r in j.collect())
    assert got == [("m1", "sub/z.csv"), ("m1", "x.txt"), ("m1", "y"),
                   ("m4", "sub/z.csv"), ("m4", "x.txt"), ("m4", "y")]


def test_latest_object_ties_and_nulls(spark, objs):
    r = O.latest_object(objs.withColumn("k", F.lit(1)), ["k"]).collect()
    assert [x.name for x in r] == ["a/bc/w"]
    r2 = O.latest_object(objs.where(~F.col("name").startswith("a/bc")).withColumn("k", F.lit(1)), ["k"]).collect()
    assert [x.name for x in r2] == ["a/b/x.txt"]            # equal updated -> smallest name


def test_listing_and_extension(spark, objs):
    files = O.filter_prefix(objs, "a/b").withColumn("k", F.lit(1))
    lst = {(r.entry, r.kind) for r in O.directory_listing(files, ["k"]).collect()}
    assert ("sub/", "DIR") in lst and ("sub/z.csv", "FILE") in lst
    top = {(r.entry, r.kind, r.size) for r in O.top_level_entries(files, ["k"]).collect()}
    assert top == {("sub", "DIR", None), ("x.txt", "FILE", 10), ("y", "FILE", 10)}
    ext = {r.name: r.e for r in objs.select("name", O.extension(F.col("name")).alias("e")).collect()}
    assert ext["a/b/y"] == ".tmp" and ext["a/b/x.txt"] == ".txt"


# ------------------------------------------------------------------ C5-C7 ML steps
def test_preprocess_edge_cases(spark):
    rows = [(1.0, None, 5.0, "x", "y1"), (2.0, None, 5.0, None, "y2"), (None, None, 5.0, "z", "y1"),
            (4.0, None, 5.0, "x", None)]
    df = spark.createDataFrame(rows, "a double, allnull double, const double, cat string, target string")
    out = M.preprocess(df, "target").collect()
    assert all(r.const == 0.0 for r in out)                  # zero variance -> divide by 1
    assert all(r.allnull is None for r in out)               # all-null column stays null
    assert sorted(r.cat for r in out) == ["unknown", "x", "x", "z"]
    assert sorted([r.target for r in out], key=str) == sorted(["y1", "y2", "y1", None], key=str)
    scaled = [r.a for r in out]
    assert None not in scaled                                # imputed with the median of the scaled column


def test_exact_quantiles_match_numpy_with_hot_value(spark):
    rng = np.random.default_rng(1)
    vals = np.concatenate([rng.normal(size=300), np.full(200, 0.25)])   # one value holds 40 %
    df = spark.createDataFrame([(float(v), float(v) * 2 if i % 3 else None) for i, v in enumerate(vals)],
                               "x double, y double")
    got = {r.column: r.median for r in exact_quantiles(df, ["x", "y"], partitions=7).collect()}
    ys = [float(v) * 2 for i, v in enumerate(vals) if i % 3]
    assert got["x"] == pytest.approx(float(np.median(vals)))
    assert got["y"] == pytest.approx(float(np.median(ys)))
    q = {r.column: r.q for r in exact_quantiles(df, ["x"], q=0.9, partitions=3, out="q").collect()}
    assert q["x"] == pytest.approx(float(np.quantile(vals, 0.9)))


def test_split_exact_sizes(spark):
    rows = [(i, "big" if i < 97 else ("one" if i == 97 else "two")) for i in range(100)]
    df = spark.createDataFrame(rows, "id bigint, y string")
    train, test = M.stratified_split(df, "y", 0.2, F.col("id").cast("string"), stratify=True)
    t = {r.y: r.n for r in test.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert t == {"big": 20, "one": 1, "two": 1}               # ceil(0.2 * n) per stratum
    assert train.count() + test.count() == 100
    assert train.join(test, "id").count() == 0
    reg = spark.createDataFrame([(i, float(i % 20)) for i in range(50)], "id bigint, y double")
    assert not M.is_stratified(reg, "y")                       # 20 distinct: not < 20
    _, t2 = M.stratified_split(reg, "y", 0.25, F.col("id").cast("string"))
    assert t2.count() == 13                                    # ceil(12.5)


def test_metrics_edge_cases(spark):
    pred = spark.createDataFrame([("a", "a"), ("a", "a"), ("b", "a")], "y string, p string")
    m = M.classification_metrics(pred).collect()[0]
    assert m.accuracy == pytest.approx(2 / 3)
    assert m.precision == pytest.approx((2 / 3) * (2 / 3))     # class b never predicted -> 0
    single = M.classification_metrics(spark.createDataFrame([("a", "a")] * 3, "y string, p string")).collect()[0]
    assert single.accuracy == 1.0 and single.f1 == 1.0
    reg = M.regression_metrics(spark.createDataFrame([(1.0, 1.5), (1.0, 0.5)], "y double, p double")).collect()[0]
    assert reg.r2 is None and reg.mse == pytest.approx(0.25)


def test_roc_auc_against_pairs(spark):
    rng = np.random.default_rng(3)
    ys = rng.integers(0, 2, 200)
    sc = np.round(rng.normal(size=200) + ys, 1)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(ys, sc)], "y bigint, score double")
    auc = M.roc_auc(df).collect()[0].auc
    pos, neg = sc[ys == 1], sc[ys == 0]
    brute = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert auc == pytest.approx(brute)


# ------------------------------------------------------------------ C9 features
def test_point_in_time_edges(spark):
    labels = spark.createDataFrame([(1, 1, "2024-01-01 00:00:00"), (2, 1, "2024-01-02 00:00:00"),
                                    (3, 1, "2024-01-05 12:00:00"), (4, 2, "2024-01-03 00:00:00")],
                                   "lid bigint, k bigint, t string").withColumn("t", F.to_timestamp_ntz("t"))
    feats = spark.createDataFrame([(1, "2024-01-02 00:00:00", 10.0, 1), (1, "2024-01-02 00:00:00", 11.0, 2),
                                   (1, "2024-01-03 00:00:00", 12.0, 3)],
                                  "k bigint, ft string, v double, id bigint").withColumn("ft", F.to_timestamp_ntz("ft"))
    r = {x.lid: x.v for x in FS.point_in_time(labels, feats, "k", "t", "ft", ["v"], tie="id").collect()}
    assert r == {1: None, 2: 11.0, 3: 12.0, 4: None}   # earlier label, same instant (tie by id), carry, no entity


def test_latest_and_views(spark):
    a = spark.createDataFrame([(1, "2024-01-01", 1.0, 1), (1, "2024-01-01", 2.0, 2), (2, "2024-01-02", 3.0, 3)],
                              "k bigint, t string, v double, id bigint")
    lat = {r.k: r.v for r in FS.latest_per_entity(a, ["k"], "t", ["id"]).collect()}
    assert lat == {1: 2.0, 2: 3.0}
    b = spark.createDataFrame([(2, "x"), (3, "y")], "k bigint, s string")
    left = FS.feature_view([(FS.latest_per_entity(a, ["k"], "t", ["id"]), "a_"), (b, "b_")], "k")
    full = FS.feature_view([(FS.latest_per_entity(a, ["k"], "t", ["id"]), "a_"), (b, "b_")], "k", how="full")
    assert left.count() == 2 and full.count() == 3


# ------------------------------------------------------------------ C10 runs
def test_runs_edges(spark):
    scores = spark.createDataFrame([("e", "r1", 0.9), ("e", "r2", 0.9), ("e", "r3", 0.5), ("e", "r0", None)],
                                   "experiment string, run string, score double")
    best = R.best_run(scores, ["experiment"]).collect()
    assert [b.run for b in best] == ["r1"]                    # tie: first run wins
    rb = {r.run: (r.best_before, r.improved) for r in R.running_best(scores.where("score is not null"),
                                                                     ["experiment"]).collect()}
    assert rb == {"r1": (None, True), "r2": (0.9, False), "r3": (0.9, False)}
    log = spark.createDataFrame([("e", "r1", "metric", "acc", None, 0.1, None),
                                 ("e", "r1", "metric", "acc", None, 0.2, None),
                                 ("e", "r2", "param", "depth", None, 3.0, "3")], R.LOG_SCHEMA)
    piv = {r.run: r["metric.acc"] for r in R.runs_pivot(log, ["depth"], ["acc"]).collect()}
    assert piv["r2"] is None and piv["r1"] in (0.1, 0.2)       # run without metrics; metric logged twice
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "src string, dst string")
    clo = R.lineage_closure(edges)                            # cycle terminates
    assert clo.count() == 9


def test_lineage_queries_follow_every_node(spark, tmp_path):
    """Nodes of any key are asked for, not only those with round keys."""
    from kestrel.plans import runs as P
    for name, rows, schema in (("nation", [(7, 2)], "n_nationkey int, n_regionkey int"),
                               ("customer", [(11, 7), (50, 7)], "c_custkey bigint, c_nationkey int"),
                               ("orders", [(3, 11), (100, 50)], "o_orderkey bigint, o_custkey bigint")):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    up = {tuple(r) for r in P.q_lineage_ancestors(spark, str(tmp_path)).collect()}
    assert up == {("nation:7", "region:2", 1),
                  *((f"customer:{c}", *r) for c in (11, 50) for r in (("nation:7", 1), ("region:2", 2))),
                  *((f"order:{o}", *r) for o, c in ((3, 11), (100, 50))
                    for r in ((f"customer:{c}", 1), ("nation:7", 2), ("region:2", 3)))}
    down = {(r.rel, r.node, r.depth) for r in P.q_lineage_descendants(spark, str(tmp_path)).collect()}
    assert down == up


# ------------------------------------------------------------------ C11 vectors
def test_vector_edges(spark):
    t = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [1.0, 0.0]), (4, [2.0, 0.0])],
                              "vec_id bigint, embedding array<double>")
    q = spark.createDataFrame([(1, [1.0, 0.0])], "qid bigint, qvec array<double>")
    r = V.knn(t, q, 5).orderBy("rank").collect()
    assert [x.vec_id for x in r] == [3, 4, 2]                 # fewer than k; ties by id; zero vector last
    assert r[-1].score is None
    r2 = V.knn(t, q, 1).collect()
    assert [x.vec_id for x in r2] == [3]                      # tie at rank k broken by id


# ------------------------------------------------------------------ C12 sinks
def test_sinks(spark):
    base = tempfile.mkdtemp(prefix="kestrel-test-")
    df = spark.createDataFrame([("2024-01-01 10:00:00", 1.0), ("2024-01-02 10:00:00", 2.0)], "t string, v double") \
        .withColumn("t", F.to_timestamp_ntz("t"))
    K.append_partitioned(df, base + "/t", "t", ["t", "v"], batch_id="7")
    K.append_partitioned(df, base + "/t", "t", ["t", "v"], batch_id="7")      # rerun: no duplicates
    K.append_partitioned(df.limit(0), base + "/t", "t", ["t", "v"], batch_id="8")
    assert spark.read.parquet(base + "/t").count() == 2
    bad = spark.createDataFrame([(None, 1.0)], "t timestamp_ntz, v double")
    with pytest.raises(Exception):
        K.append_partitioned(bad, base + "/u", "t", ["t", "v"])


def test_resolve_object(spark, objs):
    r = O.resolve_object(objs, "a/b/").collect()
    assert [x.name for x in r] == ["a/b/x.txt"]
    r = O.resolve_object(objs, "a/b/", explicit="a/b/sub/z.csv").collect()
    assert [x.name for x in r] == ["a/b/sub/z.csv"]          # explicit name wins, even with null updated
    r = O.resolve_object(objs, "a/b/", explicit="missing").collect()
    assert [x.name for x in r] == ["a/b/x.txt"]              # explicit name absent: newest under prefix
    with pytest.raises(Exception):
        O.resolve_object(objs, "zz/").collect()              # none: failure


def test_wide_column_names():
    assert S.wide_column_names([("t", "temp"), ("h", "hum"), ("t", "raw")]) == ["t_temp", "h", "t_raw"]


def test_drift_gate_writes_only_when_asked(spark):
    from kestrel.operators import drift as D
    from kestrel.operators.monitor import drift_gate
    base = spark.createDataFrame([(25, 1.0, "A"), (35, 2.0, "B"), (45, 3.0, "A")], "age bigint, income double, category string")
    cand = spark.createDataFrame([(45, 3.0, "C")] * 3, "age bigint, income double, category string")
    thr = D.thresholds(spark, ["age", "income", "category"])
    dry = drift_gate(base, cand, ["age", "income"], ["category"], thr, dry_run=True).collect()
    assert all(r.written is False for r in dry) and any(r.drift_detected for r in dry)
    path = tempfile.mkdtemp(prefix="kestrel-gate-") + "/t"
    wet = drift_gate(base, cand, ["age", "income"], ["category"], thr, dry_run=False, sink_path=path).collect()
    assert all(r.written for r in wet) and spark.read.parquet(path).count() == 3


def test_mirror_files(spark, objs):
    import os
    rows = O.filter_prefix(objs, "a/b").select(F.lit("m1").alias("message_id"), "relative_path",
                                               F.concat(F.lit("content of "), F.col("name")).alias("content"))
    dest = tempfile.mkdtemp(prefix="kestrel-mirror-")
    O.mirror_files(rows, dest)
    O.mirror_files(rows, dest)                                   # retry: same files
    got = sorted(os.path.relpath(os.path.join(d, f), dest) for d, _, fs in os.walk(dest) for f in fs)
    assert got == ["m1/sub/z.csv", "m1/x.txt", "m1/y"]
    assert open(os.path.join(dest, "m1/x.txt")).read() == "content of a/b/x.txt"


def test_listing_against_the_file_system(spark, tmp_path):
    from kestrel.operators import objects as O
    (tmp_path / "a").mkdir()
    for name, n in (("x.parquet", 5), ("a/y.parquet", 9), ("a/z.parquet", 70), ("empty.parquet", 0), ("b.txt", 3)):
        (tmp_path / name).write_bytes(b"." * n)
    now = O.list_files(spark, str(tmp_path), "*.parquet")
    assert {(r["name"], r["length"]) for r in now.collect()} == {("x.parquet", 5), ("a/y.parquet", 9), ("a/z.parquet", 70)}
    before = spark.createDataFrame([("x.parquet", 4), ("a/z.parquet", 70), ("old.parquet", 1)], "name string, length long")
    got = {(r["name"], r["change"], r["length"], r["length_before"]) for r in O.listing_changes(now, before).collect()}
    assert got == {("x.parquet", "changed", 5, 4), ("a/y.parquet", "new", 9, None), ("old.parquet", "gone", None, 1)}


def test_listing_of_the_input(spark, sf):
    import os
    from kestrel.plans.registry import QUERIES
    want = {(f, os.path.getsize(f"{sf}/{f}")) for f in os.listdir(sf) if f.endswith(".parquet")}
    assert {tuple(r) for r in QUERIES["scan_object_listing"](spark, sf).collect()} == want


def test_label_search(spark):
    from kestrel.operators import features as FS
    src = spark.createDataFrame([(1, 2.0, "x")], "id long, v double, c string")
    reg = FS.Registry(spark)
    reg.create_group("g", src, ["id"], labels={"team": "a", "unit": "none"})
    reg.create_feature("g", "v", "a value", {"unit": "usd"})
    reg.create_feature("g", "c", "a class")
    names = lambda d: sorted(r.feature for r in d.collect())
    assert names(reg.search(labels={"team": "a"})) == ["c", "v"]
    assert names(reg.search(labels={"unit": "usd"})) == ["v"] and names(reg.search(labels={"unit": "none"})) == ["c"]
    assert names(reg.search("class", {"unit": None})) == ["c"] and names(reg.search(labels={"nothing": None})) == []


def test_mirror_keeps_a_directory_once(spark):
    """Three messages name one directory: its objects are matched and kept once, and every message sees them."""
    from kestrel.operators import objects as O
    objects = spark.createDataFrame([(1, "a/b/x"), (2, "a/b/c/y"), (3, "a/bc/z"), (4, "a/b/")], "page_id long, name string")
    content = spark.createDataFrame([(i, "é" * i) for i in range(1, 5)], "page_id long, html string")
    msgs = spark.createDataFrame([("m1", "a/b"), ("m2", "a/b/"), ("m3", "a/b"), ("m4", "q")], "message_id string, path string")
    dirs = msgs.select(O.strip_trailing_slash(F.col("path")).alias("_dir")).distinct()
    mirror = O.mirror_objects(dirs, objects, content)
    assert {(r["dir"], r["relative_path"], r["length"]) for r in mirror.collect()} == {("a/b", "x", 2), ("a/b", "c/y", 4)}
    got = {(r["message_id"], r["relative_path"]) for r in O.mirror_of_messages(msgs, mirror).collect()}
    assert got == {(m, x) for m in ("m1", "m2", "m3") for x in ("x", "c/y")}
    joined = {(r["message_id"], r["relative_path"]) for r in O.join_message_prefix(msgs, objects).collect()}
    assert joined == got
