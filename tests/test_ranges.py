"""Running aggregates and quantiles over ranges, with further columns kept and null keys."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.operators import ml as M
from kestrel.operators import vectors as V
from kestrel.operators.cumulative import running
from kestrel.operators.quantiles import exact_quantiles


def test_running_sum_with_a_further_column(spark):
    n = 1_000_000
    df = spark.range(n).select((F.xxhash64("id") % 100_000).alias("o"), (F.col("id") % 7).alias("v"),
                               F.md5(F.col("id").cast("string")).alias("kept"))
    per = df.groupBy("o").agg(F.sum("v").alias("v"), F.min("kept").alias("kept"))
    out = running(per, [], "o", ["v"], partitions=16)
    assert "kept" in out.columns
    total = sum(i % 7 for i in range(n))
    got = out.agg(F.max_by("cum_v", "o"), F.max("tot_v"), F.count(F.lit(1))).first()
    assert tuple(got) == (total, total, per.count())
    big = df.withColumn("o", F.monotonically_increasing_id())
    assert running(big, [], "o", ["v"], partitions=16).agg(F.max("cum_v")).first()[0] == total


def test_running_keeps_null_keys(spark):
    rows = [("a", 1, 10), ("a", 2, 20), (None, 1, 5), (None, 2, 7)]
    got = running(spark.createDataFrame(rows, "k string, o int, v int"), ["k"], "o", ["v"]).collect()
    assert sorted((str(r.k), r.o, r.cum_v, r.tot_v) for r in got) == [
        ("None", 1, 5, 12), ("None", 2, 12, 12), ("a", 1, 10, 30), ("a", 2, 30, 30)]


def test_quantiles_of_many_rows(spark):
    x = np.random.default_rng(1).normal(size=200_001)
    df = spark.createDataFrame([(float(v), float(v * v)) for v in x[:50_000]], "a double, b double")
    got = {r.column: r.median for r in exact_quantiles(df, ["a", "b"], partitions=8).collect()}
    assert np.isclose(got["a"], np.median(x[:50_000])) and np.isclose(got["b"], np.median(x[:50_000] ** 2))


def test_split_keeps_rows_with_null_keys(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 10 != 0, F.col("id").cast("string")).alias("k"))
    train, test = M.stratified_split(df, None, 0.2, F.col("k"), stratify=False)
    assert (train.count(), test.count()) == (800, 200)


def test_more_queries_than_a_block(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(12_000)]
    q = spark.createDataFrame(rows[:11_000], "qid long, qvec array<double>")
    t = spark.createDataFrame(rows[-40:], "vec_id long, embedding array<double>")
    got = V.knn(t, q, 3, exclude_self=False).collect()
    assert len(got) == 33_000
    table = np.array([r[1] for r in rows[-40:]])
    table /= np.linalg.norm(table, axis=1, keepdims=True)
    for qid in (0, 500, 10_999):
        want = [rows[-40 + i][0] for i in np.argsort(-(table @ np.array(rows[qid][1])))[:3]]
        assert [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.qid == qid] == want


def test_inverted_file(spark):
    """Clustered vectors need few lists; rows without a direction are not found; recall against exact search."""
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(12, 16))
    rows = [(i, (centers[i % 12] + 0.2 * rng.normal(size=16)).tolist()) for i in range(1500)] + [(5000, [0.0] * 16), (5001, None)]
    t = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    q = t.where("vec_id % 50 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("qvec"))
    index = V.fit_inverted_file(t, 10)
    assert index.probes < len(index.centroids) / 2
    found = V.ann_search(V.ann_candidates(index, t, q, 10), t, q, 10)
    exact = V.knn(t, q, 10).where("score is not null")
    got, want = ({(r.qid, r.vec_id) for r in d.collect()} for d in (found, exact))
    assert len(got) == 300 and len(got & want) >= 0.9 * len(got)
    assert not {5000, 5001} & {v for _, v in got}
    empty = V.fit_inverted_file(t.limit(0), 10)
    assert V.ann_candidates(empty, t.limit(0), q.limit(0), 10).count() == 0


def _vectors_with_ties():
    """Many rows with one vector, ids that repeat or are null, vectors that are null, zero, short or not a number."""
    rng = np.random.default_rng(3)
    base, rows = rng.normal(size=(40, 5)), []
    for i in range(900):
        v = base[0 if i % 4 == 0 else rng.integers(40)].tolist()
        odd = {17: None, 19: [0.0] * 5, 23: [1.0, None, 2.0, 3.0, 4.0], 29: [float("nan")] + [1.0] * 4, 31: [1.0, 2.0], 37: []}
        v = next((o for m, o in odd.items() if i % m == 0), v)
        rows.append((None if i % 41 == 0 else int(rng.integers(700)), v, None if i % 13 == 0 else int(rng.integers(6))))
    return rows


def _by_hand(table, queries, k, per_group, exclude_self):
    """{qid: [(id, score)]} by sorting all pairs; scores are added up one after the other."""
    def unit(v):
        if v is None or None in v:
            return None
        norm = 0.0
        for x in v:
            norm += x * x
        norm = norm ** 0.5
        return None if norm == 0 else [x / norm for x in v]

    found = {}
    units = [(i, unit(v), g) for i, v, g in table]
    for qid, qvec in queries:
        q = unit(qvec)
        for i, u, g in units:
            if exclude_self and (i is None or qid is None or i == qid):
                continue
            score = None
            if q is not None and u is not None and len(q) == len(u):
                score = 0.0
                for a, b in zip(q, u):
                    score += a * b
            order = (2, 0.0) if score is None else (0, 0.0) if score != score else (1, -score)
            found.setdefault(qid, []).append((*order, -1 if i is None else i, g))
    best = {}
    for qid, pairs in found.items():
        seen, best[qid] = {}, []
        for kind, score, i, g in sorted(pairs, key=lambda p: p[:3]):
            seen[g] = seen.get(g, 0) + 1
            if (per_group is None or seen[g] <= per_group) and len(best[qid]) < k:
                best[qid].append((i, kind, -score))
    return best


@pytest.mark.parametrize("exclude_self", [True, False])
@pytest.mark.parametrize("k, per_group", [(1, None), (7, None), (10, 2), (4, 1), (40, 3)])
def test_best_pairs_of_odd_vectors(spark, monkeypatch, k, per_group, exclude_self):
    """Ties, nulls and repeated ids over several chunks and blocks give the rows that sorting all pairs gives."""
    rows = _vectors_with_ties()
    t = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    some = [(i, v) for i, v, _ in rows if i is None or i % 5 == 0]
    q = spark.createDataFrame(some, "qid long, qvec array<double>")
    monkeypatch.setattr(V, "BLOCK", 64)               # travel with the task
    monkeypatch.setattr(V, "CHUNK", 128)
    monkeypatch.setattr(V, "FIRST", 32)
    if per_group is None:
        got = V.knn(t, q, k, exclude_self=exclude_self).collect()
    else:
        got = V.knn_crowding(t, q, k, per_group, "label", exclude_self=exclude_self).collect()
    want = _by_hand(rows, some, k, per_group, exclude_self)
    have = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        kind = 2 if r.score is None else 0 if r.score != r.score else 1
        have.setdefault(r.qid, []).append((-1 if r.vec_id is None else r.vec_id, kind, r.score if kind == 1 else 0.0))
    assert have == want


def test_few_pairs_leave_the_scoring(spark):
    """Neither sort nor shuffle sees all pairs of a query and a row: the scoring tasks keep the best of each query."""
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=8).tolist(), i % 5) for i in range(2000)]
    t = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    q = t.where("vec_id % 50 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("qvec"))
    every = V.score_all(t, q, "vec_id", "embedding", ["label"])
    assert every.count() == 40 * 1999
    best = V.score_all(t, q, "vec_id", "embedding", ["label"], best=3)
    assert 40 * 3 <= best.count() <= 40 * 3 * 4       # four salts
    assert {tuple(r) for r in V.top_k(best, 3, "vec_id").collect()} == {tuple(r) for r in V.top_k(every, 3, "vec_id").collect()}
    crowded = V.score_all(t, q, "vec_id", "embedding", ["label"], best=3, crowd="label", per_group=1)
    assert 40 * 3 <= crowded.count() <= 40 * 3 * 4
    # the same for the codes of the approximate search
    cand = V.ann_candidates(V.fit_inverted_file(t, 2), t, q, 2)
    assert cand.count() == 40 * 2 * V.RERANK
