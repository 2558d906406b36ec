"""Softmax boosting against plain numpy, by histograms and by single nodes, and what it shuffles and leaves behind."""

import glob

import numpy as np
import pytest

from kestrel.operators import boosting as B


def _rows(spark, n=600):
    r = np.random.default_rng(5)
    a, b = r.normal(size=n), r.integers(0, 4, n).astype(float)
    y = np.where(a + b + r.normal(size=n) > 2, "x", np.where(b > 1, "y", "z"))
    rows = [(None if i % 50 == 0 else float(u), float("nan") if i % 70 == 0 else float(v), None if i % 90 == 0 else str(c))
            for i, (u, v, c) in enumerate(zip(a, b, y))]
    return rows, spark.createDataFrame(rows, "a double, b double, y string").repartition(3)


def _plain(model, rows, rounds, depth):
    """Margins of the rows after as many rounds: for each node the best (feature, bin) by plain sums."""
    def bin_(v, cut):
        return 0 if v is None or v != v else sum(c < v for c in cut) + 1
    x = np.array([[bin_(v, cut) for v, cut in zip(r, model.bounds)] for r in rows])
    y = np.array([model.labels.index(r[2]) for r in rows])
    m = np.tile(model.start, (len(x), 1))

    def leaf(s):
        return -B.RATE * g[s].sum() / (h[s].sum() + B.RIDGE)

    def grow(s, level):
        best = (B.LEAST_GAIN, None)
        for f in range(2):
            for b in range(B.BINS):
                left = x[s, f] <= b
                if 0 < left.sum() < len(s):
                    gain = sum(g[p].sum() ** 2 / (h[p].sum() + B.RIDGE) for p in (s[left], s[~left])) - g[s].sum() ** 2 / (h[s].sum() + B.RIDGE)
                    if gain > best[0] + 1e-9:
                        best = (gain, left)
        if level == depth or best[1] is None:
            new[s] = leaf(s)
        else:
            grow(s[best[1]], level + 1)
            grow(s[~best[1]], level + 1)
    for _ in range(rounds):
        e = np.exp(m - m.max(axis=1, keepdims=True))
        p, out = e / e.sum(axis=1, keepdims=True), m.copy()
        for k in range(len(model.labels)):
            g, h, new = p[:, k] - (y == k), p[:, k] * (1 - p[:, k]), np.zeros(len(x))
            grow(np.arange(len(x)), 0)
            out[:, k] += new
        m = out
    return x, m


@pytest.mark.parametrize("local", [1 << 20, 2 * 100, 2])       # one task a tree; histograms first; histograms only
def test_boosting_is_that_of_plain_sums(spark, monkeypatch, local):
    monkeypatch.setattr(B, "LOCAL_VALUES", local)
    monkeypatch.setattr(B, "BLOCK", 64)
    monkeypatch.setattr(B, "KEEP", 2)
    rows, df = _rows(spark)
    model = B.fit_softmax_boosting(df, "y", ["a", "b"], rounds=5, depth=3)
    known = [r for r in rows if r[2] is not None]
    x, margins = _plain(model, known, 5, 3)
    got = B._add(np.tile(model.start, (len(x), 1)).T, x.astype(np.uint8), model.rounds)
    assert np.abs(got.T - margins).max() < 1e-9
    predicted = {(r.a, repr(r.b), r.y): r.prediction for r in model.transform(df).collect()}
    assert all(predicted[r[0], repr(r[1]), r[2]] == model.labels[k] for r, k in zip(known, margins.argmax(axis=1)))


def test_boosting_shuffles_blocks_and_leaves_no_table(spark, monkeypatch, tmp_path):
    paths = iter(f"{tmp_path}/boosting-{i}" for i in range(9))
    monkeypatch.setattr(B, "scratch_path", lambda spark, name: next(paths))
    finish = B._finish

    def counted(*a):
        run = finish(*a)

        def rows(key, table):
            with open(f"{tmp_path}/rows-{key[0]}", "w") as f:
                f.write(str(table.num_rows))
            return run(key, table)
        return rows
    monkeypatch.setattr(B, "_finish", counted)
    _, df = _rows(spark)
    B.fit_softmax_boosting(df, "y", ["a", "b"], rounds=7, depth=3)
    passed = [int(open(f).read()) for f in glob.glob(f"{tmp_path}/rows-*")]
    assert len(passed) == 3 and max(passed) <= spark.sparkContext.defaultParallelism       # blocks, not the 593 rows
    assert not glob.glob(f"{tmp_path}/boosting-*")
