"""Gradient boosting of several classes with one softmax model (M7).

Every round grows one tree for each class, all of them in the same passes.  A node with many rows is split by
histograms: a task adds up the gradients of its rows by (class, node, feature, bin), the partial sums are
shuffled by (class, node) and added up, and the best split of each node comes back, one job for a level.
A node with few rows (``LOCAL_VALUES`` feature values at most) is finished in one job: its rows go to one task, which grows
the rest of its subtree.  So small nodes cost no pass over the table for each level, and no task gets more than
a bounded node.

Rows are binned once (at most ``BINS`` bins a feature, bounds from one pass of quantile sketches) and stay
in a written, cached table of blocks, ``BLOCK`` rows to a table row, with bins and margins as bytes: what Spark
reads and shuffles is a few long values, not a list of bins for every row, class and round.  The table has the
margins of every ``KEEP`` rounds; what trees were grown since is added up from the bins inside tasks, so a lost
executor costs one pass.  When margins are written anew, the table before is deleted.
"""

from __future__ import annotations

import json
import sys
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType

from kestrel.session import delete_path, scratch_path

# code that runs in tasks travels with the task: workers need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS = 32
RATE = 0.1
#: Added to the sum of second derivatives of a node.
RIDGE = 1.0
#: Least gain of a split.
LEAST_GAIN = 1e-6
#: Rounds after which margins are written again.
KEEP = 5
#: Rows of a block.
BLOCK = 1 << 14
#: Feature values (rows x features) up to which a node is finished in one task.
LOCAL_VALUES = 1 << 20


@dataclass
class Tree:
    """A binary tree in arrays, children of node i at 2 i + 1 and 2 i + 2; feature -1 is a leaf."""
    feature: np.ndarray
    bin: np.ndarray            # a row with this bin or a lower one goes left
    value: np.ndarray

    @staticmethod
    def empty(depth: int) -> "Tree":
        n = 2 ** (depth + 1) - 1
        return Tree(np.full(n, -1, np.int16), np.zeros(n, np.int16), np.zeros(n))

    def nodes(self, x: np.ndarray) -> np.ndarray:
        """The node that each row of bins has come to."""
        inner = self.feature >= 0
        place = np.arange(len(inner))
        feature = np.maximum(self.feature, 0).astype(np.int64)
        limit = np.where(inner, self.bin, np.iinfo(np.int16).max)       # a row in a leaf stays there
        left = np.where(inner, 2 * place + 1, place)
        at, flat, row = np.zeros(len(x), np.int64), x.ravel(), np.arange(len(x)) * x.shape[1]
        for _ in range(int(np.log2(place[inner].max() + 1)) + 1 if inner.any() else 0):
            at = left[at] + (flat[row + feature[at]] > limit[at])
        return at


def _values(features: list[str]):
    return [F.col(c).cast("double") for c in features]


def _bins(columns: list[pa.Array], bounds: list[list[float]]) -> np.ndarray:
    """The bins of rows: 0 for a missing value, else 1 and up."""
    out = np.zeros((len(columns[0]) if columns else 0, len(columns)), np.uint8)
    for i, (column, cut) in enumerate(zip(columns, bounds)):
        v = column.fill_null(np.nan).to_numpy(zero_copy_only=False)
        out[:, i] = np.where(np.isnan(v), 0, np.searchsorted(np.array(cut, np.float64), v) + 1)
    return out


def _softmax(m: np.ndarray) -> np.ndarray:
    e = np.exp(m - m.max(axis=0))
    return e / e.sum(axis=0)


def _add(margins: np.ndarray, x: np.ndarray, rounds: list[list[Tree]]) -> np.ndarray:
    """Margins (class by row) with those of the rounds."""
    margins = margins.copy()
    for trees in rounds:
        for k, t in enumerate(trees):
            margins[k] += t.value[t.nodes(x)]
    return margins


@dataclass
class SoftmaxBoosting:
    """A fitted model."""
    labels: list[str]
    features: list[str]
    bounds: list[list[float]]
    start: list[float]
    rounds: list[list[Tree]] = field(default_factory=list)
    gains: np.ndarray | None = None

    def importances(self) -> list[float]:
        total = float(self.gains.sum())
        return (self.gains / total if total > 0 else self.gains).tolist()

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` with the label of the largest margin (the first of equal ones)."""
        labels, start, rounds, width = self.labels, np.array(self.start), self.rounds, len(self.features)
        bounds = self.bounds
        given = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *_values(self.features))

        def run(parts):
            for batch in parts:
                x = _bins(batch.columns[1:], bounds) if width else np.zeros((batch.num_rows, 0), np.uint8)
                best = _add(np.repeat(start[:, None], len(x), axis=1), x, rounds).argmax(axis=0)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([labels[i] for i in best], pa.string())], names=["row", out])
        return given.mapInArrow(run, StructType([given.schema["row"], StructField(out, StringType())])).select("row.*", out)

    def save(self, spark, path: str) -> None:
        """One row for each node that is in use, and the rest as JSON in a table beside it."""
        rows = [(r, k, i, int(t.feature[i]), int(t.bin[i]), float(t.value[i])) for r, trees in enumerate(self.rounds)
                for k, t in enumerate(trees) for i in np.flatnonzero((t.feature >= 0) | (t.value != 0)).tolist()]
        spark.createDataFrame(rows, "round int, class int, node int, feature int, bin int, value double").write.mode("overwrite").parquet(f"{path}/trees")
        depth = max((len(t.feature) for trees in self.rounds for t in trees), default=1)
        meta = {"labels": self.labels, "features": self.features, "bounds": self.bounds, "start": self.start, "nodes": depth,
                "rounds": len(self.rounds), "gains": self.gains.tolist()}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").json(f"{path}/meta")

    @staticmethod
    def load(spark, path: str) -> "SoftmaxBoosting":
        meta = json.loads(spark.read.schema("meta string").json(f"{path}/meta").first()[0])
        n = meta["nodes"]
        rounds = [[Tree(np.full(n, -1, np.int16), np.zeros(n, np.int16), np.zeros(n)) for _ in meta["labels"]] for _ in range(meta["rounds"])]
        for r in spark.read.parquet(f"{path}/trees").toLocalIterator():      # the model, not data
            t = rounds[r["round"]][r["class"]]
            t.feature[r["node"]], t.bin[r["node"]], t.value[r["node"]] = r["feature"], r["bin"], r["value"]
        return SoftmaxBoosting(meta["labels"], meta["features"], meta["bounds"], meta["start"], rounds, np.array(meta["gains"]))


def best_splits(g: np.ndarray, h: np.ndarray, n: np.ndarray, least_rows: int) -> dict[str, np.ndarray]:
    """The best split of each node, from sums by (node, feature, bin); of equal ones the first."""
    rows = np.arange(len(g))
    left = [c.cumsum(axis=2)[:, :, :-1] for c in (g, h, n)]
    whole = [c[:, :1, :].sum(axis=2, keepdims=True) for c in (g, h, n)]
    right = [w - x for w, x in zip(whole, left)]

    def score(a, b):
        return a * a / (b + RIDGE)
    gain = score(left[0], left[1]) + score(right[0], right[1]) - score(whole[0], whole[1])
    gain[(left[2] < least_rows) | (right[2] < least_rows)] = -1.0
    flat = gain.reshape(len(g), -1)
    best = flat.argmax(axis=1)
    out = {"gain": flat[rows, best], "feature": best // BINS, "bin": best % BINS, "g": whole[0][:, 0, 0], "h": whole[1][:, 0, 0]}
    for side, parts in (("l", left), ("r", right)):
        out |= {name + side: c.reshape(len(g), -1)[rows, best] for name, c in zip("ghn", parts)}
    return out


_SPLIT = ("gain", "feature", "bin", "g", "h", "gl", "hl", "nl", "gr", "hr", "nr")
_SPLIT_SCHEMA = "node long, gain double, feature long, bin long, " + ", ".join(f"{c} double" for c in _SPLIT[3:])


def _cubes(node: np.ndarray, nodes: int, x: np.ndarray, values: tuple[np.ndarray, ...]) -> list[np.ndarray]:
    """Sums of each of ``values``, and the number of rows, by (node, feature, bin); x by feature."""
    size = BINS + 1
    out = [np.empty((nodes, len(x), size)) for _ in range(len(values) + 1)]
    first = node * size
    for f, bins in enumerate(x):
        cell = first + bins
        for cube, v in zip(out, (*values, None)):
            cube[:, f] = np.bincount(cell, v, nodes * size).reshape(nodes, size)
    return out


def grow_locally(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, rate: float, least_rows: int) -> tuple[Tree, np.ndarray]:
    """The subtree of one node's rows, and the gain of each feature."""
    tree, gains = Tree.empty(depth), np.zeros(x.shape[1])
    tree.value[0] = -rate * g.sum() / (h.sum() + RIDGE)
    x, node = np.ascontiguousarray(x.T), np.zeros(len(x), np.int64)     # of rows in nodes that may split
    for level in range(depth):
        first = 2 ** level - 1
        used = np.bincount(node - first, minlength=2 ** level) > 0
        open_, at = np.flatnonzero(used) + first, (np.cumsum(used) - 1)[node - first]
        if not len(open_):
            break
        s = best_splits(*_cubes(at, len(open_), x, (g, h)), least_rows)
        go = s["gain"] >= LEAST_GAIN
        i = open_[go]
        tree.feature[i], tree.bin[i] = s["feature"][go], s["bin"][go]
        for side, child in (("l", 2 * i + 1), ("r", 2 * i + 2)):
            tree.value[child] = -rate * s[f"g{side}"][go] / (s[f"h{side}"][go] + RIDGE)
        np.add.at(gains, s["feature"][go], s["gain"][go])
        if not go.all():
            rows = np.flatnonzero(go[at])
            x, g, h, node, at = x[:, rows], g[rows], h[rows], node[rows], at[rows]
        n = x.shape[1]
        node = 2 * node + 1 + (x.ravel()[s["feature"][at] * n + np.arange(n)] > s["bin"][at])
    return tree, gains


def _block(batch: pa.RecordBatch, i: int, width: int, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(x, y, margin) of a block, from (block, x, y, margin)."""
    x, y, m = (np.frombuffer(batch.column(c)[i].as_buffer(), kind) for c, kind in ((1, np.uint8), (2, np.int16), (3, np.float64)))
    return x.reshape(len(y), width), y, m.reshape(classes, len(y))


def _derivatives(rounds: list[list[Tree]], trees: list[Tree], width: int, classes: int):
    """For batches of blocks: (block, class, x, node, g, h) of each block and class."""
    def of(batch):
        for i, block in enumerate(batch.column(0).to_pylist()):
            x, y, m = _block(batch, i, width, classes)
            p = _softmax(_add(m, x, rounds))
            for k, t in enumerate(trees):
                yield block, k, x, t.nodes(x), p[k] - (y == k), p[k] * (1 - p[k])
    return of


_BLOCKS = "block long, x binary, y binary, margin binary"


def _blocks(bounds: list[list[float]], start: list[float]):
    """Arrow function over (y, feature ...): blocks of rows, numbered by task and place."""
    def run(parts):
        done, held, rows = 0, [], 0

        def block(taken: pa.Table):
            x = _bins([c.combine_chunks() for c in taken.columns[1:]], bounds)
            y = taken.column(0).to_numpy().astype(np.int16)
            number = TaskContext.get().partitionId() << 40 | done
            return pa.RecordBatch.from_arrays([pa.array([number]), *[pa.array([v.tobytes()], pa.binary()) for v in (x, y, np.repeat(np.array(start)[:, None], len(y), axis=1))]],
                                              names=["block", "x", "y", "margin"])
        for batch in parts:
            held.append(batch)
            rows += batch.num_rows
            while rows >= BLOCK:
                table = pa.Table.from_batches(held)
                yield block(table.slice(0, BLOCK))
                held, rows, done = table.slice(BLOCK).to_batches(), rows - BLOCK, done + 1
        if rows:
            yield block(pa.Table.from_batches(held))
    return run


def _histograms(rounds: list[list[Tree]], trees: list[Tree], open_: np.ndarray, width: int, classes: int):
    """Arrow function over blocks: (node, part, sums), a row for each node of ``open_`` that the task has rows of, sums
    being those of g, h and rows by (feature, bin).  A node is numbered class x size of a tree + place."""
    size = len(trees[0].feature)

    def run(parts):
        derive, total = _derivatives(rounds, trees, width, classes), np.zeros((len(open_), 3, width, BINS + 1))
        for batch in parts:
            for _, k, x, node, g, h in derive(batch):
                own = k * size + node
                at = np.minimum(np.searchsorted(open_, own), len(open_) - 1)
                rows = np.flatnonzero(open_[at] == own)
                if len(rows):
                    nodes, at = np.unique(at[rows], return_inverse=True)
                    for i, cube in enumerate(_cubes(at, len(nodes), x[rows].T, (g[rows], h[rows]))):
                        total[nodes, i] += cube
        used = np.flatnonzero(total[:, 2, 0].sum(axis=1))
        part = np.full(len(used), TaskContext.get().partitionId())
        yield pa.RecordBatch.from_arrays([pa.array(open_[used]), pa.array(part), pa.array([total[i].tobytes() for i in used], pa.binary())],
                                         names=["node", "part", "sums"])
    return run


def _splits(width: int, least_rows: int):
    """Arrow function over (node, part, sums), all rows of a node in one task and in order: the best split of each node."""
    def run(parts):
        nodes: list[int] = []
        sums: list[np.ndarray] = []
        for batch in parts:
            for node, own in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                cube = np.frombuffer(own, np.float64).reshape(3, width, BINS + 1)
                if nodes and nodes[-1] == node:
                    sums[-1] = sums[-1] + cube
                else:
                    nodes.append(node)
                    sums.append(cube)
        if nodes:
            s = best_splits(*np.stack(sums, axis=1), least_rows)
            yield pa.RecordBatch.from_arrays([pa.array(nodes), *[pa.array(s[c]) for c in _SPLIT]], names=["node", *_SPLIT])
    return run


def _rows_of(rounds: list[list[Tree]], trees: list[Tree], small: np.ndarray, width: int, classes: int):
    """Arrow function over blocks: (node, block, x, g, h) of the rows in the nodes ``small``, a row for each block and node."""
    size = len(trees[0].feature)

    def run(parts):
        derive = _derivatives(rounds, trees, width, classes)
        for batch in parts:
            for block, k, x, node, g, h in derive(batch):
                own = k * size + node
                rows = np.flatnonzero(np.isin(own, small))
                rows = rows[np.argsort(own[rows], kind="stable")]
                nodes, first = np.unique(own[rows], return_index=True)
                ends = [*first[1:].tolist(), len(rows)]
                of = [rows[a:b] for a, b in zip(first.tolist(), ends)]
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([block] * len(nodes), pa.int64()),
                                                  *[pa.array([v[i].tobytes() for i in of], pa.binary()) for v in (x, g, h)]],
                                                 names=["node", "block", "x", "g", "h"])
    return run


def _finish(width: int, size: int, depth: int, rate: float, least_rows: int):
    """Arrow function over the rows of one node: its subtree, as (node, place, feature, bin, value, gain), place 0 being the node."""
    def run(key, table):
        node = key[0].as_py()
        level = int(np.log2(node % size + 1))
        # the sums of a node must not hang on the order in which blocks arrive
        table = table.sort_by("block")
        x, g, h = (np.frombuffer(b"".join(table.column(c).to_pylist()), kind) for c, kind in (("x", np.uint8), ("g", np.float64), ("h", np.float64)))
        t, gains = grow_locally(x.reshape(len(g), width), g, h, depth - level, rate, least_rows)
        used = np.flatnonzero((t.feature >= 0) | (t.value != 0) | (np.arange(len(t.value)) == 0))
        n = len(used)
        rows = {"node": np.full(n + width, node), "place": np.concatenate([used, np.full(width, -1)]),
                "feature": np.concatenate([t.feature[used], np.arange(width)]).astype(np.int64),
                "bin": np.concatenate([t.bin[used], np.zeros(width)]).astype(np.int64), "value": np.concatenate([t.value[used], gains])}
        return pa.table(rows)
    return run


def _place_below(top: int, place: np.ndarray) -> np.ndarray:
    """Places of a subtree's nodes in the tree that holds it at ``top``."""
    level = np.log2(place + 1).astype(np.int64)
    return (top + 1) * 2 ** level - 1 + (place + 1 - 2 ** level)


def fit_softmax_boosting(train: DataFrame, target: str, features: list[str], rounds: int = 100, depth: int = 10,
                         rate: float = RATE, least_rows: int = 1) -> SoftmaxBoosting:
    """Boosting of all classes of ``target`` (rows without a target are left out)."""
    spark = train.sparkSession
    train = train.where(F.col(target).isNotNull())
    share = {r[0]: r[1] for r in train.groupBy(F.col(target).cast("string").alias("y")).agg(F.count(F.lit(1))).collect()}   # classes
    if not share:
        raise ValueError("no row has a target")
    labels = sorted(share)
    cuts = train.approxQuantile(features, [i / BINS for i in range(1, BINS)], 0.001)
    bounds = [sorted({b for b in own if b == b})[:BINS - 1] for own in cuts]
    total = sum(share.values())
    model = SoftmaxBoosting(labels, list(features), bounds, [float(np.log(share[c] / total)) for c in labels], [], np.zeros(len(features)))
    if len(labels) == 1:
        return model
    parts = spark.sparkContext.defaultParallelism
    y = F.array_position(F.lit(labels).cast("array<string>"), F.col(target).cast("string")) - 1
    rows = (train.repartition(parts).select(y.cast("int").alias("y"), *_values(model.features))
            .mapInArrow(_blocks(bounds, model.start), _BLOCKS))
    kept, path = _kept(spark, rows)
    since: list[list[Tree]] = []
    try:
        for _ in range(rounds):
            trees = _round(kept, since, model, total, depth, rate, least_rows, parts)
            model.rounds.append(trees)
            since.append(trees)
            if len(since) == KEEP and len(model.rounds) < rounds:
                old, before = kept, path
                kept, path = _kept(spark, kept.mapInArrow(_updated(since, len(features), len(labels)), _BLOCKS))
                since = []
                old.unpersist()
                delete_path(spark, before)
    finally:
        kept.unpersist()
        delete_path(spark, path)
    return model


def _round(kept: DataFrame, since: list[list[Tree]], model: SoftmaxBoosting, total: int, depth: int, rate: float,
           least_rows: int, parts: int) -> list[Tree]:
    """The trees of one round."""
    width, classes = len(model.features), len(model.labels)
    trees = [Tree.empty(depth) for _ in model.labels]
    size, most = len(trees[0].feature), max(1, LOCAL_VALUES // width)
    rows_of = {k * size: total for k in range(classes)}            # rows of open nodes
    small: list[int] = []
    while rows_of:
        # a leaf's depth ends the tree
        small += [i for i, n in rows_of.items() if n <= most and i % size < 2 ** depth - 1]
        big = np.array(sorted(i for i, n in rows_of.items() if n > most and i % size < 2 ** depth - 1), np.int64)
        rows_of = {}
        if not len(big):
            break
        # a node's cells go to one task: their number is bounded by features and bins
        found = (kept.mapInArrow(_histograms(since, trees, big, width, classes), "node long, part long, sums binary")
                 .repartition(max(1, min(parts, len(big))), "node").sortWithinPartitions("node", "part").mapInArrow(_splits(width, least_rows), _SPLIT_SCHEMA).collect())
        for s in found:
            t, i = trees[s["node"] // size], s["node"] % size
            t.value[i] = -rate * s["g"] / (s["h"] + RIDGE)
            if s["gain"] >= LEAST_GAIN:
                t.feature[i], t.bin[i] = s["feature"], s["bin"]
                model.gains[s["feature"]] += s["gain"]
                for side, child in (("l", 2 * i + 1), ("r", 2 * i + 2)):
                    t.value[child] = -rate * s[f"g{side}"] / (s[f"h{side}"] + RIDGE)
                    rows_of[s["node"] - i + child] = s[f"n{side}"]
    if small:
        n = 4 * max(1, min(parts, len(small)))      # more than nodes, so that few large ones share a task
        done = (kept.mapInArrow(_rows_of(since, trees, np.array(sorted(small)), width, classes), "node long, block long, x binary, g binary, h binary")
                .repartition(n, "node").groupBy("node")
                .applyInArrow(_finish(width, size, depth, rate, least_rows), "node long, place long, feature long, bin long, value double").toArrow())
        of = {c: done.column(c).to_numpy() for c in done.column_names}
        for top in np.unique(of["node"]).tolist():
            own = of["node"] == top
            sub = own & (of["place"] >= 0)
            t, at = trees[top // size], _place_below(top % size, of["place"][sub])
            t.feature[at], t.bin[at], t.value[at] = of["feature"][sub], of["bin"][sub], of["value"][sub]
            rest = own & (of["place"] < 0)
            np.add.at(model.gains, of["feature"][rest], of["value"][rest])
    return trees


def _kept(spark, rows: DataFrame) -> tuple[DataFrame, str]:
    path = scratch_path(spark, "boosting")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path).persist(), path


def _updated(rounds: list[list[Tree]], width: int, classes: int):
    def run(parts):
        for batch in parts:
            new = []
            for i in range(batch.num_rows):
                x, _, m = _block(batch, i, width, classes)
                new.append(_add(m, x, rounds).tobytes())
            yield batch.set_column(3, "margin", pa.array(new, pa.binary()))
    return run
