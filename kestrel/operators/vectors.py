"""Vector search.

Exact search scores every table row against every query vector.  Table rows are dealt over salts and packed
into chunks of about ``CHUNK`` vectors, the queries are packed into blocks of about ``BLOCK``; a block goes to
every salt once, and meets its chunks one after the other.  A chunk and a block are scored by one matrix
product; of the pairs of a block and a salt only those leave the task that can be among the best k of their
query (``best`` of ``score_all``), so neither sorting nor the shuffle ever sees all pairs.  The product only
finds the candidates: their scores are summed again element by element, so that equal vectors tie
exactly, whatever their place in a chunk.  The query set has no bound and does not pass through the driver.

Approximate search (V5) has an inverted file with sign codes.  Every row is in the list of its nearest
centroid, with a code of ``BITS`` bits: on which side of as many planes through the origin the vector
lies, so differing bits estimate the angle.  A query visits the lists nearest to it, ranks
their rows by differing bits inside the join (chunks and blocks as above), and only the first ``RERANK`` x k
rows become candidates, whose vectors are fetched and scored.  Centroids and the number of lists to visit are
fitted on a bounded sample; every row is indexed.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

# code that runs in tasks travels with the task: workers need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 1024                  # query vectors that are scored at once
CHUNK = 4096                  # table rows that are scored at once
SALT_PAIRS = 1 << 30          # pairs of a query and a row that one salt should have at most
FIRST = 1024                  # columns of scores that the first bound of a query is taken from


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity in DOUBLE; a zero vector gives null."""
    a = a.cast("array<double>")
    b = b.cast("array<double>")
    na, nb = F.sqrt(_dot(a, a)), F.sqrt(_dot(b, b))
    return F.when((na == 0) | (nb == 0), F.lit(None).cast("double")).otherwise(_dot(a, b) / (na * nb))


def unit_vectors(df: DataFrame, vec_col: str, out: str = "_u") -> DataFrame:
    """Adds ``out`` = the vector scaled to length 1 (null for a zero vector).  The norm is
    a column of its own, so it is computed once per row, not once per element."""
    v = F.col(vec_col).cast("array<double>")
    d = df.withColumn("_norm", F.sqrt(_dot(v, v)))
    return d.withColumn(out, F.when(F.col("_norm") > 0, F.transform(v, lambda x: x / F.col("_norm")))) \
            .drop("_norm")


# ---------------------------------------------------------------- the best pairs of a block and a chunk
_NULL, _LEAST = -1e30, -1e31  # stand for a null score, and below every score


@dataclass
class _Units:
    """Vectors scaled to length one by the steps of ``unit_vectors``, in the same order of additions."""
    x: np.ndarray             # (rows, dimensions), shorter vectors padded
    ok: np.ndarray            # whether there is a unit vector
    size: np.ndarray          # dimensions of each

    @classmethod
    def of(cls, columns: list[pa.Array]) -> _Units:
        v, = columns
        size = pc.fill_null(pc.list_value_length(v), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat, d = v.flatten(), int(size.max(initial=0))
        ok = v.is_valid().to_numpy(zero_copy_only=False).copy()
        if flat.null_count:
            ok[np.repeat(np.arange(len(v)), size)[flat.is_null().to_numpy(zero_copy_only=False)]] = False
            flat = pc.fill_null(flat, 0)
        values = flat.to_numpy(zero_copy_only=False).astype(np.float64)
        if (size == d).all():
            x = values.reshape(len(v), d)
        else:
            x = np.zeros((len(v), d))
            x[np.arange(d) < size[:, None]] = values
        with np.errstate(all="ignore"):
            norm = np.sqrt(_sums((c * c for c in np.ascontiguousarray(x.T)), len(x)))
            ok &= (norm > 0) | np.isnan(norm)
            return cls(np.where(ok[:, None], x / norm[:, None], 0.0), ok, size)

    def take(self, at) -> _Units:
        return _Units(self.x[at], self.ok[at], self.size[at])

    def scores(self, t: _Units) -> tuple[np.ndarray, float]:
        """The scores of all pairs, and a bound of their rounding errors; inf stands for NaN."""
        d = max(self.x.shape[1], t.x.shape[1])
        a, b = (np.pad(u.x, ((0, 0), (0, d - u.x.shape[1]))) if u.x.shape[1] < d else u.x for u in (self, t))
        with np.errstate(all="ignore"):
            s = a @ b.T
            if np.isnan(a).any() or np.isnan(b).any():
                s[np.isnan(s)] = np.inf
            long = [np.nan_to_num((u * u).sum(axis=1)).max(initial=1.0) for u in (a, b)]
        s[~self.ok] = _NULL
        s[:, ~t.ok] = _NULL
        if len({*self.size[self.ok], *t.size[t.ok]}) > 1:
            s[self.size[:, None] != t.size] = _NULL
        return s, (d + 2) * 1e-15 * (long[0] * long[1]) ** 0.5

    def exact(self, t: _Units, qi: np.ndarray, ti: np.ndarray, s: np.ndarray) -> np.ndarray:
        """The scores of some pairs as ``_dot`` adds them up; ``s``: their scores by ``scores``."""
        with np.errstate(all="ignore"):
            e = _sums((a[qi] * b[ti] for a, b in zip(np.ascontiguousarray(self.x.T), np.ascontiguousarray(t.x.T))), len(qi))
        return np.where(s == _NULL, s, np.where(np.isnan(e), np.inf, e))


def _sums(products, n: int) -> np.ndarray:
    acc = np.zeros(n)
    for p in products:
        acc += p
    return acc


@dataclass
class _Codes:
    """Words of sign codes; the score is the number of differing bits, negative."""
    x: np.ndarray             # (rows, words)

    @classmethod
    def of(cls, columns: list[pa.Array]) -> _Codes:
        return cls(np.stack([c.to_numpy(zero_copy_only=False).view(np.uint64) for c in columns], axis=1))

    @property
    def ok(self) -> np.ndarray:
        return np.ones(len(self.x), bool)

    def take(self, at) -> _Codes:
        return _Codes(self.x[at])

    def scores(self, t: _Codes) -> tuple[np.ndarray, float]:
        s = np.empty((len(self.x), len(t.x)), np.float32)
        words = np.ascontiguousarray(t.x.T)
        for a in range(0, len(s), 32):                # what is worked on at once stays in the cache
            q = self.x[a:a + 32]
            apart = np.zeros((len(q), len(t.x)), np.uint16)
            for i, w in enumerate(words):
                apart += np.bitwise_count(q[:, i, None] ^ w)
            np.negative(apart, out=s[a:a + 32], dtype=np.float32)
        return s, 0.0

    def exact(self, t: _Codes, qi: np.ndarray, ti: np.ndarray, s: np.ndarray) -> np.ndarray:
        return s.astype(np.float64)


def _by_value(a: pa.Array) -> tuple[np.ndarray, ...]:
    """Keys for ``lexsort`` that order as Spark does, nulls first; the last is the most significant."""
    if pa.types.is_integer(a.type):
        return pc.fill_null(a, 0).to_numpy(zero_copy_only=False), a.is_valid().to_numpy(zero_copy_only=False)
    return pc.rank(a, null_placement="at_start", tiebreaker="dense").to_numpy(zero_copy_only=False).astype(np.int64),


def _numbered(*arrays: pa.Array) -> list[np.ndarray]:
    """The same number for equal values (nulls are equal)."""
    n = pc.dictionary_encode(pa.concat_arrays(arrays), null_encoding="encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return np.split(n, np.cumsum([len(a) for a in arrays])[:-1])


def _places(*keys: np.ndarray) -> np.ndarray:
    """The place of each row in its run of equal keys."""
    n = len(keys[0])
    new = np.ones(n, bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.arange(n) - np.maximum.accumulate(np.where(new, np.arange(n), 0))


def _first_of_ties(group: np.ndarray, ids: pa.Array, n: int) -> np.ndarray:
    """Which rows can be among the first ``n`` by id of their group, when the rows of any one id are left out:
    no more than n of each id, and no more than 2n in all."""
    same, = _numbered(ids)
    order = np.lexsort((same, *_by_value(ids), group))
    g = group[order]
    few = _places(g, same[order]) < n
    keep = np.zeros(len(group), bool)
    keep[order[few]] = _places(g[few]) < 2 * n
    return keep


def _equal_rows(x: np.ndarray) -> np.ndarray:
    """The same number for rows with the same bytes."""
    words = np.ascontiguousarray(x).view(np.uint64)
    odd = np.random.default_rng(1).integers(0, 1 << 63, words.shape[1], dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    mixed = ((words ^ (words >> np.uint64(29))) * odd).sum(axis=1, dtype=np.uint64)
    _, first, number = np.unique(mixed, return_index=True, return_inverse=True)
    other = (words != words[first[number]]).any(axis=1)          # equal sums of other bytes stay apart
    number[other] = len(first) + np.arange(other.sum())
    return number


@dataclass
class _Rows:
    """A chunk of the table: a row that can be in no result because enough equal vectors come first is left out."""
    ids: pa.Array
    key: pa.Array             # the id in the type that it is compared in with the id of a query
    keep: list[pa.Array]
    v: _Units | _Codes

    def take(self, at: np.ndarray) -> _Rows:
        i = pa.array(at)
        return _Rows(self.ids.take(i), self.key.take(i), [c.take(i) for c in self.keep], self.v.take(at))


@dataclass
class _Best:
    """The best pairs of a block of queries so far, by query, score and id."""
    qi: np.ndarray
    score: np.ndarray
    ids: pa.Array
    keep: list[pa.Array]

    def batch(self, qids: pa.Array, names: list[str]) -> pa.RecordBatch:
        score = pa.array(np.where(np.isinf(self.score), np.nan, self.score), mask=self.score == _NULL)
        return pa.RecordBatch.from_arrays([self.ids, *self.keep, qids.take(pa.array(self.qi)), score], names=names)


def _without_self(s: np.ndarray, qkey: pa.Array, tkey: pa.Array) -> None:
    q, t = _numbered(qkey, tkey)
    order = np.argsort(t, kind="stable")
    lo, hi = (np.searchsorted(t[order], q, side) for side in ("left", "right"))
    qi = np.repeat(np.arange(len(q)), hi - lo)
    s[qi, order[np.repeat(lo, hi - lo) + _places(qi)]] = -np.inf


def _add(best: _Best | None, q: _Units | _Codes, qkey: pa.Array, rows: _Rows, k: int, per_group: int,
         crowd: int | None, exclude_self: bool) -> _Best:
    """The best pairs of what was found before and of a chunk: of each query and group (the kept column ``crowd``)
    the first ``per_group``, and of those the first ``k``."""
    n, nq = len(rows.ids), len(q.ok)
    best = best or _Best(np.zeros(0, np.int64), np.zeros(0), rows.ids.slice(0, 0), [c.slice(0, 0) for c in rows.keep])
    group, had = _numbered(rows.keep[crowd], best.keep[crowd]) if crowd is not None else (np.zeros(n, np.int64), np.zeros(len(best.qi), np.int64))
    groups = group.max() + 1                          # of the chunk; others of ``had`` have higher numbers
    vector = np.where(rows.v.ok, _equal_rows(rows.v.x), -1)
    at = np.flatnonzero(_first_of_ties(_equal_rows(np.stack([group, vector], axis=1)), rows.ids, per_group))
    at = at[np.argsort(group[at], kind="stable")]
    rows, group = rows.take(at), group[at]

    s, error = q.scores(rows.v)
    if not q.ok.all():                                # all scores of such a query are null: its first rows by id
        s[np.ix_(~q.ok, ~_first_of_ties(group, rows.ids, per_group))] = -np.inf
    if exclude_self:
        _without_self(s, qkey, rows.key)

    # least scores that a pair must reach: of k pairs of the query, and of per_group pairs of the group
    met = had < groups
    place = best.qi[met] * groups + had[met]
    full = np.bincount(place, minlength=nq * groups) >= per_group
    worst = np.full(nq * groups, np.inf)
    np.minimum.at(worst, place, best.score[met])
    least = np.where(full, worst, -np.inf).reshape(nq, groups)
    enough = np.bincount(best.qi, minlength=nq) >= k
    of_all = np.full(nq, np.inf)
    np.minimum.at(of_all, best.qi, best.score)
    of_all = np.where(enough, of_all, -np.inf)
    if not enough.all():
        tops, ends = [], np.flatnonzero(np.diff(group, append=-1)) + 1
        for a, b in zip([0, *ends[:-1]], ends):
            top = s[:, a:min(b, a + max(FIRST, 4 * per_group))]
            if top.shape[1] > per_group:
                top = np.partition(top, top.shape[1] - per_group, axis=1)[:, -per_group:]
                least[:, group[a]] = np.maximum(least[:, group[a]], top[:, 0])
            tops.append(top)
        tops = np.concatenate(tops, axis=1)
        if tops.shape[1] >= k:
            of_all = np.maximum(of_all, np.partition(tops, tops.shape[1] - k, axis=1)[:, -k])
    least = np.maximum(np.maximum(least, of_all[:, None]) - 2 * error, _LEAST).astype(s.dtype)

    found = np.flatnonzero(s >= (least[:, group] if crowd is not None else least))
    qi, ti = np.divmod(found, s.shape[1])
    score = q.exact(rows.v, qi, ti, s.ravel()[found])
    take = pa.array(ti)
    qi, score = np.concatenate([best.qi, qi]), np.concatenate([best.score, score])
    ids = pa.concat_arrays([best.ids, rows.ids.take(take)])
    keep = [pa.concat_arrays([old, c.take(take)]) for old, c in zip(best.keep, rows.keep)]
    by_id, c = _by_value(ids), np.concatenate([had, group[ti]])
    order = np.arange(len(qi))
    if crowd is not None:
        order = np.lexsort((*by_id, -score, c, qi))
        order = order[_places(qi[order], c[order]) < per_group]
    order = order[np.lexsort((*(b[order] for b in by_id), -score[order], qi[order]))]
    order = order[_places(qi[order]) < k]
    last = pa.array(order)
    return _Best(qi[order], score[order], ids.take(last), [c.take(last) for c in keep])


def _all_pairs(q, qkey: pa.Array, rows: _Rows, exclude_self: bool) -> _Best:
    s, _ = q.scores(rows.v)
    if exclude_self:
        _without_self(s, qkey, rows.key)
    found = np.flatnonzero(s >= _LEAST)
    qi, ti = np.divmod(found, s.shape[1])
    take = pa.array(ti)
    return _Best(qi, q.exact(rows.v, qi, ti, s.ravel()[found]), rows.ids.take(take), [c.take(take) for c in rows.keep])


def _pairs(joined: DataFrame, schema: StructType, of, k: int | None, per_group: int | None, crowd: int | None,
           exclude_self: bool) -> DataFrame:
    """Pairs of ``joined``, which has a row (_part, _block, _qs, _ts) for each block of queries (qid, key, vector
    columns) and each chunk of rows (id, key, vector columns, kept columns) that meet; ``of``: _Units.of or _Codes.of.
    The chunks that a block meets in a row are worked off together."""
    names = schema.names
    kept = len(names) - 3                             # id, qid and score stand beside the kept columns

    def run(parts):
        found, qids, now = {}, {}, None

        def ended():
            for a, best in found.items():
                yield best.batch(qids[a], names)
            found.clear()

        for batch in parts:
            for i in range(batch.num_rows):
                here = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                if here != now:
                    yield from ended()
                    now = here
                qs, ts = (batch.column(c)[i].values.flatten() for c in (2, 3))
                width = len(ts) - kept
                # chunks and blocks come near their sizes; many equal rows may pass them
                step = 2 * BLOCK if k is not None else 32
                for b in range(0, len(ts[0]), 2 * CHUNK):
                    t = [c.slice(b, 2 * CHUNK) for c in ts]
                    rows = _Rows(t[0], t[1], t[width:], of(t[2:width]))
                    for a in range(0, len(qs[0]), step):
                        qid, key, *v = (c.slice(a, step) for c in qs)
                        if k is None:
                            yield _all_pairs(of(v), key, rows, exclude_self).batch(qid, names)
                        else:
                            found[a], qids[a] = _add(found.get(a), of(v), key, rows, k, per_group, crowd, exclude_self), qid
        yield from ended()

    return joined.mapInArrow(run, schema)


def _salts(table: DataFrame, n_rows: int, n_queries: int) -> int:
    """Over how many salts the rows are dealt: as many as make the copies of the queries as large as the table, and
    more if a salt had too many pairs; the session's shuffle partitions bound it."""
    partitions = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(partitions, max(n_rows // max(1, n_queries), n_rows * n_queries // SALT_PAIRS)))


def score_all(table: DataFrame, queries: DataFrame, id_col: str, vec_col: str, keep: list[str] | None = None,
              exclude_self: bool = True, query_id: str = "qid", query_vec: str = "qvec", best: int | None = None,
              crowd: str | None = None, per_group: int | None = None) -> DataFrame:
    """(id, keep..., qid, score) for every table row and query: one dot product of unit vectors per pair.  With
    ``best`` only a part of the pairs that holds the first ``best`` of each query by score and id (with ``crowd``:
    of the first ``per_group`` of each value of that kept column), as a window before a shuffle would leave."""
    keep = keep or []
    t, q = table, queries
    # ids are compared in the type that a union gives them
    key = t.select(id_col).union(q.select(query_id)).schema[0].dataType
    if exclude_self:                                  # a null id differs from none
        t, q = t.where(F.col(id_col).isNotNull()), q.where(F.col(query_id).isNotNull())

    def vector(df: DataFrame, c: str) -> Column:      # floats travel as they are
        return F.col(c) if df.schema[c].dataType.simpleString() == "array<float>" else F.col(c).cast("array<double>")

    n_queries, n_rows = q.count(), t.count()
    blocks = max(1, -(-n_queries // BLOCK))
    salts = _salts(table, n_rows, n_queries)
    chunks = max(1, -(-n_rows // (salts * CHUNK)))
    q = (q.select(F.col(query_id).alias("qid"), F.col(query_id).cast(key).alias("key"), vector(q, query_vec).alias("v"))
         .groupBy(F.pmod(F.xxhash64("qid", "v"), F.lit(blocks)).alias("_block"))
         .agg(F.collect_list(F.struct("qid", "key", "v")).alias("_qs"))
         # every salt needs the block: the rows of the table are spread over the salts
         .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
         .repartition(salts, "_salt"))
    row = F.struct(F.col(id_col).alias("id"), F.col(id_col).cast(key).alias("key"), vector(t, vec_col).alias("v"),
                   *[F.col(c).alias(f"keep{i}") for i, c in enumerate(keep)])
    t = (t.select(row.alias("_t"), F.pmod(F.xxhash64(id_col, vec_col), F.lit(salts * chunks)).cast("int").alias("_chunk"))
         .withColumn("_salt", F.pmod("_chunk", F.lit(salts)))
         .repartition(salts, "_salt")
         .groupBy("_salt", "_chunk").agg(F.collect_list("_t").alias("_ts")))
    # merged, never broadcast: the blocks of all salts would pass through the driver
    joined = q.join(t.hint("merge"), "_salt").select("_salt", "_block", "_qs", "_ts")
    schema = StructType([table.schema[id_col], *[table.schema[c] for c in keep],
                         StructField("qid", queries.schema[query_id].dataType), StructField("score", DoubleType())])
    return _pairs(joined, schema, _Units.of, best, per_group or best, None if crowd is None else keep.index(crowd), exclude_self)


def top_k(scored: DataFrame, k: int, id_col: str, group: str = "qid", score: str = "score") -> DataFrame:
    """K best per query, ties by id (partial top-k before the shuffle)."""
    w = Window.partitionBy(group).orderBy(F.desc_nulls_last(score), F.asc(id_col))
    return scored.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k)


def knn(table: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding",
        keep: list[str] | None = None, where: Column | None = None, exclude_self: bool = True) -> DataFrame:
    """V1/V2/V3: k nearest neighbours (cosine) of each query, optional filter on the table."""
    t = table if where is None else table.where(where)
    return top_k(score_all(t, queries, id_col, vec_col, keep, exclude_self, best=k), k, id_col)


def knn_crowding(table: DataFrame, queries: DataFrame, k: int, per_group: int, crowd: str,
                 id_col: str = "vec_id", vec_col: str = "embedding", exclude_self: bool = True) -> DataFrame:
    """At most ``per_group`` neighbours per crowding value, then the best k overall."""
    s = score_all(table, queries, id_col, vec_col, [crowd], exclude_self, best=k, crowd=crowd, per_group=per_group)
    w1 = Window.partitionBy("qid", crowd).orderBy(F.desc_nulls_last("score"), F.asc(id_col))
    s = s.withColumn("_c", F.row_number().over(w1)).where(F.col("_c") <= per_group).drop("_c")
    return top_k(s, k, id_col)


# ---------------------------------------------------------------- V5: inverted file with sign codes
BITS = 1024
RERANK = 4                    # candidates of a query for each neighbour asked for
SAMPLE = 4096                 # vectors that centroids and probes are fitted on
SAMPLE_QUERIES = 256
LIST_RECALL = 0.98            # share of the sample's neighbours that visited lists must hold
_CODES = [f"_c{i}" for i in range(BITS // 64)]


@dataclass
class InvertedFile:
    centroids: np.ndarray     # (lists, dimensions), of length one
    planes: np.ndarray        # (dimensions, BITS)
    probes: int               # lists that a query visits

    def nearest(self, x: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` nearest lists of each vector, nearest first."""
        return np.argsort(-(x @ self.centroids.T), axis=1, kind="stable")[:, :n]

    def codes(self, x: np.ndarray) -> np.ndarray:
        return np.packbits(x @ self.planes > 0, axis=1, bitorder="little").view("<i8")


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _spherical_kmeans(x: np.ndarray, lists: int, rng: np.random.Generator, rounds: int = 10) -> np.ndarray:
    c = x[rng.choice(len(x), lists, replace=False)]
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(size > 0, sums / np.where(size > 0, size, 1), c)
    return c


def indexable(df: DataFrame, vec_col: str) -> DataFrame:
    """Rows with a vector of some length; a zero vector has no direction."""
    v = F.col(vec_col).cast("array<double>")
    return df.where(F.coalesce(_dot(v, v) > 0, F.lit(False)))


def fit_inverted_file(table: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding",
                      sample: int = SAMPLE, seed: int = 42) -> InvertedFile:
    """Centroids and probes from the ``sample`` rows with the smallest hashes of the id (all rows, if there are
    fewer).  Nearer neighbours than the sample's only make the visited lists hold more of them."""
    rows = indexable(table, vec_col).select(F.xxhash64(id_col).alias("h"), F.col(vec_col).cast("array<double>").alias("v"))
    share = min(1.0, 2.0 * sample / max(1, rows.count()))
    some = rows.where(F.pmod("h", F.lit(1 << 20)) < int(share * (1 << 20)) + 1).orderBy("h").limit(sample).select("v").collect()
    if not some:
        return InvertedFile(np.zeros((1, 1)), np.zeros((1, BITS)), 1)
    x = _unit(np.array([r.v for r in some], float))
    rng = np.random.default_rng(seed)
    # planes at right angles within each set estimate angles better than independent ones
    sets = [np.linalg.qr(rng.normal(size=(x.shape[1], x.shape[1])))[0] for _ in range(-(-BITS // x.shape[1]))]
    lists = max(1, min(128, round(len(x) ** 0.5 / 2)))
    index = InvertedFile(_spherical_kmeans(x, lists, rng), np.concatenate(sets, axis=1)[:, :BITS], lists)
    q = x[:SAMPLE_QUERIES]
    scores = q @ x.T
    scores[np.arange(len(q)), np.arange(len(q))] = -np.inf
    best = np.argsort(-scores, axis=1)[:, :k]
    own = index.nearest(x, 1)[:, 0]
    place = np.argsort(index.nearest(q, lists), axis=1)          # of each list in the query's order
    visits = np.take_along_axis(place, own[best], axis=1).ravel()
    index.probes = int(np.quantile(visits, LIST_RECALL, method="higher")) + 1
    return index


def _coded(df: DataFrame, index: InvertedFile, id_col: str, vec_col: str, probes: int) -> DataFrame:
    """(id, list, code words): a row for each of the nearest ``probes`` lists of a vector."""
    def run(parts):
        for batch in parts:
            v = batch.column(1)
            x = _unit(v.values.to_numpy().reshape(len(v), -1)[:, :index.centroids.shape[1]]) if len(v) else np.zeros((0, index.centroids.shape[1]))
            near, code = index.nearest(x, probes), index.codes(x)
            at = np.repeat(np.arange(len(x)), near.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)), pa.array(near.ravel().astype(np.int32)),
                 *[pa.array(np.ascontiguousarray(code[at, i])) for i in range(len(_CODES))]], names=["id", "list", *_CODES])
    given = indexable(df, vec_col).select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    return given.mapInArrow(run, "id long, list int, " + ", ".join(f"{c} long" for c in _CODES))


def ann_candidates(index: InvertedFile, table: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id",
                   vec_col: str = "embedding", exclude_self: bool = True) -> DataFrame:
    """(qid, id): the rows of visited lists with the fewest differing bits, RERANK x k for each query.  The rows of a
    list are dealt over salts, so that few lists still fill all tasks; queries meet them in a shuffle, not in the driver."""
    n_queries, n_rows = queries.count(), table.count()
    lists = len(index.centroids)
    salts = -(-_salts(table, n_rows, n_queries) // lists)
    blocks, chunks = max(1, -(-n_queries // BLOCK)), max(1, -(-n_rows // (lists * salts * CHUNK)))
    row = F.struct("id", F.col("id").alias("key"), *_CODES)
    t = (_coded(table, index, id_col, vec_col, 1)
         .select(row.alias("_t"), F.pmod(F.xxhash64("id", *_CODES), F.lit(salts * chunks)).cast("int").alias("_chunk"), "list")
         .withColumn("_salt", F.col("list") * salts + F.pmod("_chunk", F.lit(salts)))
         .repartition(lists * salts, "_salt")
         .groupBy("_salt", "_chunk").agg(F.collect_list("_t").alias("_ts")))
    q = (_coded(queries, index, "qid", "qvec", index.probes)
         .groupBy("list", F.pmod(F.xxhash64("id", *_CODES), F.lit(blocks)).alias("_block"))
         .agg(F.collect_list(row).alias("_qs"))
         .withColumn("_salt", F.explode(F.sequence(F.col("list") * salts, F.col("list") * salts + (salts - 1))))
         .repartition(lists * salts, "_salt"))
    joined = q.join(t.hint("merge"), "_salt").select("_salt", "_block", "_qs", "_ts")
    schema = StructType([StructField(id_col, LongType()), StructField("qid", LongType()), StructField("score", DoubleType())])
    pairs = _pairs(joined, schema, _Codes.of, RERANK * k, RERANK * k, None, exclude_self)
    w = Window.partitionBy("qid").orderBy(F.desc("score"), id_col)
    return pairs.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= RERANK * k).select("qid", id_col)


def ann_search(candidates: DataFrame, table: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id",
               vec_col: str = "embedding") -> DataFrame:
    """V5: (qid, id, score, rank), the nearest k candidates of each query by their cosine."""
    t = unit_vectors(table.select(id_col, vec_col), vec_col).select(id_col, "_u")
    q = unit_vectors(queries.select("qid", "qvec"), "qvec", "_q").select("qid", "_q")
    # vectors are not broadcast: their bytes would pass through the driver
    scored = candidates.join(t.hint("merge"), id_col).join(q.hint("merge"), "qid").select("qid", id_col, _dot(F.col("_q"), F.col("_u")).alias("score"))
    return top_k(scored, k, id_col)
