"""Language identification by the nearest centroid.

A text is a vector of hashed byte n-grams (1 to 3 bytes, ASCII letters lower-cased),
log term frequency times inverse document frequency, of length one.  Each language has
several centroids: spherical k-means over a bounded sample of its training rows.  A text
gets the language of the centroid with the largest cosine, and is rejected when it is
further from it than that language's limit: just below the cosine that all but the worst
hundredth of the language's training rows reach.  A short text cannot come near any
centroid, so below ``SHORT`` bytes the limit falls with the root of the length, for the
training rows as well.  A centroid of a few odd rows (or of one row in another language)
would draw texts of unlearned languages: clusters do not start from the rows furthest from
the mean, and small ones are dissolved.

Document frequencies are counted over all training rows (each task adds up its own, Spark
adds up the tasks).  The sample has at most ``SAMPLE_ROWS`` rows of a language, taken by
the smallest hash of the row; k-means runs per language in a task of its own.

Null texts and texts without a letter are ``und`` with score 0 and rejected; so is every
text when there is nothing to learn from.  Repeated rows get the same answer.  Texts of
any length are read whole; of equal cosines the first centroid wins (languages in order); further
columns travel as a struct.  An empty
table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, FloatType, IntegerType, StringType,
                               StructField, StructType)

from kestrel.llm.batches import slices, text_bytes, with_columns
from kestrel.llm.common import smallest_hashes, text_key, written

DIMENSIONS = 4096
SAMPLE_ROWS = 600
CENTROIDS = 4
ROUNDS = 12
#: A language's limit: this part of the cosine that 99 of 100 of its training rows reach.
REJECT_PART = 0.9
SHORT = 400
#: Share of rows too far from the mean to start a cluster, and least share (and rows) of a cluster.
ODD_SHARE, LEAST_SHARE, LEAST_ROWS = 0.1, 0.02, 5

_LETTER = regex.compile(r"\p{L}")
#: Bytes of letters as they are (all of UTF-8 beyond ASCII counts as letters), others as a space.
_LETTERS = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], np.int64)


def counts(text: bytes) -> np.ndarray:
    """Counts of the hashed 1-, 2- and 3-grams of bytes of the lower-cased text; all that is not
    a letter counts as a space, and spaces in a row as one."""
    x = _LETTERS[np.frombuffer(text.decode("utf-8", "replace").lower().encode(), np.uint8)]
    x = np.concatenate([x[:1], x[1:][(x[1:] != 32) | (x[:-1] != 32)]])
    grams = [x]
    if len(x) > 1:
        two = x[:-1] * 257 + x[1:] + 7919
        grams.append(two)
        if len(x) > 2:
            grams.append(two[:-1] * 263 + x[2:] + 104729)
    mixed = np.concatenate(grams) * 2654435761
    return np.bincount((mixed >> 11) % DIMENSIONS, minlength=DIMENSIONS)


def vectors(texts: list[bytes], idf: np.ndarray) -> np.ndarray:
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    for i, t in enumerate(texts):
        if t:
            out[i] = np.log1p(counts(t)) * idf
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    out /= np.where(norm > 0, norm, 1)
    return out


def shortness(texts: list[bytes]) -> np.ndarray:
    """The factor of a text's limit: 1 from SHORT bytes on."""
    return np.sqrt(np.minimum(1.0, np.array([len(t) for t in texts]) / SHORT))


def _rounds(x: np.ndarray, c: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Centroids after ``rounds`` rounds, and the number of rows of each."""
    c = c.copy()
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        for j in range(len(c)):
            if (own == j).any():
                m = x[own == j].mean(axis=0)
                c[j] = m / max(np.linalg.norm(m), 1e-12)
    return c, np.bincount((x @ c.T).argmax(axis=1), minlength=len(c))


def clustered(x: np.ndarray, short: np.ndarray, k: int = CENTROIDS, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Centroids of length one by spherical k-means, and the lower hundredth of the cosines of
    the rows, each over its factor ``short``.  Starts from the row nearest to the mean, then from
    the row furthest from all starts so far; rows of clusters that stay too small join the others."""
    near = x @ x.mean(axis=0)
    body = np.flatnonzero(near >= np.quantile(near, ODD_SHARE))
    starts = [int(near.argmax())]
    while len(starts) < min(k, len(body)):
        starts.append(int(body[(x[body] @ x[starts].T).max(axis=1).argmin()]))
    c, size = _rounds(x, x[starts], rounds)
    enough = size >= min(max(LEAST_ROWS, LEAST_SHARE * len(x)), size.max())
    if not enough.all():
        c, _ = _rounds(x, c[enough], rounds)
    return c, float(np.quantile((x @ c.T).max(axis=1) / np.maximum(short, 1e-6), 0.01, method="lower"))


@dataclass
class Model:
    idf: np.ndarray
    langs: list[str]          # of each centroid
    centroids: np.ndarray
    limits: np.ndarray        # least cosine that is not rejected


def fit(train: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample_rows: int = SAMPLE_ROWS, centroids: int = CENTROIDS, reject_part: float = REJECT_PART) -> Model:
    """Learns from the rows of ``train`` whose language is not null."""
    spark = train.sparkSession
    rows = train.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        F.col("lang").isNotNull() & (F.length("text") > 0))

    def frequencies(parts):
        total, n = np.zeros(DIMENSIONS, np.int64), 0
        for batch in parts:
            for t in text_bytes(batch.column(0)):
                total += counts(t) > 0
                n += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(np.arange(DIMENSIONS), -1).astype(np.int32)), pa.array(np.append(total, n))], names=["f", "n"])
    df = (rows.select("text").mapInArrow(frequencies, "f int, n long")
          .groupBy("f").agg(F.sum("n").alias("n")).toPandas())            # DIMENSIONS + 1 rows
    freq = np.zeros(DIMENSIONS + 1)
    freq[df["f"].to_numpy(np.int64)] = df["n"]
    idf = np.log((1 + freq[-1]) / (1 + freq[:-1])) + 1

    # a bounded sample: ids first, without texts; rows that share an id are cut again with their text
    ids = written(smallest_hashes(rows.select("id", "lang").distinct(), "lang", "id", sample_rows), "lang-sample")
    picked = rows.join(ids, ["id", "lang"], "left_semi").withColumn("k", text_key(F.col("id"), F.col("text"))[0])
    w = Window.partitionBy("lang").orderBy("k")
    picked = picked.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= sample_rows).select("lang", "text")

    def cluster(key, table):
        texts = text_bytes(table.column("text").combine_chunks())
        x = np.concatenate([vectors(texts[a:b], idf) for a, b in slices(texts)])
        c, low = clustered(x, shortness(texts), centroids)
        return pa.table({"lang": pa.array([key[0].as_py()] * len(c)), "k": pa.array(range(len(c)), pa.int32()),
                         "low": pa.array([low] * len(c), pa.float64()), "centroid": pa.array(list(c), pa.list_(pa.float32()))})
    schema = StructType([StructField("lang", StringType()), StructField("k", IntegerType()),
                         StructField("low", DoubleType()), StructField("centroid", ArrayType(FloatType()))])
    found = picked.groupBy("lang").applyInArrow(cluster, schema).orderBy("lang", "k").collect()
    return Model(idf, [r.lang for r in found],
                 np.array([r.centroid for r in found], np.float32).reshape(-1, DIMENSIONS),
                 np.array([r.low for r in found]) * reject_part)


def identify(df: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(row, lang_pred, score, rejected): the input row (or its columns ``keep``), the language, the
    cosine (0 to 1) and whether it is too small."""
    m = model

    def compute(texts: list[bytes]) -> list:
        lettered = np.array([_LETTER.search(t.decode("utf-8", "replace")) is not None for t in texts])
        if not len(m.langs):
            return [["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)]
        cos = np.clip(vectors(texts, m.idf) @ m.centroids.T, 0.0, 1.0)
        best = cos.argmax(axis=1)
        score = np.where(lettered, cos[np.arange(len(texts)), best], 0.0).astype(float)
        return [[m.langs[b] if ok else "und" for b, ok in zip(best, lettered)], score,
                ~lettered | (score < m.limits[best] * shortness(texts))]
    return with_columns(df, text_col, [StructField("lang_pred", StringType()), StructField("score", DoubleType()),
                                       StructField("rejected", BooleanType())], compute, keep)
