"""Quality classifier: a byte-level convolutional network in numpy.

Input symbols: a byte, and whether the ``GRAM`` bytes from it on also stand up to ``LAGS``
bytes before (a repeated word looks like any other byte by byte).  Layers:

* an embedding of ``EMBEDDING`` numbers for each symbol;
* ``FILTERS`` learned filters over chunks of ``CHUNK`` bytes that overlap by half and cover
  the whole document (the end is padded), rectified;
* the maximum of each filter over all chunks;
* one logistic unit.

For scoring, embedding and filters are multiplied out once into a table for each place in
a chunk, so a chunk costs one table row for each byte.

The network is fitted by Adam on a bounded sample of labelled rows: at most ``SAMPLE_ROWS``
of each label, by the smallest hash of the id, of these the ones with at most
``SAMPLE_BYTES`` bytes.  The gradient passes through the chunk with the maximum only.  The
sample has as many rows of each label; the bias is then moved to the share of labels over
all training rows, so the score is a probability under that share.

Null and empty texts are one chunk of padding and get the score of that.  Repeated rows
get the same score.  Texts of any length are scored whole, further columns travel as a struct (no name
can clash), and equal maxima of a filter give the same score.  With rows of one label only, the score is the share of label 1.  An
empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from kestrel.llm.batches import joined, slices, with_columns
from kestrel.llm.common import smallest_hashes, written

CHUNK = 32
HALF = CHUNK // 2
EMBEDDING = 8
FILTERS = 16
GRAM = 6
LAGS = (3, 20)
SYMBOLS = 2 * 256 + 1
PAD = SYMBOLS - 1
SAMPLE_ROWS = 1500
SAMPLE_BYTES = 16_384
EPOCHS = 14
#: Steps of Adam at least, for small samples.
STEPS = 400
BATCH = 64
RATE = 0.01


def symbols(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(half chunks, HALF) of symbols, and the first half chunk of each text.  A text has two
    half chunks at least, and PAD fills its last one."""
    raw, ends = joined(texts)
    flag = np.zeros(len(raw), bool)
    if len(raw) > GRAM:
        x = raw.astype(np.uint64)
        gram = np.zeros(len(raw) - GRAM + 1, np.uint64)
        for j in range(GRAM):
            gram |= x[j:len(raw) - GRAM + 1 + j] << np.uint64(8 * j)
        # bytes of its own text before each place; -1 where the bytes from it on reach into the next text
        size = np.diff(ends)
        own = (np.arange(len(raw)) - np.repeat(ends[:-1], size)).astype(np.int32)
        own[own + GRAM > np.repeat(size, size)] = -1
        own = own[:len(gram)]
        for lag in range(LAGS[0], LAGS[1] + 1):
            if len(gram) > lag:
                flag[lag:len(gram)] |= (gram[lag:] == gram[:-lag]) & (own[lag:] >= lag)
    sizes = np.maximum(2, -(-np.diff(ends) // HALF))
    starts = np.concatenate([[0], np.cumsum(sizes)])
    out = np.full(starts[-1] * HALF, PAD, np.int16)
    sym = raw + flag * np.int16(256)
    for i in range(len(texts)):
        out[starts[i] * HALF:starts[i] * HALF + ends[i + 1] - ends[i]] = sym[ends[i]:ends[i + 1]]
    return out.reshape(-1, HALF), starts


@dataclass
class Network:
    embedding: np.ndarray     # (SYMBOLS, EMBEDDING)
    filters: np.ndarray       # (CHUNK, EMBEDDING, FILTERS)
    shift: np.ndarray         # (FILTERS,)
    weights: np.ndarray       # (FILTERS,)
    bias: float

    def tables(self) -> np.ndarray:
        """(CHUNK, SYMBOLS, FILTERS): what a symbol at a place in the chunk adds to each filter."""
        return np.einsum("se,cef->csf", self.embedding, self.filters).astype(np.float32)

    def chunks(self, halves: np.ndarray, starts: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """(chunks, FILTERS) before rectifying; chunk i is half chunks i and i + 1.  The last half
        chunk of a text begins no chunk and gets minus infinity."""
        first = np.zeros((len(halves), FILTERS), np.float32)
        second = np.zeros((len(halves), FILTERS), np.float32)
        for j in range(HALF):
            first += tables[j].take(halves[:, j], axis=0)
            second += tables[HALF + j].take(halves[:, j], axis=0)
        first[:-1] += second[1:]
        first[starts[1:] - 1] = -np.inf
        return first + self.shift.astype(np.float32)

    def scores(self, texts: list[bytes], tables: np.ndarray) -> np.ndarray:
        halves, starts = symbols(texts)
        pooled = np.maximum(np.maximum.reduceat(self.chunks(halves, starts, tables), starts[:-1], axis=0), 0)
        return 1 / (1 + np.exp(-np.clip(pooled @ self.weights + self.bias, -30, 30)))


def fit_network(texts: list[bytes], labels: np.ndarray, prior: float, epochs: int = EPOCHS, seed: int = 1) -> Network:
    """``prior``: the share of label 1 that the scores should assume."""
    rng = np.random.default_rng(seed)
    net = Network(rng.normal(0, 0.3, (SYMBOLS, EMBEDDING)), rng.normal(0, 0.1, (CHUNK, EMBEDDING, FILTERS)),
                  np.zeros(FILTERS), rng.normal(0, 0.3, FILTERS), 0.0)
    odds = np.log(prior / (1 - prior)) if 0 < prior < 1 else np.inf * (1 if prior >= 1 else -1)
    if len(set(labels.tolist())) < 2:
        return Network(net.embedding, net.filters, net.shift, np.zeros(FILTERS), float(np.clip(odds, -5, 5)))
    parts = [symbols([t])[0] for t in texts]
    params = {"embedding": net.embedding, "filters": net.filters, "shift": net.shift, "weights": net.weights,
              "bias": np.zeros(1)}
    m, v = ({k: np.zeros_like(x) for k, x in params.items()} for _ in range(2))
    step = 0
    share = labels.mean()
    epochs = max(epochs, min(200, -(-STEPS * BATCH // len(texts))) if epochs == EPOCHS else 0)
    for epoch in range(epochs):
        rate = RATE * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
        order = rng.permutation(len(texts))
        for b in range(0, len(order), BATCH):
            own = order[b:b + BATCH]
            halves = np.concatenate([parts[i] for i in own])
            starts = np.concatenate([[0], np.cumsum([len(parts[i]) for i in own])])
            z = net.chunks(halves, starts, net.tables())
            top = np.stack([z[s:e].argmax(axis=0) + s for s, e in zip(starts[:-1], starts[1:])])   # (docs, FILTERS)
            pooled = np.maximum(np.take_along_axis(z, top, axis=0), 0)
            p = 1 / (1 + np.exp(-np.clip(pooled @ net.weights + params["bias"][0], -30, 30)))
            y = labels[own]
            # both labels weigh the same, whatever their numbers in the sample
            g = (p - y) * np.where(y == 1, 0.5 / share, 0.5 / (1 - share)) / len(own)
            gz = (g[:, None] * net.weights) * (pooled > 0)                                       # (docs, FILTERS)
            syms = np.concatenate([halves[top], halves[np.minimum(top + 1, len(halves) - 1)]], axis=2)
            emb = net.embedding[syms]                                                            # (docs, F, CHUNK, E)
            grad = {"weights": pooled.T @ g, "bias": np.array([g.sum()]), "shift": gz.sum(axis=0),
                    "filters": np.einsum("df,dfce->cef", gz, emb),
                    "embedding": np.zeros_like(net.embedding)}
            np.add.at(grad["embedding"], syms, np.einsum("df,cef->dfce", gz, net.filters))
            step += 1
            for k, x in params.items():
                gk = grad[k] + 1e-5 * x
                m[k] = 0.9 * m[k] + 0.1 * gk
                v[k] = 0.999 * v[k] + 0.001 * gk * gk
                x -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    net.bias = float(params["bias"][0] + np.clip(odds, -5, 5))
    return net


def fit(train: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> Network:
    """Learns from the rows of ``train`` that ``labels`` marks (ids with several labels count as
    label 1 if most of them are)."""
    ids = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
           .groupBy(F.col(id_col).alias("id")).agg((F.avg(label_col) > 0.5).cast("int").alias("y")))
    ids = ids.join(train.select(F.col(id_col).alias("id")).distinct(), "id", "left_semi")
    ids = written(ids, "quality-labels")
    share = ids.agg(F.avg("y")).first()[0]
    if share is None:
        return fit_network([], np.zeros(0), 0.5)
    picked = written(smallest_hashes(ids, "y", "id", sample_rows), "quality-ids")
    # at most 2 * sample_rows ids
    rows = (train.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("t"))
            .where(F.octet_length("t") <= sample_bytes)
            .join(F.broadcast(picked), "id").groupBy("id", "y").agg(F.min("t").alias("t")).orderBy("id").collect())
    return fit_network([bytes(r.t) for r in rows], np.array([r.y for r in rows], float), float(share))


def score(df: DataFrame, net: Network, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(row, score): the input row (or its columns ``keep``) and a score from 0 to 1."""
    tables = net.tables()

    def compute(texts: list[bytes]) -> list:
        return [np.concatenate([net.scores(texts[a:b], tables) for a, b in slices(texts, 1 << 18)])]
    return with_columns(df, text_col, [StructField("score", DoubleType())], compute, keep)
