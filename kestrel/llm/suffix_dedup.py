"""Removal of long repeated byte strings with run-length indexes of the Burrows-Wheeler transform.

Every byte covered by a string of ``length`` bytes that also starts somewhere else (in the same
document or another) is removed.  A window is such a string at one place.

1. Every window has an anchor: of the ``gram``-byte strings in it, the one with the smallest
   hash (the first of equal ones).  Windows in a row with the same anchor form a segment.
   Equal windows have equal anchors at the same place, so equal windows lie in segments that
   share the anchor's hash.
2. Segments (anchor, hash of the whole segment, no text) are counted.  An anchor found once has
   nothing to match.  A segment found twice or more is repeated from end to end.
3. What is left are segments found once whose anchor has other segments: the edges of repeated
   passages.  Their texts, with one copy of each repeated segment of such an anchor, go to the
   task of their anchor, which takes them in chunks and builds a run-length index of each: the suffix
   order of the chunk, its Burrows-Wheeler transform cut into runs of equal bytes, and
   samples at both ends of the runs.  Streaming over the text, the samples give every
   position's longest match with its neighbours in suffix order: one comparison of texts at
   each sample, one byte less at each position after it.  A match of ``length`` bytes or
   more marks the window.
4. An anchor with more than ``index_segments`` different segments (a passage that very many
   documents share, each with its own surroundings) is not given to one task.  The hashes of
   its segments' windows are counted instead, in a plain shuffle that is added up map-side.
5. The marks of a document are joined with its text, and the bytes they cover go.

Hashes are two polynomial hashes of 64 bits each.  Null text counts as empty.  Rows equal in id
and text are documents of their own and repeat each other.  Documents shorter than
``length`` lose nothing; longer ones, of any size, are read whole, and of equal smallest hashes the first is
the anchor.  Other columns are not read.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from kestrel.llm.batches import joined, slices, text_bytes
from kestrel.llm.common import text_key, written

LENGTH = 400
GRAM = 64
#: Different segments of one anchor that are indexed in one task; anchors with more go by hash.
INDEX_SEGMENTS = 2000
#: Bytes of segments that one index takes (the segments of one anchor stay together).
CHUNK_BYTES = 1 << 19
#: Documents with segments to index up to which their keys (two numbers each) are broadcast, so
#: that only those documents' texts are shuffled; beyond it all are.
FEW_KEYS = 1_000_000

_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_POWERS: dict = {}


# ------------------------------------------------------------------ hashes and segments
def _powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each base its powers 0..n and those of its inverse, modulo 2**64."""
    if _POWERS.get("n", -1) < n:
        n = max(n, 1 << 21)
        out = []
        for base in _BASES:
            inverse = np.uint64(pow(int(base), -1, 1 << 64))
            both = []
            for b in (base, inverse):
                p = np.full(n + 1, b, np.uint64)
                p[0] = 1
                both.append(np.cumprod(p, dtype=np.uint64))
            out.append(tuple(both))
        _POWERS.update(n=n, p=out)
    return _POWERS["p"]


class Hashes:
    """Hashes of any part of a byte array, from prefix sums."""

    def __init__(self, raw: np.ndarray):
        self.powers = _powers(len(raw) + 1)
        x = raw.astype(np.uint64) + np.uint64(1)
        self.sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * p[:len(raw)], dtype=np.uint64)])
                     for p, _ in self.powers]

    def of(self, start: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
        """Hash number ``which`` of the bytes from start to end (arrays or slices of positions)."""
        h = (self.sums[which][end] - self.sums[which][start]) * self.powers[which][1][start]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ h >> np.uint64(29)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    size, m = 1, x
    while size * 2 <= width:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    rest = width - size
    return np.minimum(m[:len(m) - rest], m[rest:]) if rest else m


def segments(raw: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[Hashes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, text, first window, end of windows, anchor) of all segments of the joined texts."""
    h = Hashes(raw)
    none = np.zeros(0, np.int64)
    if len(raw) < length:
        return h, none, none, none, none
    n = len(raw) - gram + 1
    at = np.arange(n)
    # upper bits of the hash, then the position: the minimum is the first of equal hashes
    bits = np.uint64(max(1, int(n).bit_length()))
    packed = (h.of(slice(0, n), slice(gram, gram + n), 0) >> bits << bits) | at.astype(np.uint64)
    anchor = (_sliding_min(packed, length - gram + 1) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    windows = np.maximum(0, np.diff(ends) - length + 1)
    text = np.repeat(np.arange(len(windows)), windows)
    # windows of the texts, without those that reach into the next one
    start = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows) + ends[:-1][text]
    own = anchor[start]
    new = np.ones(len(start), bool)
    new[1:] = (own[1:] != own[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    stop = np.append(first[1:], len(start))
    return h, text[first], start[first], start[stop - 1] + 1 if len(first) else none, own[first]


# ------------------------------------------------------------------ run-length index
class RunLengthIndex:
    """Longest matches inside a collection of byte strings (UTF-8: no byte 0xFF)."""

    def __init__(self, strings: list[bytes]):
        self.starts = np.cumsum([0, *[len(s) + 1 for s in strings]])
        self.text = np.frombuffer(b"\xff".join([*strings, b""]), np.uint8)
        self.left = np.repeat(self.starts[1:], np.diff(self.starts)) - np.arange(len(self.text))   # to the end mark, included
        self.ranks: list[np.ndarray] = []
        self._sort()
        self._runs()

    def _sort(self) -> None:
        """Suffix order by doubling; what follows a string's end mark does not count, and equal
        suffixes are in the order of the text."""
        n = len(self.text)
        x = np.concatenate([self.text, np.zeros(8, np.uint8)]).astype(np.uint64)
        key = np.zeros(n, np.uint64)
        for j in range(8):
            key |= np.where(self.left > j, x[j:j + n], np.uint64(0)) << np.uint64(8 * (7 - j))
        size, longest = 8, int(np.diff(self.starts).max(initial=1))
        self.first = key
        order = np.argsort(key, kind="stable")
        while True:
            k = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.concatenate([[0], k[1:] != k[:-1]]))
            self.ranks.append(rank)
            if size >= longest:
                break
            after = np.zeros(n, np.int64)
            after[:max(0, n - size)] = rank[size:] + 1
            after[self.left <= size] = 0
            key = rank * (n + 1) + after
            order = np.argsort(key, kind="stable")
            size *= 2
        self.order = order

    def _runs(self) -> None:
        """Run-compressed transform: position of every run's first and last suffix."""
        before = self.text[self.order - 1]          # the byte before; the text is cyclic
        change = before[1:] != before[:-1]
        # the transform breaks at end marks: they are different symbols
        change |= before[1:] == 0xFF
        head = np.concatenate([[True], change])
        self.heads = np.flatnonzero(head)
        self.tails = np.append(self.heads[1:], len(self.order)) - 1

    def _common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Bytes that the suffixes at i and j have in common, up to their end marks."""
        i, j = i.copy(), j.copy()
        most = np.minimum(self.left[i], self.left[j]) - 1
        total = np.zeros(len(i), np.int64)
        for level in range(len(self.ranks) - 1, -1, -1):
            size, r = 8 << level, self.ranks[level]
            # two steps: the sum of all smaller sizes is one byte short of what may be left
            for _ in range(2):
                same = (most - total >= size) & (r[np.minimum(i, len(r) - 1)] == r[np.minimum(j, len(r) - 1)])
                step = np.where(same, size, 0)
                total, i, j = total + step, i + step, j + step
        for _ in range(8):
            same = (total < most) & (self.text[np.minimum(i, len(self.text) - 1)] == self.text[np.minimum(j, len(self.text) - 1)])
            total, i, j = total + same, i + same, j + same
        return total

    def matches(self) -> np.ndarray:
        """For each position of the text the longest match with another suffix."""
        n = len(self.order)
        best = np.zeros(n, np.int64)
        # the suffix before (at run heads) and the suffix after (at run tails)
        for at, other in ((self.heads[1:], self.heads[1:] - 1), (self.tails[:-1], self.tails[:-1] + 1)):
            place = self.order[at]
            found = self._common(place, self.order[other])
            edge = self.order[0 if other is not None and len(at) and other[0] < at[0] else n - 1]   # no neighbour on that side
            samples = np.full(n, -1, np.int64)
            samples[edge] = 0
            samples[place] = found
            # the last sample before each position, one byte less for each step since
            latest = np.maximum.accumulate(np.where(samples >= 0, np.arange(n), -1))
            value = np.where(latest >= 0, samples[np.maximum(latest, 0)] - (np.arange(n) - latest), 0)
            best = np.maximum(best, value)
        return np.minimum(best, self.left - 1)


def repeated_windows(strings: list[bytes], length: int) -> list[np.ndarray]:
    """For each string the starts of windows of ``length`` bytes that also start elsewhere in the strings."""
    index = RunLengthIndex(strings)
    hit = index.matches() >= length
    return [np.flatnonzero(hit[a:b - 1]) for a, b in zip(index.starts[:-1], index.starts[1:])]


def _intervals(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows (sorted starts) as maximal runs [from, to) of covered bytes."""
    if not len(starts):
        return starts, starts
    cut = np.flatnonzero(np.diff(starts) > length) + 1
    return starts[np.concatenate([[0], cut])], starts[np.append(cut, len(starts)) - 1] + length


# ------------------------------------------------------------------ Spark steps
def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def _batch(names: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names.split())


def _rows(length: int, gram: int):
    """Arrow function over (k1, k2, text): a row for each segment."""
    def run(parts: Iterator[pa.RecordBatch]):
        for batch in parts:
            texts = text_bytes(batch.column(2))
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for a, b in slices(texts):
                raw, ends = joined(texts[a:b])
                h, text, first, stop, anchor = segments(raw, ends, length, gram)
                if len(text):
                    base = ends[text]
                    yield _batch("k1 k2 a s first stop shift", k1[a:b][text], k2[a:b][text], _signed(h.of(anchor, anchor + gram, 1)),
                                 # the whole segment, and where its anchor is in it
                                 _signed(h.of(first, stop + length - 1, 0) ^ (anchor - first).astype(np.uint64)),
                                 (first - base).astype(np.int32), (stop - base).astype(np.int32),
                                 (anchor - first).astype(np.int32))
    return run


def _cut(length: int):
    """Arrow function over (k1, k2, text, a, d, n, first, stop, shift), arrays from a on: the texts of segments."""
    def run(parts: Iterator[pa.RecordBatch]):
        for batch in parts:
            texts = text_bytes(batch.column(2))
            for i, text in enumerate(texts):
                a, d, n, first, stop, shift = (batch.column(c)[i].values for c in range(3, 9))
                lo, hi = first.to_numpy(), stop.to_numpy() + length - 1
                k1, k2 = (np.full(len(lo), batch.column(c)[i].as_py(), np.int64) for c in (0, 1))
                for b in range(0, len(lo), 4096):
                    e = slice(b, b + 4096)
                    yield _batch("k1 k2 a d n first shift body", k1[e], k2[e], a[e], d[e], n[e], first[e], shift[e],
                                 pa.array([text[x:y] for x, y in zip(lo[e], hi[e])], pa.binary()))
    return run


def _indexed(length: int, chunk: int):
    """Arrow function over (a, n, k1, k2, first, body) sorted by a: spans of the segments with n = 1."""
    def spans(rows: list[tuple]) -> pa.RecordBatch:
        out = [[], [], [], []]
        for (_, n, k1, k2, first, _), starts in zip(rows, repeated_windows([r[5] for r in rows], length)):
            if n == 1 and len(starts):
                lo, hi = _intervals(starts, length)
                for column, values in zip(out, ([k1] * len(lo), [k2] * len(lo), lo + first, hi + first)):
                    column.extend(values)
        return _batch("k1 k2 lo hi", *[pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))])

    def run(parts: Iterator[pa.RecordBatch]):
        rows, size = [], 0
        for batch in parts:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if size >= chunk and row[0] != rows[-1][0]:
                    yield spans(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[5])
        if rows:
            yield spans(rows)
    return run


def _windows(length: int):
    """Arrow function over (a, n, k1, k2, first, shift, body): the hash of every window."""
    def run(parts: Iterator[pa.RecordBatch]):
        for batch in parts:
            bodies = text_bytes(batch.column(6))
            a, n, k1, k2, first, shift = (batch.column(c).to_numpy() for c in range(6))
            for b, e in slices(bodies):
                raw, ends = joined(bodies[b:e])
                h = Hashes(raw)
                count = np.diff(ends) - length + 1
                own = np.repeat(np.arange(b, e), count)
                place = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
                start = place + ends[own - b]
                yield _batch("a w n k1 k2 at", a[own],
                             _signed(h.of(start, start + length, 0) ^ (shift[own] - place).astype(np.uint64)),
                             n[own], k1[own], k2[own], (first[own] + place).astype(np.int32))
    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
                   index_segments: int = INDEX_SEGMENTS, chunk: int = CHUNK_BYTES) -> DataFrame:
    """From documents (k1, k2, text) the spans (k1, k2, lo, hi) of bytes to remove; they may overlap."""
    if not 0 < gram <= length:
        raise ValueError("gram must be between 1 and length")
    segs = written(docs.select("k1", "k2", "text").mapInArrow(
        _rows(length, gram), "k1 long, k2 long, a long, s long, first int, stop int, shift int"), "repeat-segments")
    # counts are written before they are joined: both sides of a join are then plain shuffles,
    # and Spark can split the rows of an anchor that a third of the documents have
    twice = written(segs.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a"), "repeat-anchors")
    found = written(segs.join(twice, "a", "left_semi"), "repeat-candidates")
    kinds = written(found.groupBy("a", "s").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(
        "k1", "k2", "first", "stop", "shift")).alias("p")), "repeat-kinds")
    whole = (found.join(kinds.where("n > 1").select("a", "s"), ["a", "s"], "left_semi")
             .select("k1", "k2", F.col("first").alias("lo"), (F.col("stop") + (length - 1)).alias("hi")))

    several = written(kinds.groupBy("a").agg(F.count(F.lit(1)).alias("d"), F.min("n").alias("least"))
                      .where("d > 1 and least = 1").select("a", "d"), "repeat-open")
    work = kinds.join(several, "a").select("a", "d", "n", "p.*")
    lists = written(work.groupBy("k1", "k2").agg(F.collect_list(F.struct("a", "d", "n", "first", "stop", "shift")).alias("x"))
                    .select("k1", "k2", *[F.col(f"x.{c}").alias(c) for c in ("a", "d", "n", "first", "stop", "shift")]),
                    "repeat-work")
    need = docs.select("k1", "k2", "text")
    if lists.limit(FEW_KEYS + 1).count() <= FEW_KEYS:
        need = need.join(F.broadcast(lists.select("k1", "k2")), ["k1", "k2"], "left_semi")
    # rows equal in id and text: one of them is enough here
    need = need.dropDuplicates(["k1", "k2"])
    cut = written(need.join(lists, ["k1", "k2"]).select("k1", "k2", "text", "a", "d", "n", "first", "stop", "shift")
                  .mapInArrow(_cut(length), "k1 long, k2 long, a long, d long, n long, first int, shift int, body binary"),
                  "repeat-texts")
    span = "k1 long, k2 long, lo int, hi int"
    indexed = (cut.where(F.col("d") <= index_segments).select("a", "n", "k1", "k2", "first", "body")
               .repartition("a").sortWithinPartitions("a").mapInArrow(_indexed(length, chunk), span))

    windows = written(cut.where(F.col("d") > index_segments).select("a", "n", "k1", "k2", "first", "shift", "body")
                      .repartition("k1", "first")
                      .mapInArrow(_windows(length), "a long, w long, n long, k1 long, k2 long, at int"), "repeat-windows")
    again = written(windows.groupBy("a", "w").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("a", "w"), "repeat-again")
    hashed = (windows.where("n = 1").join(again, ["a", "w"], "left_semi")
              .select("k1", "k2", F.col("at").alias("lo"), (F.col("at") + length).alias("hi")))
    return whole.unionByName(indexed).unionByName(hashed)


def remove_spans(text: bytes, lo: np.ndarray, hi: np.ndarray) -> tuple[bytes, int, int]:
    """(what is left, bytes removed, maximal removed runs)."""
    if not len(lo):
        return text, 0, 0
    edge = np.zeros(len(text) + 1, np.int64)
    np.add.at(edge, lo, 1)
    np.add.at(edge, hi, -1)
    gone = np.cumsum(edge[:-1]) > 0
    runs = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
    return np.frombuffer(text, np.uint8)[~gone].tobytes(), int(gone.sum()), runs


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   gram: int = GRAM, index_segments: int = INDEX_SEGMENTS, chunk: int = CHUNK_BYTES) -> DataFrame:
    """One row per input row: (id, n_bytes, n_removed, n_spans, kept), kept being the bytes left."""
    k1, k2 = text_key(F.col(id_col), F.col(text_col))
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), k1.alias("k1"), k2.alias("k2"))
    spans = written(repeated_spans(docs, length, gram, index_segments, chunk), "repeat-spans")
    lists = (spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("lo", "hi")).alias("x"))
             .select("k1", "k2", F.col("x.lo").alias("lo"), F.col("x.hi").alias("hi")))

    def removed(parts: Iterator[pa.RecordBatch]):
        for batch in parts:
            texts = text_bytes(batch.column(1))
            for a, b in slices(texts):
                out = []
                for i in range(a, b):
                    lo, hi = (batch.column(c)[i].values for c in (2, 3))
                    out.append(remove_spans(texts[i], lo.to_numpy(), hi.to_numpy()) if lo is not None else (texts[i], 0, 0))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array([len(t) for t in texts[a:b]], pa.int64()),
                     pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.int64()),
                     pa.array([x[0] for x in out], pa.binary())],
                    names=["id", "n_bytes", "n_removed", "n_spans", "kept"])
    joined_ = docs.join(lists, ["k1", "k2"], "left").select("id", "text", "lo", "hi")
    schema = StructType([joined_.schema["id"], *[StructField(c, LongType()) for c in ("n_bytes", "n_removed", "n_spans")],
                         StructField("kept", BinaryType())])
    return joined_.mapInArrow(removed, schema)
