"""SimHash near-dedup with Golay-code fuzzy hashing.

A text's fingerprint has a bit for each of 64 hash bits that more than half of its word
shingles have set.  Fingerprints that differ in ``MAX_BITS`` = 4 bits at most are linked;
documents that can be reached over links form a component.

Candidates come from the (23, 12) Golay code, which is perfect: every 23-bit word lies
within 3 bits of exactly one codeword.  A segment of a fingerprint gets the index of that
codeword and, if it is 3 bits off, of the five codewords 4 bits off too: one or six keys.
Two segments that differ in 2 bits at most share a key.  (If they differ by one bit, the
codeword nearest to either is within 4 bits of the other; with two, the same holds for
the word between them.)

Pigeonhole over four 16-bit parts, for 4 differing bits in all:

* a part without a differing bit: the other 48 bits are two segments, and one of them has
  2 differing bits at most.  Key: the equal part, and a codeword of that segment;
* no such part: every part has exactly one.  Any segment inside two parts has 2 at most, and
  parities of the parts change together.  Key: a codeword for either half, and the
  changes of parity from part to part.

Distinct fingerprints are joined with themselves by key inside the join operator: only pairs
that really differ in 4 bits at most leave it, and a pair that several families of keys would
find leaves it in the first that must find it.  Copies share a fingerprint and cost nothing.
Both sides of the join are plain shuffles by key, so Spark can split the keys of a large
cluster of near copies.  Components are found by alternating star steps over written tables.

Null texts and texts without words have the fingerprint 0, which is linked like any other.
Rows may repeat; null ids take no part in the smallest id of a component (which is null
if all are).  A bit that exactly half of the shingles have is 0.  Texts of any length are read whole;
the columns of a row travel as a struct.  An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from kestrel.llm.batches import with_columns
from kestrel.llm.common import text_key, written

SHINGLE = 4
MAX_BITS = 4
SEED = 42


# ------------------------------------------------------------------ fingerprints
def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint as an unsigned number.  Lower-casing and splitting of bytes touch ASCII only."""
    w = text.lower().split()
    if not w:
        return 0
    ends = np.cumsum([len(x) + 1 for x in w]) - 1
    line = b" ".join(w)
    if len(w) <= shingle:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        first = [0, *(ends[:len(w) - shingle] + 1).tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], SEED) for a, b in zip(first, ends[shingle - 1:].tolist())]
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 4096):
        block = np.array(hashes[i:i + 4096], "<u8")
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, text_col: str = "text", shingle: int = SHINGLE, keep: list[str] | None = None) -> DataFrame:
    """(row, fingerprint): the input row (or its columns ``keep``) and a (signed) bigint."""
    def compute(texts: list[bytes]) -> list:
        return [np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)]
    return with_columns(df, text_col, [StructField("fingerprint", LongType())], compute, keep)


# ------------------------------------------------------------------ Golay code
class Golay:
    """For each 23-bit word the one or six codewords it is keyed by."""
    POLYNOMIAL = 0b101011100011    # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1

    def __init__(self):
        unit = [self._remainder(1 << i) for i in range(23)]
        self.low = self._sums(unit[:11])
        self.high = self._sums(unit[11:])
        self.errors = np.zeros((2048, 6), np.int64)      # error patterns of a syndrome
        self.count = np.zeros(2048, np.int64)
        for weight in range(5):
            for bits in combinations(range(23), weight):
                s = 0
                for b in bits:
                    s ^= unit[b]
                first = self.errors[s, 0].item().bit_count() if self.count[s] else None
                if first is None or (first == 3 and weight == 4):
                    self.errors[s, self.count[s]] = sum(1 << b for b in bits)
                    self.count[s] += 1

    def _remainder(self, x: int) -> int:
        for i in range(22, 10, -1):
            if x >> i & 1:
                x ^= self.POLYNOMIAL << (i - 11)
        return x

    @staticmethod
    def _sums(unit: list[int]) -> np.ndarray:
        out = np.zeros(1 << len(unit), np.int64)
        for i, u in enumerate(unit):
            out[1 << i:2 << i] = out[:1 << i] ^ u
        return out

    def keys(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(n, 6) codeword indexes (the upper 12 bits) of 23-bit words, and which of them count."""
        s = self.low[x & 2047] ^ self.high[x >> 11]
        return (x[:, None] ^ self.errors[s]) >> 11, np.arange(6) < self.count[s][:, None]


def _others(i: int) -> list[int]:
    return [j for j in range(4) if j != i]


def fuzzy_keys(fp: np.ndarray, golay: Golay) -> tuple[np.ndarray, np.ndarray]:
    """All keys of the fingerprints (unsigned), as (index of fingerprint, key); the family of a
    key is ``key >> 40``.  Family 2 i + h: part i equal, half h of the other 48 bits close."""
    fp = fp.astype(np.uint64)
    parts = [((fp >> np.uint64(16 * i)) & np.uint64(0xFFFF)).astype(np.int64) for i in range(4)]
    rows, keys = [], []
    for i in range(4):
        a, b, c = (parts[j] for j in _others(i))
        # 48 bits: two segments of 23 bits, two bits stay out
        for half, segment in enumerate(((a | (b & 0x7F) << 16), (b >> 8 | (c & 0x7FFF) << 8))):
            k, ok = golay.keys(segment)
            r, col = np.nonzero(ok)
            rows.append(r)
            keys.append((2 * i + half) << 40 | parts[i][r] << 12 | k[r, col])
    left, lok = golay.keys(parts[0] | (parts[1] & 0x7F) << 16)
    right, rok = golay.keys(parts[2] | (parts[3] & 0x7F) << 16)
    odd = [(np.bitwise_count(p) & 1).astype(np.int64) for p in parts]
    turn = (odd[0] ^ odd[1]) | (odd[1] ^ odd[2]) << 1 | (odd[2] ^ odd[3]) << 2
    r, i6, j6 = np.nonzero(lok[:, :, None] & rok[:, None, :])
    rows.append(r)
    keys.append(8 << 40 | turn[r] << 24 | left[r, i6] << 12 | right[r, j6])
    return np.concatenate(rows), np.concatenate(keys)


def _signed(mask: int):
    return F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long")


def _must_find(family: int, diff: Column) -> Column:
    """Whether two fingerprints with the difference ``diff`` surely share a key of a family 0 to 7."""
    i, half = divmod(family, 2)
    a, b, c = (16 * j for j in _others(i))
    segment = (0xFFFF << a | 0x7F << b) if half == 0 else (0xFF00 << b | 0x7FFF << c)
    return (diff.bitwiseAND(_signed(0xFFFF << 16 * i)) == 0) & (F.bit_count(diff.bitwiseAND(_signed(segment))) <= 2)


# ------------------------------------------------------------------ components
def _pairs_in_order(edges: DataFrame) -> DataFrame:
    """(u, v) with u > v, each once."""
    return (edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())


def components(edges: DataFrame, name: str = "cc", one_task: int = 0) -> DataFrame:
    """(u, root) for every node of ``edges`` (u, v) that is not the least of its component.  Up to
    ``one_task`` edges (counted) go without shuffles, which would cost more than their work."""
    edges = written(_pairs_in_order(edges), f"{name}-0")
    few = one_task > 0 and edges.count() <= one_task
    together = (lambda d: d.coalesce(1)) if few else (lambda d: d)      # one partition needs no shuffle
    edges, step, before = written(together(edges), f"{name}-few") if few else edges, 0, None
    while True:
        edges = together(edges)
        both = together(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # large star: the larger neighbours of a node move to its least neighbour
        large = _pairs_in_order(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        # small star: a node and its smaller neighbours move to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        step += 1
        edges = written(_pairs_in_order(together(small.select("u", F.col("m").alias("v")).unionByName(
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))))), f"{name}-{step}")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            # one least neighbour for each node: stars
            return edges.select("u", F.col("v").alias("root"))
        before = now


def link(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """From distinct fingerprints (fp): (fp, root), root being the least fingerprint of the
    component, for every fingerprint that is not that itself."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the keys find fingerprints that differ in up to {MAX_BITS} bits")

    def keyed(parts):
        golay = Golay()
        for batch in parts:
            fp = batch.column(0).to_numpy()
            for a in range(0, len(fp), 2048):
                rows, keys = fuzzy_keys(fp[a:a + 2048].view(np.uint64), golay)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fp[a:a + 2048][rows])], names=["key", "fp"])
    keys = fps.select("fp").mapInArrow(keyed, "key long, fp long")
    x, y = keys.alias("x"), keys.alias("y")
    diff, family = F.col("x.fp").bitwiseXOR(F.col("y.fp")), F.shiftright(F.col("x.key"), 40)
    once = (F.bit_count(diff) <= max_bits) & (F.col("x.fp") > F.col("y.fp"))
    for f in range(8):
        once = once & ((family <= f) | ~_must_find(f, diff))
    found = (x.join(y.hint("merge"), (F.col("x.key") == F.col("y.key")) & once)
             .select(F.col("x.fp").alias("u"), F.col("y.fp").alias("v")))
    return components(found, "simhash").withColumnRenamed("u", "fp")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: id, fingerprint (bigint) and component_id, the least id in reach."""
    rows = _components(df, id_col, text_col, shingle, max_bits)
    return rows.select("id", "fingerprint", "component_id")


def representatives(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``df`` of which each stands for its component: the one with the least id (a
    null id only if there is no other)."""
    rows = _components(df, id_col, text_col, shingle, max_bits)
    best = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "k1", "k2"))
    chosen = rows.groupBy("root").agg(best.alias("b")).select("b.k1", "b.k2")
    k1, k2 = text_key(F.col(id_col), F.col(text_col))
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), k1.alias("k1"), k2.alias("k2"))
    # rows equal in id and text: one of them
    return packed.join(chosen, ["k1", "k2"]).dropDuplicates(["k1", "k2"]).select("row.*")


def _components(df: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int) -> DataFrame:
    """(id, k1, k2, fingerprint, root, component_id) for each row."""
    k1, k2 = text_key(F.col(id_col), F.col(text_col))
    rows = df.select(F.col(id_col).alias("id"), k1.alias("k1"), k2.alias("k2"), F.col(text_col).alias("text"))
    rows = written(fingerprints(rows, "text", shingle, ["id", "k1", "k2"]).select("row.*", "fingerprint"), "simhash-rows")
    of = rows.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("id").alias("low"))
    of = written(of, "simhash-distinct")
    roots = written(of.join(link(of.select("fp"), max_bits), "fp", "left")
                    .select("fp", "low", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    least = roots.groupBy("root").agg(F.min("low").alias("component_id"))
    comp = roots.join(least, "root").select(F.col("fp").alias("fingerprint"), "root", "component_id")
    return rows.join(comp, "fingerprint")
