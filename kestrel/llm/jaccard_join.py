"""Similarity join of documents by the Jaccard similarity of their word shingles, with parity sketches.

A document is the set of its distinct word shingles, each a 64-bit hash.  A parity sketch XORs, for every
shingle, the bit at the shingle's place; XORing two sketches leaves the parities of the symmetric difference,
so their Hamming distance is at most the size of that difference.  Two sets of a and b shingles
with a similarity of p percent or more differ in at most d = (100 - p)(a + b) / (100 + p) shingles.

* Pigeonhole.  Sizes are cut into bands [2^L, 2^(L+1)).  In band L the sketch has ``p`` segments, and every
  shingle falls into one.  Of two sets that differ in d shingles, at least p - d segments are equal.
  A segment's key is its content (the XOR of its shingles' hashes, which stands for the segment's
  bits) with the band, the segment's place and its number of shingles.  Keys have a global order, the ones of
  many shingles first (few documents have them by chance); two sets that share p - d of p keys share one
  among the first d + 1 of each, so a document emits no more than that.  Segments of common passages or
  without shingles come late in the order or are left out that way.  A document close to the upper end of its band takes part in the next one, too.
* Equal sets are one class, and only classes are joined.
* First round: in the group of a key, every class is paired with the least one only.  Pairs whose 512-bit
  sketches differ in more than d bits cannot be similar; the others are verified on the words of the whole
  texts.  The links give first components.
* Further rounds: only pairs with a key in common that are in different components can still matter, so
  only groups that hold several components go on, now with sketches.  In these, classes gather around the first
  class with a near sketch (``gathered``, at most ``LEADERS`` of them to a group): again one pair for each member.
  Of keys with the same classes one goes on, as the others would give the same pairs again.
* Last round: what is still in different components of one group is joined, sketches compared
  inside the join, and verified.  So no link between components is lost, while a large group of near
  copies costs as many pairs as it has members, not their square.  The join is by the least class of the
  group (``star_pairs``): long texts meet once for each of these, not for every key they have in common.

All these joins are plain shuffles, which Spark can split.  Components are found by
alternating star steps over written tables (as in ``simhash``).

Defined results.  Texts without words, and null texts, have an empty set: n_shingles 0, linked with nothing, the
component is the row's own id.  Fewer words than a shingle: the whole sequence is the one shingle.  Repeated rows are
one class.  A null id takes no part in the smallest id of a component (null if there is no other).  A
similarity exactly at the threshold is a link.  Texts of any length are taken whole.  An empty table gives an
empty result.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField

from kestrel.llm.batches import slices, text_bytes, with_columns
from kestrel.llm.common import text_key, written
from kestrel.llm.simhash import components

SHINGLE = 5
PERCENT = 80
WORDS = 8                   # 64-bit words of the sketch that the candidates are compared by
SKETCH = [f"s{i}" for i in range(WORDS)]
CLASS = ["c1", "c2"]
#: First classes that the others of a group are compared with in a further round, and such rounds at most.
LEADERS = 64
ROUNDS = 1
#: Pairs (counted) up to which they and the keys of their texts are broadcast, some tens of MB: only
#: those texts are shuffled then.  Beyond it all texts are.
FEW_PAIRS = 1 << 18
#: Links up to which components are found without shuffles.
FEW_LINKS = 1 << 18
#: Bytes of text that are worked on at once.
SLICE_BYTES = 1 << 19

_U = np.uint64
_BASE = 0x9E3779B97F4A7C55            # odd, so it has an inverse modulo 2^64


def _mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on all bits."""
    x = x + _U(salt)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Shingler:
    """Distinct shingles of many texts at once, as hashes."""

    def __init__(self, shingle: int):
        self.shingle = shingle
        self.power = self.inverse = np.ones(1, _U)

    def _powers(self, n: int) -> None:
        if len(self.power) <= n:
            with np.errstate(over="ignore"):
                def up(base: int) -> np.ndarray:
                    x = np.full(n + 1, base, _U)
                    x[0] = 1
                    return np.multiply.accumulate(x)
                self.power, self.inverse = up(_BASE), up(pow(_BASE, -1, 1 << 64))

    def words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(text, hash) of each word in order.  Lower-casing and splitting of bytes touch ASCII only."""
        line = np.frombuffer(b"\n".join(texts).lower(), np.uint8)
        self._powers(len(line))
        blank = (line == 32) | ((line >= 9) & (line <= 13))
        edge = np.flatnonzero(np.diff(blank.view(np.int8), prepend=1, append=1))
        start, end = edge[::2], edge[1::2]
        # hash of a word: its bytes as digits in a base modulo 2^64, from running sums
        sums = np.concatenate([np.zeros(1, _U), np.cumsum((line.astype(_U) + _U(1)) * self.power[:len(line)])])
        word = _mix((sums[end] - sums[start]) * self.inverse[start])
        ends = np.cumsum([len(t) + 1 for t in texts])
        return np.searchsorted(ends, start, side="right"), word

    def sets(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(text, hash) of the distinct shingles, in the order of texts."""
        text, word = self.words(texts)
        if not len(word):
            return text, word
        n = np.bincount(text, minlength=len(texts))
        first = np.concatenate([[0], np.cumsum(n)])[:-1]
        # place of each word that starts a shingle; a short text has one, at its first word
        size = np.minimum(n, self.shingle)
        starts = np.arange(len(word)) - first[text] <= (n - size)[text]
        at = np.flatnonzero(starts)
        of, h = text[at], np.zeros(len(at), _U)
        for i in range(self.shingle):
            inside = i < size[of]
            h = np.where(inside, _mix(h * _U(3) + word[np.minimum(at + i, len(word) - 1)], i + 1), h)
        order = np.lexsort((h, of))
        of, h = of[order], h[order]
        new = np.ones(len(h), bool)
        new[1:] = (of[1:] != of[:-1]) | (h[1:] != h[:-1])
        return of[new], h[new]


def _xor_by(group: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, _U)
    np.bitwise_xor.at(out, group, values)
    return out


def identities(n: int, of: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each text's set."""
    return (_xor_by(of, _mix(h, 0xA5A5), n).view(np.int64), _xor_by(of, _mix(h, 0x5A5A5A), n).view(np.int64))


def sketches(n: int, of: np.ndarray, h: np.ndarray) -> list[np.ndarray]:
    """The parity sketch of each text, word by word."""
    place = _mix(h, 77)
    width = 64 * WORDS
    bits = np.bincount(of * width + (place % _U(width)).astype(np.int64), minlength=n * width) & 1
    words = np.packbits(bits.astype(np.uint8).reshape(n, width), axis=1, bitorder="little").view("<i8")
    return [np.ascontiguousarray(words[:, i]) for i in range(WORDS)]


def difference(a, b, percent: int):
    """The largest symmetric difference of sets of a and b elements that are similar."""
    return (100 - percent) * (a + b) // (100 + percent)


def keys(sizes: np.ndarray, of: np.ndarray, h: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, key) of the keys that the texts emit."""
    # texts in their own band, and in the next one if a similar larger set can be there
    band = np.frexp(np.maximum(sizes, 1))[1] - 1
    largest = 100 * sizes // percent
    small = np.flatnonzero(sizes > 0)
    up = np.flatnonzero((sizes > 0) & (largest >= (2 << band)))
    text = np.concatenate([small, up])
    label = np.concatenate([band[small], band[up] + 1])
    top = (2 << label) - 1
    own = sizes[text]
    most = difference(own, np.minimum(top, largest[text]), percent)
    emitted = most > 0                       # sets with nothing to differ in are linked as one class
    text, label, top, most = text[emitted], label[emitted], top[emitted], most[emitted]
    if not len(text):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    d = difference(top, top, percent)
    parts = d + d // 2 + 1
    base = np.concatenate([[0], np.cumsum(parts)])
    # the shingles of each entry
    begin = np.searchsorted(of, text)
    n = sizes[text]
    entry = np.repeat(np.arange(len(text)), n)
    own = h[np.arange(len(entry)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin, n)]
    part = base[entry] + (_mix(own, 5) % parts[entry].astype(_U)).astype(np.int64)
    total = int(base[-1])
    count, content = np.bincount(part, minlength=total), _xor_by(part, own, total)
    # keys in their global order: many shingles first, then by hash
    entry = np.repeat(np.arange(len(text)), parts)
    place = np.arange(total) - base[entry]
    key = _mix(content ^ _mix((label[entry] << 40 | place).astype(_U), 9), 13) + count.astype(_U)
    order = np.lexsort((key, -count, entry))
    rank = np.arange(total) - base[entry]    # entries are in order and keep their places
    chosen = order[rank <= most[entry]]
    return text[entry[chosen]], key[chosen].view(np.int64)


# ------------------------------------------------------------------ tables
def prepared(df: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, k1, k2, n, c1, c2, s0 ...) of every row."""
    k1, k2 = text_key(F.col(id_col), F.col(text_col))
    rows = df.select(F.col(id_col).alias("id"), k1.alias("k1"), k2.alias("k2"), F.col(text_col).alias("text"))

    def compute(texts: list[bytes]) -> list:
        sets = Shingler(shingle)
        parts = []
        for a, b in slices(texts, SLICE_BYTES):
            n = b - a
            of, h = sets.sets(texts[a:b])
            c1, c2 = identities(n, of, h)
            parts.append([np.bincount(of, minlength=n), c1, c2, *sketches(n, of, h)])
        return [np.concatenate(x) for x in zip(*parts)]
    fields = [StructField("n", IntegerType()), *[StructField(c, LongType()) for c in (*CLASS, *SKETCH)]]
    return with_columns(rows, "text", fields, compute, ["id", "k1", "k2"]).select("row.*", "n", *CLASS, *SKETCH)


def keyed(df: DataFrame, text_col: str, shingle: int, percent: int) -> DataFrame:
    """(key, c1): the keys of each class; a task emits a class it has met before no second time."""
    def run(parts):
        sets, seen = Shingler(shingle), set()
        for batch in parts:
            texts = text_bytes(batch.column(0))
            for a, b in slices(texts, SLICE_BYTES):
                of, h = sets.sets(texts[a:b])
                c1, _ = identities(b - a, of, h)
                sizes = np.bincount(of, minlength=b - a)
                text, key = keys(sizes, of, h, percent)
                if len(seen) > 1 << 20:
                    seen.clear()
                fresh = np.ones(b - a, bool)
                for i, c in enumerate(c1.tolist()):
                    if c in seen:
                        fresh[i] = False
                    seen.add(c)
                keep = fresh[text]
                yield pa.RecordBatch.from_arrays([pa.array(key[keep]), pa.array(c1[text[keep]])], names=["key", "c1"])
    return df.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(run, "key long, c1 long")


def shared_keys(keyed_rows: DataFrame) -> DataFrame:
    """(key, c1, leader): the classes of keys that at least two classes have, and the least of them."""
    def groups(parts):
        # rows come ordered by key and class; the last key of a batch may go on in the next one
        key, leader, alone = None, None, None        # alone: a first row whose group has no second yet
        for batch in parts:
            k, c = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(k):
                continue
            new = np.ones(len(k), bool)
            new[1:] = k[1:] != k[:-1]
            new[0] = key is None or k[0] != key
            same = ~new
            same[1:] &= c[1:] == c[:-1]
            if not new[0]:
                same[0] = c[0] == last
            begin = np.flatnonzero(new)
            lead = np.empty(len(k), np.int64)
            group = np.cumsum(new) - 1
            if len(begin):
                lead = np.where(group >= 0, c[begin][np.maximum(group, 0)], leader if leader is not None else 0)
            else:
                lead[:] = leader
            keep = ~new & ~same                       # members after the first, each once
            size = np.bincount(group[keep] + 1, minlength=len(begin) + 1)
            first = begin[size[1:] > 0]               # first members of groups with others
            out_k, out_c = np.concatenate([k[first], k[keep]]), np.concatenate([c[first], c[keep]])
            out_l = np.concatenate([c[first], lead[keep]])
            if alone is not None and size[0]:
                out_k, out_c, out_l = (np.append(x, y) for x, y in ((out_k, alone[0]), (out_c, alone[1]), (out_l, alone[1])))
                alone = None
            if len(begin):
                alone = (k[begin[-1]], c[begin[-1]]) if size[-1] == 0 else None
                key, leader = k[begin[-1]], c[begin[-1]]
            last = c[-1]
            yield pa.RecordBatch.from_arrays([pa.array(out_k), pa.array(out_c), pa.array(out_l)], names=["key", "c1", "leader"])
    return keyed_rows.repartition("key").sortWithinPartitions("key", "c1").mapInArrow(groups, "key long, c1 long, leader long")


def _distance(x: str, y: str) -> Column:
    bits = [F.bit_count(F.col(f"{x}.{s}").bitwiseXOR(F.col(f"{y}.{s}"))) for s in SKETCH]
    return sum(bits[1:], bits[0])


def _near(x: str, y: str, percent: int) -> Column:
    """Whether sizes and sketches allow the similarity."""
    a, b = F.col(f"{x}.n").cast("long"), F.col(f"{y}.n").cast("long")
    return ((100 * F.least(a, b) >= percent * F.greatest(a, b))
            & ((100 + percent) * _distance(x, y) <= (100 - percent) * (a + b)))


def candidates(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(u, v), classes as structs, of the pairs of class hashes (u, v) that may be similar."""
    known = classes.select(*CLASS, "n", *SKETCH)
    x, y = known.alias("x"), known.alias("y")
    return (pairs.alias("p").join(x, F.col("p.u") == F.col("x.c1")).join(y, F.col("p.v") == F.col("y.c1"))
            .where(_near("x", "y", percent))
            .select(F.struct(*[F.col(f"x.{c}") for c in CLASS]).alias("u"), F.struct(*[F.col(f"y.{c}") for c in CLASS]).alias("v")))


def gathered(inside: DataFrame, percent: int) -> DataFrame:
    """(u, v): for each class of a key's group the first of its leaders with a near sketch, if that is in another
    component.  A class without one is a leader itself, as long as there are fewer than LEADERS."""
    columns = ["key", *CLASS, "r1", "r2", "n", *SKETCH]

    def groups(parts):
        key, leaders = None, []
        for batch in parts:
            c = {name: batch.column(i).to_numpy() for i, name in enumerate(columns)}
            if not len(c["key"]):
                continue
            sketch = np.stack([c[s] for s in SKETCH], 1).view(_U)
            n = c["n"].astype(np.int64)
            new = np.flatnonzero(np.diff(c["key"], prepend=c["key"][0] ^ 1))
            pairs: list[tuple[int, ...]] = []
            for a, b in zip(new.tolist(), [*new[1:].tolist(), len(n)]):
                if c["key"][a] != key:
                    key, leaders = c["key"][a], []
                rest, fresh = np.arange(a, b), 0
                while len(rest):
                    if fresh == len(leaders):
                        if len(leaders) == LEADERS:
                            break
                        i, rest = rest[0], rest[1:]
                        leaders.append((c["c1"][i], c["c2"][i], c["r1"][i], c["r2"][i], n[i], sketch[i]))
                    c1, c2, r1, r2, size, own = leaders[fresh]
                    fresh += 1
                    apart = np.bitwise_count(sketch[rest] ^ own).sum(axis=1, dtype=np.int64)
                    near = ((apart <= difference(n[rest], size, percent))
                            & (100 * np.minimum(n[rest], size) >= percent * np.maximum(n[rest], size)))
                    for i in rest[near & ((c["r1"][rest] != r1) | (c["r2"][rest] != r2))].tolist():
                        pairs.append((c1, c2, c["c1"][i], c["c2"][i]))
                    rest = rest[~near]
            out = np.unique(np.array(pairs, np.int64).reshape(-1, 4), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(out[:, i]) for i in range(4)], names=["u1", "u2", "v1", "v2"])
    rows = inside.select("key", *CLASS, F.col("root.c1").alias("r1"), F.col("root.c2").alias("r2"), "n", *SKETCH)
    found = (rows.repartition("key").sortWithinPartitions("key", "c1")
             .mapInArrow(groups, "u1 long, u2 long, v1 long, v2 long").distinct())
    return found.select(F.struct(F.col("u1").alias("c1"), F.col("u2").alias("c2")).alias("u"),
                        F.struct(F.col("v1").alias("c1"), F.col("v2").alias("c2")).alias("v"))


def mixed_groups(inside: DataFrame) -> DataFrame:
    """The rows of those keys whose classes are in several components."""
    several = inside.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("key")
    return inside.join(several, "key", "left_semi")


def different_groups(shared: DataFrame) -> DataFrame:
    """The rows of one key (the least) of those whose classes are the same: equal groups give the same pairs, and two
    long texts may have thousands of keys in common.  Sets are told apart by their size and two 64-bit hashes."""
    sets = shared.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("c1")).alias("a"),
                                     F.bit_xor(F.xxhash64(F.lit(1), "c1")).alias("b"))
    return shared.join(sets.groupBy("n", "a", "b").agg(F.min("key").alias("key")).select("key"), "key", "left_semi")


def star_pairs(inside: DataFrame, percent: int) -> DataFrame:
    """(u, v): the classes of different components with near sketches that are in groups with the same least class.
    Two long texts may have thousands of keys in common, in groups that differ by some members.  Members of one group
    have its least class in common, so each of their pairs is here, once for each least class they share."""
    least = inside.groupBy("key").agg(F.min("c").alias("least"))
    stars = written(inside.join(least, "key").select("least", "c", "root", "n", *SKETCH).distinct(), "jaccard-stars")
    x, y = stars.alias("x"), stars.alias("y")
    return (x.join(y.hint("merge"), (F.col("x.least") == F.col("y.least")) & (F.col("x.root") < F.col("y.root"))
                   & _near("x", "y", percent)).select(F.col("x.c").alias("u"), F.col("y.c").alias("v")))


def word_shingles(text: bytes, shingle: int) -> set[bytes]:
    w = text.lower().split()
    return {b" ".join(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))} if w else set()


def verified(pairs: DataFrame, classes: DataFrame, df: DataFrame, id_col: str, text_col: str, shingle: int, percent: int,
             name: str) -> DataFrame:
    """The pairs (u, v) that are similar, by the words of their texts; written."""
    pairs = written(pairs, f"{name}-pairs")
    few = F.broadcast if pairs.count() <= FEW_PAIRS else (lambda small: small)
    needed = pairs.select(F.col("u").alias("c")).unionByName(pairs.select(F.col("v").alias("c"))).distinct()
    chosen = classes.select(F.struct(*CLASS).alias("c"), "rep", "rows").join(few(needed), "c").select("c", "rep.k1", "rep.k2", "rows")
    k1, k2 = text_key(F.col(id_col), F.col(text_col))
    texts = (df.select(k1.alias("k1"), k2.alias("k2"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
             .join(few(chosen), ["k1", "k2"]).select("c", "text", "rows"))
    texts = written(texts, f"{name}-texts")
    if not texts.where("rows > 1").isEmpty():     # rows equal in id and text have one key
        texts = texts.dropDuplicates(["c"])
    both = (texts.select(F.col("c").alias("u"), F.col("text").alias("text_u")).join(few(pairs), "u")
            .join(texts.select(F.col("c").alias("v"), F.col("text").alias("text_v")), "v").select("u", "v", "text_u", "text_v"))

    def check(parts):
        for batch in parts:
            x, y = text_bytes(batch.column(2)), text_bytes(batch.column(3))
            keep, before, known = [], None, set()
            for s, t in zip(x, y):
                if t != before:                   # pairs with one v follow each other
                    before, known = t, word_shingles(t, shingle)
                own = word_shingles(s, shingle)
                common = len(own & known)
                keep.append(100 * common >= percent * (len(own) + len(known) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
    return written(both.mapInArrow(check, both.select("u", "v").schema), f"{name}-links")


def similar(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
            percent: int = PERCENT) -> DataFrame:
    """One row per input row: id, n_shingles and component_id, the least id in reach over pairs with a
    similarity of ``percent`` or more."""
    rows = written(prepared(df, id_col, text_col, shingle), "jaccard-rows")
    # rows of the class with the representative's key: equal in id and text
    keyed_rows = rows.where("n > 0").groupBy(*CLASS, "k1", "k2").agg(
        F.count(F.lit(1)).alias("rows"), F.min("id").alias("low"), F.first("n").alias("n"), *[F.first(s).alias(s) for s in SKETCH])
    best = F.min(F.struct("k1", "k2", "rows"))
    classes = written(keyed_rows.groupBy(*CLASS).agg(best.alias("rep"), F.min("low").alias("low"), F.first("n").alias("n"),
                                                     *[F.first(s).alias(s) for s in SKETCH])
                      .withColumn("rows", F.col("rep.rows")), "jaccard-classes")
    shared = written(shared_keys(keyed(df, text_col, shingle, percent)), "jaccard-shared")

    first = written(shared.where("c1 <> leader").select(F.col("leader").alias("u"), F.col("c1").alias("v")).distinct(), "jaccard-first")
    links = verified(candidates(first, classes, percent), classes, df, id_col, text_col, shingle, percent, "jaccard-1")
    one = written(components(links, "jaccard-cc1", FEW_LINKS).select(F.col("u").alias("c"), "root"), "jaccard-roots")
    member = written(classes.select(F.struct(*CLASS).alias("c"), F.col("c1"), "n", *SKETCH).join(one, "c", "left")
                     .withColumn("root", F.coalesce("root", "c")), "jaccard-members")

    # groups with classes of several components: one member at least differs from its leader's
    root = member.select("c1", "root")
    differ = (first.join(root.select(F.col("c1").alias("u"), F.col("root").alias("ru")), "u")
              .join(root.select(F.col("c1").alias("v"), F.col("root").alias("rv")), "v").where("ru <> rv")
              .select(F.col("u").alias("leader"), F.col("v").alias("c1")).distinct())
    mixed = shared.join(differ, ["leader", "c1"]).select("key").distinct()
    several = written(shared.join(mixed, "key").select("key", "c1"), "jaccard-several")
    inside = written(different_groups(several).join(member, "c1").drop("c2"), "jaccard-mixed")

    def with_roots(rows: DataFrame) -> DataFrame:
        roots = written(components(links, "jaccard-cc", FEW_LINKS).select(F.col("u").alias("c"), F.col("root").alias("now")), "jaccard-roots")
        return rows.join(roots, "c", "left").withColumn("root", F.coalesce("now", "c")).drop("now")

    for step in range(ROUNDS):
        near = gathered(inside.select("key", "c.*", "root", "n", *SKETCH), percent)
        more = verified(near, classes, df, id_col, text_col, shingle, percent, f"jaccard-{2 + step}")
        if more.isEmpty():
            break
        links = links.unionByName(more)
        inside = written(mixed_groups(with_roots(inside)), "jaccard-mixed")
    last = star_pairs(inside, percent).distinct()
    links = links.unionByName(verified(last, classes, df, id_col, text_col, shingle, percent, "jaccard-last"))

    roots = components(links, "jaccard-cc", FEW_LINKS).select(F.col("u").alias("c"), "root")
    group = written(classes.select(F.struct(*CLASS).alias("c"), *CLASS, "low").join(roots, "c", "left")
                    .select(*CLASS, "low", F.coalesce("root", "c").alias("root")), "jaccard-groups")
    least = group.groupBy("root").agg(F.min("low").alias("component_id"))
    known = group.join(least, "root").select(*CLASS, F.lit(True).alias("has"), "component_id")
    return (rows.select("id", "n", F.when(F.col("n") > 0, F.col("c1")).alias("c1"), F.when(F.col("n") > 0, F.col("c2")).alias("c2"))
            .join(known, CLASS, "left")
            .select("id", F.col("n").cast("long").alias("n_shingles"),
                    F.when(F.col("has"), F.col("component_id")).otherwise(F.col("id")).alias("component_id")))
