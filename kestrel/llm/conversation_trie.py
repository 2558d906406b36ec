"""Prefix trie of conversations, counted in tables with minimal perfect hashes.

A conversation is rebuilt first: it begins with some turns of the first conversation of its hundred,
then go on its own turns (``rebuilt``).  A node of the trie is a distinct sequence of first turns
(role, text); the root is the empty one.  Its digest is the XOR of two 64-bit hashes of (place, role, text)
over its turns, so the digests of all prefixes are running XORs, and a node's parent has the
digest without the last turn.

* Distinct digests are enumerated with the counts of their members (a hash aggregation; every row of
  a digest must agree on depth, parent and length of the last text, or the job stops).
* Nodes are dealt to shards by whole subtrees.  The rows below a node bound the nodes of its
  subtree; a node with more than ``SHARD_ROWS`` rows below it is heavy, its ancestors are too, and a shard takes
  the subtrees that hang below heavy nodes (``anchors``), about ``SHARD_ROWS`` nodes to a shard however many
  conversations begin alike.
* In a shard a minimal perfect hash (``SlotTable``) gives each digest a slot, and each slot is verified
  against its digest.  Counts are scattered into flat numpy arrays by slot, the parent's slot is one more
  array, and the arrays are added up from the deepest level to the top.
* A heavy node's sums are those of what hangs below the heavy nodes.  Each such subtree, and each heavy
  node itself, belongs to one conversation, its smallest member, whose heavy prefixes get its
  amount: a running sum down each of these conversations (cut in ranges, so a long one is no
  single task), then a sum by digest.

The ids of conversations that end in a node are joined in pieces (in ranges ordered by node and
id), and the pieces are hashed one after the other, so no list of members is held.

Defined results.  Rows with a null conv_id belong to no conversation.  A null role or text counts as
empty.  Turns are in the order of ``turn`` (null first), ties in the order of role and text; repeated rows are
turns of their own.  A conversation without turns after rebuilding is a member of the root only.  Texts of any length are
compared whole (by hash).  An empty table gives no node.  Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from kestrel.llm.common import written
from kestrel.operators.cumulative import running

#: Rows below a node that make it heavy, and nodes of a shard on average.
SHARD_ROWS = 1 << 15
#: A conversation takes up to BORROWED - 1 turns of the first one of its BLOCK.
BLOCK = 100
BORROWED = 6
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
_NODE = ["x1", "x2"]


# ------------------------------------------------------------------ rebuilt conversations
def turns(df: DataFrame) -> DataFrame:
    """(conv_id, part, place, h1, h2, chars): the turns in order, written.  ``place`` counts from 1;
    ``part`` numbers the ranges that hold a conversation's turns, which bounds the rows of one."""
    order = [F.col("conv_id"), F.asc_nulls_first("turn"), F.col("role"), F.col("text")]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                     F.coalesce("text", F.lit("")).alias("text")).where("conv_id IS NOT NULL")
    hashed = (rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .select("conv_id", F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(1), "text", "role").alias("h2"),
                      F.char_length("text").cast("long").alias("chars"), F.monotonically_increasing_id().alias("at")))
    # written once: the bounds of ranges come from a sample and may differ when taken again
    rows = written(hashed, "trie-turns").withColumn("part", F.shiftright("at", 33))
    per = rows.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("conv_id", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return written(rows.join(per, ["conv_id", "part"]).select(
        "conv_id", "part", (F.col("at") - F.col("first") + F.col("before") + 1).alias("place"), "h1", "h2", "chars"), "trie-places")


def rebuilt(places: DataFrame) -> DataFrame:
    """(conv_id, turns, part, depth, t1, t2, chars): the turns of rebuilt conversations; every
    conversation has a row of depth 0, too."""
    own = places.groupBy("conv_id").agg(F.max("place").alias("n"))
    wanted = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % BORROWED).cast("long")
    convs = own.select("conv_id", "n", wanted.alias("h"), (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("base"))
    taken = convs.join(own.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n")), "base", "left").select(
        "conv_id", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("k"),
        F.greatest(F.col("n") - F.col("h"), F.lit(0)).alias("rest"))
    taken = written(taken.withColumn("turns", F.col("k") + F.col("rest")), "trie-convs")
    first = places.where((F.col("conv_id") % BLOCK == 0) & (F.col("place") < BORROWED)).withColumnRenamed("conv_id", "base")
    borrowed = (taken.where("k > 0").select("conv_id", "turns", "base", "k").join(first, "base").where("place <= k")
                .select("conv_id", "turns", F.lit(-1).cast("long").alias("part"), F.col("place").alias("depth"), "h1", "h2", "chars"))
    kept = (places.join(taken.select("conv_id", "turns", "h", "k"), "conv_id").where("place > h")
            .select("conv_id", "turns", "part", (F.col("place") - F.col("h") + F.col("k")).alias("depth"), "h1", "h2", "chars"))
    top = taken.select("conv_id", "turns", F.lit(-2).cast("long").alias("part"), F.lit(0).cast("long").alias("depth"),
                       F.lit(0).cast("long").alias("t1"), F.lit(0).cast("long").alias("t2"), F.lit(0).cast("long").alias("chars"))
    return borrowed.unionByName(kept).select(
        "conv_id", "turns", "part", "depth", F.xxhash64("depth", "h1", "h2").alias("t1"),
        F.xxhash64(F.lit(1), "h2", "depth", "h1").alias("t2"), "chars").unionByName(top)


def prefixes(rows: DataFrame) -> DataFrame:
    """(conv_id, turns, depth, x1, x2, p1, p2, chars): each prefix of each rebuilt conversation by digest, with
    the digest of its parent (the root's: its own)."""
    rows = written(rows, "trie-rebuilt")
    per = rows.groupBy("conv_id", "part").agg(F.bit_xor("t1").alias("t1"), F.bit_xor("t2").alias("t2"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("conv_id", "part", *[F.coalesce(F.bit_xor(t).over(before), F.lit(0)).alias(f"o{t}") for t in ("t1", "t2")])
    upto = Window.partitionBy("conv_id", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    inner = rows.select("*", F.bit_xor("t1").over(upto).alias("i1"), F.bit_xor("t2").over(upto).alias("i2"))
    x1, x2 = F.col("i1").bitwiseXOR(F.col("ot1")), F.col("i2").bitwiseXOR(F.col("ot2"))
    return written(inner.join(per, ["conv_id", "part"]).select(
        "conv_id", "turns", "depth", x1.alias("x1"), x2.alias("x2"), x1.bitwiseXOR(F.col("t1")).alias("p1"),
        x2.bitwiseXOR(F.col("t2")).alias("p2"), "chars"), "trie-prefixes")


# ------------------------------------------------------------------ nodes and shards
def _same(c: str) -> Column:
    """The one value of a group; two different ones stop the job."""
    return F.when(F.min(c) == F.max(c), F.min(c)).otherwise(
        F.raise_error(F.lit("two sequences of turns have one digest")).cast("long")).alias(c)


def nodes(rows: DataFrame) -> DataFrame:
    """(x1, x2, p1, p2, conv_id, depth, n_convs, own, below): the distinct prefixes, written.  ``own``: what the
    node itself saves; ``below``: rows in its subtree."""
    return written(rows.groupBy("x1", "x2").agg(
        _same("p1"), _same("p2"), F.min("conv_id").alias("conv_id"), _same("depth"), F.count(F.lit(1)).alias("n_convs"),
        _same("chars"), F.sum(F.col("turns") - F.col("depth") + 1).alias("below"))
        .withColumn("own", (F.col("n_convs") - 1) * F.col("chars")).drop("chars"), "trie-nodes")


class SlotTable:
    """Minimal perfect hash of digests (pairs of 64-bit numbers): n digests have the slots 0 to n - 1.

    Level by level the digests are thrown into twice as many places as there are digests left; one alone
    in its place has found it, the others go on to the next level.  The slot is the number of taken places before
    it.  The digests are kept by slot, so that a digest that is not in the table is known to be none."""

    MAX_LEVELS = 100

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        rest, before = np.arange(len(a)), 0
        while len(rest):
            if len(self.levels) == self.MAX_LEVELS:
                raise ValueError("a digest occurs twice")
            at = self._place(a[rest], b[rest], len(self.levels), 2 * len(rest))
            taken = np.bincount(at, minlength=2 * len(rest)) == 1
            self.levels.append((taken, before + np.cumsum(taken) - 1))
            before += int(taken.sum())
            rest = rest[~taken[at]]
        slot = self._slots(a, b)
        if len(a) and not (np.bincount(slot, minlength=len(a)) == 1).all():
            raise ValueError("two digests have one slot")
        self.a, self.b = np.empty_like(a), np.empty_like(b)
        self.a[slot], self.b[slot] = a, b

    @staticmethod
    def _place(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
        x = (a ^ np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % (1 << 64))) * np.uint64(0xFF51AFD7ED558CCD)
        x = ((x ^ (x >> np.uint64(33))) + b) * np.uint64(0xC4CEB9FE1A85EC53)
        return ((x ^ (x >> np.uint64(29))) % np.uint64(size)).astype(np.int64)

    def _slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out, rest = np.full(len(a), -1), np.arange(len(a))
        for level, (taken, rank) in enumerate(self.levels):
            at = self._place(a[rest], b[rest], level, len(taken))
            out[rest] = np.where(taken[at], rank[at], -1)
            rest = rest[~taken[at]]
        return out

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The slots of digests, -1 for those that are not in the table."""
        slot = self._slots(a, b)
        if not len(self.a):
            return slot
        return np.where((slot >= 0) & (self.a[slot] == a) & (self.b[slot] == b), slot, -1)


_TOTALS = StructType([StructField(n, LongType()) for n in (
    "x1", "x2", "p1", "p2", "conv_id", "depth", "n_convs", "parent_conv_id", "n_children", "n_leaves", "saved_tokens")])


def shard_totals(table: pa.Table) -> pa.Table:
    """Children, leaves and savings of the nodes of one shard (whole subtrees).  ``parent_conv_id`` is null
    where the parent is in no shard."""
    of = {n: table.column(n).to_numpy() for n in ("x1", "x2", "p1", "p2", "conv_id", "depth", "n_convs", "own")}
    x1, x2, p1, p2 = (of[n].view(np.uint64) for n in ("x1", "x2", "p1", "p2"))
    slots = SlotTable(x1, x2)
    slot, parent = slots.find(x1, x2), slots.find(p1, p2)
    parent[of["depth"] == 0] = -1
    flat = {n: np.empty(len(slot), np.int64) for n in ("conv_id", "depth", "saved", "parent")}
    for n, values in (("conv_id", of["conv_id"]), ("depth", of["depth"]), ("saved", of["own"]), ("parent", parent)):
        flat[n][slot] = values
    inside = flat["parent"] >= 0
    children = np.bincount(flat["parent"][inside], minlength=len(slot))
    leaves = (children == 0).astype(np.int64)
    # the deepest level first; every level passes its sums on to its parents
    order = np.argsort(-flat["depth"], kind="stable")
    ends = np.flatnonzero(np.diff(flat["depth"][order], append=-1)) + 1
    for level in np.split(order, ends[:-1]):
        level = level[inside[level]]
        np.add.at(leaves, flat["parent"][level], leaves[level])
        np.add.at(flat["saved"], flat["parent"][level], flat["saved"][level])
    above = np.where(inside, flat["conv_id"][flat["parent"]], 0)
    columns = [*[table.column(n) for n in ("x1", "x2", "p1", "p2", "conv_id", "depth", "n_convs")],
               pa.array(above[slot], pa.int64(), mask=~inside[slot]),
               *[pa.array(v[slot].astype(np.int64)) for v in (children, leaves, flat["saved"])]]
    return pa.table(columns, names=_TOTALS.names)


def totals(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(x1, x2, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens) of every node."""
    every = nodes(rows)
    heavy = every.where(F.col("below") > shard_rows)
    on_heavy = written(rows.join(heavy.select(*_NODE), _NODE).select("conv_id", "depth", *_NODE), "trie-heavy")
    # the depth at which a conversation leaves the heavy nodes, and its node there
    cut = on_heavy.groupBy("conv_id").agg((F.max("depth") + 1).alias("cut"))
    anchors = (rows.join(cut, "conv_id", "left").withColumn("cut", F.coalesce("cut", F.lit(0)))
               .where("depth = cut").select("conv_id", "cut", F.xxhash64(*_NODE).alias("anchor")))
    light = every.where(F.col("below") <= shard_rows).join(anchors, "conv_id")
    n = max(1, -(-every.count() // shard_rows))
    sharded = written(light.withColumn("shard", F.pmod("anchor", F.lit(n))).drop("anchor", "cut", "below")
                      .groupBy("shard").applyInArrow(shard_totals, _TOTALS), "trie-shards")

    # heavy nodes: children are heavy nodes or tops of shards' subtrees
    tops = sharded.where("parent_conv_id IS NULL AND depth > 0")
    children = (tops.select("p1", "p2").unionByName(heavy.where("depth > 0").select("p1", "p2"))
                .groupBy(F.col("p1").alias("x1"), F.col("p2").alias("x2")).agg(F.count(F.lit(1)).alias("n_children")))
    heavy = written(heavy.join(children, _NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-heavy-nodes")
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")
    amounts = (tops.select("conv_id", (F.col("depth") - 1).alias("depth"), "n_leaves", "saved_tokens")
               .unionByName(heavy.select("conv_id", "depth", leaf.alias("n_leaves"), F.col("own").alias("saved_tokens")))
               .groupBy("conv_id", "depth").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")))
    paths = (on_heavy.join(amounts.select("conv_id").distinct(), "conv_id", "left_semi").join(amounts, ["conv_id", "depth"], "left")
             .fillna(0, ["n_leaves", "saved_tokens"]))
    upto = running(paths, ["conv_id"], "depth", ["n_leaves", "saved_tokens"], descending=True)
    sums = upto.groupBy(*_NODE).agg(F.sum("cum_n_leaves").alias("n_leaves"), F.sum("cum_saved_tokens").alias("saved_tokens"))
    top = heavy.join(sums, _NODE).withColumn("parent_conv_id", F.lit(None).cast("long")).select(*_TOTALS.names)

    # parents of the nodes whose parent is heavy
    outer = tops.unionByName(top).drop("parent_conv_id").join(
        heavy.select(F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("conv_id").alias("above")), ["p1", "p2"], "left")
    outer = outer.withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.col("above")))
    kept = [n for n in _TOTALS.names if n not in ("p1", "p2")]
    return sharded.where("parent_conv_id IS NOT NULL OR depth = 0").select(*kept).unionByName(outer.select(*kept))


# ------------------------------------------------------------------ members that end in a node
def end_hashes(rows: DataFrame) -> DataFrame:
    """(x1, x2, ends_sha256) of the nodes in which conversations end."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ends = rows.where("depth = turns").select("x1", "x2", "conv_id")
    ordered = ends.repartitionByRange(n, *ends.columns).sortWithinPartitions(*ends.columns)

    def runs(x1: np.ndarray, x2: np.ndarray) -> list[tuple[int, int]]:
        new = np.flatnonzero((np.diff(x1) != 0) | (np.diff(x2) != 0)) + 1
        return list(zip([0, *new.tolist()], [*new.tolist(), len(x1)])) if len(x1) else []

    def pieces(parts):
        # the ids of one node in one batch, joined
        for batch in parts:
            x1, x2, ids = (batch.column(i).to_numpy() for i in range(3))
            at = runs(x1, x2)
            first = [i for i, _ in at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x1[first]), pa.array(x2[first]), pa.array(ids[first]),
                 pa.array([",".join(map(str, ids[i:j].tolist())) for i, j in at], pa.string())], names=["x1", "x2", "first", "piece"])

    def digests(parts):
        node, sha = None, None
        for batch in parts:
            out = []
            for x1, x2, piece in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if (x1, x2) != node:
                    if node:
                        out.append((*node, sha.hexdigest()))
                    node, sha = (x1, x2), hashlib.sha256(piece.encode())
                else:
                    sha.update(b"," + piece.encode())
            yield _digest_batch(out)
        if node:
            yield _digest_batch([(*node, sha.hexdigest())])
    joined = ordered.mapInArrow(pieces, "x1 long, x2 long, first long, piece string")
    return (joined.repartition(n, *_NODE).sortWithinPartitions("x1", "x2", "first")
            .mapInArrow(digests, "x1 long, x2 long, ends_sha256 string"))


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    x1, x2, sha = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(x1, pa.int64()), pa.array(x2, pa.int64()), pa.array(sha, pa.string())],
                                      names=["x1", "x2", "ends_sha256"])


def trie(df: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The nodes of the trie of the rebuilt conversations of ``df`` (conv_id, turn, role, text): conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows = prefixes(rebuilt(turns(df)))
    out = totals(rows, shard_rows).join(end_hashes(rows), _NODE, "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"))
