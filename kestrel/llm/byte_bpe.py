"""Byte-level BPE, encoding and decoding.

A text is cut by the tokenizer's pattern.  A word becomes an array of one-byte tokens, and a
fold merges, again and again, the neighbours with the lowest rank (the leftmost of equal
ones) until no neighbours have a rank; in these vocabularies the rank is the id.

Distinct words are folded by Spark higher-order functions over arrays; the rank map is a
literal of flat arrays in which a pair of ids has one place (``RankMap``).  These are the
words that occur most, counted over all documents: ``KNOWN_WORDS`` of them at most, of
``KNOWN_BYTES`` bytes at most, which bounds the table that tasks get.  The long tail of other
words has about as many distinct words as occurrences.  Folding it by higher-order functions
took three times the CPU time allowed (README), so tasks merge it themselves (``Merger``, the
same rule for many words at once) while they put the ids of a text together, and remember what they merged.

Decoding looks up the bytes of each id in a literal array and joins them.

Null and empty texts have no ids.  Repeated rows get the same result; texts and words of any
length are encoded whole, of equal ranks the leftmost pair merges, and columns travel as a struct.  An empty table gives an
empty result.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from kestrel.llm.batches import slices, text_bytes
from kestrel.llm.common import bind, written

KNOWN_WORDS = 1 << 17
KNOWN_BYTES = 32
#: Merged words that a task remembers at once, of this many bytes at most.
REMEMBERED = 300_000
LONGEST_REMEMBERED = 64
#: Words up to this many bytes are merged many at once.
SHORT = 48
#: In place of a rank where two neighbours do not merge.
NONE = 1 << 30
_ID_BITS = 17

#: White_Space of Unicode, which \s stands for in the tokenizers' patterns (in Java it is ASCII only).
_UNICODE_SPACE = "\\t\\n\\x0B\\f\\r\\x20\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000"


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of lines with the token in base64 and its rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def java_pattern(pattern: str) -> str:
    """The pattern with \\s and \\S spelled out, alone or inside a class."""
    out, inside, i = [], False, 0
    while i < len(pattern):
        two = pattern[i:i + 2]
        if two == "\\s":
            out.append(_UNICODE_SPACE if inside else f"[{_UNICODE_SPACE}]")
            i += 2
        elif two == "\\S":
            if inside:
                raise ValueError("\\S inside a class is not supported")
            out.append(f"[^{_UNICODE_SPACE}]")
            i += 2
        elif two[0] == "\\":
            out.append(two)
            i += 2
        else:
            inside = True if two[0] == "[" else False if two[0] == "]" else inside
            out.append(two[0])
            i += 1
    return "".join(out)


class RankMap:
    """Pairs of ids that merge, in flat arrays.  A left id has as many buckets as merges; the right id modulo their
    number is the pair's bucket, and modulo the number of the bucket's cells, enough for no two to clash, its cell.
    That is about two cells for a pair: the driver holds several copies of a literal while it sends it."""

    def __init__(self, ranks: dict[bytes, int]):
        if max(ranks.values()) >> _ID_BITS:
            raise ValueError(f"ids need more than {_ID_BITS} bits")
        left, right, rank = merges(ranks)
        n = max(ranks.values()) + 1
        buckets = np.maximum(np.bincount(left, minlength=n), 1)
        first = np.concatenate([[0], np.cumsum(buckets)])
        bucket = first[left] + right % buckets[left]
        sizes = np.maximum(np.bincount(bucket, minlength=first[-1]), 1)
        while True:
            place = right % sizes[bucket]
            order = np.lexsort((place, bucket))
            clash = (np.diff(bucket[order]) == 0) & (np.diff(place[order]) == 0)
            if not clash.any():
                break
            sizes[np.unique(bucket[order[1:]][clash])] += 1
        ends = np.concatenate([[0], np.cumsum(sizes)])
        cells = np.full(ends[-1], -1, np.int64)
        cells[ends[bucket] + place] = right << _ID_BITS | rank
        self.first, self.ends, self.cells = pa.array(first, pa.int32()), pa.array(ends, pa.int32()), pa.array(cells)
        self.bytes = pa.array([ranks.get(bytes([i]), NONE) for i in range(256)], pa.int32())
        # two bytes to the id they merge to
        self.two = pa.array([ranks.get(bytes([i, j]), NONE) for i in range(256) for j in range(256)], pa.int32())
        token = {r: t for t, r in ranks.items()}
        self.pieces = pa.array([token.get(i) for i in range(n)], pa.binary())


def merges(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(left, right, rank) of all pairs of ids that merge, in the order of left and right."""
    flat = array("q")
    for t, r in ranks.items():
        for i in range(1, len(t)):
            if t[:i] in ranks and t[i:] in ranks:
                flat.extend((ranks[t[:i]], ranks[t[i:]], r))
    pairs = np.frombuffer(flat, np.int64).reshape(-1, 3)
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    return pairs[:, 0], pairs[:, 1], pairs[:, 2]


@dataclass
class Tokenizer:
    """The ranks, the pattern, and the rank map and the pieces as literals (scalar subqueries) for column expressions."""
    ranks: dict[bytes, int]
    pattern: str
    merges: dict[str, Column]
    pieces: Column

    @staticmethod
    def load(spark: SparkSession, path: str, pattern: str) -> "Tokenizer":
        ranks = read_ranks(path)
        m = RankMap(ranks)
        arrays = {"first": m.first, "ends": m.ends, "cells": m.cells, "singles": m.bytes, "twos": m.two, "pieces": m.pieces}
        table = written(spark.createDataFrame(pa.table({k: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v)
                                                        for k, v in arrays.items()})), "bpe-literals")
        # pieces as strings of their bytes: the cast is made once, not for every token
        pieces = table.select(F.transform("pieces", lambda x: x.cast("string"))).scalar()
        return Tokenizer(ranks, java_pattern(pattern), {k: table.select(k).scalar() for k in arrays if k != "pieces"}, pieces)

    @staticmethod
    def rank(lit: Column, a: Column, b: Column) -> Column:
        """The id that two neighbours merge to, or NONE."""
        first, ends = lit["first"], lit["ends"]

        def inside(k):
            v = F.get(lit["cells"], F.get(ends, k) + F.pmod(b, F.get(ends, k + 1) - F.get(ends, k)))
            return F.when(F.shiftright(v, _ID_BITS) == b, v.bitwiseAND(F.lit((1 << _ID_BITS) - 1).cast("long")).cast("int")
                          ).otherwise(F.lit(NONE))
        return bind(F.get(first, a) + F.pmod(b, F.get(first, a + 1) - F.get(first, a)), inside)

    def fold(self, lit: Column, word: Column) -> Column:
        """The ids of one word; ``lit``: a struct of the literals of merges."""
        none = F.array().cast("array<int>")
        codes = F.transform(F.split(F.decode(F.encode(word, "UTF-8"), "ISO-8859-1"), ""), lambda c: F.ascii(c))

        def start(c):
            return F.struct(F.transform(c, lambda x: F.get(lit["singles"], x)).alias("ids"),
                            F.zip_with(c, F.slice(c, F.lit(2), F.size(c)), lambda x, y: F.coalesce(
                                F.get(lit["twos"], x * 256 + y), F.lit(NONE))).alias("r"))

        def merge(s, best, k):      # k: place (from 0) of the left one of the pair
            ids, r, n = s["ids"], s["r"], F.size(s["ids"])
            new = F.concat(F.slice(ids, F.lit(1), k), F.array(best), F.slice(ids, k + 3, n))
            left = F.when(k > 0, F.concat(F.slice(r, F.lit(1), k - 1), F.array(
                self.rank(lit, F.get(ids, k - 1), best)))).otherwise(none)
            # r has a NONE at its end, where nothing follows
            right = F.when(k + 2 < n, F.concat(F.array(self.rank(lit, best, F.get(ids, k + 2))),
                                               F.slice(r, k + 3, n))).otherwise(F.array(F.lit(NONE)))
            return F.struct(new.alias("ids"), F.concat(left, right).alias("r"))

        def step(s, _):
            return bind(F.array_min(s["r"]), lambda best: F.when(best == NONE, s).otherwise(
                bind((F.array_position(s["r"], best) - 1).cast("int"), lambda k: merge(s, best, k))))

        return bind(codes, lambda c: F.aggregate(F.sequence(F.lit(1), F.size(c)), start(c), step)["ids"])


def _words(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))


def _with_literals(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with scalar subqueries as columns.  The next projection uses each of them once, inside
    ``bind``, so the optimizer puts the subquery itself there: tasks hold its value once, rows do not."""
    return df.withColumns({f"__bpe_{k}": v for k, v in columns.items()})


def _merges(tok: Tokenizer) -> Column:
    return F.struct(*[_literal(n).alias(n) for n in tok.merges])


def _literal(name: str) -> Column:
    return F.col(f"__bpe_{name}")


def known_words(df: DataFrame, tok: Tokenizer, text_col: str) -> DataFrame:
    """(word, ids) of the most frequent short words, KNOWN_WORDS of them at most."""
    counts = written(df.select(F.explode(_words(F.col(text_col), tok.pattern)).alias("word"))
                     .where(F.octet_length("word") <= KNOWN_BYTES)
                     .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "bpe-words")
    # the least count at which no more than KNOWN_WORDS words are left
    down = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, 0)
    least = (counts.groupBy("n").agg(F.count(F.lit(1)).alias("words"))
             .withColumn("upto", F.sum("words").over(down)).where(F.col("upto") <= KNOWN_WORDS)
             .agg(F.min("n")).first()[0])
    chosen = counts.where(F.col("n") >= F.lit(least if least is not None else 1 << 62)).select("word")
    return folded(chosen, tok)


def folded(words: DataFrame, tok: Tokenizer) -> DataFrame:
    """(word, ids) for a table of words."""
    return _with_literals(words.select("word"), **tok.merges).select(
        "word", bind(_merges(tok), lambda lit: tok.fold(lit, F.col("word"))).alias("ids"))


class Merger:
    """Ranked merges of words inside a task: many short words at once, long ones one by one."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        left, right, rank = merges(ranks)
        self.pairs, self.rank = left << _ID_BITS | right, rank.astype(np.int32)
        self.bytes = np.array([ranks[bytes([i])] for i in range(256)], np.int32)

    def ids(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as 32-bit numbers in bytes."""
        out: list[bytes] = [b""] * len(words)
        short: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            whole = self.ranks.get(w)
            if whole is not None:
                out[i] = array("i", [whole]).tobytes()
            elif len(w) > SHORT:
                out[i] = array("i", self._long(w)).tobytes()
            else:
                short.setdefault(-(-len(w) // 4), []).append(i)      # words of like length together
        for own in short.values():
            for i, got in zip(own, self._short([words[i] for i in own])):
                out[i] = got
        return out

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of neighbours (-1: none there)."""
        code = a.astype(np.int64) << _ID_BITS | b
        at = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
        return np.where((self.pairs[at] == code) & (a >= 0) & (b >= 0), self.rank[at], NONE)

    def _short(self, words: list[bytes]) -> list[bytes]:
        """One merge of every word at a time, in a table of words by places."""
        size = np.array([len(w) for w in words])
        width = int(size.max())
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
        place = np.arange(width)
        ids = np.where(place < size[:, None], self.bytes[raw], -1)
        rank = np.full(ids.shape, NONE, np.int32)        # of a place and the next one
        rank[:, :-1] = self._ranks(ids[:, :-1], ids[:, 1:])
        done: list[bytes] = [b""] * len(words)
        open_ = np.arange(len(words))
        while True:
            k = rank.argmin(axis=1)                       # the leftmost of the lowest
            best = rank[np.arange(len(k)), k]
            more = best < NONE
            if not more.all():
                for i, row, n in zip(open_[~more].tolist(), ids[~more], size[~more].tolist()):
                    done[i] = row[:n].tobytes()
                open_, ids, rank, size, k, best = (x[more] for x in (open_, ids, rank, size, k, best))
            if not len(open_):
                return done
            # the places behind the merged one move up
            source = np.minimum(place + (place > k[:, None]), width - 1)
            ids, rank = np.take_along_axis(ids, source, 1), np.take_along_axis(rank, source, 1)
            size = size - 1
            at = np.arange(len(k))
            ids[at, k] = best
            ids[at, size], rank[at, size] = -1, NONE
            last = np.maximum(size - 1, 0)
            rank[at, last] = NONE
            after = np.where(k < last, ids[at, np.minimum(k + 1, width - 1)], -1)
            rank[at, k] = self._ranks(best, after)
            before = k > 0
            rank[at[before], k[before] - 1] = self._ranks(ids[at[before], k[before] - 1], best[before])

    def _long(self, word: bytes) -> list[int]:
        """A heap of neighbours by rank and place: no more than n log n steps."""
        # neighbours by place: the next place, the one before, and the token that starts there
        n = len(word)
        token = [word[i:i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = self.ranks.get
        heap = [(r, i, token[i] + token[i + 1]) for i in range(n - 1)
                if (r := rank(token[i] + token[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = after[i]
            if not token[i] or j >= n or token[i] + token[j] != both:
                continue        # one of the two has merged meanwhile
            token[i], token[j] = both, b""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank(both + token[k])) is not None:
                    heapq.heappush(heap, (r, i, both + token[k]))
            h = before[i]
            if h >= 0 and (r := rank(token[h] + both)) is not None:
                heapq.heappush(heap, (r, h, token[h] + both))
        return [self.ranks[t] for t in token if t]


class Codes(dict):
    """Word to the ids of it (as 32-bit numbers in bytes): the known words, and words merged here."""

    def __init__(self, known: pa.Table, merger: Merger):
        ids = known.column("ids").combine_chunks()
        ends, flat = ids.offsets.to_numpy().tolist(), ids.values.to_numpy().astype(np.int32, copy=False)
        super().__init__((w, flat[a:b].tobytes()) for w, a, b in zip(known.column("word").to_pylist(), ends, ends[1:]))
        self.known, self.merger, self.passing = len(self), merger, []

    def learn(self, texts: list[list[str]]) -> None:
        """Has the ids of all words of the texts, given as lists of words; long ones only until the next call."""
        for word in self.passing:
            del self[word]
        words = set().union(*texts)
        if len(self) + len(words) > self.known + REMEMBERED:
            for word in list(self)[self.known:]:      # the known words came first
                del self[word]
        fresh = [w for w in words if w not in self]
        self.update(zip(fresh, self.merger.ids([w.encode() for w in fresh])))
        self.passing = [w for w in fresh if len(w) > LONGEST_REMEMBERED]


def encode(df: DataFrame, tok: Tokenizer, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(row, ids): the input row (or its columns ``keep``) as a struct and the ids of its text."""
    # bounded by KNOWN_WORDS and KNOWN_BYTES; as a table of bytes, for the driver's memory
    known = known_words(df, tok, text_col).toArrow().combine_chunks()
    ranks, pattern = tok.ranks, tok.pattern
    names = df.columns if keep is None else keep
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")
    given = df.select(row, F.col(f"`{text_col}`").alias("text"))

    def run(parts):
        words, codes = regex.compile(pattern).findall, Codes(known, Merger(ranks))
        for batch in parts:
            texts = text_bytes(batch.column(1))
            for a, b in slices(texts):
                cut = [words(t.decode("utf-8", "replace")) for t in texts[a:b]]
                codes.learn(cut)
                own = [b"".join(map(codes.__getitem__, w)) for w in cut]
                ends = np.cumsum([0, *map(len, own)]) // 4
                ids = pa.array(np.frombuffer(b"".join(own), np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)], names=["row", "ids"])
    return given.mapInArrow(run, StructType([given.schema["row"], StructField("ids", ArrayType(IntegerType()))]))


def decode(df: DataFrame, tok: Tokenizer, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the bytes of the ids, as binary.  The pieces' bytes are joined as they are: a cast
    between binary and string changes none."""
    return _with_literals(df, pieces=tok.pieces).select(
        *[F.col(f"`{c}`") for c in df.columns], bind(_literal("pieces"), lambda p: F.array_join(
            F.transform(F.col(ids_col), lambda i: F.get(p, i)), "").cast("binary")).alias(out))
