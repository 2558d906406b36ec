"""Alignment of two tokenizers' tokens over the same bytes.

Every text is encoded twice: a space and the text by a byte-level BPE (A), the text by a
sentencepiece model that puts the space in front itself (B).  Tokens are intervals of the same
bytes.  Offsets where a token of A and one of B both end are cuts; what lies between two cuts
next to each other is a group.

The cuts are found by divide and conquer.  An interval of tokens looks for a common end near its
middle: from the middle of A's tokens outwards, each end is located among B's ends by bisection.
A common end splits the interval, and both halves go on; an interval whose inner ends are all
without a partner is a leaf, one group.  All open intervals of a slice of texts take a step
together (``cuts``), so the depth is the logarithm of the longest text's tokens, and a step is a
few array operations.

A link is a pair of token occurrences that end together.  Their bytes end alike, so the bytes of one
token are a suffix of the other's: the pairs of ids that can ever be linked follow from the two
vocabularies alone (``Universe``, some hundred thousand pairs).  That bounds everything that is kept
per pair of ids: the corpus-wide counts come to the driver as one flat array with a place for each
possible pair, whatever the size of the corpus, and go to the tasks as a broadcast.

First pass: encode, align, write each text's groups and the numbers of its pairs of ids.  Then the
counts of pairs are summed.  Second pass: a lookup of counts over the written rows; nothing is encoded
again.

Defined results.  Null and empty texts, and texts whose joined token bytes differ from the space and the
text (say, a literal U+2581, which the pieces of B use for spaces), have no tokens: zeros and ''.  Texts of any length are
encoded whole.  Repeated rows and null ids are rows like any other, each counts.  Ties for the
highest count of a B id all count as best.  An empty table gives an empty result.  The columns of
the input travel as a struct, so no name can clash.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from kestrel.llm.batches import slices, text_bytes
from kestrel.llm.common import written

SPACE = "▁"
#: Ends of A's tokens that an interval tries at once, from its middle outwards.
PROBES = 4
#: Bytes of text that are aligned at once: their offsets fit a core's cache.
SLICE_BYTES = 1 << 18
#: Words that a task remembers the pieces of, of this many characters at most.
REMEMBERED = 300_000
LONGEST_REMEMBERED = 64


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_level_tokens(file: str) -> list[bytes]:
    """Bytes of each id of a byte-level BPE, given the text of its JSON file."""
    byte = byte_characters()
    vocab = json.loads(file)["model"]["vocab"]
    out = [b""] * (max(vocab.values()) + 1)
    for t, i in vocab.items():
        # a special token in the vocabulary is plain text
        out[i] = bytes(byte[c] for c in t) if all(c in byte for c in t) else t.encode()
    return out


def piece_tokens(model) -> list[bytes]:
    """Bytes of each id of a sentencepiece model."""
    def one(i: int) -> bytes:
        p = model.id_to_piece(i)
        if model.is_byte(i):
            return bytes([int(p[3:-1], 16)])
        return p.replace(SPACE, " ").encode()
    return [one(i) for i in range(model.get_piece_size())]


class Universe:
    """All pairs of ids (a, b) whose bytes end alike, numbered in the order of b, then a."""

    def __init__(self, a: list[bytes], b: list[bytes]):
        self.n_a = len(a)
        codes = [i + j * self.n_a for i, j in self._suffixes(a, b)]
        codes += [i + j * self.n_a for j, i in self._suffixes(b, a)]
        self.codes = np.unique(np.array(codes, np.int64))
        self.b = self.codes // self.n_a

    @staticmethod
    def _suffixes(long: list[bytes], short: list[bytes]):
        ids: dict[bytes, list[int]] = {}
        for i, t in enumerate(short):
            if t:
                ids.setdefault(t, []).append(i)
        for i, t in enumerate(long):
            for k in range(len(t)):
                for j in ids.get(t[k:], ()):
                    yield i, j

    def numbers(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.codes, b.astype(np.int64) * self.n_a + a)


@dataclass
class Files:
    """The two vocabulary files by content, so that tasks need not see a path."""
    byte_bpe: str
    pieces: bytes

    @staticmethod
    def load(byte_bpe_path: str, pieces_path: str) -> "Files":
        with open(byte_bpe_path, encoding="utf-8") as f, open(pieces_path, "rb") as g:
            return Files(f.read(), g.read())

    def pieces_model(self):
        return sentencepiece.SentencePieceProcessor(model_proto=self.pieces)

    def byte_bpe_model(self) -> tiktoken.Encoding:
        """The byte-level BPE as ranks: its ids are the order of its merges.  (The library that reads
        the JSON gives the same ids in three times the time.)"""
        file = json.loads(self.byte_bpe)
        special = {t["id"] for t in file["added_tokens"]}
        ranks = {t: i for i, t in enumerate(byte_level_tokens(self.byte_bpe)) if i not in special}
        return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def cuts(ends_a: np.ndarray, ends_b: np.ndarray, texts_a: np.ndarray, texts_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``ends_a`` and ``ends_b`` of all common ends, in order.

    ``ends_*``: rising offsets where tokens end, of all texts of a slice one after the other.
    ``texts_*``: positions of the first token of each text, and the number of tokens at last; a
    text without tokens has none in either.  The last tokens of a text end together."""
    has = np.diff(texts_a) > 0
    lo_a, hi_a, lo_b, hi_b = texts_a[:-1][has], texts_a[1:][has] - 1, texts_b[:-1][has], texts_b[1:][has] - 1
    found_a, found_b = [hi_a], [hi_b]           # a text's end is a cut
    while len(lo_a):
        # an interval is [lo, hi]; hi is a common end already, the ends before it are open
        at_a, at_b = np.full(len(lo_a), -1), np.full(len(lo_a), -1)
        middle, first = (lo_a + hi_a) // 2, 0
        rest = np.arange(len(lo_a))
        while len(rest):
            # the next few ends from the middle outwards: 0, +1, -1, +2, -2, ...
            step = np.arange(first, first + PROBES)
            shift = np.where(step % 2, (step + 1) // 2, -(step // 2))
            a = middle[rest, None] + shift
            inside = (a >= lo_a[rest, None]) & (a < hi_a[rest, None])
            end = ends_a[np.where(inside, a, 0)]
            b = np.searchsorted(ends_b, end)
            hit = inside & (ends_b[np.minimum(b, len(ends_b) - 1)] == end)
            some = hit.any(axis=1)
            k = hit.argmax(axis=1)[some]
            at_a[rest[some]], at_b[rest[some]] = a[some, k], b[some, k]
            rest = rest[~some & inside.any(axis=1)]
            first += PROBES
        split = at_a >= 0                       # the others are leaves
        found_a.append(at_a[split])
        found_b.append(at_b[split])
        a, b = at_a[split], at_b[split]
        # both halves of an interval side by side, so that intervals stay in order
        lo_a, hi_a = np.stack([lo_a[split], a + 1], 1).ravel(), np.stack([a, hi_a[split]], 1).ravel()
        lo_b, hi_b = np.stack([lo_b[split], b + 1], 1).ravel(), np.stack([b, hi_b[split]], 1).ravel()
        # one token of A, or one of B, has no inner end
        more = (hi_a > lo_a) & (hi_b > lo_b)
        lo_a, hi_a, lo_b, hi_b = lo_a[more], hi_a[more], lo_b[more], hi_b[more]
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    return np.sort(a), np.sort(b)


class PieceEncoder:
    """The sentencepiece model over words that it has met before.

    No piece has a space behind another character, and none holds a line end.  So a word is encoded alike wherever it
    stands behind one space or a line end, and a text is the words' ids one after the other.  Texts with other
    spaces (two in a row, at the end) are encoded as they are, as all are if the vocabulary has other pieces."""

    def __init__(self, model, pieces: list[bytes]):
        self.model, self.known = model, {}
        self.alone = not any(b" " in p.lstrip(b" ") or (b"\n" in p and p != b"\n") for p in pieces)
        self.cut = re.compile(r"[ \n][^ \n]*").findall

    def encode(self, texts: list[str]) -> list[list[int]]:
        plain = [i for i, t in enumerate(texts) if not self.alone or not t or t[0] == " " or t[-1] == " " or t[0] == "\n"
                 or "  " in t or " \n" in t or SPACE in t]
        out: list = [None] * len(texts)
        for i, ids in zip(plain, self.model.encode([texts[i] for i in plain], num_threads=1)):
            out[i] = ids
        words = [self.cut(" " + t) if out[i] is None else () for i, t in enumerate(texts)]
        met = set().union(*words)
        if len(self.known) + len(met) > REMEMBERED:
            self.known = {}
        fresh = [w for w in met if w not in self.known]
        # a space in front is the model's own; a line end is kept, behind the space that the model puts there
        known = dict(zip(fresh, self.model.encode([w[1:] if w[0] == " " else w for w in fresh], num_threads=1)))
        for w in fresh:
            if w[0] == "\n":
                known[w] = known[w][1:]
        self.known.update(known)
        find = self.known.__getitem__
        for i, own in enumerate(words):
            if own:
                out[i] = list(chain.from_iterable(map(find, own)))
        for w in fresh:
            if len(w) > LONGEST_REMEMBERED:
                del self.known[w]
        return out


class Decimals:
    """Ids as decimal text, for whole arrays of ids."""

    def __init__(self, n: int):
        width = len(str(n)) + 1
        # numpy fills short texts with zero bytes
        self.digits = np.arange(n).astype(f"S{width}").view(np.uint8).reshape(n, width)
        self.size = (self.digits > 0).sum(axis=1)

    def joined(self, ids: np.ndarray, after: np.ndarray) -> tuple[bytes, np.ndarray]:
        """All ids, each followed by its byte of ``after``; and where each begins."""
        rows, size = self.digits[ids], self.size[ids]
        rows[np.arange(len(ids)), size] = after
        return rows[rows > 0].tobytes(), np.concatenate([[0], np.cumsum(size + 1)])


class Aligner:
    """Both tokenizers and the alignment of a slice of texts."""

    def __init__(self, files: Files, universe: Universe):
        self.a, self.b = files.byte_bpe_model(), files.pieces_model()
        self.universe = universe
        self.bytes_a, self.bytes_b = byte_level_tokens(files.byte_bpe), piece_tokens(self.b)
        self.size_a, self.size_b = (np.array([len(t) for t in x], np.int32) for x in (self.bytes_a, self.bytes_b))
        self.encode_pieces = PieceEncoder(self.b, self.bytes_b).encode
        self.decimals = Decimals(max(len(self.bytes_a), len(self.bytes_b)))

    def ids(self, texts: list[bytes]) -> tuple[list, list]:
        plain = [t.decode("utf-8", "replace") for t in texts]
        full = [self.a.encode_ordinary(" " + t) for t in plain]
        pieces = self.encode_pieces(plain)
        join, of_a, of_b = b"".join, self.bytes_a.__getitem__, self.bytes_b.__getitem__
        for k, t in enumerate(texts):
            want = b" " + t
            if not t or join(map(of_a, full[k])) != want or join(map(of_b, pieces[k])) != want:
                full[k], pieces[k] = [], []
        return full, pieces

    def align(self, texts: list[bytes]) -> list:
        """Columns n_a, n_b, n_groups, groups_sha256, pairs, times of the texts."""
        full, pieces = self.ids(texts)
        first_a, first_b = (np.cumsum([0, *map(len, x)]) for x in (full, pieces))
        a, b = (np.fromiter(chain.from_iterable(x), np.int32, n[-1]) for x, n in ((full, first_a), (pieces, first_b)))
        cut_a, cut_b = cuts(np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b]), first_a, first_b)
        numbers = self.universe.numbers(a[cut_a], b[cut_b]).astype(np.int32)
        group = np.searchsorted(cut_a, first_a)          # first group of each text
        # A's and B's tokens of each group, one after the other
        line, after = np.empty(len(a) + len(b), np.int32), np.full(len(a) + len(b), ord(","), np.uint8)
        size_a, size_b = np.diff(cut_a, prepend=-1), np.diff(cut_b, prepend=-1)
        line[np.arange(len(a)) + np.repeat(cut_b + 1 - size_b, size_a)] = a
        line[np.arange(len(b)) + np.repeat(cut_a + 1, size_b)] = b
        after[cut_a + cut_b + 1 - size_b] = ord("|")
        after[cut_a + cut_b + 1] = ord(";")
        text, at = self.decimals.joined(line, after)
        at = at[first_a + first_b]
        shas, pairs, times = [], [], []
        for k in range(len(texts)):
            # without the last separator
            shas.append(hashlib.sha256(text[at[k]:at[k + 1] - 1]).hexdigest() if full[k] else "")
            u, c = np.unique(numbers[group[k]:group[k + 1]], return_counts=True)
            pairs.append(u)
            times.append(c.astype(np.int32))
        return [np.diff(first_a), np.diff(first_b), np.diff(group), shas, pairs, times]


_LONG = [StructField(n, LongType()) for n in ("n_a", "n_b", "n_groups")]
_LISTS = [StructField(n, ArrayType(IntegerType())) for n in ("pairs", "times")]


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(arrays)))


def groups(df: DataFrame, files: Files, universe: Universe, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(row, n_a, n_b, n_groups, groups_sha256, pairs, times): the first pass.  ``pairs``: the numbers of the
    linked pairs of ids in the universe; ``times``: how often each is linked in the text."""
    names = df.columns if keep is None else keep
    given = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(f"`{text_col}`").alias("text"))

    def run(parts):
        aligner = Aligner(files, universe)
        for batch in parts:
            texts = text_bytes(batch.column(1))
            for i, j in slices(texts, SLICE_BYTES):
                *longs, shas, pairs, times = aligner.align(texts[i:j])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), *[pa.array(x, pa.int64()) for x in longs], pa.array(shas, pa.string()),
                     _lists(pairs), _lists(times)],
                    names=["row", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"])
    return given.mapInArrow(run, StructType([given.schema["row"], *_LONG, StructField("groups_sha256", StringType()), *_LISTS]))


def pair_counts(grouped: DataFrame, universe: Universe) -> np.ndarray:
    """How many links of all texts hold each pair of the universe (one array, as long as the universe)."""
    rows = (grouped.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).groupBy(F.col("x.pairs").alias("pair"))
            .agg(F.sum(F.col("x.times").cast("long")).alias("n")).toArrow())
    counts = np.zeros(len(universe.codes), np.int64)
    counts[rows.column("pair").to_numpy()] = rows.column("n").to_numpy()
    return counts


def align(df: DataFrame, byte_bpe_path: str, pieces_path: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(row, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every text."""
    files = Files.load(byte_bpe_path, pieces_path)
    universe = Universe(byte_level_tokens(files.byte_bpe), piece_tokens(files.pieces_model()))
    grouped = written(groups(df, files, universe, text_col, keep), "alignment")
    counts = pair_counts(grouped, universe)
    top = np.zeros(universe.b.max() + 1, np.int64)
    np.maximum.at(top, universe.b, counts)
    shared = df.sparkSession.sparkContext.broadcast((counts, counts == top[universe.b]))

    def look(parts):
        count, best = shared.value
        for batch in parts:
            pairs, times = batch.column("pairs"), batch.column("times")
            p, t = pairs.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
            ends = np.cumsum([0, *pairs.value_lengths().to_numpy()])

            def total(x: np.ndarray) -> pa.Array:
                upto = np.concatenate([[0], np.cumsum(x)])
                return pa.array(upto[ends[1:]] - upto[ends[:-1]], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in ("row", "n_a", "n_b", "n_groups")], total(t), total(t * best[p]), total(t * count[p]),
                 batch.column("groups_sha256")], names=[f.name for f in schema])
    schema = StructType([grouped.schema["row"], *_LONG, *[StructField(n, LongType()) for n in ("n_links", "n_best", "count_sum")],
                         grouped.schema["groups_sha256"]])
    return grouped.mapInArrow(look, schema)
