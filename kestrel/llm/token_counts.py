"""Token counts by a count-only Viterbi over a unigram vocabulary.

The vocabulary (pieces and scores) comes from a sentencepiece model file.  An Aho-Corasick
automaton enumerates every piece that ends at a character; dynamic programming carries, for
each place in the text, the best score so far and the number of pieces on that path.  No
path is stored.  Ties go to the longer last piece (the path found first when places are
taken from left to right); a character that is no piece costs ``UNKNOWN`` below the least
score and counts one token for each of its UTF-8 bytes (byte fallback).  Spaces are written as
U+2581, one stands before the text, and control and byte pieces never match text.

No piece goes on after a U+2581 that follows another character (checked when the vocabulary
is read), so a text falls into units at its spaces, and around line feeds, tabs and carriage
returns that no longer piece holds; the best paths of units are independent.  A task remembers the result of a unit, up to ``REMEMBERED`` units at once.
Scores of such files are whole numbers, so sums are exact in doubles.

Null and empty texts have no tokens and score 0.  Repeated rows get the same result, texts of any
length are read whole, ties follow the tokenizer's rule, and columns travel as a struct.  An
empty table gives an empty result.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, LongType, StructField

from kestrel.llm.batches import with_columns

SPACE = "▁"
UNKNOWN = 10.0
REMEMBERED = 300_000
LONGEST_REMEMBERED = 64


def vocabulary(path: str) -> dict[str, float]:
    """Piece to score, without control, unknown, unused and byte pieces."""
    m = sentencepiece.SentencePieceProcessor(model_file=path)
    out = {m.id_to_piece(i): m.get_score(i) for i in range(m.vocab_size())
           if not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i) or m.is_byte(i))}
    if any(a != SPACE and b == SPACE for p in out for a, b in zip(p, p[1:])):
        raise ValueError("a piece goes on after a space: texts cannot be taken apart at spaces")
    return out


def unit_pattern(pieces: dict[str, float]) -> re.Pattern:
    """A unit: spaces and what follows them, or a character that stands alone in every piece."""
    alone = "".join(c for c in "\n\t\r" if not any(c in p and len(p) > 1 for p in pieces))
    return re.compile(rf" *[^ {alone}]+| +|[{alone}]" if alone else " *[^ ]+| +")


class Viterbi:
    def __init__(self, pieces: dict[str, float]):
        self.single = {p for p in pieces if len(p) == 1}
        self.unknown = min(pieces.values(), default=0.0) - UNKNOWN
        self.machine = ahocorasick.Automaton()
        for p, s in pieces.items():
            self.machine.add_word(p, (len(p), s))
        self.machine.make_automaton()

    def count(self, text: str) -> tuple[float, int]:
        """Best score and pieces on its path, for a text with spaces already written as SPACE."""
        ends: list[list] = [[] for _ in text]
        for e, hit in self.machine.iter(text):        # longest first at each end
            ends[e].append(hit)
        score, pieces = [0.0] * (len(text) + 1), [0] * (len(text) + 1)
        for e, c in enumerate(text):
            best, n = -np.inf, 0
            for size, s in ends[e]:
                x = score[e + 1 - size] + s
                if x > best:
                    best, n = x, pieces[e + 1 - size] + 1
            if c not in self.single:
                x = score[e] + self.unknown
                if x > best:
                    best, n = x, pieces[e] + len(c.encode())
            score[e + 1], pieces[e + 1] = best, n
        return score[-1], pieces[-1]


def count_tokens(df: DataFrame, vocabulary_path: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(row, n_tokens, token_score), ``row`` being the input row (or its columns ``keep``)."""
    pieces = vocabulary(vocabulary_path)      # the file is read here; tasks get the pieces
    state: dict = {}

    def compute(texts: list[bytes]) -> list:
        if not state:
            state.update(machine=Viterbi(pieces), known={}, units=unit_pattern(pieces).findall)
        machine, known, units = state["machine"], state["known"], state["units"]
        counts, scores = [], []
        for t in texts:
            n, total = 0, 0.0
            for unit in units(" " + t.decode("utf-8", "replace")) if t else ():
                got = known.get(unit)
                if got is None:
                    got = machine.count(unit.replace(" ", SPACE))
                    if len(unit) <= LONGEST_REMEMBERED:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        known[unit] = got
                total += got[0]
                n += got[1]
            counts.append(n)
            scores.append(total)
        return [counts, scores]
    return with_columns(df, text_col, [StructField("n_tokens", LongType()), StructField("token_score", DoubleType())],
                        compute, keep)
