"""The join of similar documents, the alignment of tokenizers and the trie of conversations against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import accumulate

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from kestrel.llm import conversation_trie, jaccard_join, token_alignment
from kestrel.llm.queries import ORACLES, QUERIES

BYTE_BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, row string, id long, n int, key long, c1 string, root string, pairs int, u int"


def table(spark, texts, parts=3):
    return spark.createDataFrame([(i, t, "r", 1, 2, 3, "c", "x", 4, 5) for i, t in texts], SCHEMA).repartition(parts)


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def shingles(t, k):
    w = words(t)
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def near_copies():
    """Texts of many lengths, each with copies that differ in some words, around the threshold."""
    rnd = random.Random(9)
    vocab = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 6))) for _ in range(400)]
    shared = rnd.choices(vocab, k=120)
    out = []
    for size in (1, 2, 3, 4, 5, 6, 8, 10, 13, 17, 25, 40, 63, 64, 65, 100, 127, 128, 129, 200, 300):
        w = rnd.choices(vocab, k=size) + (shared if size % 2 else [])
        out.append(w)
        for _ in range(6):
            x = list(w)
            for _ in range(rnd.randint(0, max(1, len(x) // 30))):
                at = rnd.randrange(len(x))
                x[at:at + 1] = rnd.choice([[], [rnd.choice(vocab)], [x[at], rnd.choice(vocab)]])
            out.append(x)
    w = rnd.choices(vocab, k=90)          # a chain of near copies: the ends are far apart
    for i in range(60):
        out.append(list(w))
        w[rnd.randrange(len(w))] = rnd.choice(vocab)
    texts = [" ".join(x) for x in out]
    odd = [None, "", " \t\n", "One TWO  three\x0bfour five", "one two three four five", "Ärger", "ärger", "日本 語 の 文章 です",
           " ".join(rnd.choices(vocab, k=9000))]
    odd += [odd[-1] + " end", odd[-1]]
    rows = list(enumerate(texts + odd, 1))
    rnd.shuffle(rows)
    return rows + [rows[0], rows[0], (None, texts[3]), (None, None), (7, "another text of one id and some more words")]


def linked(rows, k, percent):
    """(id, n_shingles, component_id) of all rows, from all pairs."""
    sets = [frozenset(shingles(t, k)) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                common = len(sets[i] & sets[j])
                if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                    up[top(i)] = top(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)].append(d)
    return Counter((d, len(sets[i]), min(least[top(i)], default=None) if sets[i] else d) for i, (d, _) in enumerate(rows))


def test_jaccard_join(spark):
    rows = near_copies()
    got = Counter(tuple(r) for r in jaccard_join.similar(table(spark, rows), shingle=4, percent=85).collect())
    assert got == linked(rows, 4, 85)


def test_jaccard_join_without_gathering(spark, monkeypatch):
    """The last round alone finds the rest, without broadcasts, at another threshold."""
    for name in ("ROUNDS", "FEW_PAIRS", "FEW_LINKS"):
        monkeypatch.setattr(jaccard_join, name, 0)
    rows = near_copies()
    got = Counter(tuple(r) for r in jaccard_join.similar(table(spark, rows), shingle=2, percent=60).collect())
    assert got == linked(rows, 2, 60)


def test_jaccard_large_group(spark):
    """Hundreds of near copies of one text, and a passage that others share: pairs stay near the rows."""
    rnd = random.Random(3)
    base = [f"w{rnd.randrange(5000)}" for _ in range(80)]
    rows = []
    for i in range(600):
        x = list(base)
        x[rnd.randrange(80)] = f"own{i}"
        if i % 3 == 0:
            x = base[:40] + [f"w{rnd.randrange(5000)}" for _ in range(40)]
        rows.append((i, " ".join(x)))
    seen = []
    check = jaccard_join.verified

    def spy(pairs, *args):
        seen.append(pairs.count())
        return check(pairs, *args)
    jaccard_join.verified = spy
    try:
        got = Counter(tuple(r) for r in jaccard_join.similar(table(spark, rows), shingle=4, percent=85).collect())
    finally:
        jaccard_join.verified = check
    assert got == linked(rows, 4, 85)
    assert sum(seen) < 5 * len(rows)


def test_parity_sketch_bounds_the_difference():
    rnd = np.random.default_rng(1)
    a = rnd.integers(0, 1 << 63, 300).astype(np.uint64)
    for change in (0, 3, 40):
        b = np.concatenate([a[change:], rnd.integers(0, 1 << 63, change).astype(np.uint64)])
        x, y = (np.array(jaccard_join.sketches(1, np.zeros(300, np.int64), s)).view(np.uint64) for s in (a, b))
        assert np.bitwise_count(x ^ y).sum() <= 2 * change


def test_jaccard_long_texts_meet_once(spark, monkeypatch):
    # two long texts that are not similar share many keys; their group goes on once, not for every key
    r = random.Random(3)
    one = [f"w{r.random()}" for _ in range(2000)]
    other = one[:1500] + [f"v{r.random()}" for _ in range(500)]
    rows = [(1, " ".join(one)), (2, " ".join(other)), (3, "alone")]
    kept, write = {}, jaccard_join.written

    def spy(df, name, *a):
        kept[name] = write(df, name, *a)
        return kept[name]
    monkeypatch.setattr(jaccard_join, "written", spy)
    got = Counter(tuple(r) for r in jaccard_join.similar(table(spark, rows), shingle=4, percent=85).collect())
    assert got == Counter([(1, 1997, 1), (2, 1997, 2), (3, 1, 3)])
    assert kept["jaccard-shared"].select("key").distinct().count() > 20
    assert kept["jaccard-mixed"].count() in (0, 2)


def test_jaccard_groups_with_equal_classes(spark):
    rows = [(7, 1), (7, 2), (5, 1), (5, 2), (9, 1), (9, 2), (9, 3), (4, 2), (4, 3)]
    got = jaccard_join.different_groups(spark.createDataFrame(rows, "key long, c1 long").repartition(3))
    assert sorted(map(tuple, got.collect())) == [(4, 2), (4, 3), (5, 1), (5, 2), (9, 1), (9, 2), (9, 3)]


def test_jaccard_pairs_of_long_texts_meet_once(spark):
    # classes 1 and 2 have 60 keys in common, in groups that all differ by one member; 3 is in the component of 2
    def row(key, c, root):
        return (key, (c, c), (root, root), 5000, *[0] * jaccard_join.WORDS)
    rows = [row(k, c, c) for k in range(60) for c in (1, 2, 100 + k)] + [row(99, c, 2) for c in (2, 3)]
    schema = ["key long", "c struct<c1: long, c2: long>", "root struct<c1: long, c2: long>", "n int",
              *[f"{s} long" for s in jaccard_join.SKETCH]]
    inside = spark.createDataFrame(rows, ", ".join(schema))
    got = Counter((r.u.c1, r.v.c1) for r in jaccard_join.star_pairs(inside.repartition(3), 85).collect())
    assert got[1, 2] == 1
    groups = {(1, 2)} | {(a, 100 + k) for a in (1, 2) for k in range(60)}
    assert groups <= set(got) and (2, 3) not in got and max(got.values()) == 1


def test_jaccard_empty(spark):
    assert jaccard_join.similar(table(spark, [], 1)).collect() == []


# ------------------------------------------------------------------ token alignment
TEXTS = [(1, "The quick  brown fox."), (2, None), (3, ""), (4, " "), (5, "<|endoftext|> and <s> </s> <0x41>"), (6, "a ▁ b"),
         (7, "日本語の文章です。😀 é"), (8, "tab\tand\n\nlines\r\n  x"), (9, "\x00 zero"), (10, "internationalisation " * 900),
         (11, "x" * 5000), (1, "The quick  brown fox."), (None, "a null id"), (12, "Ärger mit ñandú, l'été"), (13, "1234567 89.5%")]


def aligned(rows):
    """By definition, with the libraries that read the two files."""
    a = Tokenizer.from_file(BYTE_BPE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    byte = token_alignment.byte_characters()
    out, links = [], []
    for d, t in rows:
        e = a.encode(" " + t, add_special_tokens=False) if t else None
        ia, ib = (e.ids, b.encode(t)) if t else ([], [])
        ta = [bytes(byte[c] for c in x) for x in (e.tokens if e else [])]
        tb = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()
              for p in map(b.id_to_piece, ib)]
        if not t or b"".join(ta) != b" " + t.encode() or b"".join(tb) != b" " + t.encode():
            out.append((d, 0, 0, 0, ""))
            links.append([])
            continue
        ea, eb = (list(accumulate(map(len, x))) for x in (ta, tb))
        at_b, groups, own, i, j = {x: y for y, x in enumerate(eb)}, [], [], 0, 0
        for x, end in enumerate(ea):
            if end in at_b:
                y = at_b[end]
                own.append((ia[x], ib[y]))
                groups.append(",".join(map(str, ia[i:x + 1])) + "|" + ",".join(map(str, ib[j:y + 1])))
                i, j = x + 1, y + 1
        out.append((d, len(ia), len(ib), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        links.append(own)
    count = Counter(x for own in links for x in own)
    top = Counter()
    for (x, y), c in count.items():
        top[y] = max(top[y], c)
    return Counter((d, na, nb, ng, len(own), sum(count[x] == top[x[1]] for x in own), sum(count[x] for x in own), sha)
                   for (d, na, nb, ng, sha), own in zip(out, links))


def alignment(spark, rows):
    return Counter((r.row.doc_id, *r[1:]) for r in token_alignment.align(table(spark, rows), BYTE_BPE, PIECES).collect())


def test_token_alignment(spark):
    assert alignment(spark, TEXTS) == aligned(TEXTS)


def test_token_alignment_of_documents(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = Counter(tuple(r) for r in QUERIES["op12_token_alignment"](spark, sf).collect())
    assert got == aligned(rows)


def test_token_alignment_empty(spark):
    assert alignment(spark, []) == Counter()
    assert alignment(spark, [(1, None), (2, "")]) == Counter({(1, 0, 0, 0, 0, 0, 0, ""): 1, (2, 0, 0, 0, 0, 0, 0, ""): 1})


@pytest.mark.parametrize("seed", range(4))
def test_cuts(seed):
    """Common ends of random tokens of several texts, some without tokens."""
    rnd = random.Random(seed)
    ends_a, ends_b, first_a, first_b, want, offset = [], [], [0], [0], [], 0
    for _ in range(30):
        n = rnd.choice([0, 1, 2, 5, 60, 400])
        if n:
            a, b = ({*rnd.sample(range(1, n), rnd.randint(0, n - 1)), n} for _ in range(2))
            want += [offset + x for x in sorted(a & b)]
            ends_a += [offset + x for x in sorted(a)]
            ends_b += [offset + x for x in sorted(b)]
        offset += n
        first_a.append(len(ends_a))
        first_b.append(len(ends_b))
    ends_a, ends_b = np.array(ends_a), np.array(ends_b)
    i, j = token_alignment.cuts(ends_a, ends_b, np.array(first_a), np.array(first_b))
    assert ends_a[i].tolist() == ends_b[j].tolist() == want


# ------------------------------------------------------------------ conversation trie
def nodes_of(rows):
    """The nodes by definition."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    whole = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(own.get(c - c % 100, [])[:h] + t[h:])
    member = defaultdict(list)
    for c, t in whole.items():
        for d in range(len(t) + 1):
            member[t[:d]].append(c)
    children = Counter(p[:-1] for p in member if p)
    leaves, saved = Counter(), Counter()
    for p, m in member.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return Counter((min(m), len(p), min(member[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(str(c) for c in sorted(m) if whole[c] == p).encode()).hexdigest())
                   for p, m in member.items())


def talks():
    rnd = random.Random(4)
    rows = []
    for c in range(130):
        size = rnd.choice([1, 2, 3, 4, 5, 6, 7, 9])
        for t in range(size):
            rows.append((c, None if rnd.random() < 0.1 else t, rnd.choice(["user", "assistant", None]), rnd.choice(["hi", "so?", None, "né"])))
    for c in range(200, 260):           # alike but for the last turn, no first one of their hundred but 200
        rows += [(c, t, "user", "the same") for t in range(8)] + [(c, 9, "user", str(c % 7))]
    rows += [(700, t, "user", str(t % 3)) for t in range(600)]         # a long one
    rows += [(750, t, "user", str(t % 3)) for t in range(600)]
    rows += [(755, 1, "a", "b"), (755, 1, "a", "b"), (755, 1, "a", None), (None, 1, "a", "b"), (355, 0, "x", "y"), (2 ** 61, 0, "x", "y")]
    rnd.shuffle(rows)
    return rows


TALKS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("shard_rows", [10, 1 << 15])
def test_conversation_trie(spark, shard_rows):
    rows = talks()
    df = spark.createDataFrame(rows, TALKS).repartition(3)
    got = Counter(tuple(r) for r in conversation_trie.trie(df, shard_rows).collect())
    assert got == nodes_of(rows)


def test_conversation_trie_oracle(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    want = Counter(con.execute(ORACLES["op13_conversation_trie"]).fetchall())
    assert Counter(tuple(r) for r in QUERIES["op13_conversation_trie"](spark, sf).collect()) == want


def test_conversation_trie_empty(spark):
    assert conversation_trie.trie(spark.createDataFrame([], TALKS)).collect() == []


def test_slot_table():
    rnd = np.random.default_rng(2)
    a, b = (rnd.integers(0, 1 << 63, 5000).astype(np.uint64) for _ in range(2))
    a[:2000] = a[0]                      # many digests share one half
    slots = conversation_trie.SlotTable(a, b)
    assert sorted(slots.find(a, b).tolist()) == list(range(5000))
    assert (slots.find(b, a) == -1).all()
    with pytest.raises(ValueError):
        conversation_trie.SlotTable(np.append(a, a[:1]), np.append(b, b[:1]))
