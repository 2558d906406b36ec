"""The document operators against brute force, and their defined results on awkward tables."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer as HF
from tokenizers import models

import corpus_pipeline
from kestrel.llm import (byte_bpe, exact_dedup, language_id, line_dedup, mixing, quality_classifier, quality_rules,
                         simhash, suffix_dedup, token_counts)
from kestrel.llm.queries import QUERIES

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          # names that the operators use inside
          "row string, id long, k1 long, k2 long, a long, score string, fingerprint string, n long, ids string, `_rank` int")


def _rows(texts):
    """Texts with ids; every third language and every fourth source is null."""
    return [(i, t, None if j % 3 == 2 else "en", None if j % 4 == 3 else f"s{j % 2}", None if t is None else len(t),
             "row", 1, 2, 3, 4, "score", "fp", 5, "ids", 6) for j, (i, t) in enumerate(texts)]


def _texts():
    rnd = random.Random(5)
    vocab = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8))) for _ in range(300)]
    some = [" ".join(rnd.choices(vocab, k=rnd.randint(3, 120))) for _ in range(40)]
    long = "\n".join(" ".join(rnd.choices(vocab, k=12)) for _ in range(400))
    shared = " ".join(rnd.choices(vocab, k=100))
    out = [*some, None, "", " \t\n\x0b ", "\n\n\n", long, long, long + " tail", "Ärger ÉCOLE ñ", "ärger ÉCOLE Ñ",
           "a" * 900, "a" * 900 + "b", "日本語の文章です。😀", *[f"{s}. {shared} {s[::-1]}" for s in some[:6]],
           *[s.upper() for s in some[:5]], "same line\nother\n Same LINE ", "same line", "SAME LINE\n"]
    docs = list(enumerate(out))
    return docs + [(None, out[0]), (None, out[0]), (3, out[3]), (3, out[3]), (3, "another text of id 3"), (None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_rows(_texts()), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def norm(t):
    return t or ""


# ------------------------------------------------------------------ line dedup
@pytest.mark.parametrize("batches,fanout", [(1, 2), (5, 2), (3, 3)])
def test_line_dedup(docs, batches, fanout):
    rows = _texts()
    keys = [[lower(x).strip(" \t\n\x0b\x0c\r") for x in norm(t).split("\n")] for _, t in rows]
    seen = Counter(k for own in keys for k in set(own))
    want = Counter()
    for (i, t), own in zip(rows, keys):
        stay = [x for x, k in zip(norm(t).split("\n"), own) if not (k and seen[k] >= 3)]
        want[i, "\n".join(stay), len(own), len(own) - len(stay)] += 1
    got = line_dedup.drop_common_lines(docs, min_docs=3, batches=batches, fanout=fanout).collect()
    assert Counter((r.row.doc_id, r.kept_text, r.n_lines, r.n_dropped) for r in got) == want
    assert sum(n for (_, _, _, d), n in want.items() if d) > 5


# ------------------------------------------------------------------ exact dedup
@pytest.mark.parametrize("support", [0.001, 0.04, 0.5])
def test_exact_dedup(docs, support):
    groups = defaultdict(list)
    for i, t in _texts():
        groups[lower(t)].append(i)
    got = exact_dedup.exact_groups(docs, support=support).collect()
    by = defaultdict(list)
    for r in got:
        by[r.digest].append(r)
    assert len(got) == len(_texts()) and len(by) == len(groups)
    for t, own in groups.items():
        rows = by[hashlib.sha256(t.encode()).hexdigest()]
        keep = max((i for i in own if i is not None), default=None)
        assert sorted(map(str, own)) == sorted(str(r.id) for r in rows)
        assert {(r.keep_id, r.group_size) for r in rows} == {(keep, len(own))}
        assert [r.id for r in rows if r.kept] == [keep]


# ------------------------------------------------------------------ quality rules
def _base(t):
    w = regex.findall(r"[^\x20\x09-\x0D]+", norm(t))
    tri = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    c = Counter(tri)
    hit = {i + k for i, x in enumerate(tri) if c[x] > 1 for k in range(3)}
    lines = [x for x in norm(t).split("\n") if regex.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum(norm(t).count(x) for x in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit))


def test_base_counts(docs):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = Counter((r.id, *[r[n] for n in names], r.base_failed) for r in quality_rules.base_counts(docs, "doc_id", "text").collect())
    want = Counter()
    for i, t in [*_texts()]:
        b = _base(t)
        want[i, *b, b[0] < 50 or 100 * b[4] > 50 * b[0]] += 1
    assert got == want


def _mcd(x):
    """The estimator in numpy: the same starts, cuts on bins and floors."""
    q = quality_rules
    floors = np.diag(np.square(q.FLOORS))

    def cut(v, share):
        b = np.sort(v)
        return b[int(np.ceil(share * len(b))) - 1]

    def med(v):
        return (cut(np.floor(v / q.FEATURE_BIN), 0.5) + 0.5) * q.FEATURE_BIN
    m = np.array([med(c) for c in x.T])
    mad = np.array([med(np.abs(c - k)) for c, k in zip(x.T, m)])
    starts = [(m, np.diag((1.4826 * mad) ** 2) + floors), (x.mean(0), np.cov(x.T, bias=True) + floors)]

    def bins(m, c):
        d = np.einsum("ni,ij,nj->n", x - m, np.linalg.inv(c), x - m)
        return d, np.clip(np.floor(np.log2(np.maximum(d, 1e-30)) * q.BINS_PER_UNIT), q.BIN_LOW * q.BINS_PER_UNIT, q.BIN_HIGH * q.BINS_PER_UNIT)
    best = None
    for m, c in starts:
        for _ in range(q.STEPS):
            b = bins(m, c)[1]
            inner = x[b <= cut(b, q.KEEP)]
            m, c = inner.mean(0), np.cov(inner.T, bias=True) + floors
        if best is None or np.linalg.slogdet(c)[1] < best[0] - 1e-12:
            best = np.linalg.slogdet(c)[1], m, c
    d, b = bins(*best[1:])
    return d / max(2 ** ((cut(b, 0.5) + 0.5) / q.BINS_PER_UNIT) / q.CHI2_MEDIAN, 1)


def test_robust_outliers_match_numpy(spark):
    rnd = random.Random(2)
    rows = []
    for i in range(900):
        words = ["".join(rnd.choices("abcdefg", k=rnd.randint(2, 9))) for _ in range(rnd.randint(60, 300))]
        if i % 40 == 0:
            words = [w + "###" for w in words]
        elif i % 41 == 0:
            words = words[:10] * 2 + words
        rows.append((i, " ".join(words), "en" if i % 2 else None, "s0" if i < 800 else f"t{i % 7}"))
    df = spark.createDataFrame(rows, "doc_id int, text string, lang string, source string")
    got = {r.doc_id: r for r in quality_rules.judge(df, "doc_id", min_rows=60).withColumnRenamed("id", "doc_id").collect()}
    groups = defaultdict(list)
    for i, _, lang, source in rows:
        # the sources t0..t6 have too few rows in each language, together not
        groups["all" if source != "s0" else lang].append(i)
    for key, own in groups.items():
        stats = []
        own = [i for i in own if not got[i].base_failed]
        for i in own:
            n, chars, symbols, dups, repeats = _base(rows[i][1])
            stats.append([np.log1p(n), np.log(chars / n), np.log1p(100 * symbols / n), np.log1p(10 * dups), np.log1p(10 * repeats / n)])
        want = _mcd(np.array(stats))
        assert np.allclose([got[i].distance for i in own], want, rtol=1e-6), key
    noisy = [i for i in range(900) if i % 40 == 0]
    assert not any(got[i].kept for i in noisy)
    assert all(got[i].kept for i in range(900) if i % 40 and i % 41)


def test_rules_on_awkward_rows(docs):
    got = quality_rules.judge(docs, min_rows=5).collect()
    assert len(got) == len(_texts()) and all(not r.kept for r in got if r.base_failed)


def test_rules_light_junk(spark):
    rnd = random.Random(7)

    def clean(n):
        return ["".join(rnd.choices("abcdefghijklmnop", k=rnd.randint(2, 9))) for _ in range(n)]

    def text(words, line=12):
        return "\n".join(" ".join(words[i:i + line]) for i in range(0, len(words), line))
    rows = [("clean", text(clean(rnd.randint(60, 500)))) for _ in range(400)]
    for _ in range(8):
        for per in (8, 14, 20):                       # symbols per 100 words
            rows.append(("junk", text([w + "$" if i < 4 * per else w for i, w in enumerate(clean(400))])))
        w = clean(400)
        rows.append(("junk", text(w[:90] + w[:50] + w[90:350])))              # a quarter of the words repeated
        lines = text(clean(360)).split("\n")
        rows.append(("junk", "\n".join(lines + lines[:6])))                    # a third of the lines
        w = [x * 2 for x in clean(300)]
        rows.append(("junk", text(w)))                                         # words twice as long
        # chance in short texts
        w = clean(60)
        rows.append(("clean", text(w[:10] + [w[10] + "$", w[11] + "&"] + w[12:])))
        lines = text(clean(60), 8).split("\n")
        rows.append(("clean", "\n".join(lines + lines[:1])))
        rows.append(("clean", text(w[:4] + w)))
    df = spark.createDataFrame([(i, t, "en", "s") for i, (_, t) in enumerate(rows)], "doc_id int, text string, lang string, source string")
    got = {r.id: r for r in quality_rules.judge(df).collect()}
    assert not any(r.base_failed for r in got.values())
    assert [i for i, (kind, _) in enumerate(rows) if kind == "junk" and got[i].kept] == []
    assert sum(kind == "clean" and not got[i].kept for i, (kind, _) in enumerate(rows)) <= 4


def test_rules_judge_the_last_rows(spark):
    rnd = random.Random(9)

    def clean():
        return ["".join(rnd.choices("abcdefghij", k=rnd.randint(2, 9))) for _ in range(rnd.randint(60, 300))]
    rows = [(i, " ".join(clean()), "en", "s0") for i in range(150)]
    rows += [(150 + i, " ".join(clean()), "en" if i % 2 else "xx", "s1") for i in range(10)]
    rows += [(160, " ".join(w + "###" for w in clean()), "en", "s1"), (161, " ".join(w + "###" for w in clean()), "xx", "s1")]
    df = spark.createDataFrame(rows, "doc_id int, text string, lang string, source string")
    got = {r.id: r for r in quality_rules.judge(df).collect()}
    assert len(got) == 162 and all(r.distance is not None for r in got.values())
    assert [i for i in got if not got[i].kept] == [160, 161]


# ------------------------------------------------------------------ repeated byte strings
def _repeats(texts, length):
    raw = [norm(t).encode() for t in texts]
    seen = Counter(x[j:j + length] for x in raw for j in range(len(x) - length + 1))
    out = []
    for x in raw:
        gone = bytearray(len(x))
        for j in range(len(x) - length + 1):
            if seen[x[j:j + length]] > 1:
                gone[j:j + length] = b"\x01" * length
        runs = sum(1 for j in range(len(x)) if gone[j] and (j == 0 or not gone[j - 1]))
        out.append((len(x), sum(gone), runs, bytes(b for b, g in zip(x, gone) if not g)))
    return out


@pytest.mark.parametrize("length,gram,limit", [(400, 64, 2000), (60, 20, 2000), (60, 20, 1), (25, 25, 3)])
def test_repeated_strings(docs, length, gram, limit):
    rows = _texts()
    want = Counter((i, *r) for (i, _), r in zip(rows, _repeats([t for _, t in rows], length)))
    got = suffix_dedup.remove_repeats(docs, length=length, gram=gram, index_segments=limit, chunk=3000).collect()
    assert Counter((r.id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == want
    assert sum(n for (_, _, removed, _, _), n in want.items() if removed) > 3


def test_run_length_index_on_periodic_strings():
    rnd = random.Random(1)
    for _ in range(60):
        strings = [bytes(rnd.choices(b"ab", k=rnd.randint(1, 40))) * rnd.randint(1, 4) for _ in range(rnd.randint(1, 8))]
        length = rnd.randint(1, 20)
        seen = Counter(s[j:j + length] for s in strings for j in range(len(s) - length + 1))
        want = [[j for j in range(len(s) - length + 1) if seen[s[j:j + length]] > 1] for s in strings]
        assert [x.tolist() for x in suffix_dedup.repeated_windows(strings, length)] == want


# ------------------------------------------------------------------ SimHash
def _fingerprint(t, k=4):
    w = regex.findall(r"[^\x20\x09-\x0D]+", lower(t))
    if not w:
        return 0
    grams = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _components(ids, fps, by_group=False):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[find(i)] = min(x, least.get(find(i), x))
    if by_group:
        return [least.get(x) for x in {find(i) for i in range(len(ids))}]
    return [least.get(find(i)) for i in range(len(ids))]


def test_simhash(docs):
    rows = _texts()
    fps = [_fingerprint(t) for _, t in rows]
    want = Counter((i, f, c) for (i, _), f, c in zip(rows, fps, _components([i for i, _ in rows], fps)))
    got = simhash.near_duplicates(docs).collect()
    assert Counter((r.id, r.fingerprint % (1 << 64), r.component_id) for r in got) == want
    one = simhash.representatives(docs)
    assert one.columns == docs.columns
    assert sorted(r.doc_id for r in one.collect()) == sorted(_components([i for i, _ in rows], fps, by_group=True))


def test_every_link_of_a_cluster_is_found(spark):
    """Chains and a dense cluster: 1 to 6 bits apart at every distance."""
    rnd = random.Random(3)
    fps = set()
    for _ in range(15):
        x = rnd.getrandbits(64)
        for _ in range(25):
            fps.add(x)
            for _ in range(rnd.randint(1, 6)):
                x ^= 1 << rnd.randrange(64)
    center = rnd.getrandbits(64)
    for _ in range(150):
        fps.add(center ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)))
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    got = dict(map(tuple, simhash.link(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()))
    want = _components(signed, fps)
    assert [got.get(s, s) for s in signed] == want


# ------------------------------------------------------------------ mixing
def test_source_targets(spark):
    sizes = [("a", 10), ("b", 1000), ("c", 5), ("d", 0), ("e", 700), (None, 300)]
    got = {r.source: r for r in mixing.source_targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()}
    weight = dict(zip(["a", "b", "c", "d", "e", None], [5, 2, 1, 5, 2, 1]))
    target, left, open_ = {}, sum(s for _, s in sizes), dict(sizes)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = [s for s, n in open_.items() if 3 * n < level * weight[s]]
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in full:
            target[s] = 3 * open_.pop(s)
            left -= target[s]
    assert {s: r.weight for s, r in got.items()} == weight
    assert all(abs(got[s].target - t) < 1e-6 for s, t in target.items())


def test_mix(docs):
    first = mixing.mix(docs, block_len=4, shard_slots=50)
    taken = first.taken.collect()
    assert len(taken) == len(_texts())
    assert Counter((r.id, r.size) for r in taken) == Counter((i, len(regex.findall(r"[^\x20\x09-\x0D]+", norm(t)))) for i, t in _texts())
    assert all(r.taken <= 3 * r.size for r in taken)
    per = defaultdict(int)
    for r in taken:
        per[r.source, r.source_size, r.target] += r.taken
    assert all(abs(n - target) <= 0.02 * target + 8 for (_, _, target), n in per.items()), per
    again = mixing.mix(docs.repartition(5), block_len=4, shard_slots=50)
    assert sorted(map(str, again.taken.collect())) == sorted(map(str, taken))
    slots = first.slots.collect()
    quota = {r.sid: r.quota for r in first.sources.collect()}
    assert Counter(r.sid for r in slots) == Counter({k: v for k, v in quota.items() if v})
    assert len({(r.sid, r.block, r.epoch) for r in slots}) == len(slots) and max(r.epoch for r in slots) <= 2
    # words of a document by hand: each of its places in the stream, as often as its block is taken
    times = Counter((r.sid, r.block) for r in slots)
    want = Counter()
    for r in first.documents.collect():
        want[r.id, r.size, sum(times[r.sid, (r.start + j) // 4] for j in range(r.size))] += 1
    assert Counter((r.id, r.size, r.taken) for r in taken) == want
    # draws: the sources of a shard vary around their share
    shards = Counter((r.shard, r.sid) for r in slots)
    assert len({n for (_, sid), n in shards.items() if sid == 0}) > 1
    out = mixing.mixed_documents(docs, block_len=4)
    assert out.columns == docs.columns and abs(out.count() - len(taken)) < len(taken)


# ------------------------------------------------------------------ token counts
def test_token_counts(docs):
    path = public_tokenizers.path("piece_bpe_32k.model")
    pieces = token_counts.vocabulary(path)
    other = HF(models.Unigram([("<unk>", 0.0), *[(f"<0x{i:02X}>", 0.0) for i in range(256)], *pieces.items()],
                              unk_id=0, byte_fallback=True))
    texts = dict(enumerate(t for _, t in _texts()))
    df = docs.sparkSession.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.row.doc_id: r.n_tokens for r in token_counts.count_tokens(df, path, keep=["doc_id"]).collect()}
    assert got == {i: len(other.encode("▁" + t.replace(" ", "▁"))) if t else 0 for i, t in texts.items()}
    assert token_counts.count_tokens(docs, path).count() == len(_texts())


def test_ties_go_to_the_longer_last_piece():
    machine = token_counts.Viterbi({"a": -1.0, "b": -1.0, "ab": -2.0, "abab": -4.0})
    assert machine.count("abab") == (-4.0, 1) and machine.count("ab") == (-2.0, 1)
    assert machine.count("é") == (-14.0, 2)


# ------------------------------------------------------------------ byte-level BPE
@pytest.mark.parametrize("known", [0, 1 << 18])
def test_byte_bpe(docs, known, monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    monkeypatch.setattr(byte_bpe, "KNOWN_WORDS", known)
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    more = ["I'll don't  we've x y \x85z", "x​y﻿", "٣٤ ½ ²", "á ǅ", "  \n \n\n  tail ", "<|endoftext|>", "\x1c\x1dq\x1e"]
    texts = dict(enumerate([t for _, t in _texts()] + more))
    df = docs.sparkSession.createDataFrame(list(texts.items()), "doc_id long, text string")
    tok = byte_bpe.Tokenizer.load(docs.sparkSession, path, public_tokenizers.PATTERN)
    for r in byte_bpe.decode(byte_bpe.encode(df, tok), tok).collect():
        assert list(r.ids) == enc.encode_ordinary(norm(texts[r.row.doc_id])), repr(texts[r.row.doc_id])
        assert bytes(r.decoded) == norm(texts[r.row.doc_id]).encode()
    # the fold by higher-order functions on every word, against the merges inside tasks
    words = df.select(F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(tok.pattern), F.lit(0))).alias("word")).distinct()
    merger = byte_bpe.Merger(tok.ranks)
    rows = byte_bpe.folded(words, tok).collect()
    for r, own in zip(rows, merger.ids([r.word.encode() for r in rows])):
        assert list(r.ids) == np.frombuffer(own, np.int32).tolist() == enc.encode_ordinary(r.word)


def test_rank_map_is_small():
    """The driver holds several copies of the literals: every pair has its cell, in a few cells a pair."""
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    m, (left, right, rank) = byte_bpe.RankMap(ranks), byte_bpe.merges(ranks)
    literals = [a for k, a in vars(m).items() if k != "pieces"]
    assert sum(a.nbytes for a in literals) < 4_000_000       # 14 MB with an array for each left id
    first, ends, cells = (x.to_numpy().astype(np.int64) for x in (m.first, m.ends, m.cells))
    k = first[left] + right % (first[left + 1] - first[left])
    assert (cells[ends[k] + right % (ends[k + 1] - ends[k])] == (right << 17 | rank)).all()
    assert (cells >= 0).sum() == len(rank)


# ------------------------------------------------------------------ learned operators
def test_language_id_held_out(spark, sf):
    r = (QUERIES["op10_language_id"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
         .where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.avg(F.col("rejected").cast("int"))).first())
    assert r[0] > 0.95 and r[1] < 0.02


@pytest.mark.parametrize("out", ["de", "en", "es", "fr"])
def test_language_id_rejects_an_unlearned_language(spark, out):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    held = corpus_pipeline.crc_mod(F.col("doc_id"), 4) == 2
    model = language_id.fit(docs.where(~held & (F.col("lang") != out)))
    share = {r[0]: r[1] for r in language_id.identify(docs.where(held), model).groupBy(F.col("row.lang") == out)
             .agg(F.avg(F.col("rejected").cast("int"))).collect()}
    assert share[True] > 0.9 and share[False] < 0.015


def test_language_id_rejects_and_und(docs, none):
    train = docs.where("doc_id < 40").withColumn("lang", F.lit("xx"))
    model = language_id.fit(train)
    odd = docs.sparkSession.createDataFrame([(1, None), (2, "123 !!"), (3, "日本語の文章です。" * 60), (4, "Ж" * 500), (5, "")], "doc_id long, text string")
    got = {r.row.doc_id: r for r in language_id.identify(odd, model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 5)] == ["und"] * 3 and all(got[i].rejected for i in got)
    kept = language_id.identify(train, model)
    assert kept.where("rejected and length(trim(row.text)) > 0").count() == 0
    empty = language_id.fit(none)
    assert {r.lang_pred for r in language_id.identify(docs, empty).collect()} == {"und"}


def test_quality_classifier_held_out(spark):
    sf = "/root/testdata/sf0.01"
    r = (QUERIES["op1_quality_classifier"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
         .where("held_out").groupBy("quality").agg(F.avg("predicted")).collect())
    share = {x[0]: x[1] for x in r}
    assert share[1] > 0.95 and share.get(0, 0) < 0.3


def test_quality_classifier_on_awkward_rows(docs, none):
    labels = docs.sparkSession.createDataFrame([(i, i % 2) for i in range(30)] + [(3, 1), (None, 0), (5, None)], "doc_id long, quality int")
    net = quality_classifier.fit(docs, labels, sample_rows=20)
    got = quality_classifier.score(docs, net).collect()
    assert len(got) == len(_texts()) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if not r.row.text}) == 1
    one = quality_classifier.fit(docs, labels.where("quality = 1"))
    assert all(r.score > 0.9 for r in quality_classifier.score(docs, one).collect())
    nothing = quality_classifier.fit(none, labels)
    assert {round(r.score, 6) for r in quality_classifier.score(docs, nothing).collect()} == {0.5}


def test_chunks_do_not_depend_on_neighbours():
    rng = np.random.default_rng(0)
    texts = [bytes(rng.integers(97, 101, n).astype(np.uint8)) for n in (0, 1, 16, 17, 40, 300, 5)]
    net = quality_classifier.fit_network(texts, np.array([0, 1, 0, 1, 0, 1, 0.0]), 0.5, epochs=1)
    together = net.scores(texts, net.tables())
    alone = [net.scores([t], net.tables())[0] for t in texts]
    assert np.allclose(together, alone, atol=1e-6)


def plain_score(net, text):
    """The network's definition, byte by byte."""
    c = quality_classifier
    sym = []
    for i, b in enumerate(text):
        gram = text[i:i + c.GRAM]
        seen = len(gram) == c.GRAM and any(i >= lag and text[i - lag:i - lag + c.GRAM] == gram for lag in range(c.LAGS[0], c.LAGS[1] + 1))
        sym.append(b + 256 * seen)
    halves = max(2, -(-len(text) // c.HALF))
    sym += [c.PAD] * (halves * c.HALF - len(sym))
    pooled = np.zeros(c.FILTERS)
    for i in range(halves - 1):
        chunk = net.embedding[sym[i * c.HALF:i * c.HALF + c.CHUNK]]
        pooled = np.maximum(pooled, np.einsum("ce,cef->f", chunk, net.filters) + net.shift)
    return 1 / (1 + np.exp(-np.clip(pooled @ net.weights + net.bias, -30, 30)))


def test_quality_scores_against_the_definition():
    """Repetitive texts, alone and behind each other."""
    texts = [b"spam spam spam spam spam", b"spam spam spam spam spam", b"", b"a", b"ab" * 50, b"abcabcabcabc" * 9, b"spam " * 80,
             "é".encode() * 40, b"no repeats here, only words", b"x" * 400, b"spam spam"]
    net = quality_classifier.fit_network(texts, np.arange(len(texts)) % 2 * 1.0, 0.5, epochs=2)
    want = [plain_score(net, t) for t in texts]
    assert np.allclose(net.scores(texts, net.tables()), want, atol=1e-5)
    assert np.allclose([net.scores([t], net.tables())[0] for t in texts], want, atol=1e-5)


def test_language_id_against_plain_cosines(docs):
    model = language_id.fit(docs.where("doc_id < 40").withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "a").otherwise("b")))

    def plain(text):
        x = "".join(c if c.isalpha() or ord(c) > 127 else " " for c in text.lower()).encode()
        while b"  " in x:
            x = x.replace(b"  ", b" ")
        v = np.zeros(language_id.DIMENSIONS)
        for i, b in enumerate(x):
            codes = [b]
            if i + 1 < len(x):
                codes.append(b * 257 + x[i + 1] + 7919)
            if i + 2 < len(x):
                codes.append(codes[1] * 263 + x[i + 2] + 104729)
            for c in codes:
                v[(c * 2654435761 >> 11) % language_id.DIMENSIONS] += 1
        v = np.log1p(v) * model.idf
        return v / max(np.linalg.norm(v), 1e-12)
    for r in language_id.identify(docs, model).collect():
        text = r.row.text or ""
        if regex.search(r"\p{L}", text) and len(text) < 3000:
            cos = model.centroids @ plain(text)
            assert abs(r.score - cos.max()) < 1e-4 and model.langs[int(cos.argmax())] == r.lang_pred
        elif not regex.search(r"\p{L}", text):
            assert (r.lang_pred, r.score) == ("und", 0.0)


# ------------------------------------------------------------------ empty tables, the pipeline
def test_empty_tables(none):
    assert exact_dedup.exact_groups(none).count() == 0
    assert line_dedup.drop_common_lines(none).count() == 0
    assert quality_rules.judge(none).count() == 0
    assert suffix_dedup.remove_repeats(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    assert mixing.mix(none).taken.count() == 0 and mixing.mixed_documents(none).count() == 0
    tok = byte_bpe.Tokenizer.load(none.sparkSession, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    assert byte_bpe.decode(byte_bpe.encode(none, tok), tok).count() == 0
    assert token_counts.count_tokens(none, public_tokenizers.path("piece_bpe_32k.model")).count() == 0
    assert language_id.identify(none, language_id.fit(none)).count() == 0


def test_stages_on_awkward_rows(spark, docs, sf):
    """Each stage on the whole table, null and repeated rows included."""
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        assert name == "tokens" or out.columns == docs.columns
        assert out.count() > 0


def test_pipeline(spark, sf):
    """The stages that have one against brute force, on what the stage before kept."""
    d = spark.read.parquet(f"{sf}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "lines", "near_duplicates", "mix", "tokens"]
    outs = [d]
    for _, f in corpus_pipeline.STAGES:
        outs.append(f(spark, outs[-1], sf).cache())
    before, after = ([(r.doc_id, r.text) for r in o.collect()] for o in (outs[1], outs[2]))
    seen = Counter(k for _, t in before for k in {lower(x).strip(" \t\n\x0b\x0c\r") for x in t.split("\n")})
    want = {i: "\n".join(x for x in t.split("\n") if not (lower(x).strip(" \t\n\x0b\x0c\r") and seen[lower(x).strip(" \t\n\x0b\x0c\r")] >= 10)) for i, t in before}
    assert dict(after) == want
    ids = [i for i, _ in after]
    assert sorted(r.doc_id for r in outs[3].collect()) == sorted(set(_components(ids, [_fingerprint(t) for _, t in after])))
    mixed = Counter(r.doc_id for r in outs[4].collect())
    assert max(mixed.values()) <= 3
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    text = dict(after)
    got = outs[5].collect()
    assert Counter(r.doc_id for r in got) == mixed
    assert all(list(r.ids) == enc.encode_ordinary(text[r.doc_id]) for r in got)
    run = corpus_pipeline.run(spark, sf)
    assert Counter(r.doc_id for r in run.select("doc_id").collect()) == mixed
