"""Thin registered queries over the document operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

import public_tokenizers

from kestrel.llm import (byte_bpe, conversation_trie, exact_dedup, jaccard_join, language_id, line_dedup, mixing,
                         quality_classifier, quality_rules, simhash, suffix_dedup, token_alignment, token_counts)
from kestrel.llm.common import crc_mod, documents, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_quality_classifier(spark, sf_dir):
    """Score of every document by a network that saw no held-out label."""
    docs = documents(spark, sf_dir)
    held = crc_mod(F.col("doc_id"), 5) == 0
    net = quality_classifier.fit(docs.where(~held), table(spark, sf_dir, "labels"))
    rows = docs.select("doc_id", held.alias("held_out"), "text")
    return (quality_classifier.score(rows, net, keep=["doc_id", "held_out"]).select("row.*", "score")
            .withColumn("predicted", (F.col("score") >= 0.3).cast("int")))


@query
def op2_line_dedup(spark, sf_dir):
    """Lines with a key found in 10 documents or more leave every document."""
    out = line_dedup.drop_common_lines(documents(spark, sf_dir), min_docs=10)
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped",
                      F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLES["op2_line_dedup"] = f"""
WITH l AS (SELECT rid, doc_id, u.i AS i, u.line AS line,
                  {_LOWER.format(f"trim(u.line, {_SPACES})")} AS k
           FROM (SELECT doc_id, row_number() OVER () AS rid,
                        string_split(coalesce(text, ''), chr(10)) AS ls FROM documents) d,
                LATERAL (SELECT unnest(range(len(d.ls))) AS i, unnest(d.ls) AS line) u),
f AS (SELECT k FROM l WHERE k <> '' GROUP BY k HAVING count(DISTINCT rid) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.k) AS n_dropped,
       sha256(coalesce(string_agg(CASE WHEN f.k IS NULL THEN line END, chr(10) ORDER BY i), '')) AS kept_sha256
FROM l LEFT JOIN f ON l.k = f.k GROUP BY rid, doc_id
"""


@query
def op3_exact_dedup(spark, sf_dir):
    """Groups of texts equal after lower-casing A-Z; the largest doc_id stays."""
    return exact_dedup.exact_groups(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


ORACLES["op3_exact_dedup"] = f"""
WITH n AS (SELECT doc_id, sha256({_LOWER.format("coalesce(text, '')")}) AS h FROM documents),
g AS (SELECT h, max(doc_id) AS keep_id, count(*) AS c FROM n GROUP BY h)
SELECT n.doc_id, g.keep_id, g.c AS group_size, n.doc_id = g.keep_id AS kept, n.h AS text_sha256
FROM n JOIN g ON n.h = g.h
"""


@query
def op4_quality_rules(spark, sf_dir):
    """Base counts and the verdict of the robust outlier test per language and source."""
    return quality_rules.judge(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


@query
def op5_suffix_dedup(spark, sf_dir):
    """Bytes covered by a 400-byte string that also starts elsewhere are removed."""
    return suffix_dedup.remove_repeats(documents(spark, sf_dir), length=400).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"),
        (F.col("n_removed") > 0).alias("removed"))


@query
def op6_simhash_dedup(spark, sf_dir):
    """Fingerprint of 4-word shingles and the component of documents up to 4 bits apart."""
    out = simhash.near_duplicates(documents(spark, sf_dir), shingle=4, max_bits=4)
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
                      "component_id")


@query
def op7_mixing(spark, sf_dir):
    """Words that the mix takes from each document."""
    return mixing.mix(documents(spark, sf_dir)).taken.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


@query
def op8_token_counts(spark, sf_dir):
    """Tokens of every whole text by the unigram Viterbi."""
    out = token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id"])
    return out.select("row.*", "n_tokens", "token_score")


@query
def op9_byte_bpe(spark, sf_dir):
    """Token ids of every whole text, and their bytes again."""
    tok = byte_bpe.Tokenizer.load(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    out = byte_bpe.decode(byte_bpe.encode(documents(spark, sf_dir), tok, keep=["doc_id"]), tok)
    return out.select("row.doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.transform("ids", lambda i: i.cast("string")), " "), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op10_language_id(spark, sf_dir):
    """Language of every document by a model that saw no held-out row."""
    docs = documents(spark, sf_dir)
    held = crc_mod(F.col("doc_id"), 4) == 2
    model = language_id.fit(docs.where(~held))
    rows = docs.select("doc_id", held.alias("held_out"), "text")
    return language_id.identify(rows, model, keep=["doc_id", "held_out"]).select("row.*", "lang_pred", "score", "rejected")


@query
def op11_jaccard_join(spark, sf_dir):
    """Components of documents whose sets of 4-word shingles have a Jaccard similarity of 0.85 or more."""
    return jaccard_join.similar(documents(spark, sf_dir), shingle=4, percent=85).select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id")


@query
def op12_token_alignment(spark, sf_dir):
    """Groups and links of the tokens of two tokenizers, and what the corpus makes of the links."""
    out = token_alignment.align(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
                                public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id"])
    return out.select("row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query
def op13_conversation_trie(spark, sf_dir):
    """Nodes of the prefix trie of all rebuilt conversations."""
    return conversation_trie.trie(table(spark, sf_dir, "conversations"))


#: CRC-32 of a short ASCII text by its definition: one byte after the other, eight divisions for each.
_CRC32 = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split({}, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
                          lambda y, i: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384) ELSE y // 2 END)), 4294967295)"""

ORACLES["op13_conversation_trie"] = f"""
WITH t AS (SELECT conv_id, md5(coalesce(role, '') || chr(1) || coalesce(text, '')) AS h, length(coalesce(text, '')) AS chars,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, n, {_CRC32.format("conv_id::VARCHAR")} % 6 AS h, conv_id - conv_id % 100 AS base
      FROM (SELECT conv_id, max(place) AS n FROM t GROUP BY conv_id)),
k AS (SELECT c.conv_id, c.base, c.h, least(c.h, coalesce(b.n, 0)) AS k, greatest(c.n - c.h, 0) AS rest
      FROM c LEFT JOIN c b ON c.base = b.conv_id),
r AS (SELECT k.conv_id, t.place AS d, t.h, t.chars FROM k JOIN t ON t.conv_id = k.base AND t.place <= k.k
      UNION ALL SELECT k.conv_id, t.place - k.h + k.k, t.h, t.chars FROM k JOIN t ON t.conv_id = k.conv_id AND t.place > k.h),
p AS (SELECT conv_id, 0 AS d, '' AS node, NULL AS parent, 0 AS chars FROM k
      UNION ALL SELECT conv_id, d, string_agg(h, '') OVER w, coalesce(string_agg(h, '') OVER (
                    PARTITION BY conv_id ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ''), chars
                FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY d)),
n AS (SELECT md5(node) AS node, md5(parent) AS parent, d, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars
      FROM p GROUP BY ALL),
ch AS (SELECT parent, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY parent),
a AS (SELECT n.conv_id, n.d, (n.n_convs - 1) * n.chars AS own, CASE WHEN ch.parent IS NULL THEN 1 ELSE 0 END AS leaf
      FROM n LEFT JOIN ch ON n.node = ch.parent),
s AS (SELECT md5(p.node) AS node, sum(a.leaf)::BIGINT AS n_leaves, sum(a.own)::BIGINT AS saved_tokens
      FROM p JOIN a ON p.conv_id = a.conv_id AND p.d <= a.d GROUP BY 1),
e AS (SELECT md5(p.node) AS node, string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) AS ids
      FROM p JOIN k ON p.conv_id = k.conv_id AND p.d = k.k + k.rest GROUP BY 1)
SELECT n.conv_id, n.d AS depth, m.conv_id AS parent_conv_id, n.n_convs, coalesce(ch.n_children, 0) AS n_children, s.n_leaves,
       s.saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM n LEFT JOIN n m ON n.parent = m.node LEFT JOIN ch ON n.node = ch.parent JOIN s ON s.node = n.node LEFT JOIN e ON e.node = n.node
"""
