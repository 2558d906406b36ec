"""The corpus pipeline: five stages over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet
to the shared scratch folder and reads it again for the next stage, so a lost executor costs
one stage at most.  All stages but the last return the columns of ``documents``.

Null columns, empty and very long texts, repeated rows and further columns pass through as the operators
define it; an empty table gives an empty result of every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import byte_bpe, language_id, line_dedup, mixing, simhash
from kestrel.llm.common import crc_mod, documents, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; rejected ones go, and so do null texts and texts without a letter.
    A null lang teaches nothing; repeated rows stay or go together."""
    model = language_id.fit(docs.where(crc_mod(F.col("doc_id"), 4) != 2))
    return language_id.identify(docs, model).where(~F.col("rejected")).select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in 10 documents or more leave every document; n_chars follows the text.  A null text becomes an
    empty one; repeated rows count as documents of their own."""
    out = line_dedup.drop_common_lines(docs, min_docs=10)
    new = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return out.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the least id (a null id only if there is no
    other); of rows equal in id and text one stays."""
    return simhash.representatives(docs, shingle=4, max_bits=4)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, whole; a null source is a source of its own."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the hash of the bytes they decode to; a null text has no ids."""
    tok = byte_bpe.Tokenizer.load(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    out = byte_bpe.decode(byte_bpe.encode(docs, tok, keep=["doc_id", "lang", "source"]), tok)
    return out.select("row.*", F.size("ids").cast("long").alias("n_tokens"), "ids",
                      F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("language", language), ("lines", lines), ("near_duplicates", near_duplicates), ("mix", mix), ("tokens", tokens)]

#: Clustering and fuzzy hashing have no SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
