"""Exact dedup with a heavy-hitter split.

One pass over the texts writes (id, SHA-256 of the normalised text).  Misra-Gries
counters (``freqItems``: at most ``1 / support`` digests, merged from per-task counters)
name the digests that may be frequent; an exact, map-side combined count verifies them.
The verified winners, at most ``1 / support`` rows, are broadcast and take their rows out
on the map side.  Every remaining digest has fewer rows than the support asks for and is
shuffled the ordinary way.

Null text counts as the empty text.  Rows repeated with the same id and text are one row
with a count until the end; of them one is kept.  A null id never wins against another id.
Texts of any length are hashed whole; other columns are not read.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import lower_ascii, written

#: Misra-Gries counters kept: 1 / SUPPORT, the bound of the broadcast.
SUPPORT = 0.001


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 support: float = SUPPORT) -> DataFrame:
    """One row per input row: (id, keep_id, group_size, kept, digest).  Texts are equal
    when identical after lower-casing A-Z; the row with the largest id stays."""
    digest = F.sha2(lower_ascii(F.coalesce(F.col(text_col), F.lit(""))), 256)
    rows = written(df.select(F.col(id_col).alias("id"), digest.alias("digest"))
                   .groupBy("id", "digest").agg(F.count(F.lit(1)).alias("n")), "exact-digests")
    total = rows.agg(F.sum("n")).first()[0] or 0

    # Misra-Gries candidates, at most 1 / support of them
    likely = (rows.stat.freqItems(["digest"], support)
              .select(F.explode("digest_freqItems").alias("digest")).distinct())
    winners = written(rows.join(F.broadcast(likely), "digest", "left_semi")
                      .groupBy("digest").agg(F.max("id").alias("keep_id"), F.sum("n").alias("group_size"))
                      .where(F.col("group_size") >= max(2.0, support * total)), "exact-winners")

    marked = rows.join(F.broadcast(winners), "digest", "left")
    hot = marked.where(F.col("group_size").isNotNull())
    w = Window.partitionBy("digest")
    rest = (marked.where(F.col("group_size").isNull()).select("digest", "id", "n")
            .withColumn("keep_id", F.max("id").over(w)).withColumn("group_size", F.sum("n").over(w)))
    both = hot.select("digest", "id", "n", "keep_id", "group_size").unionByName(rest)
    return (both.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
            .select("id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
                    (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "digest"))
