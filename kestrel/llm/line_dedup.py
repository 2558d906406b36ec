"""Line dedup over levelled sorted runs of line hashes.

A line's key is the line stripped of white space and lower-cased (A-Z), hashed to 128
bits.  Batches of documents are taken in one after the other:

* the batch's (key, number of documents) counts are merge-anti-joined with the runs of
  keys already decided (found in ``min_docs`` documents or more), so that a decided key
  is never carried again;
* what is left is written as a new sorted run of level 0;
* when a level holds ``fanout`` runs they are compacted: counts of a key are added up,
  keys that reach ``min_docs`` move to a run of decided keys, the others form one sorted
  run of the next level.

At the end the counts left in all levels are added up once.  The decided keys are joined
with the distinct keys of each document (salted: a line may be in a third of the
documents), which gives each document the few keys it loses; only those travel to the text.

Null or empty texts are one empty line, which has no key and stays.  Repeated rows count
as documents of their own.  A text of any length is split whole; lines are equal or not, so there are no
ties.  Columns travel as a struct (no name can clash).  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm.common import SPACES, lower_ascii, text_key, written

#: Batches that one call takes the table in, and runs a level holds before it is compacted.
BATCHES = 4
FANOUT = 2
#: Copies of a decided key in the join with documents.  A decided key is in ``min_docs``
#: documents at least, so the copies are at most SALTS / min_docs times its matches.
SALTS = 16


def line_keys(text: Column) -> Column:
    """The key of every line, in order; the empty string for a line without one."""
    return F.transform(F.split(lower_ascii(F.coalesce(text, F.lit(""))), "\n"),
                       lambda x: F.btrim(x, F.lit(SPACES)))


def _hashed(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit(1), key).alias("b"))


class SortedRuns:
    """Levelled sorted runs of (a, b, n): key hash and the number of documents with it."""

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = FANOUT):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.levels: list[list[DataFrame]] = [[]]
        self.decided: list[DataFrame] = []

    def _run(self, counts: DataFrame, name: str) -> DataFrame:
        return written(counts.sortWithinPartitions("a", "b"), name)

    def add(self, keys: DataFrame) -> None:
        """Takes in a batch: one row (a, b) for each document and distinct key in it."""
        new = keys.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
        for run in self.decided:
            new = new.join(run.hint("merge"), ["a", "b"], "left_anti")
        self.levels[0].append(self._run(new, "line-run-0"))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            self._compact(level)
            level += 1

    def _compact(self, level: int) -> None:
        both = self._sum(self.levels[level])
        merged = self._run(both, f"line-run-{level + 1}")
        self.levels[level] = []
        if len(self.levels) == level + 1:
            self.levels.append([])
        self.decided.append(merged.where(F.col("n") >= self.min_docs).select("a", "b"))
        self.levels[level + 1].append(merged.where(F.col("n") < self.min_docs))

    def _sum(self, runs: list[DataFrame]) -> DataFrame:
        out = runs[0]
        for r in runs[1:]:
            out = out.unionByName(r)
        return out.groupBy("a", "b").agg(F.sum("n").alias("n"))

    def frequent(self) -> DataFrame:
        """The keys (a, b) found in ``min_docs`` documents or more, each once."""
        out = (self._sum([r for level in self.levels for r in level])
               .where(F.col("n") >= self.min_docs).select("a", "b"))
        # a key is decided once and then kept out of later runs, so nothing repeats
        for run in self.decided:
            out = out.unionByName(run)
        return out


def drop_common_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10,
                      batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``df`` with its text rid of common lines: (row: the input row as a struct, kept_text,
    n_lines, n_dropped).  Lines that stay are joined by a line feed, in order."""
    spark = df.sparkSession
    text = F.col(text_col)
    k1, k2 = text_key(F.col(id_col), text)
    distinct = F.transform(F.array_distinct(F.filter(line_keys(text), lambda k: k != "")), _hashed)
    keyed = written(df.select(k1.alias("k1"), k2.alias("k2"), distinct.alias("keys"))
                    .where(F.size("keys") > 0)
                    .withColumn("batch", F.pmod(F.col("k1"), F.lit(batches)).cast("int")), "line-keys", "batch")

    runs = SortedRuns(spark, min_docs, fanout)
    for i in range(batches):
        runs.add(keyed.where(F.col("batch") == i).select(F.inline("keys")))
    common = written(runs.frequent(), "line-common")

    salted = common.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    lost = (keyed.select("k1", "k2", F.pmod(F.col("k2"), F.lit(SALTS)).cast("int").alias("salt"), F.inline("keys"))
            .join(salted, ["a", "b", "salt"], "left_semi")
            # rows equal in id and text share the key: a set, not a list
            .groupBy("k1", "k2").agg(F.collect_set("a").alias("lost")))

    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), k1.alias("k1"), k2.alias("k2"))
    t = F.coalesce(F.col(f"row.`{text_col}`"), F.lit(""))
    lines = F.split(t, "\n")
    # line and key side by side; a key without hash match stays
    stay = F.transform(
        F.filter(F.arrays_zip(lines.alias("line"), line_keys(t).alias("key")),
                 lambda x: (x["key"] == "") | ~F.array_contains(F.col("lost"), F.xxhash64(x["key"]))),
        lambda x: x["line"])
    joined = rows.join(lost, ["k1", "k2"], "left")
    return (joined.withColumn("stay", F.when(F.col("lost").isNotNull(), stay))
            .select("row", F.size(lines).cast("long").alias("n_lines"),
                    F.when(F.col("lost").isNull(), t).otherwise(F.array_join("stay", "\n")).alias("kept_text"),
                    F.when(F.col("lost").isNull(), F.lit(0)).otherwise(F.size(lines) - F.size("stay"))
                    .cast("long").alias("n_dropped")))
