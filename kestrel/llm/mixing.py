"""Mixing sources to target weights, in blocks of a fixed number of words.

1. Every source gets a target: the budget (all words) shared by weight, no source above
   ``max_repeats`` times its own words, the excess shared again by weight.  Solved in one
   step: in the order of cap over weight the capped sources come first.
2. The documents of a source, in a fixed pseudorandom order, form one stream of words; the
   stream is cut into blocks of ``block_len`` words (the last one may be shorter).
3. The mix has slots in output shards.  In each shard the counts of the sources are one
   multinomial draw (a hashed uniform number for each slot).  Over all shards a source may
   come out some slots above or below its target; slots above it pass, in order, to the
   sources that lack some, so the totals are met exactly.
4. The q-th slot of a source with B blocks takes block ``perm(q mod B)``; ``perm`` is the
   source's own pseudorandom permutation of the block indexes.  No block is taken more
   often than ``max_repeats`` times.
5. Slots, counted by (source, block), are joined with the documents' pieces by block index.

Running totals over documents or shards are taken in two steps (totals of buckets, then
inside a bucket), so no source is ever ordered in one task.

A null text has no words; documents without words are in the result with nothing taken.
A null source is a source of its own, last in the order.  Rows equal in id and text are
separate documents; ties of hashes break on a second one.  Sizes are of whole texts of any length; other columns are not read
or travel as a struct.  An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import WORD_PATTERN, text_key, written

WEIGHTS = (5, 2, 1)
BLOCK_LEN = 64
SHARD_SLOTS = 1024
MAX_REPEATS = 3
SEED = 42
#: Buckets for running totals over the documents of a source.
BUCKETS = 1024
#: Shards that form one bucket for running totals over shards.
SHARDS_PER_BUCKET = 1024
#: Primes below 2**26: a multiplier times a block index stays within 63 bits up to 2**37 blocks.
PRIMES = (67108859, 67108837, 67108819, 67108777, 67108763, 67108757, 67108753, 67108747)


@dataclass
class Mix:
    """``documents``: k1, k2, id, size, sid and the place in the source's stream; ``sources``: sid,
    source, source_size, weight, target, n_blocks, quota; ``slots``: shard, slot, sid, block, epoch;
    ``taken``: id, size, source, source_size, target, taken."""
    documents: DataFrame
    sources: DataFrame
    slots: DataFrame
    taken: DataFrame


def _uniform(text: Column) -> Column:
    """A uniform number in [0, 1) from the first 48 bits of the md5 of ``text``."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("double") / F.lit(float(2 ** 48))


def running_total(df: DataFrame, keys: list[str], bucket: str, order: list[str], value: str, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows before this one, within ``keys``, in
    the order of (bucket, *order)."""
    per = df.groupBy(*keys, bucket).agg(F.sum(value).alias("_part"))
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select(*keys, bucket, F.coalesce(F.sum("_part").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (df.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .join(offsets, [*keys, bucket])
            .withColumn(out, F.col("_before") + F.col("_inside")).drop("_before", "_inside"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget: float = 1.0, max_repeats: int = MAX_REPEATS,
                   block_len: int = BLOCK_LEN) -> DataFrame:
    """From (source, source_size): sid (rank by code point, null last), weight, target, n_blocks, quota
    (slots the source gets).  One row per source; the windows here run over that table only."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    s = (sizes.withColumn("sid", F.row_number().over(by_name) - 1)
         .withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("sid") % len(weights) + 1))
         .withColumn("cap", F.col("source_size") * max_repeats))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    s = (s.withColumn("total", F.sum("source_size").over(every) * F.lit(budget))
         .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
                     / F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("open", (F.col("cap") >= F.col("level") * F.col("weight")).cast("int"))
         # the first source below its cap sets the level of all from there on
         .withColumn("opened", F.max("open").over(by_cap.rowsBetween(Window.unboundedPreceding, 0)))
         .withColumn("level", F.first(F.when(F.col("open") == 1, F.col("level")), ignorenulls=True)
                     .over(by_cap.rowsBetween(Window.unboundedPreceding, 0)))
         .withColumn("target", F.when(F.col("opened") == 1, F.col("level") * F.col("weight"))
                     .otherwise(F.col("cap").cast("double"))))
    n_blocks = F.ceil(F.col("source_size") / block_len).cast("long")
    quota = F.least(F.floor(F.col("target") * F.col("n_blocks") / F.col("source_size") + 0.5).cast("long"),
                    F.col("n_blocks") * max_repeats)
    return (s.withColumn("n_blocks", n_blocks)
            .withColumn("quota", F.when(F.col("source_size") > 0, quota).otherwise(F.lit(0)).cast("long"))
            .select("sid", "source", "source_size", "weight", "target", "n_blocks", "quota"))


def _cells(intervals: DataFrame, width: int) -> DataFrame:
    """(sid, lo, hi) with hi > lo, once for every cell of ``width`` numbers that it meets."""
    return intervals.where(F.col("hi") > F.col("lo")).select(
        "sid", "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor((F.col("hi") - 1) / width))).alias("cell"))


def draw_slots(sources: DataFrame, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """(shard, slot, sid, q): multinomial draws shard by shard, totals brought to the quotas."""
    spark = sources.sparkSession
    n = sources.agg(F.sum("quota")).first()[0] or 0
    upto = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)
    quotas = sources.select("sid", "quota", F.coalesce(F.sum("quota").over(upto), F.lit(0)).alias("lo"))
    quotas = quotas.withColumn("hi", F.col("lo") + F.col("quota"))
    drawn = (spark.range(n).select(
        F.floor(F.col("id") / shard_slots).alias("shard"), (F.col("id") % shard_slots).alias("slot"),
        F.floor(_uniform(F.concat_ws(":", F.lit(seed), F.col("id"))) * n).alias("x"))
        .withColumn("cell", F.floor(F.col("x") / shard_slots)))
    drawn = written(drawn.join(_cells(quotas, shard_slots), "cell")
                    .where((F.col("x") >= F.col("lo")) & (F.col("x") < F.col("hi")))
                    .select("shard", "slot", "sid"), "mix-drawn")

    # place of a slot among all slots drawn for its source
    counts = drawn.groupBy("sid", "shard").agg(F.count(F.lit(1)).alias("c")).withColumn(
        "bucket", F.floor(F.col("shard") / SHARDS_PER_BUCKET))
    starts = running_total(counts, ["sid"], "bucket", ["shard"], "c", "start").select("sid", "shard", "start")
    totals = sources.select("sid", "quota").join(
        drawn.groupBy("sid").agg(F.count(F.lit(1)).alias("drawn")), "sid", "left").fillna(0, ["drawn"])
    over = totals.select("sid", "quota", "drawn", F.coalesce(
        F.sum(F.greatest(F.col("drawn") - F.col("quota"), F.lit(0))).over(upto), F.lit(0)).alias("over_lo"))
    lack = totals.select("sid", F.col("drawn"), F.greatest(F.col("quota") - F.col("drawn"), F.lit(0)).alias("k"))
    lack = (lack.withColumn("lo", F.coalesce(F.sum("k").over(upto), F.lit(0)))
            .withColumn("hi", F.col("lo") + F.col("k")))
    placed = (drawn.join(starts, ["sid", "shard"])
              .withColumn("q", F.col("start") + F.row_number().over(
                  Window.partitionBy("sid", "shard").orderBy("slot")) - 1)
              .join(F.broadcast(over) if _few(sources) else over, "sid"))
    kept = placed.where(F.col("q") < F.col("quota")).select("shard", "slot", "sid", "q")
    moved = (placed.where(F.col("q") >= F.col("quota"))
             .select("shard", "slot", (F.col("over_lo") + F.col("q") - F.col("quota")).alias("e"))
             .withColumn("cell", F.floor(F.col("e") / shard_slots))
             .join(_cells(lack, shard_slots).join(lack.select("sid", "drawn"), "sid"), "cell")
             .where((F.col("e") >= F.col("lo")) & (F.col("e") < F.col("hi")))
             .select("shard", "slot", "sid", (F.col("drawn") + F.col("e") - F.col("lo")).alias("q")))
    return kept.unionByName(moved)


def _few(sources: DataFrame, bound: int = 10_000) -> bool:
    """Whether the table of sources (a few numbers and a name each) is small enough to broadcast."""
    return sources.limit(bound + 1).count() <= bound


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, budget: float = 1.0, block_len: int = BLOCK_LEN, shard_slots: int = SHARD_SLOTS,
        max_repeats: int = MAX_REPEATS, seed: int = SEED) -> Mix:
    text = F.coalesce(F.col(text_col), F.lit(""))
    k1, k2 = text_key(F.col(id_col), F.col(text_col))
    size = F.size(F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0))).cast("long")
    rows = written(df.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), k1.alias("k1"),
                             k2.alias("k2"), size.alias("size")), "mix-rows")
    sources = written(source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")),
                                     weights, budget, max_repeats, block_len), "mix-sources")
    few = _few(sources)
    # null-safe join; the table of sources is broadcast behind a check of its size
    key = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")).alias("_s")
    names = sources.select(key, "sid", F.col("source").alias("_source"), "source_size", "target", "n_blocks")
    docs = (rows.select("id", "k1", "k2", "size", key)
            .join(F.broadcast(names) if few else names, "_s")
            .withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "k1"), F.lit(BUCKETS)).cast("int")))
    placed = running_total(docs, ["sid"], "bucket", ["k1", "k2"], "size", "start")

    slots = draw_slots(sources, shard_slots, seed)
    blocks = sources.select("sid", "n_blocks")
    b = F.col("n_blocks")
    pick = F.element_at(F.array(*[F.lit(p) for p in PRIMES]), (F.col("sid") % len(PRIMES) + 1).cast("int"))
    # coprime with the number of blocks: a prime that does not divide it (two of them cannot both, below 2**37)
    step = F.when(b % pick != 0, pick).when(b % PRIMES[0] != 0, F.lit(PRIMES[0])).otherwise(F.lit(PRIMES[1]))
    shift = F.floor(_uniform(F.concat_ws(":", F.lit("shift"), F.lit(seed), F.col("sid"))) * b)
    slots = (slots.join(F.broadcast(blocks) if few else blocks, "sid")
             .withColumn("epoch", F.floor(F.col("q") / b))
             .withColumn("block", ((F.col("q") % b) * step + shift) % b)
             .select("shard", "slot", "sid", "block", "epoch"))
    slots = written(slots, "mix-slots")
    times = slots.groupBy("sid", "block").agg(F.count(F.lit(1)).alias("times"))

    pieces = (placed.where(F.col("size") > 0)
              .select("sid", "k1", "k2", "start", "size",
                      F.explode(F.sequence(F.floor(F.col("start") / block_len),
                                           F.floor((F.col("start") + F.col("size") - 1) / block_len))).alias("block"))
              .withColumn("n", F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_len)
                          - F.greatest(F.col("start"), F.col("block") * block_len)))
    # a document's place in its stream tells apart rows that share id and text
    got = (pieces.join(times, ["sid", "block"])
           .groupBy("sid", "start", "k1", "k2").agg(F.sum(F.col("n") * F.col("times")).alias("taken")))
    withwords = placed.where(F.col("size") > 0).join(got, ["sid", "start", "k1", "k2"], "left")
    without = placed.where(F.col("size") == 0).withColumn("taken", F.lit(None).cast("long"))
    taken = withwords.unionByName(without).select(
        "id", "k1", "k2", "size", F.col("_source").alias("source"), "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    return Mix(placed, sources, slots, taken)


def mixed_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df``, each as often as the mix takes it: taken over size times, a fraction being
    decided by the row's hash.  Rows equal in id and text share their copies; texts stay whole, and
    rows without words have no place in a mix of words."""
    taken = mix(df, id_col, text_col, **options).taken
    per = (taken.groupBy("k1", "k2").agg(F.sum("taken").alias("t"), F.max("size").alias("s")).where("s > 0")
           .select("k1", "k2", F.floor(F.col("t") / F.col("s") + _uniform(F.concat_ws(":", F.lit("copy"), "k1", "k2")))
                   .cast("int").alias("copies")).where("copies > 0"))
    k1, k2 = text_key(F.col(id_col), F.col(text_col))
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), k1.alias("k1"), k2.alias("k2"))
    return (packed.join(per, ["k1", "k2"]).dropDuplicates(["k1", "k2"])
            .select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*"))
