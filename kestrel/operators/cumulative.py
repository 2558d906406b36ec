"""Running aggregates over an ordering without a single-partition window.

``Window.orderBy(x)`` with no partitioning moves every row to one task.  Here
the rows are range-partitioned once, written with the number of their range on (keys, order) — sampled bounds keep ranges
balanced — each range computes its own running aggregate, and the aggregate of
all earlier ranges of the same key (a table of keys x ranges rows) is added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.session import scratch_path

_AGG = {"sum": F.sum, "max": F.max, "min": F.min}
_COMBINE = {"sum": lambda a, b: a + b, "max": F.greatest, "min": F.least}


def in_ranges(df: DataFrame, *order, partitions: int | None = None, name: str = "ranges") -> DataFrame:
    """``df`` cut into ranges of ``order``, with the number of its range as ``_pid``, written to the
    shared scratch folder: range bounds come from a sample, and a second evaluation of the
    same plan may draw another one, so everything that uses the ranges reads this table."""
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, name)
    ranged = df.repartitionByRange(parts, *order).withColumn("_pid", F.spark_partition_id())
    ranged.write.parquet(path)
    return spark.read.schema(ranged.schema).parquet(path)


def running(df: DataFrame, keys: list[str], order: str, cols: list[str], how: str = "sum",
            descending: bool = False, partitions: int | None = None, inclusive: bool = True,
            prefix: str = "cum_") -> DataFrame:
    """Adds ``<prefix><col>`` = running ``how`` of each column within ``keys`` in ``order``
    and ``tot_<col>`` = the aggregate over the whole key group.  Null keys form a group.
    ``inclusive=False`` excludes the current row (null when nothing precedes)."""
    o = F.desc(order) if descending else F.asc(order)
    agg, comb = _AGG[how], _COMBINE[how]
    ranged = in_ranges(df, *[F.col(k) for k in keys], o, partitions=partitions, name="running")
    per = ranged.groupBy(*keys, "_pid").agg(*[agg(c).alias(f"_t_{c}") for c in cols])
    wp = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    wall = Window.partitionBy(*keys)
    offs = per.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_pid").alias("_k_pid"),
                      *[agg(f"_t_{c}").over(wp).alias(f"_o_{c}") for c in cols],
                      *[agg(f"_t_{c}").over(wall).alias(f"tot_{c}") for c in cols])
    end = Window.currentRow if inclusive else -1
    w = Window.partitionBy(*keys, "_pid").orderBy(o).rowsBetween(Window.unboundedPreceding, end)
    same = F.col("_pid") == F.col("_k_pid")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    out = ranged.join(offs, same).drop("_k_pid", *[f"_k_{k}" for k in keys])
    for c in cols:
        out = out.withColumn(f"_i_{c}", agg(c).over(w))          # one window evaluation per column
    for c in cols:
        inside, before = F.col(f"_i_{c}"), F.col(f"_o_{c}")
        val = F.when(before.isNull(), inside).when(inside.isNull(), before).otherwise(comb(before, inside))
        out = out.withColumn(f"{prefix}{c}", val)
    return out.drop("_pid", *[f"_o_{c}" for c in cols], *[f"_i_{c}" for c in cols])


def last_value(df: DataFrame, keys: list[str], order: list[str], value: str, out: str, partitions: int | None = None,
               name: str = "last") -> DataFrame:
    """Adds ``out`` = the last non-null ``value`` of the same ``keys`` up to and with the row, in ``order`` (nulls
    first).  Null keys form a group.  Rows are cut into ranges of (keys, order), so a key that holds a third of
    them is spread over as many ranges; the last value of a range is carried to the later ranges of its key
    through a table of keys x ranges rows."""
    ranged = in_ranges(df, *[F.col(k) for k in keys], *[F.col(c) for c in order], partitions=partitions, name=name)
    known = F.when(F.col(value).isNotNull(), F.struct(*order))
    per = ranged.groupBy(*keys, "_pid").agg(F.max_by(F.col(value), known).alias("_end"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carry = per.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_pid").alias("_k_pid"),
                       F.last("_end", ignorenulls=True).over(before).alias("_carry"))
    same = F.col("_pid") == F.col("_k_pid")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    inside = Window.partitionBy(*keys, "_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (ranged.withColumn("_in", F.last(value, ignorenulls=True).over(inside)).join(carry, same)
            .withColumn(out, F.coalesce("_in", "_carry")).drop("_pid", "_in", "_carry", "_k_pid", *[f"_k_{k}" for k in keys]))
