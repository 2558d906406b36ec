"""Exact quantiles (interpolated, nulls skipped) without gathering a column in one task.

``percentile``/``median`` keep every distinct value of a group in one buffer,
so a global median of a large column ends in one task.  Here:

1. unpivot the columns to ``(column, v)`` and count each distinct value
   (map-side combine: a value held by a third of the rows is one row here);
2. range-partition the distinct values on ``(column, v)`` — sampled bounds,
   so ranges are balanced, and write them with the number of their range;
3. per range, the count of rows (a table of columns x partitions rows) gives
   each range its offset; inside a range a running sum gives each distinct
   value its position interval ``[start, end)``;
4. the two order statistics around ``q * (n - 1)`` are the values whose
   interval holds them; interpolate linearly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.operators.cumulative import in_ranges


def unpivot_numeric(df: DataFrame, cols: list[str], name: str = "column", value: str = "v") -> DataFrame:
    """Long form (column, v) of the given numeric columns as DOUBLE, nulls dropped."""
    arr = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value)) for c in cols])
    return df.select(F.inline(arr)).where(F.col(value).isNotNull())


def exact_quantiles(df: DataFrame, cols: list[str], q: float = 0.5, partitions: int | None = None,
                    out: str = "median") -> DataFrame:
    """One row per column: (column, <out>) — the exact q-quantile, linear interpolation."""
    vc = unpivot_numeric(df, cols).groupBy("column", "v").agg(F.count(F.lit(1)).alias("c"))
    ranged = in_ranges(vc, "column", "v", partitions=partitions, name="quantiles").withColumnRenamed("_pid", "pid")
    per_range = ranged.groupBy("column", "pid").agg(F.sum("c").alias("pc"))
    wr = Window.partitionBy("column").orderBy("pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = per_range.select(
        "column", "pid",
        (F.sum("pc").over(wr) - F.col("pc")).alias("off"),
        F.sum("pc").over(Window.partitionBy("column")).alias("n"))
    wv = Window.partitionBy("column", "pid").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pos = F.lit(q) * (F.col("n") - 1)
    located = (ranged.join(offsets, ["column", "pid"])
               .withColumn("end", F.col("off") + F.sum("c").over(wv))
               .withColumn("start", F.col("end") - F.col("c"))
               .withColumn("pos", pos)
               .withColumn("lo", F.floor("pos"))
               .withColumn("hi", F.ceil("pos"))
               .where(((F.col("start") <= F.col("lo")) & (F.col("lo") < F.col("end")))
                      | ((F.col("start") <= F.col("hi")) & (F.col("hi") < F.col("end")))))
    agg = located.groupBy("column").agg(
        F.max(F.when((F.col("start") <= F.col("lo")) & (F.col("lo") < F.col("end")), F.col("v"))).alias("v_lo"),
        F.max(F.when((F.col("start") <= F.col("hi")) & (F.col("hi") < F.col("end")), F.col("v"))).alias("v_hi"),
        F.first("pos").alias("pos"), F.first("lo").alias("lo"))
    res = agg.select("column", (F.col("v_lo") + (F.col("pos") - F.col("lo")) * (F.col("v_hi") - F.col("v_lo")))
                     .alias(out))
    # columns that are entirely null still get a row (value null)
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    return names.join(res, "column", "left")


def exact_median(df: DataFrame, col: str) -> DataFrame:
    """One-row DataFrame (median) of one column."""
    return exact_quantiles(df, [col]).select("median")
