"""Descriptive statistics of feature tables.

All global statistics are single aggregations (partial aggregation on every
partition, one small final merge).  Shares of a total divide by a scalar
subquery rather than a window over everything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from kestrel.fixed import DAILY_STATS_LIMIT, MAX_CLASSES
from kestrel.functions.scalars import round_half_up
from kestrel.operators.quantiles import exact_quantiles


def basic_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """A1: COUNT(*), then AVG, STDDEV (sample), MIN, MAX of each numeric column."""
    aggs = [F.count(F.lit(1)).alias("total_records")]
    for c in cols:
        aggs += [F.avg(c).alias(f"avg_{c}"), F.stddev_samp(c).alias(f"std_{c}"),
                 F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.agg(*aggs)


def existing_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """A2: the five-measure form (count, then avg and stddev of each column)."""
    aggs = [F.count(F.lit(1)).alias("total_records")]
    for c in cols:
        aggs += [F.avg(c).alias(f"avg_{c}"), F.stddev_samp(c).alias(f"std_{c}")]
    return df.agg(*aggs)


def category_counts(df: DataFrame, col: str) -> DataFrame:
    """A4: rows per category, ordered by category."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(col)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """A5: rows per non-null value, most frequent first (ties by value)."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.desc("count"), F.asc(col)))


def pct_of_total(counts: DataFrame, count_col: str = "count", out: str = "percentage",
                 digits: int = 2) -> DataFrame:
    """Count * 100 / SUM(count) OVER (), as DOUBLE, rounded.

    The total is a scalar subquery over the aggregated counts (one value, computed
    once), so no window without partitioning and no join are needed."""
    total = counts.select(F.sum(count_col)).scalar()
    return counts.withColumn(out, round_half_up(F.col(count_col).cast("double") * F.lit(100.0) / total, digits))


def category_distribution_pct(df: DataFrame, col: str) -> DataFrame:
    """A3: count and percent of total per category, most frequent first."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    return pct_of_total(counts).orderBy(F.desc("count"), F.asc(col))


def daily_stats(df: DataFrame, ts_col: str, cols: list[str], n: int = DAILY_STATS_LIMIT) -> DataFrame:
    """Per DATE: record count and averages; the newest ``n`` dates."""
    aggs = [F.count(F.lit(1)).alias("record_count")] + [F.avg(c).alias(f"avg_{c}") for c in cols]
    return df.groupBy(F.to_date(ts_col).alias("date")).agg(*aggs).orderBy(F.desc("date")).limit(n)


def missing_count(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Total number of null cells over the columns (one row)."""
    cols = cols or df.columns
    total = sum((F.sum(F.col(c).isNull().cast("bigint")) for c in cols), F.lit(0).cast("bigint"))
    return df.agg(total.alias("missing"))


def column_medians(df: DataFrame, cols: list[str]) -> DataFrame:
    """Exact interpolated median of each column (nulls skipped), long form."""
    return exact_quantiles(df, cols)


def column_mean_std(df: DataFrame, cols: list[str]) -> DataFrame:
    """Mean and population standard deviation of each column, long form."""
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v"))
                                        for c in cols])))
    return long.groupBy("column").agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"))


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    """Names of numeric columns (schema only, no job)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


def task_type(df: DataFrame, target: str, max_classes: int = MAX_CLASSES) -> DataFrame:
    """A16: 'classification' when the target is a string or has fewer than
    ``max_classes`` distinct non-null values, else 'regression' (one row)."""
    dtype = df.schema[target].dataType
    nd = F.count_distinct(F.col(target))
    kind = F.lit("classification") if isinstance(dtype, StringType) else \
        F.when(nd < max_classes, "classification").otherwise("regression")
    return df.agg(nd.alias("n_distinct"), kind.alias("task_type"))


def dataset_shape(df: DataFrame, target: str, test_ratio: float) -> DataFrame:
    """Rows, feature count, class count, and the sizes of the stratified test and train sets."""
    per = df.groupBy(F.col(target).alias("_c")).agg(F.count(F.lit(1)).alias("_n"))
    return per.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
                   F.lit(len(df.columns) - 1).cast("bigint").alias("n_features"),
                   F.count("_c").alias("n_classes"),
                   F.coalesce(F.sum(F.ceil(F.lit(float(test_ratio)) * F.col("_n"))), F.lit(0)).cast("bigint").alias("n_test")
                   ).withColumn("n_train", F.col("n_rows") - F.col("n_test"))


def union_batches(base: DataFrame, batch: DataFrame) -> DataFrame:
    """Baseline plus a new batch, matched by column name."""
    return base.unionByName(batch)


def except_values(new: DataFrame, base: DataFrame, col: str) -> DataFrame:
    """Distinct values of ``col`` in ``new`` and not in ``base`` (EXCEPT DISTINCT)."""
    return new.select(col).subtract(base.select(col))
