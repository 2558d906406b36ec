"""Sinks and table lifecycle (K2–K6, K8).

Writes are idempotent where a retry can happen: a batch id becomes a partition
that is overwritten dynamically, so re-running the same batch replaces it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def require_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """NOT NULL check before a write: the first null in ``cols`` fails the job.
    The check wraps the column itself, so column pruning cannot remove it."""
    for c in cols:
        df = df.withColumn(c, F.when(F.col(c).isNull(), F.raise_error(F.lit(f"NULL in NOT NULL column {c}")))
                           .otherwise(F.col(c)))
    return df


def append_partitioned(df: DataFrame, path: str, ts_col: str, not_null: list[str],
                       batch_id: str | None = None) -> None:
    """K2: append rows to a day-partitioned Parquet table (p_date = to_date(ts));
    an empty batch writes nothing; with ``batch_id`` a rerun replaces all of that batch,
    days included that it no longer has."""
    out = require_not_null(df, not_null).withColumn("p_date", F.to_date(ts_col))
    if batch_id is None:
        out.write.mode("append").partitionBy("p_date").parquet(path)
    else:
        # the batch is a folder of its own, replaced as a whole
        (out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("p_date")
            .parquet(f"{path.rstrip('/')}/batch_id={batch_id}"))


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K3: append a DataFrame to a table."""
    df.write.mode("append").format(fmt).save(path)


def replace(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K4: create or replace the table's rows (= truncate + load)."""
    df.write.mode("overwrite").format(fmt).save(path)


# text formats default to millisecond timestamps; keep microseconds explicitly
TS_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def write_text_dataset(df: DataFrame, path: str, fmt: str = "json") -> str:
    """A dataset artifact as JSON lines or CSV with a header, timestamps at full precision."""
    w = df.write.mode("overwrite").option("timestampNTZFormat", TS_TEXT).option("timestampFormat", TS_TEXT)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)
    return path


def read_text_dataset(spark: SparkSession, path: str, schema: str, fmt: str = "json") -> DataFrame:
    """Read a JSON / CSV dataset back with an explicit schema (no inference)."""
    r = spark.read.schema(schema).option("timestampNTZFormat", TS_TEXT).option("timestampFormat", TS_TEXT)
    if fmt == "csv":
        r = r.option("header", True)
    return r.format(fmt).load(path)


def write_step(df: DataFrame, path: str) -> str:
    """K8: a step's output as Parquet; returns the path for the next step."""
    df.write.mode("overwrite").parquet(path)
    return path


def create_if_missing(spark: SparkSession, database: str, table: str, ddl: str, location: str,
                      partitioned_by: str | None = None) -> None:
    """K5: CREATE DATABASE / TABLE IF NOT EXISTS (external location, Parquet)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}/{database}.db'")
    part = f" PARTITIONED BY ({partitioned_by})" if partitioned_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{table} ({ddl}) USING parquet{part} "
              f"LOCATION '{location}/{database}.db/{table}'")


def drop(spark: SparkSession, database: str, table: str | None = None) -> None:
    """K6: drop a table, or the whole database with its contents; missing is success."""
    if table:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{table}")
    else:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
