"""Reading the input tables (S1 column-pruned scan, S9 step Parquet)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kestrel.session import configure

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """One input table; with ``columns`` only those reach the Parquet reader."""
    configure(spark)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def scan_columns(df: DataFrame, feature_columns: list[str], target_column: str | None = None) -> DataFrame:
    """Keep only the feature columns and the target (column pruning)."""
    cols = list(feature_columns) + ([target_column] if target_column else [])
    return df.select(*cols)


def read_step(spark: SparkSession, path: str) -> DataFrame:
    """Read the Parquet output of a previous step."""
    return spark.read.parquet(path)
