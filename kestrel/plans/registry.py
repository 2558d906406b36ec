"""Registry of named queries: a Spark plan per name and, where SQL can express
the result, the equivalent SQL text used as an independent oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def _neutral(df: DataFrame) -> DataFrame:
    """Registered results show DATE columns as midnight TIMESTAMP_NTZ: the same value,
    with one representation across engines and client libraries."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import DateType
    if not any(isinstance(f.dataType, DateType) for f in df.schema.fields):
        return df
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, DateType)
                       else F.col(f.name) for f in df.schema.fields])


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` (with its oracle SQL)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _neutral(fn(spark, sf_dir))
        run.__doc__, run.__name__ = fn.__doc__, fn.__name__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco
