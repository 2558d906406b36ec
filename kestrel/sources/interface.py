"""Z3: pluggable series source and storage, as small interfaces over DataFrames.

A source returns documents ``(doc_id, doc)`` for a time range; a storage takes a
DataFrame and a destination and returns where it landed.  Both run on the
cluster: implementations read and write with the DataFrame reader / writer.
"""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.sources.derived import series_doc


class SeriesSource(Protocol):
    def fetch(self, start: str, end: str) -> DataFrame: ...


class Storage(Protocol):
    def upload(self, df: DataFrame, destination: str) -> str: ...


class DerivedSeriesSource:
    """Documents built from the events table (one per day)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def fetch(self, start: str, end: str) -> DataFrame:
        d = series_doc(self.spark, self.sf_dir)
        return d.where(F.col("doc_id").between(start, end))


class FileSeriesSource:
    """Documents stored as JSON lines ``{doc_id, doc}`` under a folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def fetch(self, start: str, end: str) -> DataFrame:
        d = self.spark.read.schema("doc_id string, doc string").json(self.path)
        return d.where(F.col("doc_id").between(start, end))


class FileStorage:
    """Writes a DataFrame as JSON lines under ``base/destination``."""

    def __init__(self, base: str):
        self.base = base.rstrip("/")

    def upload(self, df: DataFrame, destination: str) -> str:
        path = f"{self.base}/{destination}"
        df.write.mode("overwrite").json(path)
        return path
