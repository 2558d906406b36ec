"""Column helpers and table helpers shared by the document operators."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.session import configure, scratch_path

#: White space that separates words and is stripped from lines.
SPACES = " \t\n\x0b\x0c\r"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, every other character as it is.  Texts of ASCII only take the fast way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words(text: Column) -> Column:
    """The words of a text (none for null or blank)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_PATTERN), lambda w: w != "")


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also where ``body`` uses it
    inside a lambda (the optimizer would copy a plain column expression into the lambda)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_key(id_: Column, text: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes that identify a row by its id and text.  Rows equal in both
    share the key, and every operator gives such rows the same result."""
    t = F.coalesce(text, F.lit(""))
    return F.xxhash64(id_.cast("string"), t), F.xxhash64(F.lit(1), t, id_.cast("string"))


def written(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: the lineage ends in
    files that every executor can read, and later uses do not compute it again."""
    path = scratch_path(df.sparkSession, name)
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_mod(id_: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (a null id counts as the empty text)."""
    return (F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % n).cast("int")


def smallest_hashes(df: DataFrame, key: str, id_col: str, rows: int) -> DataFrame:
    """Of each ``key`` the ``rows`` rows with the smallest hash of the id.  Rows whose hash is far
    above what that takes, given the key's count, are left out first: the ranking gets a few times
    ``rows`` rows of a key, however many tasks and rows there are."""
    unit = F.shiftright(F.xxhash64(id_col), 11) / F.lit(float(1 << 53)) + 0.5
    per = df.groupBy(key).agg((F.lit(4.0 * rows + 100) / F.count(F.lit(1))).alias("_share"))
    near = df.join(per, key).where(unit < F.col("_share")).drop("_share")
    w = Window.partitionBy(key).orderBy(F.xxhash64(id_col), F.col(id_col))
    return near.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= rows).drop("_rank")
