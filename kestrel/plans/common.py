"""Helpers shared by the registered plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions.scalars import round_half_away
from pyspark.sql.types import DoubleType, FloatType

DIGITS = 6


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every floating column for a stable cross-engine comparison
    (sums of doubles differ in the last bits with the order of addition)."""
    return df.select(*[round_half_away(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
                       for f in df.schema.fields])
