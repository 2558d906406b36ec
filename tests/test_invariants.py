"""
numpy's on arbitrary data (property-based)."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kestrel.operators import series as S
from kestrel.operators.quantiles import exact_quantiles
from kestrel.sources.derived import SENSORS, series_doc


def test_pivot_then_unpivot_is_identity(spark, sf):
    parsed = S.parse_series(series_doc(spark, sf))
    long = S.points_by_position(parsed).select("ts", "name", "min", "max")
    wide = S.pivot_wide(long, SENSORS, ["ts"])
    back = wide.select("ts", F.inline(F.array(*[
        F.struct(F.lit(n).alias("name"), F.col(f"{n}_min").alias("min"), F.col(f"{n}_max").alias("max"))
        for n in SENSORS])))
    key = ["ts", "name"]
    a = sorted(tuple(r) for r in long.select(*key, "min", "max").collect())
    b = sorted(tuple(r) for r in back.select(*key, "min", "max").collect())
    assert a == b


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.floats(-1e6, 1e6, allow_nan=False), st.sampled_from([0.0, 1.5, -2.0])),
                min_size=1, max_size=60),
       st.sampled_from([0.0, 0.1, 0.5, 0.9, 1.0]))
def test_exact_quantile_property(spark, values, q):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = exact_quantiles(df, ["x"], q=q, partitions=3, out="v").collect()[0].v
    assert got == pytest.approx(float(np.quantile(np.array(values), q)), rel=1e-9, abs=1e-9)
