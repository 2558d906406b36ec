"""Helpers for code that runs on Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Bytes of text that are worked on at once (a longer single text is taken alone).
SLICE_BYTES = 1 << 20
#: Texts that are worked on at once: short ones can be many, and each may take some memory of its own.
SLICE_ROWS = 1024


def text_bytes(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8; a null as no bytes."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def slices(texts: list[bytes], limit: int = SLICE_BYTES, rows: int = SLICE_ROWS) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts with ``limit`` bytes and ``rows`` texts at most, or one text."""
    begin = size = 0
    for i, t in enumerate(texts):
        if i > begin and (size + len(t) > limit or i - begin == rows):
            yield begin, i
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield begin, len(texts)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes in one array, and the offsets of the texts in it (one more than texts)."""
    ends = np.cumsum([0, *map(len, texts)])
    return np.frombuffer(b"".join(texts), np.uint8), ends


_ARROW = {"string": pa.string(), "double": pa.float64(), "int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_()}


def with_columns(df: DataFrame, text_col: str, fields: list[StructField],
                 compute: Callable[[list[bytes]], list], keep: list[str] | None = None) -> DataFrame:
    """(row, *fields): the columns ``keep`` of each row (all by default) as a struct, so that no
    name can clash, and what ``compute`` derives from a list of texts (a list or array for each
    field).  Works slice by slice, so memory does not grow with the batch."""
    names = df.columns if keep is None else keep
    inside = names.index(text_col) if text_col in names else None
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")
    given = df.select(row) if inside is not None else df.select(row, F.col(f"`{text_col}`").alias("text"))

    def run(parts):
        for batch in parts:
            rows = batch.column(0)
            texts = text_bytes(batch.column(1) if inside is None else rows.field(inside))
            for a, b in slices(texts):
                yield pa.RecordBatch.from_arrays(
                    [rows.slice(a, b - a), *[pa.array(x, _ARROW[f.dataType.simpleString()])
                                             for x, f in zip(compute(texts[a:b]), fields)]],
                    names=["row", *[f.name for f in fields]])
    return given.mapInArrow(run, StructType([given.schema["row"], *fields]))
