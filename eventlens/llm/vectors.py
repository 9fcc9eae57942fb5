"""Integer vectors on a lattice: the shared input of op11 and op12.

A vector becomes ``floor(scale * x)`` per component, x as double, held as
little-endian 32-bit binary.  Vectors that are null or hold null or non-finite
components are left out.  Components whose squared distances could not be
summed in a long raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from eventlens.llm.shared import map_arrow, widened

WORD = 4  # bytes a component


def finite(v: Column) -> Column:
    """Whether an array of doubles is there and all its components are finite."""
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & F.coalesce(fine, F.lit(False))


def quantised(vectors: DataFrame, scale: int, vector: Column, **keep: Column) -> DataFrame:
    """The columns of ``keep`` and ``raw``, for every row with a finite vector."""
    rows = vectors.select(*(c.alias(k) for k, c in keep.items()), vector.cast("array<double>").alias("v")).where(
        finite(F.col("v")))
    names = [*keep, "raw"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            dims = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            values = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            most = np.abs(values).max(initial=0)
            if 4 * most * most * dims.max(initial=0) >= 2.0**62 or most >= 2.0**30:
                raise ValueError("vector values too large for exact integer distances")
            ends = np.r_[0, np.cumsum(dims) * WORD].astype(np.int32)
            raw = pa.Array.from_buffers(
                pa.binary(), batch.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(values.astype("<i4"))])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], raw], names=names)

    return map_arrow(rows, run, widened(rows.drop("v").schema, ("raw", BinaryType())))


def matrix(raw: pa.Array, dim: int) -> np.ndarray:
    """Rows x ``dim`` components, of vectors that all have ``dim``."""
    return np.frombuffer(b"".join(raw.to_pylist()), dtype="<i4").reshape(len(raw), dim).astype(np.int64)


def of_dim(table: DataFrame, dim: int) -> DataFrame:
    return table.where(F.length("raw") == dim * WORD)
