"""Integer vectors: whole components of embeddings, and matrices of them in Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def sound(vector: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    inf = float("inf")
    return F.coalesce(F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < inf)), F.lit(False))


def whole(vector: str, scale: int, most: int) -> Column:
    """floor(scale * x) of each component x, taken as a double, as array<int>. A component beyond ``most`` fails: results on it wouldn't fit their types."""
    floor = lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))
    bad = F.raise_error(F.lit(f"a component times {scale} is beyond {most}"))
    return F.transform(F.col(vector), lambda x: F.when(F.abs(F.lit(float(scale)) * x.cast("double")) > most, bad.cast("int")).otherwise(floor(x).cast("int")))


def matrix(column: pa.Array, dims: int, kind=np.int64) -> np.ndarray:
    """Vectors of a list column as rows of ``dims`` components; shorter ones are filled with zeros."""
    sizes = np.diff(np.asarray(column.offsets))
    flat = np.asarray(column.flatten())
    if (sizes == dims).all():
        return flat.reshape(-1, dims).astype(kind, copy=False)
    out = np.zeros((len(sizes), dims), kind)
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


def lists(rows: np.ndarray) -> pa.ListArray:
    """The rows of a matrix as a list column."""
    n, width = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(np.ascontiguousarray(rows).ravel()))
