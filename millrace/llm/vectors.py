"""Vectors that take part in searches and links, and their numpy form."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(column: str = "embedding") -> Column:
    """Not null or empty, all components present and finite, not all zero."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(column, lambda x: x != 0), F.lit(False))


def matrices(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix in double precision) for each vector length among the rows of a list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(offsets)
    out = []
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        out.append((rows, flat[offsets[rows][:, None] + np.arange(size)]))
    return out
