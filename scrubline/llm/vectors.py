"""Vectors in columns of arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector can take part: not null, not zero, all components finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Vectors of a list column as rows in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
