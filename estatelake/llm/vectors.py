"""Vectors as whole numbers, and what operators on them share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Whole components stay below this, so that sums of squared differences of 64 of them fit a long.
LARGEST = 1 << 27
#: Whole numbers up to this are exact in double precision.
EXACT = 1 << 53


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are numbers and finite."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def whole(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component in double precision, as an int. A component of LARGEST or more stops the job: its squares would
    leave a long."""
    floor = lambda x: F.floor(x.cast("double") * F.lit(float(scale)))
    return F.transform(vector, lambda x: F.when(F.abs(x) * scale < LARGEST, floor(x).cast("int")).otherwise(F.raise_error(F.lit("a vector's component is too large for exact distances")).cast("int")))


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """An Arrow list column of vectors of one length as rows of a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole rows, exact, as longs."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = int(np.abs(a).max()) * int(np.abs(b).max()) * a.shape[1]
    kind = np.float64 if most < EXACT else np.int64
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)
