"""Vectors as integers, and their Arrow columns as numpy arrays, for operators that work on vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Components saturate here, so that a squared distance of vectors of up to 128 components fits a 64-bit integer.
LARGEST = 1 << 27


def sound(vector: Column) -> Column:
    """Neither null nor with a null or non-finite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite


def integers(vectors: DataFrame, vector: str, scale: int) -> Column:
    """floor(scale * component) of each component, saturating at `LARGEST`."""
    bounded = lambda x: F.least(F.greatest(x, F.lit(-float(LARGEST))), F.lit(float(LARGEST)))
    return F.transform(F.col(vector).cast("array<double>"), lambda x: F.floor(bounded(x * float(scale))).cast("int"))


def matrix(column: pa.Array, width: int, dtype=np.int64) -> np.ndarray:
    """A list column whose lists have `width` entries, a row each."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(len(column), width)


def lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """The rows of a matrix as a list column."""
    offsets = pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(values).reshape(-1), kind))


def floor_means(sums: np.ndarray, counts: np.ndarray, old: np.ndarray) -> np.ndarray:
    """floor(sum / count) by component, and the old vector where nothing was counted. Numpy's integer division floors."""
    return np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], old)


def products(vectors: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """vectors @ factors.T, exact. Where no sum can pass 2**53 doubles are exact too, and faster."""
    if not vectors.size or not factors.size:
        return np.zeros((len(vectors), len(factors)), np.int64)
    if float(np.abs(vectors).max()) * float(np.abs(factors).sum(axis=1).max()) < 2**53:
        return (vectors.astype(np.float64) @ factors.T.astype(np.float64)).astype(np.int64)
    return vectors @ factors.T
