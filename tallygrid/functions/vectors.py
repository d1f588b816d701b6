"""Vector columns: conversions and Arrow batches as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, functions as F


def as_array(df: DataFrame, col: str) -> Column:
    """The column as array<double>, from an array or an ML vector."""
    if isinstance(df.schema[col].dataType, VectorUDT):
        return vector_to_array(F.col(col))
    return F.col(col).cast("array<double>")


def as_vector(df: DataFrame, col: str) -> Column:
    if isinstance(df.schema[col].dataType, VectorUDT):
        return F.col(col)
    return array_to_vector(F.col(col).cast("array<double>"))


def matrix(column: pa.Array) -> np.ndarray:
    """One Arrow list column of a batch as an (n, d) float64 matrix."""
    n = len(column)
    values = column.flatten().to_numpy(zero_copy_only=False).astype("float64", copy=False)
    return values.reshape(n, -1) if n else values.reshape(0, 0)


def lists(values: np.ndarray) -> pa.Array:
    """An (n, d) matrix as an Arrow list column."""
    n, d = values.shape
    offsets = pa.array(np.arange(0, (n + 1) * d, d, dtype="int32")) if d else pa.array([0] * (n + 1), "int32")
    return pa.ListArray.from_arrays(offsets, pa.array(values.ravel()))
