"""Helpers to move feature columns into numpy inside executor tasks."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

FEATURES = "_x"

# Model state shipped to tasks with the closure is capped: a codebook or a
# network above this size must not be broadcast this way.
MAX_MODEL_BYTES = 256 << 20


def as_double_array(df: DataFrame, col: str | list[str]) -> Column:
    """Features as ``array<double>`` from an array column, a vector column
    or a list of numeric columns."""
    if isinstance(col, (list, tuple)):
        return F.array(*[F.col(c).cast("double") for c in col])
    dtype = df.schema[col].dataType
    if isinstance(dtype, VectorUDT):
        return vector_to_array(F.col(col))
    if isinstance(dtype, ArrayType):
        return F.col(col).cast("array<double>")
    raise TypeError(f"{col}: expected array, vector or a list of columns")


def batch_matrix(series: pd.Series) -> np.ndarray:
    if len(series) == 0:
        return np.zeros((0, 0))
    return np.stack(series.to_numpy()).astype(np.float64, copy=False)


def array_matrix(column: pa.Array) -> np.ndarray:
    """Rows of an Arrow column of lists as a matrix, without a copy; a null
    element is NaN. A null list, or lists of several sizes, are an error."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros((0, 0))
    if column.null_count:
        raise ValueError("a row has no features")
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    if not (sizes == sizes[0]).all():
        raise ValueError("rows have several numbers of features")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(column), int(sizes[0]))


def check_model_size(*arrays: np.ndarray) -> None:
    size = sum(a.nbytes for a in arrays)
    if size > MAX_MODEL_BYTES:
        raise ValueError(f"model state of {size} bytes exceeds {MAX_MODEL_BYTES}")


def is_vector(df: DataFrame, col: str | list[str]) -> bool:
    return isinstance(col, str) and isinstance(df.schema[col].dataType, VectorUDT)


@dataclass
class SparseRows:
    """Rows of vectors as compressed sparse rows: the entries of row i are
    ``start[i]:start[i + 1]`` of ``index`` and ``value``. Memory follows the
    stored entries, not rows x dimension."""

    start: np.ndarray
    index: np.ndarray
    value: np.ndarray
    dim: int

    def __len__(self) -> int:
        return len(self.start) - 1

    def rows(self, lo: int, hi: int) -> "SparseRows":
        a, b = self.start[lo], self.start[hi]
        return SparseRows(self.start[lo:hi + 1] - a, self.index[a:b], self.value[a:b], self.dim)

    def row_of_entry(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.start))

    def dense(self, rows: np.ndarray) -> np.ndarray:
        """The given rows as a dense matrix."""
        out = np.zeros((len(rows), self.dim))
        for k, r in enumerate(rows):
            own = slice(self.start[r], self.start[r + 1])
            out[k, self.index[own]] = self.value[own]
        return out

    def row_sums(self, of_entry: np.ndarray) -> np.ndarray:
        """Sum of ``of_entry`` (one row for each entry) by row."""
        out = np.zeros((len(self), *of_entry.shape[1:]))
        full = np.flatnonzero(np.diff(self.start))
        if len(full):
            out[full] = np.add.reduceat(of_entry, self.start[full], axis=0)
        return out


def sparse_rows(column: pa.Array, dim: int) -> SparseRows:
    """CSR of an Arrow column of vectors in their struct form (type 0: sparse
    with indices, type 1: dense). A null vector, or one of another size, is
    an error."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        raise ValueError("a feature vector is null")
    kind, size, indices, values = (column.field(n) for n in ("type", "size", "indices", "values"))
    is_sparse = kind.to_numpy(zero_copy_only=False) == 0
    counts = values.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.where(is_sparse, size.fill_null(0).to_numpy(zero_copy_only=False), counts)
    if len(sizes) and not (sizes == dim).all():
        raise ValueError(f"feature vectors of other sizes than {dim}")
    start = np.append(0, np.cumsum(counts))
    value = values.flatten().to_numpy(zero_copy_only=False)
    index = np.arange(len(value)) - np.repeat(start[:-1], counts)
    index[np.repeat(is_sparse, counts)] = indices.flatten().to_numpy(zero_copy_only=False)
    return SparseRows(start, index, value, dim)
