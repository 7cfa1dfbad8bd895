"""Helpers shared by the vector operators (11 and 12)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vec: Column) -> Column:
    """True where the vector is there, has entries, and all are there and finite."""
    return F.coalesce((F.size(vec) > 0) & F.forall(vec, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))),
                      F.lit(False))


def digest(vec: Column) -> Column:
    """SHA-256 of a vector's entries: the key under which equal vectors meet."""
    return F.unhex(F.sha2(F.array_join(F.transform(vec, lambda e: e.cast("string")), ",").cast("binary"), 256))


def matrix(col: pa.Array, dtype) -> np.ndarray:
    """A list column without nulls as a matrix; rows of unequal length are an error."""
    if not len(col):
        return np.zeros((0, 0), dtype=dtype)
    sizes = np.diff(np.asarray(col.offsets))
    if (sizes != sizes[0]).any():
        raise ValueError(f"vectors of {int(sizes.min())} and of {int(sizes.max())} entries in one table")
    return np.asarray(col.flatten()).astype(dtype, copy=False).reshape(len(col), int(sizes[0]))


def lists(m: np.ndarray, kind: pa.DataType) -> pa.Array:
    """The rows of a matrix as a list column."""
    ends = np.arange(0, m.size + 1, max(1, m.shape[1]), dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(m).reshape(-1), kind))
