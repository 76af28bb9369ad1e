"""Vectors of tables as arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column, size: int | None = None) -> Column:
    """Whether a vector takes part: not null, every component there and finite, not all zero, and of the given size."""
    big = F.lit(float("inf"))
    fine = vector.isNotNull() & F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < big)) & F.exists(vector, lambda v: v != 0)
    return F.coalesce(fine & (F.size(vector) == size) if size is not None else fine, F.lit(False))


def common_size(vectors: DataFrame, vector_col: str) -> int:
    """The size that most usable vectors have; 0 without any."""
    found = vectors.where(usable(F.col(vector_col))).groupBy(F.size(vector_col).alias("d")).count().orderBy(F.desc("count"), "d").first()
    return found.d if found else 0


def components_of(vectors: DataFrame, vector_col: str) -> Column:
    """The vector as floats if the column has them, which is half the bytes to ship and loses nothing; as doubles otherwise."""
    kind = vectors.schema[vector_col].dataType.simpleString()
    return F.col(vector_col) if kind == "array<float>" else F.transform(F.col(vector_col), lambda v: v.cast("double"))


def matrix(column: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    """A list column without nulls as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def rotation(size: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, the same wherever it is made."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return q * np.sign(np.diag(r))
