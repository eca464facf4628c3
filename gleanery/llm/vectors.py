"""Vectors as columns and as arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not NULL, without NULL or non-finite components, and not zero (an empty vector is)."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))


def sizes_of(rows: DataFrame, vector: str) -> list[int]:
    """The numbers of components that vectors have, the smallest first."""
    return sorted(r["size"] for r in rows.select(F.size(vector).alias("size")).distinct().collect())


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """A list column without NULLs, of ``size`` components each, as rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
