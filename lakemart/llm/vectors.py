"""Vectors as rows: which take part, and their components as an array in a task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vec: str | Column) -> Column:
    """Whether a vector is there and holds no null and no non-finite component."""
    v = F.col(vec) if isinstance(vec, str) else vec
    return F.coalesce(v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (
        F.abs(x) != F.lit(float("inf")))), F.lit(False))


def common_length(df: DataFrame, vec: str) -> int:
    """The most frequent length of the vectors, the greater of equally frequent ones; 0 for none."""
    top = (df.groupBy(F.size(vec).alias("size")).agg(F.count("*").alias("n"))
           .orderBy(F.desc("n"), F.desc("size")).first())
    return 0 if top is None else max(0, top["size"])


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A column of lists, all of ``dim`` components, as rows of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, np.float64).reshape(len(column), dim)
