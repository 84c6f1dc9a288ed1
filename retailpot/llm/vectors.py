"""Embedding columns: whole finite vectors, integer components, and their way between Arrow and numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole(vector: Column) -> Column:
    """True where the vector is there and every component is a finite number; an empty vector is whole."""
    def finite(c: Column) -> Column:
        c = c.cast("double")
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))

    return F.coalesce(F.forall(vector, finite), F.lit(False))


def floored(vector: Column, scale: int, shift: int = 0) -> Column:
    """floor(scale * component) + shift as longs."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("long") + F.lit(shift).cast("long"))


class Shape:
    """Common length of the integer vectors of a column and their largest absolute component; ``n`` vectors in all."""

    def __init__(self, df: DataFrame, column: str):
        x = F.col(column)
        r = df.agg(F.count("*").alias("n"), F.min(F.size(x)).alias("least"), F.max(F.size(x)).alias("most"),
                   F.greatest(F.max(F.array_max(x)), -F.min(F.array_min(x)), F.lit(0)).alias("top")).first()
        if r.n and r.least != r.most:
            raise ValueError(f"vectors have {r.least} to {r.most} components; one length is needed")
        self.n, self.length, self.top = r.n, r.most or 0, int(r.top or 0)


def matrix(column: pa.Array, length: int) -> np.ndarray:
    """Rows of a list column without nulls, all of one length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), length)


def lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A matrix as a list column."""
    ends = pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32())
    return pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(rows).ravel(), kind))
