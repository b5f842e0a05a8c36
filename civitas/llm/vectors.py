"""Vectors of scaled integers: the rows that take part, and their components as numpy arrays.

Components are kept as doubles, which hold floor(scale * x) exactly whatever x is, as the scale is a
power of two.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

#: Integers below this bound are exact in double arithmetic.
EXACT = 2.0**53


def scaled(x: Column, scale: int) -> Column:
    """The components as floor(scale * x)."""

    def one(e: Column) -> Column:
        y = e.cast("double") * F.lit(float(scale))
        return F.when(F.abs(y) < F.lit(EXACT), F.floor(y).cast("double")).otherwise(y)

    return F.transform(x, one)


def usable(x: Column, scale: int) -> Column:
    """Whether a vector is there and all its scaled components are numbers."""
    return x.isNotNull() & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double") * F.lit(float(scale))) < F.lit(float("inf"))))


def kept(vectors: DataFrame, scale: int, vector: str, *others: str) -> DataFrame:
    """`others` and the scaled vector x of the rows whose vector is usable."""
    return vectors.where(usable(F.col(vector), scale)).select(*others, scaled(F.col(vector), scale).alias("x"))


def matrix(array, width: int | None = None) -> np.ndarray:
    """The rows of an Arrow list array, filled up with zeros to a common width."""
    lengths = np.diff(array.offsets.to_numpy())
    values = array.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    wide = int(lengths.max(initial=0)) if width is None else width
    if (lengths == wide).all():
        return values.reshape(len(lengths), wide)
    out = np.zeros((len(lengths), wide))
    out[np.arange(wide) < lengths[:, None]] = values
    return out


def whole(row) -> list[int]:
    """Components as Python's integers, which have no limit."""
    return [int(v) for v in row]
