"""Vectors as exact integers, shared by the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: no component may be larger after scaling: products of vectors of up to 512 components then fit a long
LARGEST = 1 << 27


def is_whole(vector: Column) -> Column:
    """True where the vector and all its components are there and finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def scaled(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component; the job fails, rather than overflow, where one is beyond ``LARGEST``."""
    too_large = F.raise_error(F.lit(f"a vector component is beyond {LARGEST} after scaling by {scale}")).cast("long")
    one = lambda x: F.when(F.abs(scale * x.cast("double")) > LARGEST, too_large).otherwise(F.floor(scale * x.cast("double")))
    return F.transform(vector, one)


def matrix(column: pa.ListArray | pa.ChunkedArray) -> np.ndarray:
    """Lists of integers as the rows of a matrix; shorter ones are filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    width = int(sizes.max()) if len(sizes) else 0
    if len(sizes) and sizes.min() == width:
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def exact(numbers: np.ndarray, partner: int) -> np.ndarray:
    """As floats, which multiply faster, where all sums of products with numbers up to ``partner`` stay exact in them."""
    bound = max(1, numbers.shape[-1]) * (int(np.abs(numbers).max(initial=0)) + partner) ** 2
    if bound >= 1 << 63:
        raise OverflowError("products of these vectors do not fit a long")
    return numbers.astype(np.float64 if bound < 1 << 53 else np.int64)
