"""Small helpers that the operators on vectors share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vec: Column) -> Column:
    """Whether a vector is there and every component is a finite number."""
    plain = F.forall(vec, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(vec.isNotNull() & plain, F.lit(False))


def floored(vec: Column, times: int) -> Column:
    """floor(times * x) of each component x as a long; null where one of them is beyond 2^53, where doubles skip numbers."""
    near = F.forall(vec, lambda x: F.abs(x.cast("double")) < 2.0**53 / times)
    return F.when(near, F.transform(vec, lambda x: F.floor(x.cast("double") * times)))


def usual_length(vectors: DataFrame, vec_col: str) -> int:
    """The length that most vectors have, the longest of several such; 0 where there is none. A row a length is sorted."""
    lengths = vectors.where(F.col(vec_col).isNotNull()).groupBy(F.size(vec_col).alias("length")).count()
    first = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    return first["length"] if first else 0


def matrix(lists: pa.Array | pa.ChunkedArray, length: int) -> np.ndarray:
    """Lists of one length as rows of a matrix."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)
