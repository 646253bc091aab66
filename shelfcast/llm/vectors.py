"""Which vectors can be compared, and moving them between Spark and numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LARGEST = 1.7976931348623157e308


def comparable(vector: Column) -> Column:
    """Whether a vector is there, has only finite components, and is not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) <= _LARGEST))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def as_vectors(table: DataFrame) -> DataFrame:
    """(vec_id long, vector array<double>, usable boolean) of a table with vec_id and embedding."""
    vector = F.col("embedding").cast("array<double>")
    return table.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"), comparable(vector).alias("usable"))


def by_dimension(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) for each length of vector in a list column without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum(lengths)
    out = []
    for size in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == size)
        out.append((rows, values[(ends[rows] - size)[:, None] + np.arange(size)]))
    return out
