"""Fixed-size tables of counts or bits over a whole corpus, summed on the executors and small enough to broadcast."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 16
PART_SCHEMA = "chunk int, salt int, payload binary"
SALTS = 64


def packed(counts: np.ndarray) -> bytes:
    """Counters as compressed byte planes; small counts leave empty high planes."""
    planes = counts.astype("<u8").view(np.uint8).reshape(-1, 8).T
    return zlib.compress(np.ascontiguousarray(planes).tobytes(), 1)


def unpacked(payload: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(payload), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def parts(counts: np.ndarray, salt: int) -> Iterator[tuple[int, int, bytes]]:
    """The non-zero chunks of one task's counters as rows of PART_SCHEMA."""
    for lo in range(0, len(counts), CHUNK):
        block = counts[lo : lo + CHUNK]
        if block.any():
            yield lo // CHUNK, salt % SALTS, packed(block)


def _sum(rows: pd.DataFrame) -> pd.DataFrame:
    total = unpacked(rows.payload.iloc[0]).copy()
    for payload in rows.payload.iloc[1:]:
        total += unpacked(payload)
    return pd.DataFrame({"chunk": [rows.chunk.iloc[0]], "salt": [rows.salt.iloc[0]], "payload": [packed(total)]})


def summed(rows: DataFrame, size: int) -> np.ndarray:
    """Total of all tasks' parts, first within a salt and then over the salts.

    Only the total reaches the driver: ``size`` counters, whatever the size of the corpus.
    """
    once = rows.groupBy("chunk", "salt").applyInPandas(_sum, PART_SCHEMA)
    twice = once.withColumn("salt", F.lit(0)).groupBy("chunk").applyInPandas(_sum, PART_SCHEMA)
    total = np.zeros(size, dtype=np.uint64)
    for row in twice.select("chunk", "payload").collect():
        block = unpacked(row.payload)
        total[row.chunk * CHUNK : row.chunk * CHUNK + len(block)] = block
    return total


def shared(rows: DataFrame, array: np.ndarray) -> Broadcast:
    return rows.sparkSession.sparkContext.broadcast(zlib.compress(array.tobytes(), 1))


def opened(value: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zlib.decompress(value), dtype=dtype)
