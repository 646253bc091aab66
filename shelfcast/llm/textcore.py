"""Word and shingle hashing of whole UTF-8 texts with numpy, for use inside Spark tasks.

Texts arrive as Arrow string columns. They are worked on in slices of a few megabytes (one long text may exceed that),
so memory follows the slice and never the partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_FOLD = np.arange(256)
_FOLD[ord("A") : ord("Z") + 1] += 32
_EXACT_BYTES = np.random.default_rng(20240607).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED_BYTES = _EXACT_BYTES[_FOLD]
_powers = np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)


def utf8_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, bounds of the rows in the bytes) of consecutive rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + limit, "right")) - 1)
        yield lo, hi, raw[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo]
        lo = hi


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64, at least ``n`` of each."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, min(1 << (n - 1).bit_length(), SLICE_BYTES + 1))
        up, down = np.full(size, _BASE), np.full(size, _BASE_INVERSE)
        up[0] = down[0] = 1
        _powers = np.cumprod(up), np.cumprod(down)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads all 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """64-bit hash of every byte span; equal bytes give equal hashes wherever they stand."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((_FOLDED_BYTES if fold else _EXACT_BYTES)[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


SOLID = ~_SPACE


def word_spans(
    data: np.ndarray, bounds: np.ndarray, solid_bytes: np.ndarray = SOLID
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, bounds of the words of each row) of the maximal runs of ``solid_bytes``: no white space."""
    solid = solid_bytes[data]
    before = np.empty_like(solid)
    after = np.empty_like(solid)
    if len(data):
        before[0], before[1:] = False, solid[:-1]
        after[-1], after[:-1] = False, solid[1:]
        edges = bounds[(bounds > 0) & (bounds < len(data))]
        before[edges] = False
        after[edges - 1] = False
    starts, ends = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def shingle_hashes(words: np.ndarray, word_bounds: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words of each row, in text order, and their bounds.

    A row with fewer words gives its whole sequence as one; a row without words gives none.
    """
    counts = np.diff(word_bounds)
    out_counts = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    out_bounds = np.concatenate(([0], np.cumsum(out_counts)))
    out = np.zeros(int(out_bounds[-1]), dtype=np.uint64)
    weights = mix(np.arange(1, k + 1, dtype=np.uint64) * _BASE) | np.uint64(1)
    if len(words) >= k:
        runs = np.zeros(len(words) - k + 1, dtype=np.uint64)
        for j in range(k):
            runs += words[j : len(words) - k + 1 + j] * weights[j]
        inside = np.zeros(len(words) + 1, dtype=np.int8)
        long = counts >= k
        np.add.at(inside, word_bounds[:-1][long], 1)
        np.add.at(inside, word_bounds[1:][long] - k + 1, -1)
        target = np.zeros(len(out) + 1, dtype=np.int8)
        np.add.at(target, out_bounds[:-1][long], 1)
        np.add.at(target, out_bounds[1:][long], -1)
        out[np.cumsum(target[:-1]) > 0] = runs[np.cumsum(inside[: len(runs)]) > 0]
    for row in np.flatnonzero((counts > 0) & (counts < k)):
        some = words[word_bounds[row] : word_bounds[row + 1]]
        out[out_bounds[row]] = (some * weights[: len(some)]).sum(dtype=np.uint64)
    short = np.repeat(np.where(counts < k, counts, 0), out_counts).astype(np.uint64)  # a short row is no shingle
    return mix(out + short * _BASE), out_bounds


def shingle_sets(data: np.ndarray, bounds: np.ndarray, k: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    starts, ends, word_bounds = word_spans(data, bounds)
    values, out_bounds = shingle_hashes(span_hashes(data, starts, ends), word_bounds, k)
    for lo, hi in zip(out_bounds[:-1].tolist(), out_bounds[1:].tolist(), strict=True):
        one = np.sort(values[lo:hi])
        if hi - lo > 1:
            keep = np.empty(hi - lo, dtype=bool)
            keep[0] = True
            np.not_equal(one[1:], one[:-1], out=keep[1:])
            one = one[keep]
        yield one


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as Spark longs with the same bits."""
    return x.view(np.int64)
