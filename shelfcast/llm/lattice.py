"""Near-duplicate vectors by lattice hashing.

In each of several tables a random projection takes a unit vector to eight dimensions, where it is decoded to the
nearest point of the E8 lattice. A vector is posted to its own cell and probes the neighbouring cells that it lies
closest to; two vectors meet if one's own cell is the other's own or probed cell. Meetings are sifted with vectors of
one byte per component, wide enough to lose none, and what is left is verified with the original vectors in double
precision.

Equal vectors are one class before anything else. Cells that hold very many postings are known from a fixed table of
counts and are split into pairs of chunks, so no task holds a whole hot cell.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import sketch
from shelfcast.llm.components import components
from shelfcast.llm.textcore import mix
from shelfcast.llm.vectors import as_vectors, by_dimension
from shelfcast.session import settle

TABLES, PROBES, SCALE, SEED = 6, 6, 1.0, 11
COUNTERS = 1 << 20
CHUNK = 4096
BUCKET_POSTINGS = 50_000
#: What single precision may take from a cosine of byte vectors, for each dimension.
ROUNDING = 2.0**-22
_MOVED = "bucket long, postings binary"
_POSTING = [("cell", "<u8"), ("id", "<i8"), ("dim", "<i4"), ("step", "<f4"), ("home", "u1"), ("side", "u1")]


def _shortest() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in combinations(range(8), 2):
        for s, t in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = s, t
            out.append(v)
    out += [np.array(s) for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


NEIGHBOURS = _shortest()


def _even(y: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum."""
    near = np.rint(y)
    off = y - near
    odd = np.flatnonzero(near.sum(axis=1) % 2 != 0)
    worst = np.abs(off[odd]).argmax(axis=1)
    near[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
    return near


def nearest_e8(y: np.ndarray) -> np.ndarray:
    """Nearest E8 lattice point of each row: the better one of the even integers and the same shifted by a half."""
    whole, half = _even(y), _even(y - 0.5) + 0.5
    closer = ((y - half) ** 2).sum(axis=1) < ((y - whole) ** 2).sum(axis=1)
    return np.where(closer[:, None], half, whole)


def _cell_hash(points: np.ndarray, table: int, dim: int) -> np.ndarray:
    twice = np.rint(points * 2).astype(np.int64).view(np.uint64)
    out = np.full(len(points), (table + 1) * 1_000_003 + dim, dtype=np.uint64)
    for k in range(8):
        out = mix(out ^ twice[..., k] * np.uint64(0x9E3779B97F4A7C15))
    return out


def cells(unit: np.ndarray, tables: int, probes: int, scale: float) -> Iterator[tuple[np.ndarray, bool]]:
    """Cell of every row, and whether it is its own, for all tables and probes."""
    dim = unit.shape[1]
    for table in range(tables):
        random = np.random.default_rng((SEED, table, dim))
        y = unit @ random.normal(size=(dim, 8)) * scale + random.uniform(0, 2, 8)
        point = nearest_e8(y)
        yield _cell_hash(point, table, dim), True
        # |y - p - m|^2 = |y - p|^2 - 2 (y - p).m + 2: the nearest neighbours have the largest products.
        close = np.argpartition(-((y - point) @ NEIGHBOURS.T), probes, axis=1)[:, :probes] if probes else None
        for k in range(probes):
            yield _cell_hash(point + NEIGHBOURS[close[:, k]], table, dim), False


def _units(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    ids = batch.column("cid").to_numpy()
    for rows, matrix in by_dimension(batch.column("vector")):
        matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)  # keeps squares finite
        yield ids[rows], matrix / np.sqrt((matrix**2).sum(axis=1, keepdims=True))


def _count(batches: Iterator[pa.RecordBatch], tables: int, probes: int, scale: float) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(COUNTERS, dtype=np.uint64)
    for batch in batches:
        for _, unit in _units(batch):
            for cell, _ in cells(unit, tables, probes, scale):
                counts += np.bincount((cell & np.uint64(COUNTERS - 1)).view(np.int64), minlength=COUNTERS).astype(np.uint64)
    rows = list(sketch.parts(counts, TaskContext.get().partitionId()))
    if rows:
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary()))]
        yield pa.RecordBatch.from_arrays(columns, ["chunk", "salt", "payload"])


def _post(
    batches: Iterator[pa.RecordBatch], tables: int, probes: int, scale: float, shared: Broadcast, buckets: int
) -> Iterator[pa.RecordBatch]:
    """Packed postings by bucket. In a cell with several chunks a posting goes to every pair of chunks with its own."""
    chunks = sketch.opened(shared.value, np.uint32)
    for batch in batches:
        for ids, unit in _units(batch):
            dim = unit.shape[1]
            step = np.abs(unit).max(axis=1) / 127
            small = np.rint(unit / step[:, None]).astype(np.int8)
            kind = np.dtype([*_POSTING, ("vector", "i1", (dim,))])
            for cell, home in cells(unit, tables, probes, scale):
                parts = chunks[(cell & np.uint64(COUNTERS - 1)).view(np.int64)].astype(np.int64)
                own = (mix(ids.astype(np.int64).view(np.uint64)) % parts.view(np.uint64)).astype(np.int64)
                which = np.repeat(np.arange(len(ids)), parts)
                other = np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)
                low, high = np.minimum(own[which], other), np.maximum(own[which], other)
                out = np.zeros(len(which), dtype=kind)
                out["cell"] = mix(cell[which] + (low * 65_537 + high).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                out["id"], out["dim"], out["step"], out["home"] = ids[which], dim, step[which], home
                out["side"] = np.where(low == high, 0, np.where(own[which] == low, 1, 2))
                out["vector"] = small[which]
                to = (out["cell"] >> np.uint64(20)) % np.uint64(buckets)
                by = np.argsort(to, kind="stable")
                to, out = to[by], out[by]
                cuts = np.flatnonzero(np.diff(to)) + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(to[np.concatenate(([0], cuts)).astype(np.int64)].astype(np.int64)),
                        pa.array([block.tobytes() for block in np.split(out, cuts)], pa.binary()),
                    ],
                    ["bucket", "postings"],
                )


def _bounds(small: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two matrices whose products are at least the cosines of the vectors that were rounded to ``small`` * ``step``.

    Components move by h = step / 2 at most, so cosines by h |v|_1 + h' |u|_1 + d h h' for the rounded u (h) and v (h').
    """
    vectors = small.astype(np.float32) * step[:, None]
    dim = small.shape[1]
    half, norm = step[:, None] / 2, np.abs(vectors).sum(axis=1, keepdims=True)
    both = np.float32(np.sqrt(dim)) * half
    slack = np.full((len(small), 1), np.sqrt((dim + 4) * ROUNDING), dtype=np.float32)
    return np.hstack((vectors, half, norm, both, slack)), np.hstack((vectors, norm, half, both, slack))


def _meetings(table: pa.Table, least: float) -> pa.Table:
    """Pairs (a, b) of one bucket that share a cell and may have a cosine of ``least``, each once."""
    by_dim: dict[int, list[np.ndarray]] = {}
    for blob in table.column("postings").to_pylist():
        dim = int(np.frombuffer(blob, dtype="<i4", count=1, offset=16)[0])
        by_dim.setdefault(dim, []).append(np.frombuffer(blob, dtype=np.dtype([*_POSTING, ("vector", "i1", (dim,))])))
    found = [np.zeros((0, 2), dtype=np.int64)]
    for blocks in by_dim.values():
        rows = np.concatenate(blocks)
        rows = rows[np.argsort(rows["cell"], kind="stable")]
        edges = np.concatenate(([0], np.flatnonzero(rows["cell"][1:] != rows["cell"][:-1]) + 1, [len(rows)]))
        homes = np.concatenate(([0], np.cumsum(rows["home"], dtype=np.int64)))
        full = np.flatnonzero((np.diff(edges) > 1) & (np.diff(homes[edges]) > 0))
        for lo, hi in zip(edges[full].tolist(), edges[full + 1].tolist(), strict=True):
            run = rows[lo:hi]
            ours, theirs = _bounds(run["vector"], run["step"])
            for at in range(0, hi - lo, 1024):
                near = ours[at : at + 1024] @ theirs.T >= least
                i, j = np.nonzero(near)
                i += at
                ok = (i < j) & ((run["home"][i] | run["home"][j]) > 0)
                ok &= (run["side"][i] == 0) | (run["side"][i] != run["side"][j])
                a, b = run["id"][i[ok]], run["id"][j[ok]]
                found.append(np.stack((np.minimum(a, b), np.maximum(a, b)), axis=1))
    pairs = np.concatenate(found)
    pairs = np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0) if len(pairs) else pairs
    return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})


def near_duplicates(
    table: DataFrame, least: float = 0.95, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE
) -> DataFrame:
    """One row per row of ``table`` (vec_id long, embedding array): vec_id, n_links, component_id, kept.

    Links join vectors of equal length with cosine ``least`` or more, copies among them. n_links counts the other rows
    linked directly; component_id is the smallest vec_id reachable by links, itself included. None below ``least`` is
    linked; the chance to miss a pair at the threshold is about 0.002 with the default tables, less above it.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing. A null vec_id is
    counted as a neighbour but names no component. Repeated rows are rows. Other columns are ignored. Empty: empty.
    """
    vectors = as_vectors(table)
    usable = vectors.where("usable")
    classes = settle(
        usable.groupBy("vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
        .withColumn("cid", F.monotonically_increasing_id())
    )
    plain = classes.select("cid", "vector")
    options = {"tables": tables, "probes": probes, "scale": scale}
    counts = sketch.summed(plain.mapInArrow(partial(_count, **options), sketch.PART_SCHEMA), COUNTERS)
    shared = sketch.shared(plain, (1 + counts // CHUNK).astype(np.uint32))
    buckets = max(32, int(counts.sum()) // BUCKET_POSTINGS)
    moved = plain.mapInArrow(partial(_post, **options, shared=shared, buckets=buckets), _MOVED)
    pairs = moved.groupBy("bucket").applyInArrow(lambda t: _meetings(t, least), "a long, b long").distinct()
    # Scaled by the largest component first, so that no square overflows or vanishes.
    top = F.array_max(F.transform("vector", F.abs))
    scaled = plain.select("cid", top.alias("top"), "vector").select(
        "cid", F.transform("vector", lambda x: x / F.col("top")).alias("vector")
    )
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    sized = scaled.select("cid", "vector", norm.alias("norm"))
    left, right = (sized.select(*[F.col(c).alias(f"{c}_{s}") for c in sized.columns]) for s in "ab")
    dot = F.aggregate(F.zip_with("vector_a", "vector_b", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    links = settle(
        pairs.join(left, F.col("a") == F.col("cid_a")).join(right, F.col("b") == F.col("cid_b"))
        .where(dot / (F.col("norm_a") * F.col("norm_b")) >= least).select("a", "b")
    )
    weights = classes.select("cid", "n")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = (
        both.join(weights.withColumnRenamed("cid", "b"), "b").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("far"))
    )
    grouped = components(links).withColumnRenamed("node", "cid")
    least_ids = (
        grouped.join(classes.select("cid", "rep"), "cid").groupBy("component").agg(F.min("rep").alias("component_id"))
    )
    result = (
        classes.join(linked, "cid", "left").join(grouped, "cid", "left").join(least_ids, "component", "left")
        .select(
            "vector", (F.col("n") - 1 + F.coalesce("far", F.lit(0))).alias("n_links"),
            F.coalesce("component_id", "rep").alias("component_id"),
        )
    )
    found = usable.select("vec_id", "vector").join(result, "vector").select("vec_id", "n_links", "component_id")
    alone = vectors.where("NOT usable").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return found.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op2_lattice_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``embeddings``, cosine 0.95."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
