"""Approximate nearest neighbours with an inverted multi-index.

A vector is cut into two halves, each quantised to its own codebook; the pair of centroids names one of K^2 cells. A
query visits cells by the sum of its distances to both centroids, with a heap over the two sorted lists, until the
cells hold enough candidates, and these are ranked by exact distance.

The codebooks are fitted on a bounded sample (SAMPLE vectors per centroid); every vector is indexed. How many candidates
are enough is measured, not guessed: for TRIALS queries the true neighbours are found by one pass over all vectors, and
the count is set so that the walk reaches the wanted share of them. Of equal vectors
only those with the smallest ids can be among the nearest, so an index keeps ``nearest`` + 1 of each, which loses
nothing. Cells of one first centroid share a task; if they hold many vectors or queries they are cut into blocks of
bounded size, and every block of queries meets every block of vectors.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.llm.vectors import as_vectors, by_dimension
from shelfcast.operators.layout import sized
from shelfcast.session import settle

NEAREST, RECALL, TRIALS = 10, 0.97, 200
PER_CELL, MOST_CENTROIDS = 12, 1024
SAMPLE, TURNS, SEED = 40, 12, 5
BLOCK_VECTORS, BLOCK_QUERIES = 20_000, 2_000


def centroids(points: np.ndarray, k: int, turns: int = TURNS) -> np.ndarray:
    """k-means from distinct random points; a centroid without points keeps its place."""
    points = np.unique(points, axis=0)
    random = np.random.default_rng(SEED)
    centres = points[random.permutation(len(points))[:k]].copy()
    for _ in range(turns):
        nearest = squared(points, centres).argmin(axis=1)
        sizes = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


def squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, up to rounding."""
    return np.maximum((x**2).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres**2).sum(axis=1), 0)


def visited(first: np.ndarray, second: np.ndarray, filled: np.ndarray, enough: int) -> list[tuple[int, int]]:
    """Non-empty cells in the order of ``first[i] + second[j]`` until they hold ``enough`` vectors."""
    by_first, by_second = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    a, b = first[by_first].tolist(), second[by_second].tolist()
    heap, out, held = [(a[0] + b[0], 0, 0)], [], 0
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        cell = int(by_first[i]), int(by_second[j])
        n = int(filled[cell])
        if n:
            out.append(cell)
            held += n
        if i + 1 < len(a):
            heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))
        if i == 0 and j + 1 < len(b):
            heapq.heappush(heap, (a[0] + b[j + 1], 0, j + 1))
    return out


def _assign(batches: Iterator[pa.RecordBatch], books: Broadcast) -> Iterator[pa.RecordBatch]:
    one, two = books.value
    for batch in batches:
        for rows, x in by_dimension(batch.column("vector")):
            part = batch.take(pa.array(rows))
            cut = one.shape[1]
            i, j = (squared(h, c).argmin(axis=1).astype(np.int32) for h, c in ((x[:, :cut], one), (x[:, cut:], two)))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(i), pa.array(j)], [*part.schema.names, "i", "j"]
            )


def _probe(batches: Iterator[pa.RecordBatch], books: Broadcast, filled: Broadcast, enough: int) -> Iterator[pa.RecordBatch]:
    """One row for each query and first centroid it visits, with the second centroids."""
    one, two = books.value
    for batch in batches:
        for rows, x in by_dimension(batch.column("vector")):
            cut = one.shape[1]
            first, second = squared(x[:, :cut], one), squared(x[:, cut:], two)
            at, lead, seconds = [], [], []
            for row in range(len(rows)):
                by: dict[int, list[int]] = {}
                for i, j in visited(first[row], second[row], filled.value, enough):
                    by.setdefault(i, []).append(j)
                at += [int(rows[row])] * len(by)
                lead += list(by)
                seconds += list(by.values())
            part = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(lead, pa.int32()), pa.array(seconds, pa.list_(pa.int32()))],
                [*part.schema.names, "i", "seconds"],
            )


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    ((_, matrix),) = by_dimension(column)
    return matrix


def _closest(x: np.ndarray, norms: np.ndarray, vector: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Those of the rows ``at`` that can be among the ``n`` nearest, by products alone and with room for their rounding."""
    if len(at) <= n:
        return at
    rough = norms[at] - 2 * (x[at] @ vector)
    limit = np.partition(rough, n - 1)[n - 1] + 1e-9 * (norms[at].max() + vector @ vector)
    return at[rough <= limit]


def _true(batches: Iterator[pa.RecordBatch], trials: Broadcast, nearest: int) -> Iterator[pa.RecordBatch]:
    """(trial, i, j, distance) of the nearest vectors to each trial within a task's batch."""
    wanted = trials.value
    for batch in batches:
        for rows, x in by_dimension(batch.column("vector")):
            far = squared(wanted, x)
            far[far <= 1e-9 * ((wanted**2).sum(axis=1)[:, None] + (x**2).sum(axis=1))] = np.inf  # not itself
            n = min(nearest, len(rows))
            best = np.argpartition(far, n - 1, axis=1)[:, :n]
            picked = rows[best.ravel()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.arange(len(wanted)), n).astype(np.int32)),
                    batch.column("i").take(pa.array(picked)),
                    batch.column("j").take(pa.array(picked)),
                    pa.array(np.take_along_axis(far, best, axis=1).ravel()),
                ],
                ["trial", "i", "j", "far"],
            )


def enough_candidates(
    index: DataFrame, trials: np.ndarray, books: Broadcast, filled: np.ndarray, nearest: int, recall: float
) -> int:
    """Candidates at which the walk has met ``recall`` of the trials' true neighbours."""
    shared = index.sparkSession.sparkContext.broadcast(trials)
    near = index.select("vector", "i", "j").mapInArrow(
        partial(_true, trials=shared, nearest=nearest), "trial int, i int, j int, far double"
    )
    place = F.row_number().over(Window.partitionBy("trial").orderBy("far"))
    rows = near.withColumn("place", place).where(F.col("place") <= nearest).collect()  # at most TRIALS * nearest
    one, two = books.value
    first, second = squared(trials[:, : one.shape[1]], one), squared(trials[:, one.shape[1] :], two)
    needed = []
    for trial in range(len(trials)):
        total = first[trial][:, None] + second[trial][None, :]
        needed += [int(filled[total <= total[r.i, r.j]].sum()) for r in rows if r.trial == trial and r.far < float("inf")]
    return int(np.quantile(needed, recall, method="higher")) if needed else 1


def _rank(queries: pa.Table, vectors: pa.Table, nearest: int) -> pa.Table:
    """The ``nearest`` candidates of each query within one block, ties to the smaller id."""
    out_q, out_v, out_s = [], [], []
    if queries.num_rows and vectors.num_rows:
        x, ids, cells = _matrix(vectors.column("vector")), vectors.column("vec_id").to_numpy(), vectors.column("j").to_numpy()
        by = np.argsort(cells, kind="stable")
        x, ids, cells = x[by], ids[by], cells[by]
        norms = (x**2).sum(axis=1)
        for q, vector, seconds in zip(
            queries.column("qid").to_pylist(), _matrix(queries.column("vector")), queries.column("seconds").to_pylist(),
            strict=True,
        ):
            lo, hi = np.searchsorted(cells, seconds), np.searchsorted(cells, seconds, "right")
            at = _closest(x, norms, vector, np.concatenate([np.arange(a, b) for a, b in zip(lo, hi, strict=True)]), nearest)
            score = np.sqrt(((x[at] - vector) ** 2).sum(axis=1))
            best = np.lexsort((ids[at], score))[:nearest]
            out_q += [q] * len(best)
            out_v += ids[at][best].tolist()
            out_s += score[best].tolist()
    return pa.table({"qid": pa.array(out_q, pa.int64()), "vec_id": pa.array(out_v, pa.int64()), "score": pa.array(out_s, pa.float64())})


def _blocks(table: DataFrame, id_: str, own: str, other: str, others: DataFrame) -> DataFrame:
    """``table`` with its own block number, repeated for each block of the other side."""
    salt = F.pmod(F.xxhash64(id_), F.col(own)).cast("int")
    both = table.join(sized(others), "i")
    return both.withColumn(f"{own}_no", salt).withColumn(
        f"{other}_no", F.explode(F.sequence(F.lit(0), F.col(other) - 1).cast("array<int>"))
    ).drop(own, other)


def nearest_neighbours(
    table: DataFrame, is_query, nearest: int = NEAREST, recall: float = RECALL
) -> DataFrame:
    """The ``nearest`` found for each row of ``table`` (vec_id, embedding) for which ``is_query`` (a condition) holds.

    Returns query_id, rank (from 1), vec_id and score, the Euclidean distance in double precision, nearest first, ties
    to the smaller vec_id. A row is never its own neighbour; rows that share a query's vec_id are none either. As many
    distinct vectors are ranked per query as it took to find ``recall`` of the neighbours of the trial queries.

    Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do null vec_ids. Vectors
    of different lengths have no distance: each length has its own codebooks and is searched apart. Repeated rows count
    once. A vec_id with several vectors is as near as the nearest. Fewer rows than ``nearest``: all of them. Empty
    table: empty result. Other columns are ignored.
    """
    spark = table.sparkSession
    vectors = settle(as_vectors(table).where("usable AND vec_id IS NOT NULL").select("vec_id", "vector").distinct())
    lengths = vectors.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n")).orderBy("d").collect()  # few rows
    found = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for part in [_search(vectors.where(F.size("vector") == r.d), r.d, r.n, is_query, nearest, recall) for r in lengths]:
        found = found.unionByName(part)
    if len(lengths) < 2:
        return found
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")  # a vec_id may have vectors of two lengths
    once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return (
        once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest)
        .select("query_id", "rank", "vec_id", "score")
    )


def _search(vectors: DataFrame, dim: int, n: int, is_query, nearest: int, recall: float) -> DataFrame:
    """``nearest_neighbours`` among the ``n`` distinct (vec_id, vector) rows of one length."""
    spark = vectors.sparkSession
    same = Window.partitionBy("vector").orderBy("vec_id")
    few = vectors.withColumn("place", F.row_number().over(same)).where(F.col("place") <= nearest + 1)
    # Each query vector is searched once; its id here is the smallest of those that have it.
    asked = settle(vectors.where(is_query))
    queries = asked.groupBy("vector").agg(F.min("vec_id").alias("qid"))

    k = int(min(MOST_CENTROIDS, max(2, round((n / PER_CELL) ** 0.5))))
    share = max(1, -(-n // (SAMPLE * k)))
    rows = vectors.where(F.pmod(F.xxhash64("vec_id", F.lit(SEED)), F.lit(share)) == 0).select("vector").collect()
    sample = np.array([r.vector for r in rows] or [vectors.first().vector])
    cut = max(1, dim // 2)
    books = spark.sparkContext.broadcast((centroids(sample[:, :cut], k), centroids(sample[:, cut:], k)))
    index = settle(
        few.select("vec_id", "vector", "place").mapInArrow(
            partial(_assign, books=books), "vec_id long, vector array<double>, place int, i int, j int"
        )
    )
    filled = np.zeros((len(books.value[0]), len(books.value[1])), dtype=np.int64)
    for r in index.where("place = 1").groupBy("i", "j").agg(F.count("*").alias("n")).collect():  # at most K^2 rows
        filled[r.i, r.j] = r.n
    hashed = queries.orderBy(F.xxhash64("qid"), "qid").limit(TRIALS).select("vector").collect()
    trials = np.array([r.vector for r in hashed] or sample[:1])
    enough = enough_candidates(index, trials, books, filled, nearest, recall)
    probes = settle(
        queries.select("qid", "vector").mapInArrow(
            partial(_probe, books=books, filled=spark.sparkContext.broadcast(filled), enough=enough),
            "qid long, vector array<double>, i int, seconds array<int>",
        )
    )
    sizes = (
        index.groupBy("i").agg(F.ceil(F.count("*") / BLOCK_VECTORS).cast("int").alias("v"))
        .join(probes.groupBy("i").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("q")), "i")
    )
    key = ["i", "v_no", "q_no"]
    left = _blocks(probes, "qid", "q", "v", sizes)
    right = _blocks(index.drop("place"), "vec_id", "v", "q", sizes)
    ranked = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        lambda q, v: _rank(q, v, nearest + 1), "qid long, vec_id long, score double"
    )
    best = Window.partitionBy("qid").orderBy("score", "vec_id")
    once = ranked.groupBy("qid", "vec_id").agg(F.min("score").alias("score"))
    few_each = once.withColumn("place", F.row_number().over(best)).where(F.col("place") <= nearest + 1).drop("place")
    each = (
        asked.join(queries.select("qid", "vector"), "vector").select(F.col("vec_id").alias("query_id"), "qid")
        .join(few_each, "qid").where("vec_id != query_id")
        .groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest)
        .select("query_id", "rank", "vec_id", "score")
    )


def op10_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries are the rows of ``embeddings`` whose vec_id is divisible by 100, against all rows."""
    return nearest_neighbours(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)
