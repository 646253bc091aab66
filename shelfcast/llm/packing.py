"""Best-fit packing of tokenised documents into sequences by bin completion.

One pass tokenises whole texts, cuts those longer than a sequence and numbers the pieces of each length within the
task. The lengths' histogram (at most one count per length) is all that the planner sees; its patterns are shared with
every task, which places each piece by its length and number. No task gathers the pieces of a length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.llm.bin_completion import Pattern, complete
from shelfcast.llm.textcore import utf8_slices
from shelfcast.session import settle

CAPACITY = 1024
END = 2
#: Bytes of text that are encoded, cut and sent on at a time; a worker holds the ids of no more than that or one text.
SLICE = 256 << 10
_PIECE = "doc_id long, piece int, start long, length long, {payload}, task int, number long"
_PAYLOADS = {"crc32": ("ids_crc32 long", pa.int64()), "ids": ("ids array<int>", pa.list_(pa.int32()))}


@lru_cache(maxsize=1)
def _encoder(ranks: str, reference: str):
    """One encoder and its memory of words for all tasks of a worker process."""
    from shelfcast.llm.tokens import Encoder

    return Encoder(ranks, reference)


def _slices(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, _, _ in utf8_slices(batch.column("text"), limit):
            yield batch.slice(lo, hi - lo)


def _pieces(
    batches: Iterator[pa.RecordBatch], ranks: str, reference: str, capacity: int, payload: str
) -> Iterator[pa.RecordBatch]:
    encoder, task = _encoder(ranks, reference), TaskContext.get().partitionId()
    met = [0] * (capacity + 1)
    last = np.array([END], dtype="<u4")
    for batch in _slices(batches, SLICE):
        rows, pieces, starts, lengths, numbers, payloads = [], [], [], [], [], []
        for row, ids in enumerate(encoder.encode(batch.column("text"))):
            ids = np.concatenate((ids.astype("<u4"), last))
            cut = len(ids) % capacity if len(ids) > capacity else len(ids)
            edges = [*([0, cut] if cut else [0]), *range(cut + capacity, len(ids) + 1, capacity)]
            for piece, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
                rows.append(row)
                pieces.append(piece)
                starts.append(lo)
                lengths.append(hi - lo)
                numbers.append(met[hi - lo])
                met[hi - lo] += 1
                part = ids[lo:hi]
                payloads.append(zlib.crc32(part.tobytes()) if payload == "crc32" else part.astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(pa.array(rows, pa.int64())),
                pa.array(pieces, pa.int32()),
                pa.array(starts, pa.int64()),
                pa.array(lengths, pa.int64()),
                pa.array(payloads, _PAYLOADS[payload][1]),
                pa.array([task] * len(rows), pa.int32()),
                pa.array(numbers, pa.int64()),
            ],
            ["doc_id", "piece", "start", "length", _PAYLOADS[payload][0].split()[0], "task", "number"],
        )


def placements(patterns: list[Pattern], capacity: int = CAPACITY) -> dict[int, np.ndarray]:
    """For each length the runs of its pieces: rows (first number, copies per bin, first bin, first offset)."""
    used: dict[int, int] = {}
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    first_bin = 0
    for sizes, often in patterns:
        offset = 0
        for size in sorted(set(sizes), reverse=True):
            copies = sizes.count(size)
            runs.setdefault(size, []).append((used.get(size, 0), copies, first_bin, offset))
            used[size] = used.get(size, 0) + copies * often
            offset += size * copies
        first_bin += often
    return {size: np.array(rows, dtype=np.int64) for size, rows in runs.items()}


def _place(batches: Iterator[pa.RecordBatch], shared: Broadcast) -> Iterator[pa.RecordBatch]:
    runs = shared.value
    for batch in batches:
        length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
        sequence, offset = np.zeros(len(length), dtype=np.int64), np.zeros(len(length), dtype=np.int64)
        for size in np.unique(length).tolist():
            at = np.flatnonzero(length == size)
            run = runs[size][np.searchsorted(runs[size][:, 0], number[at], "right") - 1]
            within = number[at] - run[:, 0]
            sequence[at] = run[:, 2] + within // run[:, 1]
            offset[at] = run[:, 3] + within % run[:, 1] * size
        names = [n for n in batch.schema.names if n != "number"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"]
        )


def best_fit_pack(
    docs: DataFrame, ranks: str, reference: str, capacity: int = CAPACITY, payload: str = "ids", **search: int
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ``payload``, sequence_id, offset.

    ``ranks`` and ``reference`` are the vocabulary as ranks and as a tokenizer file. A document is its ids and then END.
    Only documents longer than ``capacity`` are cut, into full pieces after a first one that may be shorter.
    ``payload`` is "ids" (the piece's ids) or "crc32" (ids_crc32 of the little-endian 32-bit ids). ``search`` goes to
    ``complete``: it bounds the planner's effort, never the pieces packed.

    Null or empty text is one piece that holds END alone. Null and repeated doc_ids are kept, a row each. Other columns
    are ignored. An empty table gives an empty result.
    """
    column = _PAYLOADS[payload][0]
    pieces = settle(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
            partial(_pieces, ranks=ranks, reference=reference, capacity=capacity, payload=payload),
            _PIECE.format(payload=column),
        )
    )
    by_task = settle(pieces.groupBy("length", "task").agg(F.count("*").alias("n")))
    counts = {r.length: r.n for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = docs.sparkSession.sparkContext.broadcast(placements(complete(counts, capacity, **search), capacity))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    # One key of both, so that a length that many pieces share is still dealt over the tasks it came from.
    slot = (F.col("task").cast("long") * (capacity + 1) + F.col("length")).alias("slot")
    before = by_task.select(slot, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = pieces.withColumn("slot", slot).join(before, "slot").withColumn("number", F.col("number") + F.col("before"))
    name = column.split()[0]
    return numbered.select("doc_id", "piece", "start", "length", name, "number").mapInArrow(
        partial(_place, shared=runs),
        f"doc_id long, piece int, start long, length long, {column}, sequence_id long, offset long",
    )


def vocabulary() -> tuple[str, str]:
    """The public vocabulary files on this box."""
    from public_tokenizers import path

    return path("byte_bpe_50k.tiktoken"), path("byte_bpe_50k.json")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` in sequences of 1024 tokens."""
    return best_fit_pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), *vocabulary(), payload="crc32")
