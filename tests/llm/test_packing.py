"""Bin completion on its own, and packed documents against the tokenizer."""

from __future__ import annotations

import random
import zlib
from collections import Counter
from itertools import combinations_with_replacement

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfcast.llm.bin_completion import best_fit, bins, complete, dominates, lower_bound
from shelfcast.llm.packing import best_fit_pack, vocabulary


def used(patterns):
    out = Counter()
    for sizes, often in patterns:
        for s in sizes:
            out[s] += often
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=60))
def test_every_item_is_packed_once_within_capacity(sizes):
    counts = Counter(sizes)
    patterns = complete(counts, 30)
    assert used(patterns) == counts and all(sum(p) <= 30 for p, _ in patterns)
    assert lower_bound(counts, 30) <= bins(patterns) <= bins(best_fit(counts, 30))


def optimum(sizes, capacity):
    best = len(sizes)

    def place(rest, loads):
        nonlocal best
        if len(loads) >= best:
            return
        if not rest:
            best = len(loads)
            return
        for i in range(len(loads)):
            if loads[i] + rest[0] <= capacity and loads[i] not in loads[:i]:
                place(rest[1:], [*loads[:i], loads[i] + rest[0], *loads[i + 1 :]])
        place(rest[1:], [*loads, rest[0]])

    place(sorted(sizes, reverse=True), [])
    return best


def test_completion_finds_optima_that_best_fit_misses():
    rng = random.Random(8)
    better = 0
    for _ in range(60):
        sizes = [rng.randint(3, 14) for _ in range(10)]
        best = optimum(sizes, 20)
        got = bins(complete(Counter(sizes), 20))
        assert got == best, sizes
        better += best < bins(best_fit(Counter(sizes), 20))
    assert better


def test_dominance():
    assert dominates((6, 2), (3, 3, 2)) and dominates((5,), (3, 2)) and not dominates((4, 4), (5, 2))
    for a in combinations_with_replacement(range(1, 5), 2):
        assert dominates(tuple(sorted(a, reverse=True)), tuple(sorted(a, reverse=True)))


def test_too_large_or_empty_items_are_refused():
    with pytest.raises(ValueError):
        complete({11: 1}, 10)
    assert complete({}, 10) == []


@pytest.mark.parametrize("payload", ["ids", "crc32"])
def test_pieces_hold_the_tokens_and_sequences_have_no_gaps(spark, payload):
    ranks, reference = vocabulary()
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma's", "Ünï", "日本", "12", "\n"]) for _ in range(rng.randint(0, 120))) for _ in range(90)]
    rows = [*enumerate(texts), (7, texts[7]), (None, "x"), (200, None), (201, ""), (202, "a " * 700), (203, "<|endoftext|>")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("length", F.lit("clash")).repartition(3)
    out = best_fit_pack(docs, ranks, reference, capacity=64, payload=payload).collect()
    tokenizer = Tokenizer.from_file(reference)
    want = Counter()
    for d, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % 64 if len(ids) > 64 else len(ids)
        edges = [0, first] if first else [0]
        while edges[-1] < len(ids):
            edges.append(edges[-1] + 64)
        for k, (lo, hi) in enumerate(zip(edges, edges[1:])):
            crc = zlib.crc32(np.array(ids[lo:hi], dtype="<u4").tobytes())
            want[d, k, lo, hi - lo, crc if payload == "crc32" else tuple(ids[lo:hi])] += 1
    name = "ids_crc32" if payload == "crc32" else "ids"
    value = (lambda r: r[name]) if payload == "crc32" else (lambda r: tuple(r[name]))
    assert Counter((r.doc_id, r.piece, r.start, r.length, value(r)) for r in out) == want
    ends: dict[int, int] = {}
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 64 and len(ends) <= 1.02 * lower_bound(Counter(r.length for r in out), 64) + 1


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert best_fit_pack(docs, *vocabulary()).count() == 0


def test_pieces_leave_a_task_in_small_batches_with_one_encoder(monkeypatch):
    import pyarrow as pa

    from shelfcast.llm import packing

    class Task:
        get = staticmethod(lambda: Task)
        partitionId = staticmethod(lambda: 4)

    monkeypatch.setattr(packing, "TaskContext", Task)
    texts = [None, "", *[f"word{i} " * 4000 for i in range(60)]]  # about 2 MB in one batch
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts)})
    found = list(packing._pieces(iter([batch]), *vocabulary(), 1024, "ids"))
    largest = max(len(t or "") for t in texts)
    assert len(found) > 5
    for part in found:
        some = {texts[i] for i in part.column("doc_id").to_pylist()}
        assert sum(len(t or "") for t in some) <= max(packing.SLICE, largest)
    whole = pa.Table.from_batches(found).to_pylist()
    assert [r["doc_id"] for r in whole] == sorted(r["doc_id"] for r in whole) and {r["doc_id"] for r in whole} == set(range(len(texts)))
    met = Counter()
    for r in whole:
        assert r["number"] == met[r["length"]] and len(r["ids"]) == r["length"] and r["task"] == 4
        met[r["length"]] += 1
    assert packing._encoder(*vocabulary()) is packing._encoder(*vocabulary())
