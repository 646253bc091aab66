"""The n-gram Jaccard join against all pairs."""

from __future__ import annotations

import random
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from test_textcore import plain_set  # noqa: E402

from shelfcast.llm import jaccard_join as module  # noqa: E402
from shelfcast.llm.components import components  # noqa: E402
from shelfcast.llm.jaccard_join import BITS, COARSE, _slot, jaccard_join, parity_sketch  # noqa: E402
from shelfcast.session import scratch, settle  # noqa: E402

SCHEMA = "doc_id long, text string"


def brute(rows):
    sets = [(d, plain_set(t)) for d, t in rows]
    parent = {d: d for d, _ in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            common = len(x & y)
            if common and 100 * common >= 75 * (len(x) + len(y) - common):
                lo, hi = sorted((root(a), root(b)))
                parent[hi] = lo
    return sorted((d, len(s), root(d)) for d, s in sets)


def found(spark, rows):
    out = jaccard_join(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted(tuple(r) for r in out.collect())


def corpus():
    rng = random.Random(3)
    word = lambda: rng.choice("abcdefghij") + rng.choice("klmnop") + rng.choice("qrstuv")
    shared = [word() for _ in range(60)]
    rows = []
    for family in range(6):
        text = [word() for _ in range(rng.randint(30, 90))]
        for _ in range(12):
            copy = list(text)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = word()
            rows.append(" ".join(copy[: rng.randint(len(copy) - 6, len(copy))]))
    rows += [" ".join([*(word() for _ in range(rng.randint(3, 25))), *shared]) for _ in range(25)]
    rows += [" ".join(shared[i : i + 30]) for i in range(0, 12)]
    rows += ["", " ", "one two", "one  TWO", "one two three", "the the the the the the", "the the the the the"]
    rows += [rows[0]] * 9
    rng.shuffle(rows)
    return [(i * 3 + 5, t) for i, t in enumerate(rows)]


def test_components_equal_all_pairs(spark):
    rows = corpus()
    assert found(spark, rows) == brute(rows)


def test_hot_shingles_are_dealt_out_without_loss(spark, monkeypatch):
    monkeypatch.setattr("shelfcast.llm.jaccard_join.HOT", 2)
    rows = corpus()
    assert found(spark, rows) == brute(rows)


def test_sketches_never_differ_more_than_the_sets():
    rng = np.random.default_rng(5)
    for n in (1, 40, 255, 256, 257, 900, 4000):
        pool = rng.integers(0, 1 << 63, n + n // 2 + 3, dtype=np.uint64)
        x, y = np.sort(pool[:n]), np.sort(pool[n // 4 : n // 4 + n + n // 8])
        a, b = parity_sketch(x), parity_sketch(y)
        short, long = sorted((a, b), key=len)
        assert len(long) in (len(short), 2 * len(short))
        if len(long) > len(short):
            long = long[: len(short)] ^ long[len(short) :]
        differ = len(set(x.tolist()) ^ set(y.tolist()))
        assert sum(int(v).bit_count() for v in (short ^ long).view(np.uint64)) <= differ


def test_sketches_of_two_lengths(spark):
    """Sets of 511 to 560 shingles on both sides of a sketch's step, some similar, some below the threshold."""
    words = [f"w{i}" for i in range(700)]
    rows = [(1, " ".join(words[:515])), (2, " ".join(words[:560])), (3, " ".join(words[40:560])), (4, " ".join(words[160:700]))]
    rows += [(10 + i, " ".join([*words[: 350 + i], *(f"x{i}_{j}" for j in range(170))])) for i in range(6)]
    assert found(spark, rows) == brute(rows)


def test_nulls_ties_and_repeated_rows(spark):
    text = "a b c d e f g h"
    rows = [(4, text), (4, text), (9, text), (2, None), (None, text), (7, "x y z"), (7, text), (8, "x y z")]
    got = jaccard_join(spark.createDataFrame(rows, SCHEMA).withColumn("n", F.lit(1)).withColumn("component_id", F.lit("x")))
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(
        [(4, 4, 4), (4, 4, 4), (9, 4, 4), (2, 0, 2), (None, 4, None), (7, 1, 4), (7, 4, 4), (8, 1, 4)], key=str
    )


def test_empty_table(spark):
    assert found(spark, []) == []


def test_long_text_links_with_itself_changed_a_little(spark):
    words = [f"w{i}" for i in range(30_000)]
    other = list(words)
    other[15_000] = "changed"
    assert found(spark, [(1, " ".join(words)), (2, " ".join(other)), (3, "w0 " * 40_000)]) == [
        (1, 29_996, 1), (2, 29_996, 1), (3, 1, 3)
    ]


@pytest.mark.parametrize("links", [[], [(1, 2)], [(5, 1), (2, 5), (9, 8), (8, 7), (3, 3)], [(i, i + 1) for i in range(60)]])
def test_components(spark, links):
    parent = {x: x for p in links for x in p}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        lo, hi = sorted((root(a), root(b)))
        parent[hi] = lo
    want = {x: root(x) for p in links for x in p if p[0] != p[1]}
    got = components(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.component for r in got.collect()} == want and got.count() == len(want)


def test_coarse_sketches_tell_copies_below_the_threshold():
    """Sets of 146 shingles at similarity 0.7: hardly any may pass, or a group of them is paired whole."""
    rng = np.random.default_rng(7)
    base = rng.integers(0, 1 << 63, 146, dtype=np.uint64)
    near = [np.sort(np.concatenate((base[:133], rng.integers(0, 1 << 63, 13, dtype=np.uint64)))) for _ in range(2)]
    passed = 0
    for _ in range(200):
        x, y = (np.sort(np.concatenate((base[:121], rng.integers(0, 1 << 63, 25, dtype=np.uint64)))) for _ in range(2))
        apart = sum(int(v).bit_count() for v in (parity_sketch(x) ^ parity_sketch(y)).view(np.uint64))
        passed += 175 * apart <= 25 * 292
    same = sum(int(v).bit_count() for v in (parity_sketch(near[0]) ^ parity_sketch(near[1])).view(np.uint64))
    assert len(parity_sketch(base)) == len(COARSE) and 175 * same <= 25 * 292 and passed <= 20


def test_scratch_removes_shuffle_files(spark):
    """A write inside asks Spark to drop its shuffle files; outside the option is as it was."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    with scratch(spark) as keep:
        assert spark.conf.get(name) == "true"
        inner = settle(spark.range(100).repartition(3, "id").groupBy("id").count())
        out = keep(inner.where("id < 7"))
    assert spark.conf.get(name, None) == before and out.count() == 7


def test_ids_that_count_up_by_partition_have_bits_of_their_own():
    """Numbers of ``monotonically_increasing_id`` share their low bits; sharing a bit, each wanted set drew in many others."""
    ids = np.concatenate([(np.int64(part) << 33) + np.arange(2000) for part in range(40)])
    assert len(np.unique(_slot(ids))) > 0.95 * len(ids)
    assert len(np.unique(_slot(np.arange(80_000)))) > 0.95 * 80_000
    for edge in (np.array([-1, 0, 2**63 - 1, -(2**63)]), np.array([], dtype=np.int64)):
        assert ((0 <= _slot(edge)) & (_slot(edge) < BITS)).all()


def test_pairs_of_whole_sets_move_in_small_batches(spark, monkeypatch):
    """A batch of 1000 pairs of long sets took the memory of an executor; only the setting during the write counts."""
    seen, option = [], "spark.sql.execution.arrow.maxRecordsPerBatch"
    monkeypatch.setattr(module, "settle", lambda df: seen.append((df.columns, spark.conf.get(option))) or settle(df))
    before = spark.conf.get(option)
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text), (2, text + " end"), (3, "other words")], SCHEMA)
    assert sorted(tuple(r) for r in jaccard_join(docs).collect()) == [(1, 36, 1), (2, 37, 1), (3, 1, 3)]
    verified = [int(n) for columns, n in seen if columns == ["a", "b"]]
    assert min(verified) == module.PAIR_ROWS < int(before) == int(spark.conf.get(option))
