"""Lattice near-duplicates and nearest neighbours against brute force."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from shelfcast.llm import ann, lattice

SCHEMA = "vec_id long, embedding array<float>"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows], SCHEMA)


def clustered(n=600, dim=64, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 6, dim))
    x = centres[rng.integers(0, len(centres), n)] + rng.normal(size=(n, dim)) * rng.choice([0.05, 0.15, 0.6], (n, 1))
    return np.vstack([x, x[:40], x[:15] * 2.0]).astype(np.float32).astype(np.float64)


def test_nearest_lattice_point_is_nearest():
    y = np.random.default_rng(0).normal(size=(300, 8)) * 2
    p = lattice.nearest_e8(y)
    twice = np.rint(2 * p)
    assert np.allclose(2 * p, twice) and (np.ptp(twice % 2, axis=1) == 0).all() and (p.sum(axis=1) % 2 == 0).all()
    best = ((y - p) ** 2).sum(axis=1)
    around = ((y[:, None, :] - p[:, None, :] - lattice.NEIGHBOURS[None]) ** 2).sum(axis=2)
    assert (best[:, None] <= around + 1e-12).all() and len(lattice.NEIGHBOURS) == 240


def test_links_equal_all_pairs(spark):
    x = clustered()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    got = {r.vec_id: r for r in lattice.near_duplicates(table(spark, enumerate(x))).collect()}
    want = linked.sum(axis=1) - 1
    links = np.array([got[i].n_links for i in range(len(x))])
    assert (links <= want).all() and links.sum() >= 0.99 * want.sum()
    for i in range(len(x)):
        assert got[i].kept == (got[i].component_id == i) and got[i].component_id <= i
    for i in np.flatnonzero(links == want):
        assert len({got[j].component_id for j in np.flatnonzero(linked[i])}) == 1


def test_unusable_vectors_link_with_nothing(spark):
    v, nan, inf = [1.0, 2.0, 3.0], float("nan"), float("inf")
    rows = [(1, v), (2, v), (3, None), (4, [0.0, 0.0, 0.0]), (5, [1.0, None, 3.0]), (6, [1.0, nan, 3.0]), (7, [inf, 2.0, 3.0]),
            (8, []), (9, [1.0, 2.0]), (None, v), (2, v)]
    got = sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in lattice.near_duplicates(table(spark, rows)).collect())
    alone = [(str(i), 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9)]
    assert got == sorted([("1", 3, 1, True), ("2", 3, 1, False), ("2", 3, 1, False), ("None", 3, 1, False), *alone])
    assert lattice.near_duplicates(table(spark, [])).count() == 0


def test_hot_cells_are_cut_into_chunks_without_loss(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.normal(size=64) + rng.normal(size=(150, 64)) * 0.02
    monkeypatch.setattr(lattice, "CHUNK", 16)
    got = lattice.near_duplicates(table(spark, enumerate(x))).collect()
    assert {r.component_id for r in got} == {0} and sum(r.n_links for r in got) >= 0.99 * 150 * 149


def brute_neighbours(x, ids, q, n=10):
    far = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
    order = [i for i in np.lexsort((ids, far)) if ids[i] != ids[q]][:n]
    return [(int(ids[i]), far[i]) for i in order]


def test_neighbours_reach_the_recall(spark):
    x = np.vstack([np.random.default_rng(7).normal(size=(3000, 32)), clustered(400, 32)]).astype(np.float32).astype(np.float64)
    ids = np.arange(len(x))
    out = ann.nearest_neighbours(table(spark, zip(ids.tolist(), x, strict=True)), F.col("vec_id") % 100 == 0).collect()
    got: dict[int, list] = {}
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    hits = total = 0
    for q in range(0, len(x), 100):
        want = brute_neighbours(x, ids, q)
        assert len(got[q]) == 10 and got[q] == sorted(got[q], key=lambda p: (p[1], p[0]))
        exact = dict((i, s) for i, s in brute_neighbours(x, ids, q, len(x)))
        assert all(abs(exact[i] - s) < 1e-12 for i, s in got[q])
        hits += len({i for i, _ in want} & {i for i, _ in got[q]})
        total += 10
    assert hits >= 0.9 * total


def test_neighbours_with_copies_ties_and_few_rows(spark):
    rows = [(0, [1.0, 0.0]), *[(i, [1.0, 0.0]) for i in range(100, 130)], (50, [0.0, 1.0]), (51, None), (None, [1.0, 1.0]),
            (52, [0.0, 0.0]), (100, [1.0, 0.0])]
    query = F.col("vec_id") % 100 == 0
    got = {}
    for r in ann.nearest_neighbours(table(spark, rows), query).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(got[0]) == [(k + 1, 100 + k, 0.0) for k in range(10)]
    assert sorted(got[100]) == [(1, 0, 0.0), *[(k + 1, 100 + k, 0.0) for k in range(1, 10)]]
    few = ann.nearest_neighbours(table(spark, [(0, [1.0, 2.0]), (1, [1.0, 3.0])]), query).collect()
    assert [tuple(r) for r in few] == [(0, 1, 1, 1.0)]
    assert ann.nearest_neighbours(table(spark, []), query).columns == ["query_id", "rank", "vec_id", "score"]
    assert ann.nearest_neighbours(table(spark, [(0, [1.0, 2.0])]), query).count() == 0


def test_neighbours_of_every_length(spark):
    rng = np.random.default_rng(11)
    rows = [(i, rng.normal(size=6 if i % 3 == 0 else 4)) for i in range(600)] + [(601, [1.0]), (700, [2.0, 2.0])]
    wide = table(spark, rows).withColumns({"rank": F.lit("x"), "vector": F.lit(1), "score": F.lit(2), "i": F.lit(3), "n": F.lit(4)})
    got = {}
    for r in ann.nearest_neighbours(wide, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(got) == [0, 100, 200, 300, 400, 500]
    hits = 0
    for q, found in got.items():
        same = [(i, np.array(x)) for i, x in rows if len(x) == len(rows[q][1])]
        near = brute_neighbours(np.array([x for _, x in same]), np.array([i for i, _ in same]), [i for i, _ in same].index(q))
        assert [k for k, *_ in sorted(found)] == list(range(1, 11))
        hits += len({i for _, i, _ in found} & {i for i, _ in near})
    assert hits >= 54


def test_sieve_keeps_long_vectors_that_round_badly():
    dim, rng = 768, np.random.default_rng(5)
    base = np.full(dim, 4.49)
    base[0] = 127.0
    flipped = base.copy()
    flipped[1:31] *= -1
    far = base * np.where(np.arange(dim) % 3 == 1, -1, 1)
    rows = np.stack((base, flipped, far, rng.normal(size=dim)))
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    post = np.zeros(len(rows), dtype=np.dtype([*lattice._POSTING, ("vector", "i1", (dim,))]))
    step = np.abs(unit).max(axis=1) / 127
    post["id"], post["dim"], post["step"], post["home"] = np.arange(len(rows)), dim, step, 1
    post["vector"] = np.rint(unit / step[:, None])
    rounded = post["vector"] * step[:, None]
    assert unit[0] @ unit[1] > 0.95 and rounded[0] @ rounded[1] < 0.95 - 0.07
    found = lattice._meetings(pa.table({"postings": [post.tobytes()]}), 0.95).to_pylist()
    assert [(r["a"], r["b"]) for r in found] == [(0, 1)]
    ours, theirs = lattice._bounds(post["vector"], post["step"])
    assert (ours @ theirs.T >= unit @ unit.T).all()
