"""Exact n-gram Jaccard self-join by grouped prefixes.

A document is the set of its distinct word shingles. All sets are put in one order, rare shingles first, so that two
sets with Jaccard similarity t or more share a shingle among their first n - ceil(t n) + 1 ones (the prefix). Documents
with the same prefix and size form one group; groups that meet in a prefix shingle and pass the size bound are
expanded to their members, whose whole sets are compared.

Scale
* The order comes from a fixed table of shingle counts over all documents. Any order is right; this one keeps
  passages that many documents share out of the prefixes.
* Documents stay where they are; only prefixes are shuffled, as packed arrays, one per slice of text and bucket.
  Shingles met once end there.
* Copies fall into one class (size and 128-bit digest of the set) before anything is compared.
* Every set has a parity sketch: one bit per slot, the parity of its shingles there. Two sets differ in at least as many
  shingles as their sketches differ in bits, so a pair whose sketches differ too much is no link. This bound loses
  nothing, costs a few longs a pair, and is tested inside the joins that would emit the pair.
* Candidates of a shingle are first compared with a few pivots, for some turns. What the pivots connect needs no further
  look: in the end only candidates that still lie in different components are paired, so a group of near copies costs
  its size, not its square.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.llm import sketch
from shelfcast.llm.common import batch_rows
from shelfcast.llm.components import components
from shelfcast.llm.textcore import shingle_sets, signed, utf8_slices
from shelfcast.session import scratch, settle

COUNTERS = 1 << 20
BITS = 1 << 23
BUCKET_POSTINGS = 500_000
HOT = 200_000
SALTS = 256
PIVOT_TURNS = 4
#: Pairs of whole sets in one Arrow batch: a task holds a batch on either side of the pipe, and a set may have 20,000 longs.
PAIR_ROWS = 50
#: Longs of the coarse sketch that the joins compare. With 1024 bits, pairs of sets of some hundred shingles that pass
#: are few more than the similar ones; with 256, copies a little below the threshold passed too.
COARSE = [f"c{i}" for i in range(16)]
_DOCUMENT = f"doc_id long, n long, gid long, d1 long, d2 long, {', '.join(f'{c} long' for c in COARSE)}, sketch array<long>"


def _count(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(COUNTERS, dtype=np.uint64)
    for batch in batches:
        for _, _, data, bounds in utf8_slices(batch.column("text")):
            sets = list(shingle_sets(data, bounds, k))
            slots = np.concatenate(sets) & np.uint64(COUNTERS - 1)
            counts += np.bincount(slots.view(np.int64), minlength=COUNTERS).astype(np.uint64)
    rows = list(sketch.parts(counts, TaskContext.get().partitionId()))
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary()))] if rows else None
    if columns:
        yield pa.RecordBatch.from_arrays(columns, ["chunk", "salt", "payload"])


def prefix_length(n: int, percent: int) -> int:
    return n - (-(-percent * n // 100)) + 1


def _digest(one: np.ndarray) -> tuple[np.uint64, np.uint64]:
    """128 bits of a sorted set, order-free."""
    return one.sum(dtype=np.uint64), (one * (one >> np.uint64(29) | np.uint64(1))).sum(dtype=np.uint64)


def _prefix(one: np.ndarray, counts: np.ndarray, percent: int) -> tuple[np.ndarray, np.uint64]:
    """The sorted prefix of a set that is not empty, and the name of its group: same prefix, same size."""
    n = len(one)
    size = prefix_length(n, percent)
    if size < n:  # all below the weight of the last one, then the smallest of its equals
        weight = counts[(one & np.uint64(COUNTERS - 1)).view(np.int64)]
        last = np.partition(weight, size - 1)[size - 1]
        prefix = np.concatenate((one[weight < last], one[weight == last][: size - int((weight < last).sum())]))
        prefix.sort()
    else:
        prefix = one
    p1, p2 = _digest(prefix)
    return prefix, np.uint64((int(p1) ^ int(p2) * 2) + n * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)


def parity_sketch(one: np.ndarray) -> np.ndarray:
    """Parities of the shingles in 1024 slots, or in the next power of two from their number on, packed as longs.

    Half of the slots of a sketch are the exclusive or of its two halves.
    """
    slots = max(64 * len(COARSE), 1 << (len(one) - 1).bit_length()) if len(one) else 64 * len(COARSE)
    odd = np.bincount((one & np.uint64(slots - 1)).view(np.int64), minlength=slots) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _documents(batches: Iterator[pa.RecordBatch], k: int, percent: int, order: Broadcast) -> Iterator[pa.RecordBatch]:
    """Size, group, digest and sketches of every document; the whole sketch only where it is more than the coarse one."""
    counts = sketch.opened(order.value, np.uint32)
    names = ["doc_id", "n", "gid", "d1", "d2", *COARSE]
    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        for lo, hi, data, bounds in utf8_slices(batch.column("text")):
            table = np.zeros((hi - lo, len(names)), dtype=np.int64)
            table[:, 0] = ids[lo:hi]
            sketches: list[np.ndarray | None] = [None] * (hi - lo)
            for row, one in enumerate(shingle_sets(data, bounds, k)):
                if len(one):
                    _, group = _prefix(one, counts, percent)
                    whole = parity_sketch(one)
                    table[row, 1] = len(one)
                    table[row, 2:5] = np.array([group, *_digest(one)], dtype=np.uint64).view(np.int64)
                    table[row, 5:] = np.bitwise_xor.reduce(whole.reshape(-1, len(COARSE)), axis=0)
                    if len(whole) > len(COARSE):
                        sketches[row] = whole
            columns = [pa.array(np.ascontiguousarray(table[:, i])) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sketches, pa.list_(pa.int64()))], [*names, "sketch"])


def _prefixes(
    batches: Iterator[pa.RecordBatch], k: int, percent: int, order: Broadcast, buckets: int, hot_from: int
) -> Iterator[pa.RecordBatch]:
    """Packed (shingle, group) of every new group's prefix, by bucket."""
    counts = sketch.opened(order.value, np.uint32)
    known: set[np.uint64] = set()
    for batch in batches:
        for _, _, data, bounds in utf8_slices(batch.column("text")):
            tokens, groups = [], []
            for one in shingle_sets(data, bounds, k):
                if not len(one):
                    continue
                prefix, group = _prefix(one, counts, percent)
                if group not in known:
                    known.add(group)
                    tokens.append(prefix)
                    groups.append(np.full(len(prefix), group, dtype=np.uint64))
            if not tokens:
                continue
            token, group = np.concatenate(tokens), np.concatenate(groups)
            hot = counts[(token & np.uint64(COUNTERS - 1)).view(np.int64)] >= hot_from
            to = (token >> np.uint64(20)) % np.uint64(buckets)
            # A shingle that may be in very many prefixes is dealt over many buckets.
            spread = np.uint64(buckets) + (token + group % np.uint64(SALTS)) % np.uint64(SALTS)
            dealt = _deal(np.where(hot, spread, to), np.stack((signed(token), signed(group)), axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array([at for at, _ in dealt], pa.int64()), pa.array([rows for _, rows in dealt], pa.binary())],
                ["bucket", "postings"],
            )


def _deal(to: np.ndarray, rows: np.ndarray) -> list[tuple[int, bytes]]:
    by = np.argsort(to, kind="stable")
    to, rows = to[by], rows[by]
    cuts = np.flatnonzero(np.diff(to)) + 1
    starts = to[np.concatenate(([0], cuts)).astype(np.int64)]
    return [(int(at), block.tobytes()) for at, block in zip(starts, np.split(rows, cuts), strict=True)]


def _meet(table: pa.Table, buckets: int) -> pa.Table:
    """The postings whose shingle is in two groups (or may be, if it is hot), each once."""
    rows = np.frombuffer(b"".join(table.column("postings").to_pylist()), dtype=np.int64).reshape(-1, 2)
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    if len(rows):
        new_token = np.concatenate(([True], rows[1:, 0] != rows[:-1, 0]))
        rows_kept = new_token | np.concatenate(([True], rows[1:, 1] != rows[:-1, 1]))
        rows, new_token = rows[rows_kept], new_token[rows_kept]
        if table.column("bucket")[0].as_py() < buckets:
            single = new_token & np.concatenate((new_token[1:], [True]))
            rows = rows[~single]
    return pa.table({"token": np.ascontiguousarray(rows[:, 0]), "gid": np.ascontiguousarray(rows[:, 1])})


def _sets(batches: Iterator[pa.RecordBatch], k: int, wanted: Broadcast) -> Iterator[pa.RecordBatch]:
    """(doc_id, packed set) of the documents whose bit is set."""
    bits = sketch.opened(wanted.value, np.uint8)
    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        take = np.flatnonzero(bits[_slot(ids)])
        if len(take):
            some = batch.take(pa.array(take))
            for lo, hi, data, bounds in utf8_slices(some.column("text")):
                packed = [one.tobytes() for one in shingle_sets(data, bounds, k)]
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id").slice(lo, hi - lo), pa.array(packed, pa.binary())], ["doc_id", "shingles"]
                )


def _slot(ids: np.ndarray) -> np.ndarray:
    """Where an id's bit stands: ids that count up, within partitions or over the table, are dealt over all bits."""
    x = ids.astype(np.int64).view(np.uint64)
    x = (x ^ x >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)
    return (x >> np.uint64(65 - BITS.bit_length())).astype(np.int64)


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(BITS, dtype=np.uint8)
    for batch in batches:
        bits[_slot(batch.column("doc_id").to_numpy(zero_copy_only=False))] = 1
    rows = list(sketch.parts(bits, TaskContext.get().partitionId()))
    if rows:
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary()))]
        yield pa.RecordBatch.from_arrays(columns, ["chunk", "salt", "payload"])


def _similar(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = np.zeros(batch.num_rows, dtype=bool)
        left, right = batch.column("left"), batch.column("right")
        for i in range(batch.num_rows):
            x, y = (np.frombuffer(c[i].as_buffer(), dtype=np.uint64) for c in (left, right))
            both = np.sort(np.concatenate((x, y)))
            common = int((both[1:] == both[:-1]).sum())
            keep[i] = 100 * common >= percent * (len(x) + len(y) - common)
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _verified(pairs: DataFrame, named: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough, written. Only the sets they need are made and moved."""
    pairs = settle(pairs)
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    bits = sketch.summed(wanted.mapInArrow(_mark, sketch.PART_SCHEMA), BITS)
    shared = sketch.shared(named, (bits > 0).astype(np.uint8))
    sets = settle(named.mapInArrow(partial(_sets, k=k, wanted=shared), "doc_id long, shingles binary"))
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("right"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    with batch_rows(named.sparkSession, PAIR_ROWS):
        return settle(both.mapInArrow(partial(_similar, percent=percent), "a long, b long"))


def _sizes(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, data, bounds in utf8_slices(batch.column("text")):
            sizes = [len(one) for one in shingle_sets(data, bounds, k)]
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64())], ["n_shingles"])


def _needed(a: Column, b: Column, percent: int) -> Column:
    """Prefix shingles that similar sets of ``a`` and ``b`` shingles share at least.

    What they share outside both prefixes lies in the rest of the one whose prefix ends first.
    """
    return F.ceil(percent * (a + b) / (100 + percent)) - (F.ceil(percent * F.greatest(a, b) / 100) - 1)


def _near(percent: int) -> Column:
    """Whether sets of n_a and n_b shingles can be similar by their sizes and their coarse sketches, if both are known."""
    a, b = F.col("n_a"), F.col("n_b")
    apart = reduce(Column.__add__, [F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in COARSE])
    fits = 100 * F.least(a, b) >= percent * F.greatest(a, b)
    return fits & F.coalesce((100 + percent) * apart <= (100 - percent) * (a + b), F.lit(True))


def _near_whole(percent: int) -> Column:
    """The same by the whole sketches, if both sets have one."""
    a, b = F.col("sketch_a"), F.col("sketch_b")
    size = F.least(F.size(a), F.size(b))

    def halved(x: Column) -> Column:
        folded = F.zip_with(F.slice(x, F.lit(1), size), F.slice(x, size + 1, size), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(x) > size, folded).otherwise(x)

    bits = F.zip_with(halved(a), halved(b), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    apart = F.aggregate(bits, F.lit(0), lambda total, one: total + one)
    differ = (100 + percent) * apart <= (100 - percent) * (F.col("n_a") + F.col("n_b"))
    return a.isNull() | b.isNull() | differ


def _promising(met: DataFrame, percent: int) -> DataFrame:
    """(token, gid, n) of the meetings that are needed to meet every similar partner.

    A similar pair shares at least ``_needed`` prefix shingles. In any common order the first shingle that it shares has
    that many, less one, behind it on either side. So with a group's shared shingles in order, rarest first, those with
    fewer behind them than any size met there would need can go, and with them groups that share too few at all.
    """
    all_met = met.withColumn("meets", F.count("*").over(Window.partitionBy("gid")))
    runs = all_met.groupBy("token").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.count("*").alias("size")
    )
    n, share = F.col("n"), percent / 100
    small, large = F.greatest("least", F.ceil(n * share)), F.least("most", F.floor(n / share))
    fewest = F.least(_needed(n, small, percent), _needed(n, large, percent)) - 1  # rounding between the two ends
    place = F.row_number().over(Window.partitionBy("gid").orderBy("size", "token"))
    placed = all_met.join(runs, "token").withColumn("behind", F.col("meets") - place + 1)
    return placed.where((F.col("least") <= large) & (F.col("most") >= small) & (F.col("behind") >= fewest)).select(
        "token", "gid", "n"
    )


def _within(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of each group's first class with its other ones."""
    first = nodes.groupBy("gid").agg(F.min("rep").alias("a"))
    return nodes.join(first, "gid").where("rep != a").select("a", F.col("rep").alias("b"))


def _open_rows(live: DataFrame, labelled: DataFrame) -> DataFrame:
    """(token, label, gid, n) of the shingles whose groups still lie in different components, written."""
    parts = live.join(labelled.select("gid", "label").distinct(), "gid")
    spread = parts.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi")
    return settle(parts.join(spread.select("token"), "token").select("token", "label", "gid", "n"))


def _pivot_pairs(rows: DataFrame, labelled: DataFrame, percent: int, turn: int) -> DataFrame:
    """Pairs (a, b): pivots for each shingle and class of sizes, with the groups in other components than theirs.

    Pivots are the first and the last in two random orders of groups, others each turn, the same for all shingles of a
    family.
    """
    scale = F.floor(F.log(F.col("n")) / math.log(100 / percent))
    sized = rows.withColumn("scale", scale)
    picks = {}
    for k in (0, 1):
        group = F.struct(F.xxhash64("gid", F.lit(2 * turn + k)).alias("place"), "gid", "label", "n")
        picks |= {f"least_{k}": F.min(group), f"most_{k}": F.max(group)}
    ends = sized.groupBy("token", "scale").agg(
        F.count("*").alias("size"), *[pick.alias(name) for name, pick in picks.items()]
    )
    each = [F.struct(*[F.col(f"{name}.{c}").alias(c) for c in ("gid", "label", "n")]) for name in picks]
    chosen = F.when(F.col("size") > 2, F.array_distinct(F.array(*each))).otherwise(F.array(each[0]))
    pivots = ends.where("size > 1").select("token", "scale", F.explode(chosen).alias("pivot"))
    met = (
        sized.join(pivots, ["token", "scale"])
        .where("gid != pivot.gid AND label != pivot.label")
        .where(100 * F.least("n", "pivot.n") >= percent * F.greatest("n", "pivot.n"))
        .select(F.least("pivot.gid", "gid").alias("gid_a"), F.greatest("pivot.gid", "gid").alias("gid_b"))
    )
    return _members(met.distinct(), labelled, percent)


def _members(groups: DataFrame, labelled: DataFrame, percent: int) -> DataFrame:
    """Expand pairs of groups to the pairs (a, b) of their members in different components that may be similar."""
    columns = ["gid", "label", "n", *COARSE, "sketch"]
    a, b = (labelled.select(F.col("rep").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in columns]) for s in "ab")
    pairs = groups.join(a, "gid_a").join(b, "gid_b").where("label_a != label_b").where(_near(percent))
    once = pairs.where(_near_whole(percent)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return once.distinct()


def _all_pairs(rows: DataFrame, labelled: DataFrame, percent: int) -> DataFrame:
    """All candidate pairs (a, b) whose components differ.

    Under each shingle the smaller component is expanded first. The join that meets the groups tests their coarse
    sketches (of groups with one class), so it makes rows for pairs that may be similar only.
    """
    single = F.count("*") == 1
    marks = labelled.groupBy("gid").agg(*[F.when(single, F.min(c)).alias(c) for c in COARSE])
    runs = rows.groupBy("token", "label").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.count("*").alias("many")
    )
    left, right = (
        runs.select("token", *[F.col(c).alias(f"{c}_{s}") for c in ("label", "least", "most", "many")]) for s in "ab"
    )
    meets = left.join(right, "token").where(
        (F.struct("many_a", "label_a") > F.struct("many_b", "label_b"))
        & (100 * F.col("most_a") >= percent * F.col("least_b"))
        & (100 * F.col("most_b") >= percent * F.col("least_a"))
    )
    wide = rows.join(marks, "gid")
    a, b = (wide.select("token", *[F.col(c).alias(f"{c}_{s}") for c in ("label", "gid", "n", *COARSE)]) for s in "ab")
    met = (
        meets.select("token", "label_a", "label_b").join(b, ["token", "label_b"]).join(a, ["token", "label_a"])
        .where("gid_a != gid_b").where(_near(percent))
        .select(F.least("gid_a", "gid_b").alias("gid_a"), F.greatest("gid_a", "gid_b").alias("gid_b"))
    )
    several = labelled.groupBy("gid").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi")
    within = several.select(F.col("gid").alias("gid_a"), F.col("gid").alias("gid_b"))
    return _members(met.distinct().unionByName(within), labelled, percent)


def _links(live: DataFrame, nodes: DataFrame, named: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (a, b) that connect whatever all links would connect.

    Turns with pivots cost as much as there are postings. They go on while pairing all that is still apart would cost
    more than that, for PIVOT_TURNS at most; then all that is still apart is paired.
    """
    links = _verified(_within(nodes), named, k, percent)
    for turn in range(PIVOT_TURNS + 1):
        labels = components(links).withColumnRenamed("node", "rep")
        named_parts = nodes.join(labels, "rep", "left").withColumn("label", F.coalesce("component", "rep"))
        labelled = settle(named_parts.drop("component"))
        rows = _open_rows(live, labelled)
        live = rows.select("token", "gid", "n").distinct()  # what lies in one component stays there
        spread = rows.groupBy("token").agg(F.count_distinct("label").cast("double").alias("l"), F.count("*").alias("n"))
        pairs, postings = spread.agg(F.sum(F.expr("l * (l - 1) / 2")), F.sum("n")).first()
        last = turn == PIVOT_TURNS or (pairs or 0) <= (postings or 0)
        if last:
            found = _all_pairs(rows, labelled, percent)
        else:
            found = _pivot_pairs(rows, labelled, percent, turn)
        links = links.unionByName(_verified(found, named, k, percent))
        if last:
            break
    return links


def jaccard_join(docs: DataFrame, k: int = 5, percent: int = 75) -> DataFrame:
    """One row per row of ``docs`` (doc_id long, text string): doc_id, n_shingles, component_id.

    Words are maximal runs without ASCII white space, A-Z in lower case; a set holds the distinct ``k``-word shingles,
    or the whole sequence if it is shorter. Two documents link when 100 * intersection >= ``percent`` * union;
    component_id is the smallest doc_id reachable by links, itself included.

    Null or empty text, or white space only: n_shingles 0, linked with nothing. Null doc_id: n_shingles is given and
    component_id is null. Rows that share a doc_id are one node and each keep their own n_shingles. Other columns of
    ``docs`` are ignored, whatever their names. An empty table gives an empty result. The result is written to the
    shared folder; the tables on the way to it are removed.
    """
    with scratch(docs.sparkSession) as keep:
        return keep(_joined(docs, k, percent))


def _joined(docs: DataFrame, k: int, percent: int) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    named = docs.where("doc_id IS NOT NULL")
    counted = named.select("text").mapInArrow(partial(_count, k=k), sketch.PART_SCHEMA)
    counts = sketch.summed(counted, COUNTERS)
    buckets = max(64, math.ceil(int(counts.sum()) * (100 - percent) / 100 / BUCKET_POSTINGS))
    order = sketch.shared(docs, np.minimum(counts, np.iinfo(np.uint32).max).astype(np.uint32))
    members = settle(named.mapInArrow(partial(_documents, k=k, percent=percent, order=order), _DOCUMENT))
    dealt = partial(_prefixes, k=k, percent=percent, order=order, buckets=buckets, hot_from=HOT)
    moved = named.select("text").mapInArrow(dealt, "bucket long, postings binary")
    postings = settle(moved.groupBy("bucket").applyInArrow(lambda table: _meet(table, buckets), "token long, gid long"))

    name = ["n", "gid", "d1", "d2"]
    classes = settle(members.where("n > 0").groupBy(*name).agg(F.min("doc_id").alias("rep")))
    groups = classes.groupBy("gid", "n").agg(F.count("*").alias("classes"))
    live = settle(_promising(postings.join(groups.select("gid", "n"), "gid"), percent))
    # Nodes that may have a partner: of groups that meet another one, or that hold several classes.
    some = live.select("gid").union(groups.where("classes > 1").select("gid")).distinct()
    wanted = classes.join(some, "gid").select("gid", "rep", *[F.col(c).alias(f"{c}_") for c in ("n", "d1", "d2")])
    same = "doc_id = rep AND n = n_ AND d1 = d1_ AND d2 = d2_"  # repeated ids may stand for several sets
    drawn = members.select("doc_id", "n", "d1", "d2", *COARSE, "sketch").join(wanted, F.expr(same))
    each = drawn.dropDuplicates(["gid", "n", "d1", "d2"])
    nodes = settle(each.select("gid", "n", "rep", *COARSE, "sketch"))
    links = _links(live, nodes, named, k, percent)
    placed = members.join(classes, name, "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("rep", "doc_id").alias("rep")
    )
    twice = placed.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a < b")
    joined = components(links.unionByName(twice.select("a", "b"))).withColumnRenamed("node", "rep")
    whole = placed.join(joined, "rep", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id")
    )
    unnamed = docs.where("doc_id IS NULL").mapInArrow(partial(_sizes, k=k), "n_shingles long")
    return whole.unionByName(
        unnamed.select(
            F.lit(None).cast("long").alias("doc_id"), "n_shingles", F.lit(None).cast("long").alias("component_id")
        )
    )


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five words, similarity 0.75, over all of ``documents``."""
    return jaccard_join(spark.read.parquet(f"{sf_dir}/documents.parquet"))
