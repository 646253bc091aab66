"""Language identification by nearest centroid.

A text becomes a TF-IDF vector of hashed letter pairs and triples, of length one. Inverse document frequencies come
from all documents to learn from. Each language has several centroids, clustered by cosine on a bounded sample of its
documents. A text takes the language of its nearest centroid; it is accepted if it lies no farther from it than nearly
all of the sample did.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import sketch
from shelfcast.llm.textcore import utf8_slices
from shelfcast.operators.layout import join_small

SLOTS = 4096
CENTROIDS, TURNS, SEED = 6, 10, 3
SAMPLE = 1500
ACCEPT, SLACK = 0.995, 1.1
UNDETERMINED = "und"
SLICE = 1 << 20

_LETTERS = np.full(256, 0x20, dtype=np.uint8)
_LETTERS[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTERS[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTERS[0x80:] = np.arange(0x80, 0x100)


def gram_counts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Counts of the hashed letter pairs and triples of each row, a space at either end; A-Z and À-Þ count as lower."""
    n = len(bounds) - 1
    sizes = np.diff(bounds)
    text = np.full(len(data) + 2 * n, 0x20, dtype=np.uint8)
    letters = _LETTERS[data]
    upper = np.zeros(len(data), dtype=bool)
    upper[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    letters[upper] += 0x20
    text[np.arange(len(data)) + np.repeat(2 * np.arange(n) + 1, sizes)] = letters
    row = np.repeat(np.arange(n), sizes + 2)
    wide = text.astype(np.uint32)
    solid = text != 0x20
    pairs = wide[:-1] * np.uint32(0x9E3779B1) + wide[1:] * np.uint32(0x85EBCA77)
    triples = pairs[:-1] * np.uint32(0xC2B2AE3D) + wide[2:] * np.uint32(0x27D4EB2F) + np.uint32(1)
    counts = np.zeros(n * SLOTS, dtype=np.int64)
    for grams, good in ((pairs, solid[:-1] | solid[1:]), (triples, solid[1:-1] & (solid[:-2] | solid[2:]))):
        good &= row[: len(good)] == row[len(row) - len(good) :]
        slot = ((grams[good] ^ (grams[good] >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(20)
        counts += np.bincount(row[: len(good)][good] * SLOTS + slot, minlength=n * SLOTS)
    return counts.reshape(n, SLOTS)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF vectors of length one; a row without letters stays zero."""
    x = np.log1p(counts.astype(np.float32)) * idf
    return x / np.maximum(np.sqrt((x**2).sum(axis=1, keepdims=True)), 1e-12)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(SLOTS, dtype=np.uint64)
    for batch in batches:
        for _, _, data, bounds in utf8_slices(batch.column("text"), SLICE):
            counts += (gram_counts(data, bounds) > 0).sum(axis=0).astype(np.uint64)
    rows = list(sketch.parts(counts, TaskContext.get().partitionId()))
    if rows:
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary()))]
        yield pa.RecordBatch.from_arrays(columns, ["chunk", "salt", "payload"])


def clustered(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(centroids of length one, radius as cosine distance of each) by spherical k-means, spread-out first points."""
    first = [int(np.random.default_rng(SEED).integers(len(x)))]
    near = x @ x[first[0]]
    while len(first) < min(k, len(x)) and near.min() < 1 - 1e-6:
        first.append(int(near.argmin()))
        near = np.maximum(near, x @ x[first[-1]])
    centres = x[first].copy()
    for _ in range(TURNS):
        own = (x @ centres.T).argmax(axis=1)
        for c in range(len(centres)):
            if (own == c).any():
                mean = x[own == c].sum(axis=0)
                centres[c] = mean / max(np.sqrt((mean**2).sum()), 1e-12)
    best = x @ centres.T
    own = best.argmax(axis=1)
    far = 1 - best.max(axis=1)
    return centres, np.array([np.quantile(far[own == c], ACCEPT) if (own == c).any() else 0.0 for c in range(len(centres))])


def _fit(rows: pd.DataFrame, idf: Broadcast) -> pd.DataFrame:
    """The centroids of one language from its bounded sample."""
    weights = sketch.opened(idf.value, np.float32)
    rows = rows.sort_values(["doc_id", "text"])
    x = np.concatenate([
        weighted(gram_counts(data, bounds), weights) for _, _, data, bounds in utf8_slices(pa.array(rows.text), SLICE)
    ])
    centres, radius = clustered(x, CENTROIDS)
    return pd.DataFrame({
        "lang": [rows.lang.iloc[0]] * len(centres), "radius": radius,
        "centre": [c.astype("<f4").tobytes() for c in centres],
    })


def _predict(batches: Iterator[pa.RecordBatch], model: Broadcast) -> Iterator[pa.RecordBatch]:
    langs, centres, radius, idf = model.value
    for batch in batches:
        for lo, hi, data, bounds in utf8_slices(batch.column("text"), SLICE):
            cosine = weighted(gram_counts(data, bounds), idf) @ centres.T
            best = cosine.argmax(axis=1)
            score = np.clip(cosine.max(axis=1).astype(np.float64), 0, 1)
            ascii_letters = np.concatenate(([0], np.cumsum((_LETTERS[data] != 0x20) & (data < 0x80))))
            has = ascii_letters[bounds[1:]] > ascii_letters[bounds[:-1]]
            for row in np.flatnonzero(~has & (np.diff(bounds) > 0)).tolist():
                has[row] = any(map(str.isalpha, data[bounds[row] : bounds[row + 1]].tobytes().decode()))
            part = batch.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), part.column("held_out"),
                    pa.array([langs[b] if h else UNDETERMINED for b, h in zip(best.tolist(), has.tolist(), strict=True)]),
                    pa.array(np.where(has, score, 0.0)),
                    pa.array(has & (1 - score <= SLACK * radius[best])),
                ],
                ["doc_id", "held_out", "lang_pred", "score", "accepted"],
            )


def identify_languages(docs: DataFrame, learn, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang): doc_id, held_out, lang_pred, score, accepted.

    ``learn`` is the condition for rows to learn from; the others are held out. Only their text and lang are used, and
    only texts with lang and letters. Centroids come from about ``sample`` of them per language, chosen by a hash of
    the id; frequencies come from all. score is the cosine to the nearest centroid; accepted says whether that is
    close enough to trust.

    Null, empty or letterless text: ``und``, score 0, not accepted. Null doc_id: not learnt from, not held out. Nothing
    to learn from: ``und`` for all. Ties go to the language first in alphabetical order. Repeated rows are rows; other
    columns are ignored; empty table: empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    ).withColumn("_learn", learn)
    known = rows.where("_learn AND lang IS NOT NULL AND doc_id IS NOT NULL AND text IS NOT NULL")
    frequencies = sketch.summed(known.select("text").mapInArrow(_frequencies, sketch.PART_SCHEMA), SLOTS)
    sizes = known.groupBy("lang").agg(F.count("*").alias("n"))
    shares = sizes.select("lang", F.ceil(F.col("n") / sample).alias("share"), "n")
    total = max(1, shares.agg(F.sum("n")).first()[0] or 0)
    idf = (np.log((1 + total) / (1 + frequencies.astype(np.float64))) + 1).astype(np.float32)
    shared = sketch.shared(docs, idf)
    chosen = join_small(known, shares, "lang").where(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.col("share")) == 0)
    fitted = (
        chosen.select("doc_id", "text", "lang").groupBy("lang")
        .applyInPandas(lambda rows: _fit(rows, shared), "lang string, radius double, centre binary")
        .orderBy("lang", "centre").collect()  # CENTROIDS rows per language
    )
    fitted = [r for r in fitted if np.frombuffer(r.centre, dtype="<f4").any()]
    if fitted:
        centres = np.stack([np.frombuffer(r.centre, dtype="<f4") for r in fitted])
        model = [r.lang for r in fitted], centres, np.array([r.radius for r in fitted]), idf
    else:
        model = [UNDETERMINED], np.zeros((1, SLOTS), dtype=np.float32), np.zeros(1), idf
    held = F.coalesce(~F.col("_learn"), F.lit(False)).alias("held_out")
    return rows.select("doc_id", held, "text").mapInArrow(
        partial(_predict, model=spark.sparkContext.broadcast(model)),
        "doc_id long, held_out boolean, lang_pred string, score double, accepted boolean",
    )


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``; every fourth by the checksum of its id is held out."""
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    return identify_languages(spark.read.parquet(f"{sf_dir}/documents.parquet"), remainder != 2)
