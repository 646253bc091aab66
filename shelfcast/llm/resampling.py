"""Importance resampling of documents towards a target distribution of hashed word n-grams.

Arrow kernels do the text work inside mapInArrow: ``ascii_lower``, ``split_pattern_regex``, ``list_flatten`` and
``dictionary_encode`` turn a slice of whole texts into dictionary indices; shifted indices of the same text form
n-grams; only distinct n-grams are spelled out and hashed; ``take`` and a segmented sum weigh the documents. Two passes
read the texts: one counts the buckets (a fixed-size table per task), one scores. Ranks come from narrow rows that are
range-partitioned by score, so neither the driver nor a single task sees all documents.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators.layout import number_rows
from shelfcast.session import in_parallel, settle

# Everything that separates words once A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
SLICE_BYTES = 4 << 20


def _slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Runs of whole texts of about ``limit`` bytes; a longer text is a run of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    lo = 0
    while lo < len(column):
        done = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield column.slice(lo, hi - lo)
        lo = hi


def _words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(dictionary index of every word, dictionary, number of words of each text); null counts as empty."""
    lists = pc.split_pattern_regex(pc.ascii_lower(texts.fill_null("").cast(pa.large_string())), SEPARATORS)
    coded = pc.dictionary_encode(pc.list_flatten(lists))
    codes = coded.indices.to_numpy(zero_copy_only=False)
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    blank = pc.index(coded.dictionary, pa.scalar("", pa.large_string())).as_py()
    if blank >= 0:  # text that starts or ends with a separator has an empty part there
        solid = codes != blank
        kept = np.concatenate(([0], np.cumsum(solid)))
        bounds = np.concatenate(([0], np.cumsum(lengths)))
        lengths, codes = np.diff(kept[bounds]), codes[solid]
    return codes.astype(np.int64), coded.dictionary, lengths.astype(np.int64)


def _crc(grams: pa.Array, buckets: int) -> np.ndarray:
    return np.array([zlib.crc32(g.encode()) % buckets for g in grams.to_pylist()], dtype=np.int64)


def _features(texts: pa.Array, most: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For n = 1 … ``most``: (buckets of all runs of n words, in text order, how many of them each text has)."""
    codes, words, lengths = _words(texts)
    yield _crc(words, buckets)[codes] if len(codes) else codes, lengths
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))  # words of the text from here on
    grams, spelled = codes, words
    for n in range(2, most + 1):
        whole = left[: max(len(codes) - n + 1, 0)] >= n  # the run ends inside its text
        pairs = grams[: len(whole)] * len(words) + codes[n - 1 :]
        distinct, at = np.unique(pairs[whole], return_inverse=True)
        first, last = (pa.array(part(distinct, max(len(words), 1))) for part in (np.floor_divide, np.remainder))
        spelled = pc.binary_join_element_wise(spelled.take(first), words.take(last), pa.scalar(" ", pa.large_string()))
        grams = np.zeros(len(whole), dtype=np.int64)
        grams[whole] = at
        yield _crc(spelled, buckets)[at] if len(at) else at, np.maximum(lengths - n + 1, 0)


def _count(batches: Iterator[pa.RecordBatch], most: int, buckets: int) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(buckets, dtype=np.int64)
    for batch in batches:
        for texts in _slices(batch.column("text")):
            for found, _ in _features(texts, most, buckets):
                counts += np.bincount(found, minlength=buckets)
    met = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(counts[met])], ["bucket", "n"])


def _weigh(batches: Iterator[pa.RecordBatch], most: int, gains: list[int]) -> Iterator[pa.RecordBatch]:
    table = pa.array(gains, pa.int64())
    for batch in batches:
        words, features, weights = [], [], []
        for texts in _slices(batch.column("text")):
            weight, total = np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
            for n, (found, lengths) in enumerate(_features(texts, most, len(gains)), 1):
                some = np.flatnonzero(lengths)
                if len(some):
                    first = (np.cumsum(lengths) - lengths)[some]
                    weight[some] += np.add.reduceat(table.take(pa.array(found)).to_numpy(), first)
                total += lengths
                if n == 1:
                    words.append(lengths)
            features.append(total)
            weights.append(weight)
        columns = [pa.array(np.concatenate(c)) if c else pa.array([], pa.int64()) for c in (words, features, weights)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_words", "n_features", "weight"])


def bucket_counts(texts: DataFrame, most: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over the ``text`` column of all rows: at most ``buckets`` rows per task are shuffled."""
    counted = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(
        partial(_count, most=most, buckets=buckets), "bucket long, n long"
    )
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """Thousandths of the smoothed log ratio target : source of every bucket, rounded down."""
    all_source, all_target = float(sum(source.values())), float(sum(target.values()))

    def gain(b: int) -> int:
        wanted, had = float(target.get(b, 0)), float(source.get(b, 0))
        return math.floor(1000 * math.log((wanted + 1) * (all_source + buckets) / ((had + 1) * (all_target + buckets))))

    return [gain(b) for b in range(buckets)]


def _noise(seed: int):
    """Gumbel noise in thousandths, rounded down, from the first 32 bits of sha256('seed:doc_id')."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(uniform)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    most: int = 1,
    least_words: int = 20,
    buckets: int = BUCKETS,
    seed: int = 2024,
) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank (all long).

    Features are all runs of 1 … ``most`` words, repeats counted. ``target`` needs a ``text`` column only. Of the
    documents with at least ``least_words`` words, floor(percent % of them) with the highest scores get rank 1, 2, …;
    the others have a null rank. Equal scores go by doc_id, nulls last.

    Null and empty texts have no features, weight 0 and no rank, and still a score. A null doc_id draws its noise as an
    empty string. Repeated rows are rows of their own. An empty ``docs`` gives an empty result; an empty ``target`` is a
    uniform one. Other columns are ignored, whatever their names. Counts over (task, bucket) and two lists of ``buckets``
    numbers are all that leaves the tasks before the scores.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    source, wanted = in_parallel(
        lambda: {r.bucket: r.n for r in bucket_counts(plain, most, buckets).collect()},
        lambda: {r.bucket: r.n for r in bucket_counts(target, most, buckets).collect()},
    )
    weighed = plain.mapInArrow(
        partial(_weigh, most=most, gains=bucket_gains(source, wanted, buckets)),
        "doc_id long, n_words long, n_features long, weight long",
    )
    scores = settle(
        weighed.select(
            "doc_id", "n_words", "n_features", "weight", (F.col("weight") + _noise(seed)).alias("score"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )
    enough = F.col("n_words") >= least_words
    drawn = percent * scores.filter(enough).count() // 100
    out = ["doc_id", "n_features", "weight", "score", "rank"]
    # The row number makes the order total, so that repeated rows with one doc_id are spread over ranges as well.
    order = {"_down": -F.col("score"), "_unnamed": F.col("doc_id").isNull()}
    numbered = number_rows(scores.filter(enough).withColumns(order), [*order, "doc_id", "_row"], "_place")
    rank = F.when(F.col("_place") < drawn, F.col("_place") + 1)
    return (
        numbered.withColumn("rank", rank.cast("long")).select(*out)
        .unionByName(scores.filter(~enough).withColumn("rank", F.lit(None).cast("long")).select(*out))
    )


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of ``documents``, drawn towards the word distribution of ``benchmark``."""
    return resample(
        spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    )


SQL = r"""
WITH RECURSIVE bits(byte, crc, step) AS (
    SELECT i, i, 0 FROM range(256) AS r(i)
    UNION ALL
    SELECT byte, CASE WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END, step + 1 FROM bits WHERE step < 8
),
crc_table AS (SELECT list(crc ORDER BY byte) AS crcs FROM bits WHERE step = 8),
texts AS (
    SELECT 'd' AS side, row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS text FROM documents
    UNION ALL
    SELECT 't', row_number() OVER (), NULL, coalesce(text, '') FROM benchmark
),
split AS (
    SELECT side, row_no, doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM texts
),
words AS MATERIALIZED (SELECT side, row_no, unnest(words) AS word FROM split),
coded AS (SELECT word, hex(encode(word)) AS code FROM (SELECT DISTINCT word FROM words)),
buckets AS MATERIALIZED (
    SELECT word, xor(list_reduce(
        list_prepend(4294967295::BIGINT,
            list_transform(range(length(code) // 2), lambda i: ('0x' || substr(code, 2 * i + 1, 2))::BIGINT)),
        lambda crc, byte: xor(crc >> 8, crcs[1 + (xor(crc, byte) & 255)])), 4294967295) % 10000 AS bucket
    FROM coded, crc_table
),
counts AS (
    SELECT bucket, count(*) FILTER (side = 'd')::DOUBLE AS s, count(*) FILTER (side = 't')::DOUBLE AS t
    FROM words JOIN buckets USING (word) GROUP BY bucket
),
totals AS (SELECT coalesce(sum(s), 0) AS all_s, coalesce(sum(t), 0) AS all_t FROM counts),
gains AS (
    SELECT bucket, floor(1000 * ln((t + 1) * (all_s + 10000) / ((s + 1) * (all_t + 10000))))::BIGINT AS gain
    FROM counts, totals
),
weights AS (
    SELECT row_no, sum(gain) AS weight FROM words JOIN buckets USING (word) JOIN gains USING (bucket)
    WHERE side = 'd' GROUP BY row_no
),
scored AS (
    SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
        (coalesce(weight, 0) + floor(-1000 * ln(-ln(
            (('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
            / 4294967296::DOUBLE))))::BIGINT AS score
    FROM split LEFT JOIN weights USING (row_no) WHERE side = 'd'
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place,
        count(*) OVER (PARTITION BY n_features >= 20) AS n
    FROM scored
)
SELECT doc_id, n_features, weight, score,
    CASE WHEN n_features >= 20 AND place <= (10 * n) // 100 THEN place END AS "rank"
FROM placed
"""
