"""Importance resampling against a word-by-word version, and its SQL on the given tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from compare import digest, oracle_frame
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfcast.llm.resampling import SQL, _features, op11_importance_resampling, resample

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_features(text, most):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return words, [" ".join(words[i : i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)]


def plain_resample(docs, target, percent=10, most=1, least=20, buckets=10_000):
    def bucket(feature):
        return zlib.crc32(feature.encode()) % buckets

    source = Counter(bucket(f) for _, t in docs for f in plain_features(t, most)[1])
    wanted = Counter(bucket(f) for t in target for f in plain_features(t, most)[1])
    s_all, t_all = sum(source.values()), sum(wanted.values())
    rows = []
    for doc_id, text in docs:
        words, features = plain_features(text, most)
        weight = sum(
            math.floor(1000 * math.log((wanted[b] + 1) * (s_all + buckets) / ((source[b] + 1) * (t_all + buckets))))
            for b in map(bucket, features)
        )
        key = "" if doc_id is None else doc_id
        h = int(hashlib.sha256(f"2024:{key}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(words)])
    able = [r for r in rows if r[4] >= least]
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = {id(r): i for i, r in enumerate(able[: percent * len(able) // 100], 1)}
    return [(*r[:4], drawn.get(id(r))) for r in rows]


def in_order(rows):
    return sorted((tuple(-1 if x is None else x for x in r) for r in rows))


TEXTS = [
    None, "", " ", "...", "One two THREE", "É é ÀB cD\x00e\x7ff{g", "İ ǅ ß", "a " * 30, "b\n" * 25 + "a", "x1 2y " * 12,
    "漢字 かな " * 15, "w" * 70_000, "word " * 40_000, "-a-", "a", "the same text of more than twenty words " * 4,
]


@pytest.mark.parametrize(("most", "percent"), [(1, 30), (3, 70)])
def test_against_a_plain_version(spark, most, percent):
    docs = [(i, t) for i, t in enumerate(TEXTS)] + [(7, TEXTS[7]), (7, TEXTS[7]), (None, TEXTS[8]), (None, None)]
    target = ["the same text", None, "", "漢字 a a b"]
    table = spark.createDataFrame(docs, "doc_id int, text string").repartition(3)
    table = table.withColumns({"weight": F.lit("x"), "rank": F.lit(0), "bucket": F.lit(1)})
    got = resample(table, spark.createDataFrame([(t,) for t in target], "text string"), percent, most)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert all(t == "bigint" for _, t in got.dtypes)
    assert in_order(got.collect()) == in_order(plain_resample(docs, target, percent, most))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a " * 20)], "doc_id long, text string")
    assert resample(none, some).collect() == []
    got = resample(some, none, percent=100).collect()
    assert in_order(got) == in_order(plain_resample([(1, "a " * 20)], [], 100))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB1é -\n漢", max_size=30)), min_size=1, max_size=8), st.integers(1, 4))
def test_runs_of_words(texts, most):
    got = [[] for _ in texts]
    for found, lengths in _features(pa.array(texts, pa.string()), most, 997):
        at = 0
        for row, n in enumerate(lengths.tolist()):
            got[row] += found[at : at + n].tolist()
            at += n
        assert at == len(found)
    assert got == [[zlib.crc32(f.encode()) % 997 for f in plain_features(t, most)[1]] for t in texts]


def test_the_tables_against_sql(spark, sf_dir):
    got = op11_importance_resampling(spark, sf_dir).toPandas()
    assert digest(got) == digest(oracle_frame(sf_dir, SQL))
    ranks = sorted(got["rank"].dropna().astype(int))
    assert ranks == list(range(1, len(ranks) + 1)) and ranks
