"""The pipeline's stages, each against a plain account of what it must keep."""

from __future__ import annotations

import sys
from pathlib import Path

import corpus_pipeline
from shelfcast.llm import mixing, quality
from shelfcast.session import settle

sys.path.insert(0, str(Path(__file__).parent))
from test_jaccard_join import brute  # noqa: E402
from test_pii import plain  # noqa: E402


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_one_by_one(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "n-gram Jaccard join", "personal data", "mixing", "best-fit packing"]
    stages = [f for _, f in corpus_pipeline.STAGES]

    good = settle(stages[0](spark, docs, sf_dir))
    scored = quality.score_quality(docs, labels, *quality.site())
    assert good.columns == columns and ids(good) == ids(scored.where("score >= 0.5"))
    rated = {r.doc_id: r.quality for r in labels.collect()}
    assert all(d in set(ids(good)) for d, q in rated.items() if q == 1)

    single = settle(stages[1](spark, good, sf_dir))
    want = sorted(d for d, _, c in brute([(r.doc_id, r.text) for r in good.collect()]) if d == c)
    assert single.columns == columns and ids(single) == want

    clean = settle(stages[2](spark, single, sf_dir))
    before = {r.doc_id: r for r in single.collect()}
    assert clean.columns == columns and ids(clean) == want
    for r in clean.collect():
        assert not plain(r.text)
        if not plain(before[r.doc_id].text):
            assert r == before[r.doc_id]

    drawn = settle(stages[3](spark, clean, sf_dir))
    assert drawn.columns == columns and ids(drawn) == ids(mixing.mix(clean).where("sampled"))

    packed = stages[4](spark, drawn, sf_dir)
    assert sorted({r.doc_id for r in packed.collect()}) == ids(drawn)
    whole = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, whole.drop("sequence_id", "offset").collect())) == sorted(map(tuple, packed.drop("sequence_id", "offset").collect()))


def test_near_duplicates_are_told_apart_by_row(spark):
    one, two, three = (" ".join(f"{w}{i}" for i in range(30)) for w in ("river", "stone", "green"))
    rows = [(1, one), (1, two), (2, one), (2, one), (None, two), (None, three), (None, three), (None, None), (3, "")]
    docs = spark.createDataFrame([(d, t, i) for i, (d, t) in enumerate(rows)], "doc_id long, text string, row int")
    out = corpus_pipeline.near_duplicates_stage(spark, docs, "")
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert got == sorted([(1, one), (1, two), (None, three), (None, None), (3, "")], key=str)
