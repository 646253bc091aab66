"""Token alignment against a byte-by-byte version over both public vocabularies."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from shelfcast.llm.alignment import align, align_tokenizers, op13_tokenizer_alignment, vocabularies

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@cache
def tools():
    _, reference, pieces = vocabularies()
    a = Tokenizer.from_file(reference)
    a.encode_special_tokens = True
    # The byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    return a, letters, SentencePieceProcessor(model_file=pieces)


def spans(tokens):
    out, at = [], 0
    for number, raw in tokens:
        out.append((number, at, at + len(raw)))
        at += len(raw)
    return out


def plain_groups(text):
    """(a ids, b ids, groups, links) of one text from every pair of spans, or None."""
    if not text:
        return None
    tokenizer, letters, splitter = tools()
    raw = (" " + text).encode()
    a = [(i, bytes(letters[c] for c in tokenizer.id_to_token(i))) for i in tokenizer.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in splitter.encode(text):
        piece = splitter.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if splitter.is_byte(i) else piece.replace("▁", " ").encode()))
    if b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
        return None
    a, b = spans(a), spans(b)
    ends = sorted({e for *_, e in a} & {e for *_, e in b})
    group_of = {e: g for g, e in enumerate(ends)}
    groups = [([], []) for _ in ends]
    for side, tokens in enumerate((a, b)):
        for number, _, end in tokens:
            groups[group_of[min(e for e in ends if e >= end)]][side].append(number)
    links = [(x, y) for x, s, e in a for y, t, f in b if s < f and t < e]
    return a, b, groups, links


def plain_table(docs):
    aligned = [(i, plain_groups(t)) for i, t in docs]
    counts = Counter(pair for _, g in aligned if g for pair in set(g[3]))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    rows = []
    for doc_id, g in aligned:
        if g is None:
            rows.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = g
        told = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append(
            (doc_id, len(a), len(b), len(groups), len(links), sum(counts[p] == best[p[0]] for p in links),
             sum(counts[p] for p in links), hashlib.sha256(told.encode()).hexdigest())
        )
    return rows


def key(rows):
    return sorted(map(tuple, rows), key=str)


HOSTILE = [
    None, "", " ", "  ", "\n", "a", " a", "word word word", "<|endoftext|> and <s> </s> <unk> <0x41> [x]", "a▁b c",
    "▁", "tab\tand\r\nline  two   spaces ", "Ünïcödé façade straße", "漢字かな混じり文 한국어 عربى", "é   ​ ﻿ x",
    "😀👩‍👩‍👧‍👦 emoji 🇩🇪", "x" * 3000, "nospaces" * 500, "don't we'll I'M", "\x00\x01 nul \x7f", "ﬁ ligature ２", "1234567890 3.14 -7e-5",
    "A sentence with hyphen-ation, punctuation; and (brackets). " * 30,
]


def test_hostile_texts_against_a_plain_version(spark):
    docs = [(i, t) for i, t in enumerate(HOSTILE)] + [(5, "a"), (None, "word word"), (None, None), (11, HOSTILE[11])]
    table = spark.createDataFrame(docs, "doc_id int, text string").repartition(3)
    table = table.withColumns({"row": F.lit("x"), "pairs": F.lit(1), "n": F.lit(2), "best": F.lit(3)})
    want = key(plain_table(docs))
    for max_bytes in (None, 0):
        got = align_tokenizers(table, *vocabularies(), payload="sha256", max_bytes=max_bytes)
        assert got.columns == COLUMNS
        assert key(got.collect()) == want


def test_groups_payload_and_empty_table(spark):
    docs = [(1, "A façade, isn't it?"), (2, None)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r for r in align_tokenizers(table, *vocabularies()).collect()}
    groups = plain_groups(docs[0][1])[2]
    assert got[1].groups == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
    assert got[1].n_links == got[1].n_a + got[1].n_b - got[1].n_groups and got[2].groups == ""
    assert align_tokenizers(table.limit(0), *vocabularies()).collect() == []


def test_whole_table_against_a_plain_version(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    short = [d for d in docs if len(d[1] or "") < 2500]
    table = spark.createDataFrame(short, "doc_id long, text string")
    got = align_tokenizers(table, *vocabularies(), payload="sha256")
    assert key(got.collect()) == key(plain_table(short)) and len(short) > 100
    whole = op13_tokenizer_alignment(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in whole) == sorted(d[0] for d in docs)
    assert all(r.n_links == r.n_a + r.n_b - r.n_groups and 0 <= r.n_best <= r.n_links for r in whole)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(1, 19)), st.sets(st.integers(1, 19)))
def test_align_of_cuts(a, b):
    spans_a, spans_b = ([(s, e) for s, e in zip([0, *sorted(x)], [*sorted(x), 20])] for x in (a, b))
    shared, link_a, link_b = align(*(np.array([e for _, e in x]) for x in (spans_a, spans_b)))
    assert list(zip(link_a.tolist(), link_b.tolist())) == [
        (i, j) for i, (s, e) in enumerate(spans_a) for j, (t, f) in enumerate(spans_b) if s < f and t < e
    ]
    assert shared.tolist() == [*sorted(a & b), 20]
