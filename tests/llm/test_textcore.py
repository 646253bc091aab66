"""Hashing of words and shingles, and token ids, against plain Python."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from shelfcast.llm import textcore
from shelfcast.llm.tokens import LATIN, Encoder

FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_set(text: str | None, k: int = 5) -> set:
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def hashed_sets(texts, limit=textcore.SLICE_BYTES):
    out = []
    for _, _, data, bounds in textcore.utf8_slices(pa.array(texts, pa.string()), limit):
        out += list(textcore.shingle_sets(data, bounds))
    return out


@pytest.mark.parametrize("limit", [1, 7, 1 << 20])
def test_sets_equal_plain_sets(limit):
    rng = random.Random(5)
    words = ["a", "B", "b", "ab", "é", " x", "日本", "c", "d"]
    texts = ["", None, " \t\n", "a", "a b c d", "a b c d e", "A B C D E"]
    texts += ["".join(rng.choice(words) + rng.choice([" ", "\n", "  ", "\t"]) for _ in range(rng.randint(0, 40))) for _ in range(80)]
    sets, plain = hashed_sets(texts, limit), [plain_set(t) for t in texts]
    assert [len(s) for s in sets] == [len(p) for p in plain]
    for i in range(0, len(texts), 3):
        for j in range(len(texts)):
            assert len(np.intersect1d(sets[i], sets[j])) == len(plain[i] & plain[j])


def test_short_text_is_no_part_of_a_longer_one():
    short, long = hashed_sets(["a b c d", "a b c d e"])
    assert not set(short) & set(long)


@pytest.fixture(scope="module")
def encoder():
    return Encoder(path("byte_bpe_50k.tiktoken"), path("byte_bpe_50k.json"))


def test_token_ids_equal_the_tokenizer(encoder):
    rng = random.Random(1)
    marks = [*" \t\n\r'aAsStTdDmMrRevVlL..,!?0129|\x00\x1c\x85\xa0éÉßºª²¼×ǅɐʰ", "'s", "'re", "'ll", " 've", "  ", "\n\n", "<|endoftext|>", "日本", "😀"]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    texts += [f"{chr(c)}x{chr(c)} {chr(c)}1{chr(c)}" for c in range(LATIN + 64)] + [None, ""]
    reference = Tokenizer.from_file(path("byte_bpe_50k.json"))
    want = [e.ids for e in reference.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [ids.tolist() for ids in encoder.encode(pa.array(texts))] == want


def test_forgetting_words_changes_nothing(encoder):
    small = Encoder(path("byte_bpe_50k.tiktoken"), path("byte_bpe_50k.json"), most=3)
    texts = pa.array(["one two three four", "five six", "one two", "Seven's eight"] * 3)
    assert [a.tolist() for a in small.encode(texts)] == [a.tolist() for a in encoder.encode(texts)]
