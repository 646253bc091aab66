"""Alignment of two tokenisations of the same text by the bytes that their tokens cover.

Every text is tokenised whole by both tokenizers. Where tokens that start with a space begin at the same byte in both,
the tokens before them share an end; such anchors cut a document into windows of a word or so. A window is known by its
two tuples of token ids, and its groups and links are kept by them; only new windows are aligned. How many documents hold each
linked id pair is a grouped count; each document's pairs then meet those counts in a join.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.tokens import Encoder
from shelfcast.operators.layout import join_small, sized
from shelfcast.session import settle

#: A task forgets its windows when they hold so many tokens.
MEMO_TOKENS = 1_500_000
MARK = 1 << 31
_PAYLOADS = {"sha256": ("groups_sha256", pa.string()), "groups": ("groups", pa.string())}
_ROW = "doc_id long, n_a long, n_b long, n_groups long, n_links long, {payload} string, pairs array<long>, times array<int>"


class PlainEncoder(Encoder):
    """The byte-level tokenizer with the strings of special tokens as ordinary text."""

    def reference(self, text: str) -> np.ndarray:
        if self._reference is None:
            from tokenizers import Tokenizer

            self._reference = Tokenizer.from_file(self.reference_path)
            self._reference.encode_special_tokens = True
        return super().reference(text)


def byte_level_table(ranks: str, size: int) -> list[bytes]:
    """Bytes of every id of the byte-level vocabulary; an id without an entry has none."""
    table = [b""] * size
    with open(ranks, "rb") as lines:
        for entry, rank in map(bytes.split, lines):
            table[int(rank)] = base64.b64decode(entry)
    return table


def piece_bytes(piece: str) -> bytes:
    """Bytes of a sentence piece: U+2581 is a space, <0xHH> one byte."""
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


class Vocabulary:
    """Bytes, lengths and leading spaces of the ids of one tokenizer."""

    def __init__(self, table: list[bytes]):
        self.table = table
        self.lengths = np.array([len(t) for t in table], dtype=np.int64)
        self.spaced = np.array([t.startswith(b" ") for t in table])
        self.bytes = np.frombuffer(b"".join(table), dtype=np.uint8)
        self.first = np.cumsum(self.lengths) - self.lengths

    def spells(self, ids: np.ndarray, text: bytes) -> bool:
        """Whether the joined bytes of the ids are the text."""
        lengths = self.lengths[ids]
        if int(lengths.sum()) != len(text):
            return False
        at = np.arange(len(text)) + np.repeat(self.first[ids] - np.cumsum(lengths) + lengths, lengths)
        return self.bytes[at].tobytes() == text

    def spans(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first byte of every token, those of them at which a token with a leading space starts)."""
        starts = np.cumsum(self.lengths[ids]) - self.lengths[ids]
        return starts, starts[self.spaced[ids]]


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shared ends, A and B token of every link) of two cuts of the same bytes, given by the ends of their tokens.

    Between two neighbouring ends of either cut lies a piece of exactly one token of each, so each piece is a link.
    """
    pieces = np.union1d(ends_a, ends_b)
    shared = np.intersect1d(ends_a, ends_b, assume_unique=True)
    return shared, np.searchsorted(ends_a, pieces), np.searchsorted(ends_b, pieces)


class Windows(dict):
    """What windows hold, by their two id tuples: (groups as text, number of groups, codes of the links as bytes).

    A key is the window's A ids and then its B ids, the latter marked, as 32-bit numbers in one bytes object. The groups
    end in a semicolon each. The new windows of a document are aligned together, end to end.
    """

    def __init__(self, a: Vocabulary, b: Vocabulary):
        super().__init__()
        self.a, self.b = a, b
        self.width = len(b.table)
        self.names = [f"{i}{mark}" for mark in ",|;" for i in range(max(len(a.table), self.width))]
        self.tokens = 0

    def forget(self) -> None:
        self.clear()
        self.tokens = 0

    def learn(self, keys: list[bytes]) -> None:
        ids = np.frombuffer(b"".join(keys), dtype=np.uint32)
        second = ids >= MARK
        a, b = ids[~second].astype(np.int64), (ids[second] - MARK).astype(np.int64)
        ends_a, ends_b = np.cumsum(self.a.lengths[a]), np.cumsum(self.b.lengths[b])
        shared, link_a, link_b = align(ends_a, ends_b)
        links = (a[link_a] * self.width + b[link_b]).tobytes()
        group_a, group_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
        # Every group's A ids and then its B ids, each id with the mark that follows it.
        told = np.empty(len(ids), dtype=np.int64)
        marks = len(self.names) // 3
        told[np.arange(len(a)) + np.searchsorted(group_b, group_a, "left")] = a + marks * (ends_a == shared[group_a])
        told[np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")] = b + 2 * marks * (ends_b == shared[group_b])
        names = [self.names[i] for i in told.tolist()]
        tokens = np.cumsum([len(key) // 4 for key in keys])
        ends = ends_a[np.cumsum(~second)[tokens - 1] - 1]
        groups = np.searchsorted(shared, ends, "right").tolist()
        pieces = np.searchsorted(np.minimum(ends_a[link_a], ends_b[link_b]), ends, "right").tolist()
        token = group = link = 0
        for key, next_token, next_group, next_link in zip(keys, tokens.tolist(), groups, pieces, strict=True):
            self[key] = "".join(names[token:next_token]), next_group - group, links[8 * link : 8 * next_link]
            token, group, link = next_token, next_group, next_link
        self.tokens += token

    def of(self, a: np.ndarray, b: np.ndarray) -> list[tuple[str, int, bytes]]:
        """The windows of two tokenisations of the same bytes, in text order."""
        (starts_a, marks_a), (starts_b, marks_b) = self.a.spans(a), self.b.spans(b)
        anchors = np.intersect1d(marks_a, marks_b, assume_unique=True)
        anchors = anchors[anchors > 0]
        cuts_a, cuts_b = np.searchsorted(starts_a, anchors), np.searchsorted(starts_b, anchors)
        # A token stands after the B tokens of all earlier windows, a B token after the A tokens of its own as well.
        ids = np.empty(len(a) + len(b), dtype=np.uint32)
        before = np.concatenate(([0], cuts_b))[np.searchsorted(cuts_a, np.arange(len(a)), "right")]
        ids[np.arange(len(a)) + before] = a
        upto = np.concatenate((cuts_a, [len(a)]))[np.searchsorted(cuts_b, np.arange(len(b)), "right")]
        ids[np.arange(len(b)) + upto] = b + MARK
        raw = ids.tobytes()
        cuts = [0, *((cuts_a + cuts_b) * 4).tolist(), len(raw)]
        keys = [raw[i:j] for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
        found = [self.get(key) for key in keys]
        if None in found:
            self.learn([key for key in dict.fromkeys(keys) if key not in self])
            found = [self[key] for key in keys]
        return found


def _rows(
    batches: Iterator[pa.RecordBatch], ranks: str, reference: str, pieces: str, payload: str
) -> Iterator[pa.RecordBatch]:
    import hashlib

    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    encoder = PlainEncoder(ranks, reference)
    splitter = SentencePieceProcessor(model_file=pieces)
    a_words = Vocabulary(byte_level_table(ranks, Tokenizer.from_file(reference).get_vocab_size()))
    b_words = Vocabulary([piece_bytes(splitter.id_to_piece(i)) for i in range(splitter.get_piece_size())])
    windows = Windows(a_words, b_words)
    nothing = np.zeros(0, dtype=np.int64)
    for batch in batches:
        texts = batch.column("text")
        numbers, told, pairs, times = [], [], [], []
        for text, a in zip(texts, encoder.encode(pc.binary_join_element_wise(" ", texts.fill_null(""), "")), strict=True):
            text = text.as_py()
            b = np.array(splitter.encode(text, num_threads=1) if text else [], dtype=np.int64)
            a = a.astype(np.int64)
            raw = b" " + (text or "").encode()
            if not (text and a_words.spells(a, raw) and b_words.spells(b, raw)):
                numbers.append((0, 0, 0, 0))
                told.append("")
                pairs.append(nothing)
                times.append(nothing)
                continue
            met = windows.of(a, b)
            spelled = "".join([w[0] for w in met])[:-1]
            told.append(hashlib.sha256(spelled.encode()).hexdigest() if payload == "sha256" else spelled)
            distinct, often = np.unique(np.frombuffer(b"".join([w[2] for w in met]), dtype=np.int64), return_counts=True)
            pairs.append(distinct)
            times.append(often)
            numbers.append((len(a), len(b), sum([w[1] for w in met]), int(often.sum())))
            if windows.tokens > MEMO_TOKENS:
                windows.forget()
        columns = np.array(numbers, dtype=np.int64).reshape(-1, 4).T
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                *(pa.array(c) for c in columns),
                pa.array(told, pa.string()),
                pa.array(pairs, pa.list_(pa.int64())),
                pa.array(times, pa.list_(pa.int32())),
            ],
            ["doc_id", "n_a", "n_b", "n_groups", "n_links", _PAYLOADS[payload][0], "pairs", "times"],
        )


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """(pair, n documents with it, whether n is the highest of its A id) over all aligned documents."""
    counts = settle(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")))
    one = F.floor(F.col("pair") / size_b)
    highest = counts.groupBy(one.alias("_a")).agg(F.max("n").alias("_highest"))
    joined = join_small(counts.withColumn("_a", one), settle(highest), "_a")
    return joined.select("pair", "n", (F.col("n") == F.col("_highest")).alias("best"))


def align_tokenizers(
    docs: DataFrame, ranks: str, reference: str, pieces: str, payload: str = "groups", max_bytes: int | None = None
) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, and the groups.

    ``ranks`` and ``reference`` are the byte-level vocabulary A as ranks and as a tokenizer file, ``pieces`` the sentence
    piece model B. ``payload`` is "groups" (a1,a2|b1;a3|b2,b3 with decimal ids in text order) or "sha256" (of that, in
    hex). A text is encoded with one space before it; byte offsets where tokens of both end cut it into groups; all
    pairs of tokens whose bytes overlap are links. A pair's count is the number of documents that hold it linked.

    Null and empty texts, and texts that either tokenizer does not spell byte by byte, have zeros and an empty string.
    Null and repeated doc_ids are kept, a row each, and each row is a document in the counts. Other columns are ignored.
    An empty table gives an empty result. The table of counts is broadcast only if it measures under ``max_bytes``;
    beyond that it meets the documents' pairs in a shuffle join.
    """
    from sentencepiece import SentencePieceProcessor

    size_b = SentencePieceProcessor(model_file=pieces).get_piece_size()
    name = _PAYLOADS[payload][0]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = rows.mapInArrow(
        partial(_rows, ranks=ranks, reference=reference, pieces=pieces, payload=payload), _ROW.format(payload=name)
    )
    aligned = settle(made.withColumn("row", F.monotonically_increasing_id()))
    counts = settle(pair_counts(aligned, size_b))
    small = sized(counts) if max_bytes is None else sized(counts, max_bytes)
    linked = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("_")).select("row", "_.pairs", "_.times")
    summed = (
        linked.withColumnRenamed("pairs", "pair")
        .join(small, "pair")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("n") * F.col("times")).alias("count_sum"),
        )
    )
    numbers = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    return (
        aligned.select("row", *numbers, name)
        .join(summed, "row", "left")
        .select(*numbers, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")], name)
    )


def vocabularies() -> tuple[str, str, str]:
    """The public vocabulary files on this box."""
    from public_tokenizers import path

    return path("byte_bpe_50k.tiktoken"), path("byte_bpe_50k.json"), path("piece_bpe_32k.model")


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` under a byte-level and a sentence-piece vocabulary."""
    return align_tokenizers(spark.read.parquet(f"{sf_dir}/documents.parquet"), *vocabularies(), payload="sha256")
