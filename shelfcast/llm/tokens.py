"""Token ids of whole texts under a public byte-level BPE vocabulary, many texts at a time.

The vocabulary's split pattern is applied to code points with numpy; every distinct word of a slice is then encoded
once. Texts with code points beyond LATIN or with the vocabulary's special string go to the reference tokenizer.
"""

from __future__ import annotations

import base64
import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from shelfcast.llm.textcore import span_hashes, utf8_slices

LATIN = 0x280
SPECIAL = b"<|endoftext|>"
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)
#: The endings that the vocabulary's split pattern takes off after an apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def _kind(code: int) -> int:
    if code in (*range(0x09, 0x0E), 0x20, 0x85, 0xA0):
        return _SPACE
    return {"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(chr(code))[0], _OTHER)


_BLANK = np.zeros(256, dtype=bool)
_BLANK[[*range(0x09, 0x0E), 0x20]] = True
_KINDS = np.array([_kind(c) for c in range(LATIN)], dtype=np.int8)


def token_starts(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Positions at which the split pattern starts a word, for rows of code points below LATIN."""
    n = len(codes)
    if not n:
        return np.zeros(0, dtype=np.int64)
    kinds = _KINDS[codes]
    first = np.zeros(n + 1, dtype=bool)
    first[bounds[:-1]] = True
    first = first[:n]
    new = first.copy()
    new[1:] |= kinds[1:] != kinds[:-1]
    runs = np.flatnonzero(new)
    ends = np.append(runs[1:], n)
    kind = kinds[runs]
    tail = np.append(first[runs[1:]], True)  # the row ends with this run
    starts = np.zeros(n + 1, dtype=bool)
    space = kind == _SPACE
    starts[runs[space]] = True
    inner = space & ~tail
    starts[ends[inner] - 1] = True  # the last space of a run stands alone or joins the next word
    joined = np.zeros(len(runs), dtype=bool)
    joined[1:] = inner[:-1] & (codes[ends[:-1] - 1] == 0x20)
    starts[runs[~space & ~joined]] = True
    # An apostrophe of its own takes an ending from the letters that follow.
    mark = np.flatnonzero(
        (kind[:-1] == _OTHER) & (ends[:-1] - runs[:-1] == 1) & (codes[runs[:-1]] == 0x27) & ~joined[:-1]
        & ~tail[:-1] & (kind[1:] == _LETTER)
    )
    for i in mark.tolist():
        at, end = int(runs[i + 1]), int(ends[i + 1])
        word = "".join(map(chr, codes[at : min(end, at + 2)].tolist()))
        ending = next((e for e in ENDINGS if word.startswith(e)), None)
        if ending:
            starts[at] = False
            if at + len(ending) < end:
                starts[at + len(ending)] = True
    return np.flatnonzero(starts[:n])


class Encoder:
    """Encodes slices of texts; keeps the words met so far, up to ``most``."""

    def __init__(self, ranks: str, reference: str, most: int = 1_000_000):
        import tiktoken
        from public_tokenizers import PATTERN

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.words = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self.line = table[b"\n"]
        self.reference_path, self._reference = reference, None
        self.most = most
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)
        self.at = np.zeros(0, dtype=np.int64)
        self.sizes = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def reference(self, text: str) -> np.ndarray:
        if self._reference is None:
            from tokenizers import Tokenizer

            self._reference = Tokenizer.from_file(self.reference_path)
        return np.array(self._reference.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def _learn(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Encode new words: those of white space one by one, the others in one call, each after a line end."""
        raw = data.tobytes()
        last = data[ends - 1]
        blank = _BLANK[last] | (np.isin(last, (0x85, 0xA0)) & (data[np.maximum(ends - 2, 0)] == 0xC2))
        order = np.argsort(blank, kind="stable")
        plain = order[: len(order) - int(blank.sum())]
        words = [raw[s:e] for s, e in zip(starts[plain].tolist(), ends[plain].tolist(), strict=True)]
        ids = np.array(self.words.encode_ordinary(b"".join(b"\n" + w for w in words).decode()), dtype=np.uint32)
        lines = np.flatnonzero(ids == self.line)
        blanks = [
            np.array(self.words.encode_ordinary(raw[starts[i] : ends[i]].decode()), np.uint32)
            for i in order[len(plain) :].tolist()
        ]
        blank_sizes = np.array([len(b) for b in blanks], dtype=np.int64)
        sizes = np.concatenate((np.append(lines[1:], len(ids))[: len(lines)] - lines - 1, blank_sizes))
        at = len(self.ids) + np.concatenate((lines + 1, len(ids) + np.cumsum(blank_sizes) - blank_sizes))
        self.ids = np.concatenate((self.ids, ids, *blanks))
        merged = np.concatenate((self.keys, keys[order]))
        by = np.argsort(merged, kind="stable")
        self.keys = merged[by]
        self.at, self.sizes = np.concatenate((self.at, at))[by], np.concatenate((self.sizes, sizes))[by]

    def _latin(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds of the rows in them) for rows of code points below LATIN."""
        lead = (data & 0xC0) != 0x80
        at = np.flatnonzero(lead)
        codes = data[at].astype(np.int32)
        wide = codes >= 0x80
        codes[wide] = ((codes[wide] & 0x1F) << 6) | (data[at[wide] + 1] & 0x3F)
        starts = token_starts(codes, np.searchsorted(at, bounds))
        starts = at[starts]
        ends = np.append(starts[1:], len(data))
        keys, first, which = np.unique(span_hashes(data, starts, ends, fold=False), return_index=True, return_inverse=True)
        if len(self.keys) > self.most:
            self._forget()
        place = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), dtype=bool)
        known[place < len(self.keys)] = self.keys[place[place < len(self.keys)]] == keys[place < len(self.keys)]
        if not known.all():
            new = first[~known]
            self._learn(keys[~known], data, starts[new], ends[new])
            place = np.searchsorted(self.keys, keys)
        at, sizes = self.at[place][which], self.sizes[place][which]
        total = np.concatenate(([0], np.cumsum(sizes)))
        ids = self.ids[np.repeat(at - total[:-1], sizes) + np.arange(total[-1])]
        return ids, total[np.searchsorted(starts, bounds)]

    def encode(self, column: pa.Array) -> Iterator[np.ndarray]:
        """Ids of every row of a string column; null counts as empty."""
        for _, _, data, bounds in utf8_slices(column):
            high = np.concatenate(([0], np.cumsum(data >= 0xCA)))
            raw = data.tobytes()
            plain = high[bounds[1:]] == high[bounds[:-1]]
            if SPECIAL in raw:
                for row in np.flatnonzero(plain):
                    plain[row] = SPECIAL not in raw[bounds[row] : bounds[row + 1]]
            if plain.all():
                ids, cuts = self._latin(data, bounds)
                yield from (ids[lo:hi] for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
                continue
            for row, (lo, hi) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                if plain[row]:
                    yield self._latin(data[lo:hi], np.array([0, hi - lo]))[0]
                else:
                    yield self.reference(raw[lo:hi].decode())
