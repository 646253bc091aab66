"""Licence scan: winnowed fingerprints of templates pick candidates, banded alignment confirms them.

A template is a sequence of words. Its runs of GRAM words are hashed, and of every WINDOW neighbouring hashes the least
is kept: the fingerprints, in one inverted index of all templates (a bounded table that every task holds). Every run of
a document is looked up, so a shared passage of GRAM + WINDOW - 1 words cannot be missed. Hits on near diagonals form a
candidate; a local alignment within a band around them gives the words matched and the span.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.textcore import shingle_hashes, span_hashes, utf8_slices, word_spans

GRAM, WINDOW, BAND, COVERAGE = 3, 4, 12, 0.7
MATCH, MISMATCH, GAP = 2, -1, -1

#: Names and wordings of well-known licence notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License."
    ),
    "BSD-2-Clause conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution."
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    ),
    "ISC grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MIT": "Released under the MIT License.",
    "MIT grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software."
    ),
    "MPL-2.0 notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
}

_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
_WORD[0x80:] = True


def _words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    starts, ends, cuts = word_spans(data, bounds, _WORD)
    return span_hashes(data, starts, ends), starts, ends, cuts


def winnowed(hashes: np.ndarray, window: int = WINDOW) -> list[int]:
    """Positions of the least hash of every window, the last one on ties; of all hashes if there are fewer."""
    picked = set()
    for at in range(max(1, len(hashes) - window + 1)):
        part = hashes[at : at + window]
        if len(part):
            picked.add(at + len(part) - 1 - int(part[::-1].argmin()))
    return sorted(picked)


class Index:
    """Fingerprints of all templates, sorted, with the template and place of each."""

    def __init__(self, templates: Mapping[str, str]):
        self.names = sorted(templates)
        self.words: list[np.ndarray] = []
        rows = []
        for number, name in enumerate(self.names):
            data = np.frombuffer(templates[name].encode(), dtype=np.uint8)
            words, _, _, cuts = _words(data, np.array([0, len(data)]))
            grams, _ = shingle_hashes(words, cuts, GRAM)
            self.words.append(words)
            rows += [(int(grams[p]), number, p) for p in winnowed(grams)]
        rows.sort()
        self.keys = np.array([r[0] for r in rows], dtype=np.uint64)
        self.template = np.array([r[1] for r in rows], dtype=np.int64)
        self.place = np.array([r[2] for r in rows], dtype=np.int64)

    def hits(self, grams: np.ndarray) -> list[tuple[int, int, int]]:
        """(place in ``grams``, template, place in the template) of every fingerprint met."""
        lo = np.searchsorted(self.keys, grams)
        found = np.flatnonzero((lo < len(self.keys)) & (self.keys[np.minimum(lo, len(self.keys) - 1)] == grams))
        out = []
        for at in found.tolist():
            k = int(lo[at])
            while k < len(self.keys) and self.keys[k] == grams[at]:
                out.append((at, int(self.template[k]), int(self.place[k])))
                k += 1
        return out


def aligned(words: np.ndarray, template: np.ndarray, shift: int, band: int = BAND) -> tuple[int, int, int, int, int] | None:
    """Best local alignment with |word - template word - shift| <= band: (matched, start, end, template start, end).

    Equal words score MATCH, other pairs MISMATCH, words left out GAP. The earliest of equally good ones.
    """
    best = (0, 0, 0, 0, 0, 0)
    rows: dict[int, tuple[int, int, int, int]] = {}  # word place: score, matched, start, template start
    for j, word in enumerate(template.tolist()):
        lo, hi = max(0, j + shift - band), min(len(words), j + shift + band + 1)
        new: dict[int, tuple[int, int, int, int]] = {}
        for i in range(lo, hi):
            same = int(words[i]) == word
            score, matched, start, first = rows.get(i - 1, (0, 0, i, j))
            if score <= 0:
                score, matched, start, first = 0, 0, i, j
            options = [(score + (MATCH if same else MISMATCH), matched + same, start, first)]
            if i in rows:
                options.append((rows[i][0] + GAP, *rows[i][1:]))
            if i - 1 in new:
                options.append((new[i - 1][0] + GAP, *new[i - 1][1:]))
            cell = max(options, key=lambda o: (o[0], -o[2]))
            if cell[0] > 0:
                new[i] = cell
                if cell[0] > best[0]:
                    best = (cell[0], cell[1], cell[2], i + 1, cell[3], j + 1)
        rows = new
    return best[1:] if best[0] else None


def matches(words: np.ndarray, grams: np.ndarray, index: Index, coverage: float) -> list[tuple[int, int, int, int, int, int]]:
    """(template, matched, start, end, template start, end) of a text, words counted from 0, ends exclusive."""
    places: dict[int, list[tuple[int, int]]] = {}
    for at, template, place in index.hits(grams):
        places.setdefault(template, []).append((at - place, at))
    out = []
    for template, hits in sorted(places.items()):
        size, left, tried = len(index.words[template]), words.copy(), set()
        for shift, at in sorted(hits):
            if shift in tried or not left[at]:
                continue
            tried.add(shift)
            lo, hi = max(0, shift - BAND), min(len(words), shift + size + 2 * BAND)
            found = aligned(left[lo:hi], index.words[template], shift - lo)
            if found and found[0] >= coverage * size:
                matched, start, end, first, last = found
                left[lo + start : lo + end] = 0  # the next one lies elsewhere
                tried.discard(shift)
                out.append((template, matched, lo + start, lo + end, first, last))
    return [one for one in out if not any(_outdone(one, other, index) for other in out)]


def _outdone(one: tuple, other: tuple, index: Index) -> bool:
    """Whether an incomplete match overlaps one with more words, or as many of a shorter template."""
    size, size_other = len(index.words[one[0]]), len(index.words[other[0]])
    if one[1] == size or one[2] >= other[3] or other[2] >= one[3]:
        return False
    return (other[1], -size_other) > (one[1], -size)


def _scan(batches: Iterator[pa.RecordBatch], templates: dict[str, str], coverage: float) -> Iterator[pa.RecordBatch]:
    index = Index(templates)
    names = ["doc_id", "licence", "start", "end", "matched_words", "template_words", "coverage", "template_start", "template_end"]
    for batch in batches:
        ids = batch.column("doc_id")
        out: list[tuple] = []
        for lo, _, data, bounds in utf8_slices(batch.column("text")):
            words, starts, ends, cuts = _words(data, bounds)
            grams, gram_cuts = shingle_hashes(words, cuts, GRAM)
            at = np.searchsorted(index.keys, grams)
            met = np.flatnonzero(index.keys[np.minimum(at, len(index.keys) - 1)] == grams)
            for row in np.unique(np.searchsorted(gram_cuts, met, "right") - 1).tolist():
                first = cuts[row]
                found = matches(words[first : cuts[row + 1]], grams[gram_cuts[row] : gram_cuts[row + 1]], index, coverage)
                code = np.concatenate(([0], np.cumsum((data[bounds[row] : bounds[row + 1]] & 0xC0) != 0x80)))
                for template, matched, s, e, t0, t1 in found:
                    size = len(index.words[template])
                    place = int(code[starts[first + s] - bounds[row]]), int(code[ends[first + e - 1] - bounds[row]])
                    out.append((ids[lo + row].as_py(), index.names[template], *place, matched, size, matched / size, t0, t1))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[k] for r in out], t)
                for k, t in enumerate([pa.int64(), pa.string(), *[pa.int64()] * 4, pa.float64(), pa.int64(), pa.int64()])
            ],
            names,
        )


def scan_licences(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """One row per template found in a row of ``docs`` (doc_id, text).

    Columns: doc_id, licence, start and end (code points, end exclusive), matched_words, template_words, coverage (their
    ratio, at least ``coverage``), template_start and template_end (words). Words are runs of letters and digits, A-Z in
    lower case. A template found several times gives a row each. Templates that share wording may overlap, but an
    incomplete match gives way to one of more words.

    Null, empty or wordless text: no rows. Null and repeated doc_ids: rows as they come. Other columns are ignored.
    Empty table: empty result. A template without words is an error.
    """
    if not templates or not all(len(w) for w in Index(templates).words):
        raise ValueError("every template needs words")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        partial(_scan, templates=dict(templates), coverage=coverage),
        "doc_id long, licence string, start long, end long, matched_words long, template_words long, coverage double, "
        "template_start long, template_end long",
    )


def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` against TEMPLATES."""
    return scan_licences(spark.read.parquet(f"{sf_dir}/documents.parquet"))
