"""Licenses in texts: an inverted index of template fingerprints finds candidates, banded alignment confirms them.

Long templates are winnowed: of the hashes of ``GRAM`` consecutive words in every window of ``WINDOW`` the smallest is
a fingerprint. The index maps fingerprints to places in templates. A text's grams are all looked up, so a run of
``GRAM + WINDOW - 1`` words of a template is always hit. Templates of up to ``SHORT`` words have single words as
fingerprints, one more than an alignment may leave unmatched, so one of them is in every alignment that is accepted.
Hits of a text that agree on where a template would begin are one candidate; the template is aligned with
the words around it in a band. The index is small and bounded and goes to the tasks with the plan, so one pass over
the documents does it all, without a shuffle.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kinweave.llm.common import by_batch

GRAM, WINDOW = 3, 4
#: Share of a template's words that an alignment must match, and words by which it may be shifted.
COVERAGE, BAND = 0.8, 12
#: Words of the longest templates that are found by single words.
SHORT = 50
#: Words in all templates together; more are an error, as the index goes to every task.
MAX_WORDS = 200_000
MATCH, MISMATCH, GAP = 2, -1, -1

#: Texts that name or grant a license.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "mit-short": "Released under the MIT License.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "apache-2.0-short": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "gpl-3.0-short": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "cc-by-nc-4.0-short": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
}

_TOKEN = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    return [w.lower() for w in _TOKEN.findall(text)]


class _Vocabulary(dict):
    """Numbers of the words in templates, by any spelling; 0 for other words."""

    LIMIT = 1 << 18

    def __init__(self, numbers: dict[str, int]):
        super().__init__()
        self.numbers = numbers

    def __missing__(self, word: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = self.numbers.get(word.lower(), 0)
        return value


def grams(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, places)`` of the word grams of a text, given as word numbers, that have only words of templates."""
    n = len(ids) - GRAM + 1
    if n < 1:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    known = np.lib.stride_tricks.sliding_window_view(ids > 0, GRAM).all(axis=1)
    at = np.flatnonzero(known)
    hashes = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(GRAM):
            hashes = (hashes ^ ids[at + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            hashes ^= hashes >> np.uint64(32)
    return hashes, at


def fingerprints(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, places)`` of a template's winnowed word grams; of equal smallest ones in a window the last."""
    hashes, at = grams(ids)
    if len(hashes) <= WINDOW:
        chosen = np.array([int(hashes.argmin())])
    else:
        windows = np.lib.stride_tricks.sliding_window_view(hashes, WINDOW)
        chosen = np.unique(np.arange(len(windows)) + WINDOW - 1 - windows[:, ::-1].argmin(axis=1))
    return hashes[chosen], at[chosen]


def band_of(length: int) -> int:
    """Words by which a template of so many words may be shifted."""
    return min(BAND, max(1, length // 3))


def anchors(split: list[str], coverage: float) -> list[int]:
    """Places of the longest words of a template, one more than may be unmatched at a coverage."""
    spare = len(split) - math.ceil(coverage * len(split))
    return sorted(range(len(split)), key=lambda i: (-len(split[i]), i))[: spare + 1]


class Index:
    """Templates by number, and where in which of them each fingerprint is, for alignments of a coverage."""

    def __init__(self, templates: Mapping[str, str], coverage: float = COVERAGE):
        self.names = sorted(templates)
        split = [words(templates[name]) for name in self.names]
        if sum(map(len, split)) > MAX_WORDS:
            raise ValueError(f"templates have more than {MAX_WORDS} words")
        self.numbers = {w: i + 1 for i, w in enumerate(sorted({w for ws in split for w in ws}))}
        self.templates = [np.array([self.numbers[w] for w in ws], np.int32) for ws in split]
        self.places: dict[int, list[tuple[int, int]]] = {}
        self.anchors: dict[int, list[tuple[int, int]]] = {}
        for t, ids in enumerate(self.templates):
            if len(ids) < GRAM:
                raise ValueError(f"template {self.names[t]!r} has fewer than {GRAM} words")
            if len(ids) <= SHORT:
                for at in anchors(split[t], coverage):
                    self.anchors.setdefault(int(ids[at]), []).append((t, at))
            else:
                for h, at in zip(*fingerprints(ids)):
                    self.places.setdefault(int(h), []).append((t, int(at)))
        # Different words of each template, and how many of them an accepted alignment has at least.
        self.needed = [
            (frozenset(ids.tolist()), len(set(ids.tolist())) - len(ids) + math.ceil(coverage * len(ids))) for ids in self.templates
        ]
        self._look_up()

    def _look_up(self) -> None:
        self.hashes = np.array(sorted(self.places), np.uint64)
        self.anchored = np.zeros(len(self.numbers) + 1, bool)
        self.anchored[list(self.anchors)] = True
        self.vocabulary = _Vocabulary(self.numbers)

    def __reduce__(self):
        return Index._of, (self.names, self.templates, self.numbers, self.places, self.anchors, self.needed)

    @classmethod
    def _of(cls, names, templates, numbers, places, anchors, needed) -> Index:
        self = cls.__new__(cls)
        self.names, self.templates, self.numbers, self.places, self.anchors, self.needed = names, templates, numbers, places, anchors, needed
        self._look_up()
        return self

    def band(self, t: int) -> int:
        """Words by which an alignment may leave the place a candidate begins at.

        A short template's only hit can be at either end of the shifts, so it may leave it by twice as many.
        """
        length = len(self.templates[t])
        return band_of(length) * (2 if length <= SHORT else 1)

    def candidates(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """``(template, place)``: where in a text templates may begin. For long ones, nearby places are one."""
        found, at = grams(ids)
        hit = np.isin(found, self.hashes)
        begins: dict[int, set[int]] = {}
        for h, place in zip(found[hit].tolist(), at[hit].tolist()):
            for t, offset in self.places[h]:
                begins.setdefault(t, set()).add(place - offset)
        out = []
        for t, places in sorted(begins.items()):
            last = None
            for begin in sorted(places):
                if last is None or begin - last > band_of(len(self.templates[t])):
                    out.append((t, begin))
                    last = begin
        single = np.flatnonzero(self.anchored[ids])
        short = {(t, place - at) for place, w in zip(single.tolist(), ids[single].tolist()) for t, at in self.anchors[w]}
        for t, begin in sorted(short):
            different, least = self.needed[t]
            around = ids[max(0, begin - self.band(t)) : begin + len(self.templates[t]) + self.band(t)]
            if len(different.intersection(around.tolist())) >= least:
                out.append((t, begin))
        return out


def align(template: np.ndarray, text: np.ndarray, begin: int, band: int = BAND) -> tuple[int, int, int]:
    """``(matched words, first, last)`` of the best local alignment of a template with a text around a diagonal.

    Row ``i`` of the band holds the text's words ``begin + i - band`` to ``begin + i + band``. ``first`` and ``last`` are
    the places in the text of the first and last matched word; no match gives ``(0, -1, -1)``.
    """
    m, width = len(template), 2 * band + 1
    padded = np.full(m + 2 * width, -1, np.int64)
    low = begin - band
    a, b = max(0, low), min(len(text), low + m + width - 1)
    if a < b:
        padded[a - low : b - low] = text[a:b]
    score = np.zeros((m + 1, width + 2), np.int64)
    steps = GAP * np.arange(width)
    for i in range(m):
        here = padded[i : i + width]
        equal = (here == template[i]) & (here > 0)
        diagonal = score[i, 1 : width + 1] + np.where(equal, MATCH, MISMATCH)
        best = np.maximum(np.maximum(diagonal, score[i, 2 : width + 2] + GAP), 0)
        # Gaps along the row: the best of all cells to the left, less one gap for each cell between.
        score[i + 1, 1 : width + 1] = np.maximum.accumulate(best - steps) + steps
    i, j = np.unravel_index(int(score.argmax()), score.shape)
    matched, first, last = 0, -1, -1
    while i > 0 and 1 <= j <= width and score[i, j] > 0:
        equal = padded[i - 1 + j - 1] == template[i - 1] and padded[i - 1 + j - 1] > 0
        if score[i, j] == score[i - 1, j] + (MATCH if equal else MISMATCH):
            if equal:
                place = low + i - 1 + j - 1
                matched, first, last = matched + 1, place, place if last < 0 else last
            i -= 1
        elif score[i, j] == score[i - 1, j + 1] + GAP:
            i, j = i - 1, j + 1
        else:
            j -= 1
    return matched, first, last


def find(index: Index, text: str, coverage: float = COVERAGE) -> list[tuple[str, int, int, int, int]]:
    """``(license, matched words, template's words, start, end)`` in a text, by start; code points, end exclusive.

    Of matches that overlap, one with more matched words stays; then the larger covered share; then the first name.
    """
    ids = np.fromiter(map(index.vocabulary.__getitem__, _TOKEN.findall(text)), np.int32)
    found = []
    for t, begin in index.candidates(ids):
        matched, first, last = align(index.templates[t], ids, begin, index.band(t))
        if matched >= coverage * len(index.templates[t]):
            found.append((matched, t, first, last))
    taken: list[tuple[int, int, int, int]] = []
    for one in sorted(set(found), key=lambda x: (-x[0], -x[0] / len(index.templates[x[1]]), x[1], x[2])):
        if all(one[3] < other[2] or other[3] < one[2] for other in taken):
            taken.append(one)
    if not taken:
        return []
    spans = [m.span() for m in _TOKEN.finditer(text)]
    return [
        (index.names[t], matched, len(index.templates[t]), spans[first][0], spans[last][1])
        for matched, t, first, last in sorted(taken, key=lambda x: x[2])
    ]


def scan(
    docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, coverage: float = COVERAGE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per license found: ``(id, license, coverage, matched_words, template_words, span_start, span_end)``.

    ``coverage`` is the matched share of the template's words. Words are runs of letters and digits in any case. A
    null or empty text has none; repeated rows give repeated rows.
    """
    index = Index(templates, coverage)

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            row, found = [], []
            for i, text in enumerate(batch.column(1)):
                here = find(index, text.as_py() or "", coverage)
                row += [i] * len(here)
                found += here
            column = lambda k, kind: pa.array([f[k] for f in found], kind)
            return pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row, pa.int64())), column(0, pa.string()),
                    pa.array([f[1] / f[2] for f in found], pa.float64()), *[column(k, pa.int64()) for k in (1, 2, 3, 4)],
                ],
                names=[id_col, "license", "coverage", "matched_words", "template_words", "span_start", "span_end"],
            )

        return run

    kind = docs.schema[id_col].dataType.simpleString()
    return by_batch(
        docs.select(F.col(id_col), F.col(text_col).cast("string")), make,
        f"`{id_col}` {kind}, license string, coverage double, matched_words long, template_words long, span_start long, span_end long",
    )
