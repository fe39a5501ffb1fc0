"""License scans: winnowed fingerprints pick candidates, banded alignment reports them.

Fingerprints of all templates form an inverted index (a small table that every task holds; it is
bounded by the templates). A text's fingerprints are looked up in it. Hits of one template on
neighbouring diagonals are one candidate, which a banded local alignment turns into matched
words, coverage of the template and a span of the text.

Short lines of different licenses differ in a word or two. So a short template's own words, those
that few templates have, must all be in the span, and of overlapping findings only the best stays:
that with the most matched words less those missing from the template and those put in between.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from tidemark.llm.common import keyed_texts

WORD = re.compile(r"[^\W_]+")
SHORT, RARE = 20, 2  # templates under SHORT words must have all their words that at most RARE templates have
GRAM, WINDOW = 3, 2  # every shared run of GRAM + WINDOW - 1 words has a fingerprint in common

# Short notices and opening paragraphs of public licenses, word for word.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
        "in the documentation and/or other materials provided with the distribution."
    ),
    "cc-by-4.0-line": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0-line": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. "
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
        "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "mit-line": "Released under the MIT License.",
    "mit": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "mpl-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, "
        "either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. "
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely"
    ),
}


def words_of(text: str) -> tuple[list[str], list[int], list[int]]:
    """Case-folded words and where each starts and ends (code points)."""
    words, starts, ends = [], [], []
    for m in WORD.finditer(text):
        words.append(m.group().casefold())
        starts.append(m.start())
        ends.append(m.end())
    return words, starts, ends


def fingerprints(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Winnowed hashes of word runs and their places: the smallest hash (rightmost on ties) of every window."""
    if len(words) < GRAM:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    run = np.zeros(len(h) - GRAM + 1, np.uint64)
    for k in range(GRAM):
        run = (run ^ (run >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + h[k : k + len(run)]
    width = min(WINDOW, len(run))
    seen = np.lib.stride_tricks.sliding_window_view(run, width)
    place = np.unique(np.arange(len(seen)) + width - 1 - seen[:, ::-1].argmin(axis=1))
    return run[place], place


def align(template: list[str], words: list[str], diagonal: int, band: int) -> tuple[int, int, int]:
    """Best local alignment within ``band`` of a diagonal (place in the text minus place in the
    template): matched words and the first and last aligned word of the text. A match scores 1,
    a mismatch or gap -1; equal scores go to more matches, then to the earlier end."""
    lo = diagonal - band
    width = 2 * band + 1
    none = (0, 0, -1)  # score, matches, first word
    before = [none] * (width + 1)
    best, span = (0, 0), (0, 0, -1)
    for i, t in enumerate(template):
        row, left = [], none
        for j in range(width):
            at = i + lo + j  # the diagonal neighbour has the same j in the row before
            if not 0 <= at < len(words):
                left = none
                row.append(left)
                continue
            s, m, f = before[j]
            hit = words[at] == t
            cell = (s + 1, m + 1, f if s > 0 else at) if hit else (s - 1, m, f)
            s, m, f = before[j + 1]
            if (s - 1, m) > cell[:2]:
                cell = (s - 1, m, f)
            s, m, f = left
            if (s - 1, m) > cell[:2]:
                cell = (s - 1, m, f)
            left = cell if cell[0] > 0 else none
            row.append(left)
            if left[:2] > best:
                best, span = left[:2], (left[1], left[2], at)
        row.append(none)
        before = row
    return span


class Templates:
    """The inverted index of the templates and their words."""

    def __init__(self, templates: dict[str, str]):
        self.names = sorted(templates)
        self.words = [words_of(templates[n])[0] for n in self.names]
        own = [set(w) for w in self.words]
        known = Counter(w for words in own for w in words)
        self.telling = [{w for w in words if known[w] <= RARE} if len(all_) < SHORT else set() for words, all_ in zip(own, self.words, strict=True)]
        entries = sorted((int(h), t, int(p)) for t, words in enumerate(self.words) for h, p in zip(*fingerprints(words), strict=True))
        self.hashes = np.array(sorted({e[0] for e in entries}), np.uint64)
        self.postings: dict[int, list[tuple[int, int]]] = {}
        for h, t, p in entries:
            self.postings.setdefault(h, []).append((t, p))

    def find(self, text: str, least_coverage: float) -> list[tuple]:
        """template, coverage, matched words, start and end (code points) of every finding.

        Findings never overlap. Those of one template with more matched words go first, then the
        earlier; of those of several templates the best by matched less missing and added words,
        then the longer, then the first template by name.
        """
        if not len(self.hashes):
            return []
        words, starts, ends = words_of(text)
        h, place = fingerprints(words)
        at = np.searchsorted(self.hashes, h)
        at[at == len(self.hashes)] = 0
        hit = np.flatnonzero(self.hashes[at] == h) if len(h) else []
        diagonals: dict[int, list[int]] = {}
        for k in hit:
            for t, p in self.postings[int(h[k])]:
                diagonals.setdefault(t, []).append(int(place[k]) - p)
        out = []
        for t, found in diagonals.items():
            template = self.words[t]
            band = 2 + len(template) // 10
            spans, until = [], None
            for d in sorted(set(found)):
                if until is not None and d <= until:  # within reach of the candidate before
                    continue
                until = d + band
                m, first, last = align(template, words, d + band // 2, band)
                if m >= least_coverage * len(template):
                    spans.append((-m, first, last))
            for first, last, m in _apart([(m, first, last, -m) for m, first, last in spans]):
                if self.telling[t] <= set(words[first : last + 1]):
                    added = last - first + 1 - m
                    out.append((-(m - (len(template) - m) - added), -m, t, first, last))
        kept = _apart([((score, m, t), first, last, (t, -m)) for score, m, t, first, last in out])
        return [(self.names[t], m / len(self.words[t]), m, starts[first], ends[last]) for first, last, (t, m) in sorted(kept)]


def _apart(spans: list[tuple]) -> list[tuple]:
    """(first, last, what) of the spans (rank, first, last, what) that overlap none of lower rank, then earlier."""
    taken: list[tuple[int, int]] = []
    out = []
    for _, first, last, what in sorted(spans):
        i = bisect_right(taken, (first, last))
        if (i and taken[i - 1][1] >= first) or (i < len(taken) and taken[i][0] <= last):
            continue
        taken.insert(i, (first, last))
        out.append((first, last, what))
    return out


def scan_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES, least_coverage: float = 0.8) -> DataFrame:
    """One row per finding in the whole text of every row.

    doc_id, template, coverage (matched share of the template's words), matched_words, span_start
    and span_end (code points, end exclusive). Findings do not overlap. Null, empty and wordless texts have no findings.
    Repeated rows and null doc_ids are scanned like all others. Templates of under three words
    have no fingerprint and are never found.
    """
    names = ["doc_id", "template", "coverage", "matched_words", "span_start", "span_end"]
    types = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]

    def scan(batches):
        index = Templates(templates)
        for batch in batches:
            rows = [(k, *f) for k, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) if t.is_valid for f in index.find(t.as_py(), least_coverage)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return keyed_texts(docs).mapInArrow(scan, "doc_id long, template string, coverage double, matched_words long, span_start long, span_end long")
