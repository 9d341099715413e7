"""License scans by winnowed template fingerprints and banded alignment.

Templates are cut into words (letters and digits, lower case).  The codes of their runs of ``k`` words are winnowed:
of every ``window`` neighbouring codes the smallest is kept, so a run of k + window - 1 words that text and template
share holds a kept code.  An inverted index maps each kept code to its templates and places.  A text looks up all its
runs; hits on about the same diagonal make a candidate, and a banded alignment of the template with the text around
it tells how many template words match, in order, and where.  Templates under ``SHORT`` words keep all their codes,
those under ``BRIEF`` words of runs of two.

A candidate is reported if the matched words cover at least ``min_coverage`` of the template, the words between them
are at most the share of the template that may be missing, and the words that tell licences apart (``TELLING`` and
numbers) agree: each of the template's is matched, and none stands between the matched words.  So a notice of a
neighbouring licence is not taken for the template.  Of overlapping candidates of all templates only the best, the one
with the most matched words, is reported.

The templates are a parameter and travel with the tasks; they are a short list, not a table that grows with the data.

Defined cases: null and empty texts have no match; each occurrence is reported, also several in a text; rows that
repeat an id are scanned each; of overlapping candidates ties go to the larger coverage, then to the shorter span, the
first place and the template's name; an empty table or list of templates gives an empty result.  Only the id and text columns are read.
"""
from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# fixed values: notices as their licences word them
TEMPLATES = {
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
    "MIT line": "Released under the MIT License.",
    "MIT grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction',
    "GPL-3.0 line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "BSD clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "CC BY-NC 4.0 line": "Licensed under CC BY-NC 4.0.",
    "CC BY 4.0 line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "Reserved": "All rights reserved.",
    "GPL-2.0 line": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0 notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-2.0 notice": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "LGPL notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "AGPL notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    "LGPL-2.1 line": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-3.0 line": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0 line": "This work is licensed under the GNU Affero General Public License, version 3.",
    **{f"CC {kind} 4.0 short": f"Licensed under CC {kind} 4.0." for kind in ("BY", "BY-SA", "BY-ND", "BY-NC-SA", "BY-NC-ND")},
    **{f"CC {kind} 4.0 line": f"This work is licensed under a Creative Commons {name} 4.0 International License."
       for kind, name in (("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
                          ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))},
    "CC BY-NC 4.0 long line": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "MIT text": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
}
# fixed values: words that tell neighbouring licences apart, besides numbers
TELLING = frozenset("apache mit bsd gnu gpl lgpl agpl lesser library affero mozilla cc by nc sa nd attribution noncommercial sharealike noderivatives noderivs creative commons reserved".split())
BRIEF, SHORT = 8, 16      # words of templates with runs of two, and of those that are not winnowed
WORD = re.compile(r"[^\W_]+")
OUT = "id long, template string, matched int, template_words int, coverage double, start_char long, end_char long, start_word long, end_word long"


def _codes(ids: np.ndarray, k: int) -> np.ndarray:
    """64-bit codes of all runs of k word numbers."""
    code = np.zeros(max(0, len(ids) - k + 1), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            code = (code ^ ids[j:j + len(code)].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            code ^= code >> np.uint64(31)
    return code


def winnow(codes: np.ndarray, window: int) -> list[int]:
    """Places of the smallest code (the last of equals) of every window."""
    if not len(codes):
        return []
    spans = [codes[i:i + window] for i in range(max(1, len(codes) - window + 1))]
    return sorted({i + len(s) - 1 - int(np.argmin(s[::-1])) for i, s in enumerate(spans)})


def align(template: np.ndarray, text: np.ndarray, diagonal: int, band: int) -> tuple[int, int, int]:
    """(matched words, first, last place in the text) of the best alignment within ``band`` of the diagonal.

    Longest common subsequence between the template and text[diagonal + i + d] for -band <= d <= band; of equals the
    one that ends nearest to the diagonal.
    """
    width = 2 * band + 1
    score, first = np.zeros(width + 1, dtype=np.int64), np.full(width + 1, -1, dtype=np.int64)
    last = np.full(width + 1, -1, dtype=np.int64)
    for i, word in enumerate(template):
        new, new_first, new_last = score.copy(), first.copy(), last.copy()
        for c in range(width):                       # column c of row i is text place diagonal + i + c - band
            at = diagonal + i + c - band
            best = (score[c + 1], first[c + 1], last[c + 1]) if c + 1 < width else (0, -1, -1)      # template word left out
            if c and new[c - 1] >= best[0]:
                if new[c - 1] > best[0] or new_last[c - 1] <= best[2]:
                    best = (new[c - 1], new_first[c - 1], new_last[c - 1])                           # text word left out
            if 0 <= at < len(text) and text[at] == word and score[c] + 1 >= best[0]:
                best = (score[c] + 1, first[c] if score[c] else at, at)
            new[c], new_first[c], new_last[c] = best
        score, first, last = new, new_first, new_last
    c = max(range(width), key=lambda c: (score[c], -abs(c - band)))
    return int(score[c]), int(first[c]), int(last[c])


def chain(template: np.ndarray, words: np.ndarray, barred: set[int]) -> list[tuple[int, int]]:
    """(place in the template, place in the words) of the matched words of a longest common subsequence, its ends cut.

    The part is kept that scores most with +1 for a matched word and -1 for each word between two of them; it has no
    ``barred`` word between them.
    """
    n, m = len(template), len(words)
    best = np.zeros((n + 1, m + 1), dtype=np.int64)
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i, j] = best[i + 1, j + 1] + 1 if template[i] == words[j] else max(best[i + 1, j], best[i, j + 1])
    pairs, i, j = [], 0, 0
    while i < n and j < m:
        if template[i] == words[j]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1, j] >= best[i, j + 1]:
            i += 1
        else:
            j += 1
    most, kept, score, first = 0, (0, 0), 0, 0
    for at, (_, j) in enumerate(pairs):
        between = words[pairs[at - 1][1] + 1:j].tolist() if at else []
        score = 0 if barred.intersection(between) else score - len(between)
        if score <= 0:
            score, first = 0, at
        score += 1
        if score > most:
            most, kept = score, (first, at + 1)
    return pairs[slice(*kept)]


class Scanner:
    def __init__(self, templates: dict[str, str], k: int, window: int, band: int, min_coverage: float):
        self.band, self.min_coverage = band, min_coverage
        words = {name: WORD.findall(t.lower()) for name, t in templates.items()}
        self.number: dict[str, int] = {}
        for ws in words.values():
            for w in ws:
                self.number.setdefault(w, len(self.number) + 1)
        self.names = [n for n in sorted(words) if words[n]]
        self.ids = [np.array([self.number[w] for w in words[n]], dtype=np.int64) for n in self.names]
        self.sets = [set(ids.tolist()) for ids in self.ids]
        tells = lambda w: w in TELLING or w.isdigit()
        self.must = [{self.number[w] for w in words[n] if tells(w)} for n in self.names]
        self.telling = {-1} | {i for w, i in self.number.items() if tells(w)}
        self.index: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for t, ids in enumerate(self.ids):
            size = min(2 if 3 < len(ids) < BRIEF else k, len(ids))
            codes = _codes(ids, size)
            for place in range(len(codes)) if len(ids) < SHORT else winnow(codes, window):
                self.index.setdefault(size, {}).setdefault(int(codes[place]), []).append((t, place))
        self.kept = {size: np.array(sorted(found), dtype=np.uint64) for size, found in self.index.items()}

    def _number(self, word: str) -> int:
        """The number of a word; -1 for one of no template that tells licences apart."""
        low = word.lower()
        return self.number.get(low, -1 if low in TELLING or low.isdigit() else 0)

    def _candidate(self, t: int, ids: np.ndarray, diagonal: int):
        """(matched, first, last) if the template lies in the text around the diagonal."""
        template, band = self.ids[t], self.band
        n, least = len(template), self.min_coverage * len(template)
        around = ids[max(0, diagonal - band):max(0, diagonal + n + band)].tolist()
        if not self.must[t].issubset(around) or sum(w in self.sets[t] for w in around) < least:
            return None
        matched, first, last = align(template, ids, diagonal, band)
        if matched < least:
            return None
        pairs = chain(template, ids[first:last + 1], self.telling)
        begin, end = pairs[0][1], pairs[-1][1]
        if len(pairs) < least or end + 1 - begin - len(pairs) > n - least:
            return None
        if not self.must[t].issubset(int(template[i]) for i, _ in pairs):
            return None
        return len(pairs), first + begin, first + end

    def scan(self, text: str | None) -> list[tuple]:
        if not text or not self.index:
            return []
        words = WORD.findall(text)
        ids = np.fromiter(map(self._number, words), dtype=np.int64, count=len(words))
        near: set[tuple[int, int]] = set()
        for size, index in self.index.items():
            codes = _codes(ids, size)
            known = np.flatnonzero(np.isin(codes, self.kept[size])) if len(codes) else []
            for p in known:
                near.update((t, int(p) - place) for t, place in index[int(codes[p])])
        found = set()
        for t, d in near:
            hit = self._candidate(t, ids, d)
            if hit:
                found.add((-hit[0], -hit[0] / len(self.ids[t]), hit[2] - hit[1], hit[1], self.names[t], len(self.ids[t])))
        out, taken = [], []
        spans = list(WORD.finditer(text)) if found else []
        for neg, cover, long, first, name, size in sorted(found):
            last = first + long
            if all(last < a or first > b for a, b in taken):
                taken.append((first, last))
                out.append((name, -neg, size, -cover, spans[first].start(), spans[last].end(), first, last + 1))
        return sorted(out, key=lambda r: (r[4], r[0]))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None, *,
         k: int = 3, window: int = 2, band: int = 4, min_coverage: float = 0.8) -> DataFrame:
    """(id, template, matched, template_words, coverage, spans in characters and words): one row per notice found."""
    templates = TEMPLATES if templates is None else templates

    def run(batches):
        scanner = Scanner(templates, k, window, band, min_coverage)
        for batch in batches:
            rows = [(key, *hit) for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for hit in scanner.scan(text)]
            if rows:
                cols = list(zip(*rows))
                kinds = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.float64(), *[pa.int64()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, kinds)], names=[f.split()[0] for f in OUT.split(", ")])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")).mapInArrow(run, OUT)
