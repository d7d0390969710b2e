"""License scans: winnowed fingerprints of templates in an inverted index pick candidates, banded alignment measures them.

A template of n words may miss up to k = n - ceil(coverage * n) of them, and a match may have extra words in up to
b = ``band_of(n)`` further stretches, with agreeing words that shift against each other by at most b places. So what is left of it lies in at most k + b + 1 runs, of which the longest has at least
r = ceil((n - k) / (k + b + 1)) words. From r follow the template's gram length q and window w, with q + w - 1 <= r: every w
neighbouring grams of q words have their smallest hash selected, the last of equal ones, in templates and texts alike, and a run
of r words selects the same fingerprint in both. The whole match shares at least (n - k) - (k + b + 1)(q + w - 2) windows, a
fingerprint at most w of them, so the number of fingerprints that a match hits is known too; where as many lie on nearby
diagonals there is a candidate. Around it template and text are aligned word by word in a band, and the words that agree are the
matched coverage. So a match within these bounds is always found, wherever its edits are and whatever the template's length.
Matches that cover at least 80 % of a template are reported, one row for each occurrence, with their place in characters.

The templates are a parameter of bounded size that every task holds. Any k + 1 of a template's words hold one of a match; a
text without any of the longest k + 1 can't have a match and isn't cut into words.

Null and empty texts have no matches. A very long text is read whole, by one task, whose memory grows with that text alone.
Templates may overlap; each is reported for itself; one without a word is never found. Equal alignments prefer agreeing
words, then the earlier place. Repeated rows are reported each. Empty tables give an empty result. Other columns may have
any names.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COVERAGE = 0.8
#: Most words of a gram and most grams of a window; shorter ones only make more fingerprints.
MOST_WORDS = 4
MOST_WINDOW = 8

#: Usual notices and whole texts of public licenses (fixed texts).
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
    "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless "
    "required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" "
    "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "MIT": "Released under the MIT License.",
    "MIT-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights "
    "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
    "whom the Software is furnished to do so.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
    "version.",
    "BSD-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND "
    "THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND "
    "FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
    "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
    "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights "
    "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
    "whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission "
    "notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT "
    "WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
    "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
    "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE "
    "OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
    "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, "
    "including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The "
    "origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this "
    "software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered "
    "source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice "
    "may not be removed or altered from any source distribution.",
}

_WORD = re.compile(r"[^\W_]+")


def split(text: str) -> list[tuple[str, int, int]]:
    """Lower-case words of letters and digits with their place."""
    return [(m.group().lower(), m.start(), m.end()) for m in _WORD.finditer(text)]


def missing_of(length: int, coverage: float) -> int:
    """The words of a template that a match may miss."""
    return sum((length - n) / length >= coverage for n in range(1, length))


def winnowing(length: int, coverage: float = COVERAGE) -> tuple[int, int, int]:
    """Gram length and window of a template, and the fingerprints that a match of it hits at least."""
    missing = missing_of(length, coverage)
    runs = missing + band_of(length) + 1
    run = -(-(length - missing) // runs)
    gram = min(MOST_WORDS, (run + 1) // 2 if run > 2 else run)
    window = min(MOST_WINDOW, run - gram + 1)
    shared = length - missing - runs * (gram + window - 2)
    return gram, window, max(1, -(-shared // window))


def hashed(found: list[str]) -> np.ndarray:
    """One number for each word."""
    seen = {w: xxhash.xxh64_intdigest(w) for w in set(found)}
    return np.fromiter((seen[w] for w in found), np.uint64, len(found))


def grams_of(words: np.ndarray, gram: int) -> np.ndarray:
    """One number for each run of ``gram`` neighbouring words."""
    out = words[:max(0, len(words) - gram + 1)].copy()
    for i in range(1, gram):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + words[i:len(words) - gram + 1 + i]
    return (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def selected(grams: np.ndarray, window: int) -> np.ndarray:
    """The places of the fingerprints: of every ``window`` neighbouring grams the last one of the smallest."""
    if len(grams) < window or not len(grams):
        return np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(grams, window)
    last = window - 1 - np.argmin(views[:, ::-1], axis=1)
    return np.unique(np.arange(len(views)) + last)


class Index:
    """Winnowed fingerprints of the templates: to each its places in templates, and how many a match hits at least."""

    def __init__(self, templates: dict[str, str], coverage: float = COVERAGE) -> None:
        self.words = {name: found for name, text in templates.items() if (found := [w for w, _, _ in split(text)])}
        self.need: dict[str, int] = {}
        #: For each gram length and window: fingerprint to (template, place).
        self.at: dict[tuple[int, int], dict[int, list[tuple[str, int]]]] = defaultdict(lambda: defaultdict(list))
        anchors: set[str] = set()
        for name, found in self.words.items():
            gram, window, self.need[name] = winnowing(len(found), coverage)
            grams = grams_of(hashed(found), gram)
            for i in selected(grams, window).tolist():
                self.at[gram, window][int(grams[i])].append((name, i))
            longest = sorted(found, key=lambda w: (-len(w), w))
            anchors.update(longest[:missing_of(len(found), coverage) + 1])
        self.known = {k: np.fromiter(v, np.uint64, len(v)) for k, v in self.at.items()}
        self.anchors = sorted(anchors, key=lambda w: (-len(w), w))

    def candidates(self, found: list[str]) -> Iterator[tuple[str, int, int]]:
        """Template and the range of diagonals (place in text less place in template) of each group of enough hits."""
        hits: dict[str, list[tuple[int, int]]] = defaultdict(list)
        words = hashed(found)
        for (gram, window), places in self.at.items():
            grams = grams_of(words, gram)
            chosen = selected(grams, window)
            for i in chosen[np.isin(grams[chosen], self.known[gram, window])].tolist():
                for name, j in places[int(grams[i])]:
                    hits[name].append((i - j, j))
        for name, places in hits.items():
            if len(places) < self.need[name]:
                continue
            band = band_of(len(self.words[name]))
            places.sort()
            held: Counter[int] = Counter()
            begin, now = 0, None
            for end, (diagonal, j) in enumerate(places):
                held[j] += 1
                while diagonal - places[begin][0] > band:
                    held[places[begin][1]] -= 1
                    held += Counter()
                    begin += 1
                if len(held) < self.need[name]:
                    continue
                low = places[begin][0]
                if now and low - now[1] <= band:
                    now = (now[0], diagonal)
                    continue
                if now:
                    yield name, *now
                now = (low, diagonal)
            if now:
                yield name, *now


def band_of(length: int) -> int:
    return max(2, length // 8)


def align(template: list[str], found: list[str], low: int, high: int) -> tuple[int, int, int]:
    """Most agreeing words of a template and a stretch of the text, on diagonals from low to high and the band around.

    Returns them with the places of the first and the last agreeing word; edits cost nothing but agreement is kept in order.
    """
    band = band_of(len(template))
    low, high = low - band, high + band
    width = high - low + 1
    best = [(0, 0, -1, -1)] * (width + 1)  # agreeing words, minus words passed over, first place, last place
    for i, word in enumerate(template):
        now = [(0, 0, -1, -1)] * (width + 1)
        for d in range(width):
            j = i + low + d
            take = best[d]
            if 0 <= j < len(found) and found[j] == word:
                n, passed, first, last = take
                take = (n + 1, passed - (j - last - 1 if last >= 0 else 0), first if first >= 0 else j, j)
            skip = best[d + 1] if d + 1 < width else (0, 0, -1, -1)  # the template's word is missing
            left = now[d - 1] if d else (0, 0, -1, -1)  # a word of the text is extra
            now[d] = max(take, skip, left, key=lambda x: (x[0], x[1], -x[2]))
        best = now
    n, _, first, last = max(best, key=lambda x: (x[0], x[1], -x[2]))
    return n, first, last


def scan_text(text: str | None, index: Index, coverage: float = COVERAGE) -> list[tuple[str, int, int, float, int, int]]:
    """Matches of one text: license, agreeing words, words of the template, their share, begin and end in characters."""
    lower = (text or "").lower()
    if not any(a in lower for a in index.anchors):
        return []
    places = split(text)
    found = [w for w, _, _ in places]
    out = set()
    for name, low, high in index.candidates(found):
        template = index.words[name]
        n, first, last = align(template, found, low, high)
        if n and n / len(template) >= coverage:
            out.add((name, n, len(template), n / len(template), places[first][1], places[last][2]))
    return sorted(out, key=lambda x: (x[4], x[0]))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per license notice found in a document."""
    used = dict(templates or TEMPLATES)
    names = ["license", "matched_words", "template_words", "coverage", "start_char", "end_char"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = Index(used, coverage)
        for pdf in batches:
            rows = [(key, *match) for key, text in zip(pdf["doc_id"], pdf["text"]) for match in scan_text(text, index, coverage)]
            if rows:
                yield pd.DataFrame(rows, columns=["doc_id", *names])

    named = docs.select(F.col(id_col).cast("long").cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    found = named.mapInPandas(run, "doc_id string, license string, matched_words long, template_words long, coverage double, "
                                   "start_char long, end_char long")
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))
