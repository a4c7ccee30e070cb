"""License scan by patience alignment of license templates to document text.

Words are runs of letters and digits, lower-cased. A pair of adjacent words that a text shares with a template is a
seed; a seed at text word p and template word i puts the template's start at p - i. For each start so proposed, the
window of the text that the template can fill there, a quarter of its length longer, is aligned to the template:
equal ends are matched, words that occur once in both are anchors, the longest increasing run of anchors is kept, and
the gaps between them are aligned in the same way; a gap without such words gives its longest common subsequence, so that
what is found does not hang on where the window ends. The coverage is the share of the template's words that are matched.

Windows with too few different seeds for the wanted coverage are not aligned: of m matched words, at most L - m
neighbours are parted by missing words and at most len(window) - m by inserted ones, so at least
m - 1 - (L - m) - (len(window) - m) pairs are adjacent in both. A text counts as holding a template only if at least
one pair is.

Of overlapping findings of one template the best covered stays (then the first), so that several copies in a
document are all found. Different templates may overlap.

Defined cases: a null, empty or word-free text has no words and no licenses; rows are judged one by one, so repeated
rows give repeated results; an empty table gives no rows; further columns are left alone. Whole texts are scanned.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import query, table

COVERAGE = 0.8

# Public license notices by SPDX name.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "Apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable
        law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
        CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
        limitations under the License.""",
    "MIT-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
        files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
        merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished
        to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all
        copies or substantial portions of the Software.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions
        and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of
        conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
        provided that the above copyright notice and this permission notice appear in all copies.""",
    "GPL-3.0-header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
        with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
}

_WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def increasing(values: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence, by patience piles."""
    tops: list[int] = []
    piles: list[int] = []
    under = [-1] * len(values)
    for k, v in enumerate(values):
        at = bisect_left(tops, v)
        if at == len(tops):
            tops.append(v)
            piles.append(k)
        else:
            tops[at] = v
            piles[at] = k
        under[k] = piles[at - 1] if at else -1
    out, k = [], piles[-1] if piles else -1
    while k >= 0:
        out.append(k)
        k = under[k]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Matched positions of ``a`` and ``b``, increasing in both."""
    out = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, m, j, n = todo.pop()
        while i < m and j < n and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            out.append((m, n))
        if i == m or j == n:
            continue
        in_a, in_b = Counter(a[i:m]), Counter(b[j:n])
        place = {w: k for k, w in enumerate(b[j:n], j) if in_b[w] == 1}
        both = [(k, place[w]) for k, w in enumerate(a[i:m], i) if in_a[w] == 1 and w in place]
        anchors = [both[k] for k in increasing([y for _, y in both])]
        for x, y in anchors:
            todo.append((i, x, j, y))
            out.append((x, y))
            i, j = x + 1, y + 1
        if anchors:
            todo.append((i, m, j, n))
        else:
            out += common(a, b, i, m, j, n)
    return sorted(out)


def common(a: list[str], b: list[str], i: int, m: int, j: int, n: int) -> list[tuple[int, int]]:
    """A longest common subsequence of ``a[i:m]`` and ``b[j:n]``: the longest increasing run over all equal places."""
    place = defaultdict(list)
    for y in range(n - 1, j - 1, -1):
        place[b[y]].append(y)
    both = [(x, y) for x in range(i, m) for y in place.get(a[x], ())]  # descending within a word, so none is taken twice
    return [both[k] for k in increasing([y for _, y in both])]


class Scanner:
    """Finds templates in word lists."""

    def __init__(self, templates: dict[str, str], coverage: float = COVERAGE):
        self.coverage = coverage
        self.names = list(templates)
        self.texts = [words(t) for t in templates.values()]
        self.pairs: dict[tuple[str, str], list[tuple[int, int]]] = defaultdict(list)
        for t, text in enumerate(self.texts):
            for i, pair in enumerate(zip(text, text[1:])):
                self.pairs[pair].append((t, i))

    def find(self, text: list[str]) -> list[tuple[str, int, int, float]]:
        """(template, first word, word after the last, coverage) of every finding, in text order."""
        pairs = self.pairs
        seeds = defaultdict(list)
        for p, pair in enumerate(zip(text, text[1:])):
            if pair in pairs:
                for t, i in pairs[pair]:
                    seeds[t].append((p - i, p, i))
        found = []
        for t, of in seeds.items():
            found += self._of_template(t, sorted(of), text)
        return sorted(found, key=lambda f: (f[1], f[2], f[0]))

    def _of_template(self, t: int, seeds: list[tuple[int, int, int]], text: list[str]) -> list[tuple[str, int, int, float]]:
        template = self.texts[t]
        size = len(template)
        wanted = ceil(self.coverage * size - 1e-9)
        drift = max(2, size // 4)
        least = max(1, wanted - 1 - (size - wanted) - (size + drift - wanted))
        found = []
        starts = [s for s, _, _ in seeds]
        for k in range(len(seeds)):
            start = starts[k]
            if k and start == starts[k - 1]:
                continue
            low = max(0, start - drift // 2)
            high = min(len(text), start + size + drift - drift // 2)
            near = {i for _, p, i in seeds[bisect_left(starts, start - drift) : bisect_left(starts, start + drift + 1)] if low <= p < high}
            if len(near) < least or high - low < wanted:
                continue
            window = text[low:high]
            have = Counter(window)
            if sum(min(n, have[w]) for w, n in Counter(template).items()) < wanted:
                continue
            matched = align(window, template)
            if len(matched) >= wanted:
                found.append((-len(matched), low + matched[0][0], low + matched[-1][0] + 1))
        kept: list[tuple[int, int, int]] = []
        for n, a, b in sorted(set(found)):
            if all(b <= x or a >= y for _, x, y in kept):
                kept.append((n, a, b))
        return [(self.names[t], a, b, -n / size) for n, a, b in kept]


FOUND = "array<struct<license:string,first:int,stop:int,coverage:double>>"


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, n_words, found) per row: every license notice in its text. ``templates`` is a short list of the caller's."""
    found = pa.list_(pa.struct([("license", pa.string()), ("first", pa.int32()), ("stop", pa.int32()), ("coverage", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, coverage)
        for batch in batches:
            sizes, hits = [], []
            for text in batch.column(1):
                w = words(text.as_py())
                sizes.append(len(w))
                hits.append([dict(zip(("license", "first", "stop", "coverage"), f)) for f in scanner.find(w)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(hits, found)], names=["doc_id", "n_words", "found"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, f"doc_id {kind}, n_words long, found {FOUND}")


@query("op1_license_scan")
def op1(spark, folder):
    """Per document: its licenses in text order, and the place and coverage of the best one (then the first)."""
    found = scan(table(spark, folder, "documents"))
    best = F.array_sort(F.transform("found", lambda f: F.struct((-f["coverage"]).alias("c"), f["first"], f["stop"], f["license"])))
    top = F.get(best, F.lit(0))
    return found.select(
        "doc_id",
        "n_words",
        F.size("found").alias("n_found"),
        F.array_join(F.transform("found", lambda f: f["license"]), ",").alias("licenses"),
        top["license"].alias("best"),
        F.round(-top["c"], 6).alias("coverage"),
        top["first"].alias("first_word"),
        top["stop"].alias("stop_word"),
    )
