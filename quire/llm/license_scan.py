"""License scans by patience alignment of texts with license templates.

Texts and templates are compared as lower-case words. In a stretch of text the
words that occur exactly once in it and exactly once in the template are
anchors; the longest increasing subsequence of anchors (in template order) is
kept, and the gaps between anchors are aligned the same way, recursively; a gap
without anchors is matched greedily from its two ends. Coverage is the share of the
template's words that are aligned.

Some words decide which license it is, whatever the coverage. Every family word,
clause and number of a template (``DECIDING``) must be aligned; and no word that
makes another license of the same family (``VARIANTS``), nor another version
number, may stand among the aligned words. Of matches of several templates that
overlap, the one with the most aligned words is kept (on a tie the one with the
higher coverage, then the earlier name).

A text is first narrowed to stretches that can reach the coverage asked for: a
match must lie in ``SPREAD`` times the template's length, so windows of that
many words that hold too few of the template's distinct words are out. So are
those whose longest common subsequence with the template is too short; it grows
by one word at most when the window moves by one, so as many windows are passed
over as words are missing. Windows that remain are aligned one by one, which
finds every occurrence of a notice, also repeated ones.

Scale. One pass, no shuffle; the templates are a parameter of a few kilobytes
that travels with the task. A text without enough of a template's words costs
one set intersection.

Edge cases: null, empty or wordless texts have no matches; a text may match
several templates, or one several times (every place is listed; places never
overlap); repeated rows give equal results; ``matches`` replaces
a column of that name, other columns stay.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import drop_clashes, quoted

# Public license notices.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": """
        Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing,
        software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
        CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
        permissions and limitations under the License.""",
    "MIT notice": "Released under the MIT License.",
    "MIT": """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions: The above copyright notice and this permission notice shall be included in all
        copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF
        ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS
        FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE
        LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL header": """
        This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or
        (at your option) any later version. This program is distributed in the hope that it will be useful, but
        WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR
        PURPOSE. See the GNU General Public License for more details.""",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "BSD disclaimer": """
        Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. Redistributions in binary form must
        reproduce the above copyright notice, this list of conditions and the following disclaimer in the
        documentation and/or other materials provided with the distribution.""",
}

#: Words of a template that a match must align, besides its numbers.
DECIDING = frozenset("""
apache mit bsd gnu general public affero lesser library
cc by nc sa nd creative commons attribution noncommercial sharealike noderivatives
""".split())
SHORT_WORDS = 20          # in longer templates only family words and numbers decide
FAMILIES = frozenset("apache mit bsd gnu cc creative".split())

#: Words that make another license of a family, by a word of its templates.
_CLAUSES = frozenset("nc sa nd non commercial noncommercial share alike sharealike noderivatives noderivs "
                     "derivatives".split())
VARIANTS = {"gnu": frozenset("affero lesser library".split()), "cc": _CLAUSES, "creative": _CLAUSES}

COVERAGE = 0.8
SPREAD = 1.5
_NUMBER = re.compile(r"[0-9]{1,2}(?:\.[0-9]+)*\Z")  # a version, not a year
_WORD = re.compile(r"[^\W_]+(?:\.[0-9]+)*")


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Increasing pairs (place in a, place in b) of equal words, by patience."""
    pairs: list[tuple[int, int]] = []
    gaps = [(0, len(a), 0, len(b))]
    while gaps:
        a0, a1, b0, b1 = gaps.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:  # equal ends
            pairs.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            pairs.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: j for j, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        anchors = [(i, place[w]) for i, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and w in place]
        chain = increasing(anchors)
        i0, j0 = a0, b0
        for i, j in chain:
            pairs.append((i, j))
            gaps.append((i0, i, j0, j))
            i0, j0 = i + 1, j + 1
        if chain:
            gaps.append((i0, a1, j0, b1))
    return sorted(pairs)


def increasing(anchors: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence of anchors (sorted by a) that increases in b."""
    tails: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(anchors):
        p = bisect_left(tails, j)
        back.append(at[p - 1] if p else -1)
        if p == len(tails):
            tails.append(j)
            at.append(k)
        else:
            tails[p], at[p] = j, k
    chain, k = [], at[-1] if at else -1
    while k >= 0:
        chain.append(anchors[k])
        k = back[k]
    return chain[::-1]


def longest_common(window: list[str], places: dict[str, list[int]]) -> int:
    """Length of the longest common subsequence with a template, given the places
    of its words, last ones first."""
    tails: list[int] = []
    for w in window:
        for j in places.get(w, ()):
            p = bisect_left(tails, j)
            if p == len(tails):
                tails.append(j)
            else:
                tails[p] = j
    return len(tails)


class Template:
    """One license text as words, and what a match of it needs."""

    def __init__(self, name: str, text: str, coverage: float):
        self.name, self.seq = name, words(text)
        n, self.need = len(self.seq), set(self.seq)
        # words a match must align (a product that is whole up to rounding
        # counts as whole), so distinct words it must hold
        self.enough = max(1, math.ceil(coverage * n - 1e-9))
        self.least = max(1, len(self.need) - (n - self.enough))
        self.width = int(n * SPREAD) + 1
        self.places: dict[str, list[int]] = {}
        for j in range(n - 1, -1, -1):
            self.places.setdefault(self.seq[j], []).append(j)
        #: words that a match can begin with
        self.opens = set(self.seq[:n - self.enough + 1])
        numbers = {w for w in self.need if _NUMBER.match(w)}
        self.must = numbers | self.need & (DECIDING if n <= SHORT_WORDS else FAMILIES)
        self.never = frozenset().union(*[VARIANTS[w] for w in self.need & VARIANTS.keys()]) - self.need
        self.versioned = bool(numbers)

    def decided(self, window: list[str], pairs: list[tuple[int, int]]) -> bool:
        """Whether the words that tell licenses apart agree."""
        if not self.must <= {self.seq[j] for _, j in pairs}:
            return False
        between = set(window[:pairs[-1][0]]) - self.need
        return between.isdisjoint(self.never) and not (self.versioned and any(map(_NUMBER.match, between)))

    def matches(self, found: list[str]) -> Iterator[tuple[str, float, int, int, int]]:
        """(name, coverage, first, past, aligned words) of each place in order, none
        overlapping."""
        number = {w: k for k, w in enumerate(sorted(self.need))}
        at = np.array([i for i, w in enumerate(found) if w in self.need], dtype=np.int64)
        kind = [number[found[i]] for i in at.tolist()]
        # slide over the template's words: how many distinct ones follow within a window
        times = [0] * len(number)
        distinct = right = done = 0
        for left, start in enumerate(at.tolist()):
            while right < len(at) and at[right] < start + self.width:
                times[kind[right]] += 1
                distinct += times[kind[right]] == 1
                right += 1
            if distinct >= self.least and start >= done and found[start] in self.opens:
                window = found[start:start + self.width]
                missing = self.enough - longest_common(window, self.places)
                if missing > 0:
                    done = start + missing  # no window before has enough words in order
                else:
                    pairs = align(window, self.seq)
                    if len(pairs) >= self.enough and pairs[0][0] == 0 and self.decided(window, pairs):
                        done = start + pairs[-1][0] + 1
                        yield self.name, len(pairs) / len(self.seq), start, done, len(pairs)
            times[kind[left]] -= 1
            distinct -= times[kind[left]] == 0


class Scanner:
    def __init__(self, templates: dict[str, str], coverage: float = COVERAGE):
        self.templates = [t for name, text in templates.items() if (t := Template(name, text, coverage)).seq]

    def scan(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """Matches ``(template, coverage, first word, word past the last)`` in order."""
        found = words(text)
        have = set(found)
        every = [m for t in self.templates if len(have & t.need) >= t.least for m in t.matches(found)]
        every.sort(key=lambda m: (-m[4], -m[1], m[0], m[2]))
        starts: list[int] = []
        kept: list[tuple[str, float, int, int]] = []
        for name, share, first, past, _ in every:
            k = bisect_left(starts, first)
            if (k == len(starts) or starts[k] >= past) and (k == 0 or kept[k - 1][3] <= first):
                starts.insert(k, first)
                kept.insert(k, (name, share, first, past))
        return kept


def scan(docs: DataFrame, text: str = "text", templates: dict[str, str] | None = None,
         coverage: float = COVERAGE) -> DataFrame:
    """``docs`` with ``matches``: array of (license, coverage, first, past), the
    words counted from 0."""
    ship_package(docs.sparkSession)
    templates = dict(TEMPLATES if templates is None else templates)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(templates, coverage)
        for texts in batches:
            yield pd.Series([[{"license": n, "coverage": c, "first": a, "past": b} for n, c, a, b in scanner.scan(t)]
                             for t in texts])

    kind = "array<struct<license:string,coverage:double,first:long,past:long>>"
    return drop_clashes(docs, "matches").withColumn(
        "matches", F.pandas_udf(run, kind).asNondeterministic()(F.col(quoted(text))))
