"""Licence scan: passages of documents against licence texts by the Dice coefficient of word bigrams.

Texts are normalised to lower-case words of letters and digits. A passage is any run of
consecutive words of a document, over sentences, lines and paragraphs. A run with n distinct
bigrams, c of them in a template of m, has the Dice coefficient 2c / (m + n), so it reaches d
only if n lies between m * d / (2 - d) and m * (2 - d) / d and c is at least m * d / (2 - d).
Templates of which a document, and then a stretch of it, has fewer bigrams are passed over;
in the stretches left, every run that begins at a bigram of the template is compared.

Templates are a parameter, a short list by nature (identifier, text); they travel with the
task. Documents never leave their partition.

Of passages that overlap, a template keeps its nearest. Of passages of several templates that
share more than half of the words they cover together, the nearest is reported; a notice
inside a much longer passage is reported beside it.

Defined cases: a null or empty text has no passages; a template of one word is compared with
sentences of one word; a passage that is just a sentence, line, paragraph or text is named so
(the smallest of them), others are windows; ties between templates go to the smaller
identifier; other columns are not read.
"""

from __future__ import annotations

import bisect
import pkgutil
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ALNUM, Words, by_block, mix

LEAST_DICE = 0.85

# Short notices, then the whole public texts and notices.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
        this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
        "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
        HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
        the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License.""",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details.""",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    (
        "CC-BY-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    (
        "CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    ("BSD", "Licensed under the BSD License."),
    (
        "MPL-2.0",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    ),
    (
        "Unlicense",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
        use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
        commercial or non-commercial, and by any means.""",
    ),
]

#: Whole texts in ``licence_texts``, and those of them that also have a notice for source files.
TEXTS = "0BSD AGPL-3.0 Apache-2.0 BSD-2-Clause BSD-3-Clause GPL-2.0 GPL-3.0 ISC LGPL-2.1 LGPL-3.0 MPL-2.0 Unlicense".split()
NOTICES = "AGPL-3.0 GPL-2.0 GPL-3.0 LGPL-2.1 LGPL-3.0".split()


def whole_text(file: str) -> str:
    return pkgutil.get_data("tidemark.llm", f"licence_texts/{file}.txt").decode()


TEMPLATES += [(name, whole_text(name)) for name in TEXTS] + [(name, whole_text(f"{name}.notice")) for name in NOTICES]

_STEP = np.uint64(0x9FB21C651E98DF25)
#: Bytes after which a unit of each size ends (sentence, line, paragraph); the whole text is the last unit.
_ENDS = [re.compile(rb"[.!?]\s|\n"), re.compile(rb"\n"), re.compile(rb"\n[ \t\r]*\n")]
UNITS = ("sentence", "line", "paragraph", "text")
_MASK = np.uint64((1 << 20) - 1)


def bigrams(ids: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bigram ids and their units; a unit of one word has the bigram of that word and nothing."""
    if not len(ids):
        return ids, unit
    last = np.append(unit[1:] != unit[:-1], True)
    alone = last & np.append(True, unit[1:] != unit[:-1])
    follow = np.where(last, np.uint64(0), np.append(ids[1:], np.uint64(0)))
    keep = ~last | alone
    return mix(ids * _STEP + follow)[keep], unit[keep]


def size_bounds(n: int, dice: float) -> tuple[float, float]:
    """Sizes of bigram sets that can reach ``dice`` with a set of ``n``."""
    return n * dice / (2 - dice), n * (2 - dice) / dice


class Templates:
    """Bigram sets of the licence texts, and for each known bigram the templates that have it."""

    def __init__(self, templates):
        self.names = [name for name, _ in templates]
        self.sets = []
        for _, text in templates:
            words = Words(pa.array([text]), ALNUM)
            self.sets.append(np.unique(bigrams(words.ids(), words.doc)[0]))
        self.sizes = np.array([len(s) for s in self.sets], np.int64)
        grams = np.concatenate([*self.sets, np.zeros(0, np.uint64)])
        order = np.argsort(grams, kind="stable")
        self.owners = np.repeat(np.arange(len(self.sets)), self.sizes)[order]
        self.known, self.first = np.unique(grams[order], return_index=True)
        self.counts = np.diff(np.append(self.first, len(grams)))
        self.likely = np.zeros(1 << 20, bool)
        self.likely[(self.known & _MASK).astype(np.int64)] = True

    def numbers(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the known bigrams among ``pairs``, and their numbers in ``known``."""
        at = np.flatnonzero(self.likely[(pairs & _MASK).astype(np.int64)])
        number = np.minimum(np.searchsorted(self.known, pairs[at]), max(len(self.known) - 1, 0))
        same = self.known[number] == pairs[at] if len(at) else np.zeros(0, bool)
        return at[same], number[same]

    def candidates(self, pairs: np.ndarray, doc: np.ndarray, n_docs: int, least: float) -> np.ndarray:
        """(document, template) of which the document has enough distinct bigrams for a passage."""
        at, number = self.numbers(pairs)
        own = np.unique(doc[at] * len(self.known) + number)
        row, number = own // max(len(self.known), 1), own % max(len(self.known), 1)
        n = self.counts[number]
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        owner = self.owners[np.repeat(self.first[number], n) + inner]
        k = len(self.sets)
        seen = np.bincount(np.repeat(row, n) * k + owner, minlength=n_docs * k).reshape(n_docs, k)
        return np.argwhere(seen >= np.maximum(size_bounds(self.sizes, least)[0] - 1e-9, 1))


def _reach(before: np.ndarray, a: int, count_from: int, most: float, stop: int) -> int:
    """End of the longest run from ``a`` to ``stop`` whose places from ``count_from`` on have at most ``most`` bigrams new since ``a``."""
    size = int(2 * most) + 2 + count_from - a
    while True:
        new = np.cumsum(before[count_from : min(a + size, stop)] < a)
        if len(new) and new[-1] > most:
            return count_from + int(np.searchsorted(new, most, "right"))
        if a + size >= stop:
            return stop
        size *= 2


def passages(hit: np.ndarray, before: np.ndarray, after: np.ndarray, m: int, least: float) -> list[tuple[float, int, int]]:
    """(Dice, first, end) of the nearest runs of bigrams from ``least`` on that do not overlap.

    ``hit`` tells whether a bigram is one of the template's ``m``; ``before`` and ``after`` are
    the places of the same bigram before and after, -1 and the length without one. A run counts
    each bigram once, so a run without its first place is as near if that bigram comes again:
    runs are compared up to there, and those kept take in repeated bigrams at their ends.
    """
    low, high = size_bounds(m, least)
    low, high = low - 1e-9, high + 1e-9
    step = max(16, m // 8)
    found = []
    for a in np.unique(np.flatnonzero(hit) // step) * step:
        starts = a + np.flatnonzero(hit[a : a + step])
        # none of the runs that begin here has more bigrams of the template than the longest from a on
        end = _reach(before, a, min(a + step, len(hit)), high, max(int(after[starts].max()), min(a + step, len(hit))))
        if np.count_nonzero(hit[a:end] & (before[a:end] < a)) < low:
            continue
        for i in starts:
            end = _reach(before, i, i, high, int(after[i]))
            new = before[i:end] < i
            common = np.cumsum(new & hit[i:end])
            if common[-1] < low:
                continue
            dice = 2 * common / (m + np.cumsum(new))
            j = int(np.argmax(dice))
            if dice[j] >= least:
                found.append((float(dice[j]), int(i), int(i) + j + 1))
    found.sort(key=lambda f: (-f[0], f[1], f[2]))
    taken = np.zeros(len(hit), bool)
    out = []
    for dice, i, j in found:
        if taken[i:j].any():
            continue
        while i and hit[i - 1] and after[i - 1] < j and not taken[i - 1]:
            i -= 1
        while j < len(hit) and hit[j] and before[j] >= i and not taken[j]:
            j += 1
        taken[i:j] = True
        out.append((dice, i, j))
    return out


def _nearest(found: list[tuple]) -> list[tuple]:
    """Of (-Dice, name, first word, words), those that share no place with a nearer one."""
    kept: list[tuple] = []  # first word, words, -Dice, name
    for d, name, first, n in sorted(found, key=lambda f: (f[0], f[1], -f[3], f[2])):
        a, b = bisect.bisect_left(kept, (first - 2 * n,)), bisect.bisect_left(kept, (first + n,))
        if not any(_same_place((first, n), o) for o in kept[a:b]):
            bisect.insort(kept, (first, n, d, name))
    return kept


def _same_place(a: tuple, b: tuple) -> bool:
    """Whether two (first word, words, ..) share more than half of the words they cover together."""
    both = min(a[0] + a[1], b[0] + b[1]) - max(a[0], b[0])
    return 2 * both > a[1] + b[1] - both


def _neighbours(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the same bigram before and after each place; -1 and the length without one."""
    order = np.argsort(pairs, kind="stable")
    before, after = np.full(len(pairs), -1, np.int64), np.full(len(pairs), len(pairs), np.int64)
    same = pairs[order[1:]] == pairs[order[:-1]]
    before[order[1:][same]] = order[:-1][same]
    after[order[:-1][same]] = order[1:][same]
    return before, after


def _single_words(templates: Templates, ids: np.ndarray, unit: np.ndarray) -> list[tuple[int, int]]:
    """(word, template) of sentences of one word that are a template."""
    alone = np.append(True, unit[1:] != unit[:-1]) & np.append(unit[1:] != unit[:-1], True)
    words = np.flatnonzero(alone) if len(ids) else np.zeros(0, np.int64)
    at, number = templates.numbers(mix(ids[words] * _STEP))
    owners = [templates.owners[f : f + n] for f, n in zip(templates.first[number], templates.counts[number], strict=True)]
    return [(int(words[w]), int(k)) for w, own in zip(at, owners, strict=True) for k in own if templates.sizes[k] == 1]


FOUND = "doc_id bigint, matches array<struct<licence:string,dice:double,unit:string,first_word:bigint,n_words:bigint>>"
_KIND = pa.list_(
    pa.struct([("licence", pa.string()), ("dice", pa.float64()), ("unit", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64())])
)


def _scan_block(templates: Templates, least: float):
    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(block.column("text"), ALNUM)
        ids, doc = words.ids(), words.doc
        raw = words.data.tobytes()
        units = []
        for ends in _ENDS:
            cuts = np.array([m.end() for m in ends.finditer(raw)], np.int64)
            units.append(np.searchsorted(np.unique(np.concatenate([cuts, words.offsets])), words.start, "right"))
        units.append(doc)
        found: list[list] = [[] for _ in range(len(block))]
        for w, k in _single_words(templates, ids, units[0]):
            found[doc[w]].append((-1.0, templates.names[k], w, 1))
        inside = np.append(doc[1:] == doc[:-1], False) if len(doc) else np.zeros(0, bool)
        starts = np.flatnonzero(inside)  # first word of each bigram
        pairs = mix(ids[starts] * _STEP + ids[starts + 1]) if len(starts) else np.zeros(0, np.uint64)
        owner, last = doc[starts], None
        for row, k in templates.candidates(pairs, owner, len(block), least):
            if row != last:
                a, b = np.searchsorted(owner, [row, row + 1])
                (before, after), last = _neighbours(pairs[a:b]), row
            hit = np.isin(pairs[a:b], templates.sets[k])
            for dice, i, j in passages(hit, before, after, int(templates.sizes[k]), least):
                found[row].append((-dice, templates.names[k], int(starts[a + i]), j - i + 1))

        def kind(first: int, n: int) -> str:
            for name, unit in zip(UNITS, units, strict=True):
                a, b = np.searchsorted(unit, [unit[first], unit[first] + 1])
                if (a, b) == (first, first + n):
                    return name
            return "window"

        rows = []
        for row, f in enumerate(found):
            rows.append([
                {"licence": name, "dice": -d, "unit": kind(a, n), "first_word": int(a - words.first_word[row]), "n_words": n}
                for a, n, d, name in _nearest(f)
            ])
        arrays = [block.column("doc_id").cast(pa.int64()), pa.array(rows, _KIND)]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "matches"])

    return work


def scan(docs: DataFrame, templates=None, least: float = LEAST_DICE) -> DataFrame:
    """``matches`` of each document (doc_id, text): licence, dice, unit and the words it covers."""
    ready = Templates(TEMPLATES if templates is None else templates)
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(by_block(_scan_block(ready, least)), FOUND)


def licences(docs: DataFrame, templates=None, least: float = LEAST_DICE) -> DataFrame:
    """Per document: its licences by name, the best one and its Dice coefficient."""
    rows = scan(docs, templates, least)
    best = F.array_min(F.transform("matches", lambda m: F.struct((-m.dice).alias("d"), m.licence.alias("l"))))
    return rows.select(
        "doc_id",
        F.size("matches").cast("bigint").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.col("matches.licence"))), ",").alias("licences"),
        best.l.alias("best"),
        (-best.d).alias("best_dice"),
    )
