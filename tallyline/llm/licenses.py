"""Licence scan: Dice coefficient over word bigrams against licence templates.

A text is normalised (lower case, `licence` spelt `license`, words of letters
and digits) and compared in units: every line, every paragraph of several lines
(between blank lines) and the whole text. Dice of two bigram multisets is 2 * common / (sum of sizes), so a
unit of `a` bigrams reaches `threshold` t only with templates of a size from
a * t / (2 - t) to a * (2 - t) / t: the templates are kept by size and all
others are never looked at. Of a template of n bigrams at least n * t / (2 - t) must
occur, so one of its other-than-that-many-plus-one rarest does: only templates with
such an anchor in the text are compared, and phrases common to many licences
lead to none.

A notice inside a longer line or text is found by word windows: every window of
a size that the bounds allow, over the whole text. Cutting a window's ends down to
bigrams that the template holds never lowers its Dice, so only windows between
two such bigrams are tried, and only where enough of them lie near each other. The best
windows that do not overlap are the text's passages; none that reaches the
threshold is left beside them.

Templates are the bundled notices and short texts, and the whole texts in a folder of
licence files (a parameter; by default that of Debian and its kin, where it is
there): each as a whole, compared with units, and each of its paragraphs that no
other licence has, compared with units and windows. So a long licence is found
whole, and any part of it inside other text. Each task works on its own rows;
the templates travel with the code. No shuffle.

Defined cases: a null text, and a unit of fewer than two words, match nothing;
of equal scores the first template name wins; repeated documents are judged
alike; an empty table yields no rows; other columns travel in `row` and cannot
clash.
"""

from __future__ import annotations

import os
import re
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import map_arrow, read

THRESHOLD = 0.8
MAX_TEMPLATE_BYTES = 8 << 20
FOLDER = "/usr/share/common-licenses"
PARAGRAPH_WORDS = 20       # of a paragraph that is a template of its own
WINDOW_BIGRAMS = 1000      # larger templates are whole texts: found as units, and by their paragraphs inside other text

# Notices and texts of public licences as their stewards publish them.
TEMPLATES = {
    "all-rights-reserved": ["All rights reserved.", "Copyright. All rights reserved."],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        "law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ],
    "bsd-2-clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE "
        "ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
        "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
        "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, "
        "STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF "
        "ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ],
    "cc-by-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-nc-4.0": ["Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-sa-4.0": ["Licensed under CC BY-SA 4.0.",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "gpl-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" "
        "AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND "
        "FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
        "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
        "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
        "shall be included in all copies or substantial portions of the Software.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
        "shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY "
        "OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
        "USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
}

WORD = re.compile(r"[^\W_]+")
BLANK = re.compile(r"\n[^\S\n]*\n")



def words(text: str) -> list[str]:
    return ["license" + w[7:] if w.startswith("licence") else w for w in WORD.findall(text.lower())]


def bigrams(text: str) -> Counter:
    w = words(text)
    return Counter(zip(w, w[1:]))


def folder_templates(folder: str = FOLDER) -> dict[str, list[str]]:
    """License name -> its whole text and the paragraphs that only it has; nothing without such a folder."""
    texts = {}
    for file in sorted(os.listdir(folder)) if os.path.isdir(folder) else []:
        path = os.path.join(folder, file)
        if os.path.isfile(path) and not os.path.islink(path):
            with open(path, encoding="utf-8", errors="replace") as f:
                name = file.lower()
                texts[f"{name}.0" if re.search(r"-\d$", name) else name] = f.read()
    parts = {name: {" ".join(words(p)) for p in BLANK.split(t)} for name, t in texts.items()}
    seen = Counter(p for own in parts.values() for p in own)
    return {name: [t, *sorted(p for p in parts[name] if seen[p] == 1 and p.count(" ") >= PARAGRAPH_WORDS - 1)] for name, t in texts.items()}


def all_templates(folder: str = FOLDER) -> dict[str, list[str]]:
    more = folder_templates(folder)
    return {name: TEMPLATES.get(name, []) + more.get(name, []) for name in sorted({*TEMPLATES, *more})}


class Matcher:
    """Templates by size, and the templates that a bigram anchors."""

    def __init__(self, templates: dict[str, list[str]], threshold: float):
        made = [(name, bigrams(t)) for name in sorted(templates) for t in templates[name]]
        made = sorted(((sum(b.values()), name, b) for name, b in made if b), key=lambda x: x[:2])
        self.threshold, self.sizes, self.names = threshold, [x[0] for x in made], [x[1] for x in made]
        self.low = threshold / (2 - threshold) * (1 - 1e-12)      # a size just at a bound is not lost by rounding
        self.counts = [b for _, _, b in made]
        # common bigrams that a unit or window needs at least: as many as the smallest size that can reach the threshold
        self.need = [max(1, ceil(n * self.low - 1e-9)) for n in self.sizes]
        self.least = min(self.need, default=1)
        held_by = Counter(g for b in self.counts for g in b)
        self.anchors: dict[tuple, list[int]] = defaultdict(list)
        for k, b in enumerate(self.counts):
            missing = self.sizes[k] - self.need[k]                 # as many occurrences may be absent
            for g in sorted(b, key=lambda g: (held_by[g], g)):
                self.anchors[g].append(k)
                missing -= b[g]
                if missing < 0:
                    break
        self.anchors = dict(self.anchors)

    def best(self, w: list[str]) -> tuple[str, float] | None:
        """The template of the highest Dice at or above the threshold."""
        a = len(w) - 1
        lo, hi = bisect_left(self.sizes, a * self.low), bisect_right(self.sizes, a / self.low)
        if a < 1 or lo == hi:
            return None
        anchors = self.anchors
        near = {k for g in zip(w, w[1:]) if g in anchors for k in anchors[g] if lo <= k < hi}
        if not near:
            return None
        own = Counter(zip(w, w[1:]))
        found = []
        for k in near:
            template = self.counts[k]
            common = sum(min(n, template[g]) for g, n in own.items() if g in template)
            if 2 * common >= self.threshold * (a + self.sizes[k]):
                found.append((2 * common / (a + self.sizes[k]), k))
        if not found:
            return None
        dice, k = min(found, key=lambda x: (-x[0], self.names[x[1]]))
        return self.names[k], dice

    def passages(self, w: list[str]) -> list[tuple[str, float, int, int]]:
        """(name, Dice, first word, last word) of the best windows that do not overlap, in order of place."""
        out = []
        anchors, counts = self.anchors, self.counts
        near = {k for g in zip(w, w[1:]) if g in anchors for k in anchors[g] if self.sizes[k] <= WINDOW_BIGRAMS}
        if not near:
            return out
        index: dict[tuple, list[int]] = defaultdict(list)
        for k in near:
            for g in counts[k]:
                index[g].append(k)
        todo = [[(i, g) for i, g in enumerate(zip(w, w[1:])) if g in index]]
        while todo:
            part = todo.pop()
            if len(part) < self.least:
                continue
            taken: list[tuple[int, int]] = []
            for dice, _, a, name, b in sorted(self._windows(part, index)):
                at = bisect_left(taken, (a, b))
                if (at == len(taken) or taken[at][0] > b) and (not at or taken[at - 1][1] < a):
                    taken.insert(at, (a, b))
                    out.append((name, -dice, a, b))
            # what lies between the windows may hold others that overlapped with a better one
            i = 0
            for a, b in taken:
                j = i
                while part[j][0] + 1 < a:
                    j += 1
                todo.append(part[i:j])
                while j < len(part) and part[j][0] <= b:
                    j += 1
                i = j
            if taken:
                todo.append(part[i:])
        return sorted(out, key=lambda x: x[2])

    def _windows(self, held: list[tuple[int, tuple]], index: dict[tuple, list[int]]) -> Iterator[tuple[float, int, int, str, int]]:
        """The best window from each first bigram: (-Dice, -template size, first word, name, last word)."""
        by: dict[int, list[tuple[int, tuple]]] = defaultdict(list)
        for x in held:
            for k in index[x[1]]:
                by[k].append(x)
        for k, at in by.items():
            size, need, counts = self.sizes[k], self.need[k], self.counts[k]
            for x in range(len(at) - need + 1):
                first = at[x][0]
                if (at[x + need - 1][0] - first + 1) * self.low > size + 1e-9:
                    continue
                seen: Counter = Counter()
                common, best, last = 0, 0.0, 0
                for y in range(x, len(at)):
                    i, g = at[y]
                    a = i - first + 1
                    if a * self.low > size + 1e-9:
                        break
                    seen[g] += 1
                    common += seen[g] <= counts[g]
                    if 2 * common >= self.threshold * (a + size) and 2 * common / (a + size) > best:
                        best, last = 2 * common / (a + size), i + 1
                if best:
                    yield -best, -size, first, self.names[k], last


def word_places(text: str) -> list[tuple[int, int]]:
    """(start, stop) of each of the text's words, in code points of the text as it stands."""
    lower = text.lower()
    spans = [m.span() for m in WORD.finditer(lower)]
    if len(lower) == len(text):
        return spans
    of = [i for i, c in enumerate(text) for _ in c.lower()]
    return [(of[a], of[b - 1] + 1) for a, b in spans]


def units(text: str) -> Iterator[tuple[str, int, int]]:
    """(kind, start, stop) of the lines, the paragraphs of several lines, and the text, in code points."""
    at = 0
    for line in text.split("\n"):
        yield "line", at, at + len(line)
        at += len(line) + 1
    cuts = [0, *(x for m in BLANK.finditer(text) for x in m.span()), len(text)]
    parts = list(zip(cuts[::2], cuts[1::2]))
    if len(parts) > 1:
        yield from (("paragraph", a, b) for a, b in parts if "\n" in text[a:b].strip())
    if "\n" in text:
        yield "text", 0, len(text)


def scan_licenses(docs: DataFrame, row: Column | None = None, templates: dict[str, list[str]] | None = None,
                  threshold: float = THRESHOLD) -> DataFrame:
    """row, n_units, `matches`: license, Dice, unit kind and place of every unit that reaches the threshold, and `passages`: of every window."""
    templates = all_templates() if templates is None else templates
    if sum(len(t) for texts in templates.values() for t in texts) > MAX_TEMPLATE_BYTES:
        raise ValueError("templates are sent to every task; scan with parts of them in turn")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if row is None else row
    given = docs.select(row.alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    out = given.select("row", F.lit(0).cast("long").alias("n_units"),
                       F.expr("cast(array() as array<struct<license:string,dice:double,unit:string,start:int,stop:int>>)").alias("matches"),
                       F.expr("cast(array() as array<struct<license:string,dice:double,start:int,stop:int>>)").alias("passages"))
    kind = pa.list_(pa.struct([("license", pa.string()), ("dice", pa.float64()), ("unit", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))

    place = pa.list_(pa.struct([("license", pa.string()), ("dice", pa.float64()), ("start", pa.int32()), ("stop", pa.int32())]))

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(templates, threshold)
        for batch in batches:
            counts, found, inside = [], [], []
            for text in batch.column("text"):
                text = text.as_py()
                n, own = 0, []
                for unit, a, b in units(text):
                    n += 1
                    best = matcher.best(words(text[a:b]))
                    if best:
                        own.append({"license": best[0], "dice": best[1], "unit": unit, "start": a, "stop": b})
                counts.append(n)
                found.append(own)
                windows = matcher.passages(words(text))
                at = word_places(text) if windows else []
                inside.append([{"license": name, "dice": dice, "start": at[a][0], "stop": at[b][1]} for name, dice, a, b in windows])
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(counts, pa.int64()), pa.array(found, kind), pa.array(inside, place)],
                                              ["row", "n_units", "matches", "passages"])

    return map_arrow(given, tasks, out.schema)


def op4_license_dice(spark, sf_dir: str) -> DataFrame:
    found = scan_licenses(read(spark, sf_dir, "documents"), F.struct("doc_id"))
    both = lambda field: F.concat(*[F.transform(c, lambda m: m[field]) for c in ("matches", "passages")])
    return found.select(
        "row.doc_id", "n_units", F.size("matches").cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(both("license"))), ",").alias("licenses"),
        F.array_max(both("dice")).alias("best_dice"), F.size("passages").cast("long").alias("n_passages"))
