"""License scans: winnowed templates find candidates, banded alignment measures them.

The templates are a small, given set. Runs of `gram` words of each are hashed, and of every `window`
neighbouring hashes the smallest is kept; the kept runs form an inverted index that travels with the
task. All runs of a document are looked up, so any `gram + window - 1` consecutive words that a
document shares with a template are found. Hits near one diagonal, or near several that follow each
other around inserted or missing passages, are one occurrence, and a local alignment in a band around
them counts the template's words that are there and says where.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Notices and license texts as published.
TEMPLATES: dict[str, str] = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
        'IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. "
        "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
        "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE "
        "OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License."
    ),
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details. "
        "You should have received a copy of the GNU General Public License along with this program. If not, see "
        "https://www.gnu.org/licenses/."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND "
        'CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED '
        "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
        "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
        "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF "
        "USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
        "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
        "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of "
        "its contributors may be used to endorse or promote products derived from this software without specific "
        'prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND '
        "ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY "
        "AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS "
        "BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT "
        "NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
        "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
        "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF "
        "THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
}

WORDS = re.compile(rb"[a-z0-9]+")
MATCH, MISMATCH, GAP = 2, -1, -1


def word_list(text: str) -> list[bytes]:
    return WORDS.findall(text.encode("utf-8", "surrogatepass").lower())


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


@dataclass
class TemplateIndex:
    """Numbered words of the templates, and their winnowed runs: packed run -> (template, position)."""

    names: list[str]
    gram: int = 4
    window: int = 2
    numbers: dict[bytes, int] = field(default_factory=dict)
    words: list[np.ndarray] = field(default_factory=list)
    runs: np.ndarray = None
    places: list[list[tuple[int, int]]] = field(default_factory=list)

    @classmethod
    def of(cls, templates: Mapping[str, str], gram: int = 4, window: int = 2) -> TemplateIndex:
        index = cls(sorted(templates), gram, window)
        found = defaultdict(list)
        for t, name in enumerate(index.names):
            words = [index.numbers.setdefault(w, len(index.numbers)) for w in word_list(templates[name])]
            index.words.append(np.array(words, np.int64))
        if len(index.numbers) ** gram >= 1 << 63:
            raise ValueError("too many words in the templates for runs of this length")
        for t, words in enumerate(index.words):
            at, packed = index.packed(words)
            for i in index.winnow(_mix(packed.astype(np.uint64))):
                found[int(packed[i])].append((t, int(at[i])))
        index.runs = np.array(sorted(found), np.int64)
        index.places = [found[r] for r in index.runs.tolist()]
        return index

    def packed(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of runs of known words, and each run as one number; different runs differ."""
        n = len(words) - self.gram + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        unknown = np.concatenate(([0], np.cumsum(words < 0)))
        at = np.flatnonzero(unknown[self.gram :] == unknown[:n])
        out = np.zeros(len(at), np.int64)
        for i in range(self.gram):
            out = out * len(self.numbers) + words[at + i]
        return at, out

    def winnow(self, hashes: np.ndarray) -> list[int]:
        """Of every `window` neighbours the smallest hash, the last of equals."""
        kept = set()
        for a in range(max(len(hashes) - self.window + 1, min(len(hashes), 1))):
            part = hashes[a : a + self.window]
            kept.add(a + len(part) - 1 - int(part[::-1].argmin()))
        return sorted(kept)

    def hits(self, words: np.ndarray) -> dict[int, list[tuple[int, int]]]:
        """Diagonals (document position - template position) and template positions of the runs found, by template."""
        at, packed = self.packed(words)
        if not len(at) or not len(self.runs):
            return {}
        place = np.minimum(np.searchsorted(self.runs, packed), len(self.runs) - 1)
        out = defaultdict(list)
        for i in np.flatnonzero(self.runs[place] == packed).tolist():
            for t, p in self.places[place[i]]:
                out[t].append((int(at[i]) - p, p))
        return out


def align(doc: list[int], template: list[int], low: int, high: int) -> tuple[int, int, int, int] | None:
    """Best local alignment with diagonals from `low` to `high`: (score, matches, start, end) in the document."""
    best = (0, 0, 0, 0)
    before: dict[int, tuple[int, int, int]] = {}
    for j, word in enumerate(template):
        row: dict[int, tuple[int, int, int]] = {}
        left = (0, 0, 0)
        for i in range(max(j + low, 0), min(j + high + 1, len(doc))):
            s, m, a = before.get(i - 1, (0, 0, i))
            if s <= 0:
                s, m, a = 0, 0, i
            same = doc[i] == word
            cell = (s + MATCH, m + 1, a) if same else (s + MISMATCH, m, a)
            up = before.get(i)
            if up and up[0] + GAP > cell[0]:
                cell = (up[0] + GAP, up[1], up[2])
            if left[0] + GAP > cell[0]:
                cell = (left[0] + GAP, left[1], left[2])
            if cell[0] <= 0:
                cell = (0, 0, i + 1)
            row[i] = left = cell
            if cell[0] > best[0]:
                best = (cell[0], cell[1], cell[2], i + 1)
        before = row
    return best if best[1] else None


def chains(groups: list[list[int]], size: int) -> set[tuple[int, int]]:
    """Bands (low, high) over a group of hits and all that can follow it in one occurrence.

    A group follows if it goes on in the template and in the document. A passage of more than `size`
    words between two parts costs an alignment more than the smaller part gives.
    """
    out = set()
    for low, high, first, last in groups:
        near = groups[bisect_left(groups, [high - size]) : bisect_left(groups, [low + size + 1])]
        after = [g for g in near if g[2] > first and g[3] > last and g[1] + g[3] > high + last]
        if after:
            out.add((min(low, *[g[0] for g in after]), max(high, *[g[1] for g in after])))
    return out


def occurrences(index: TemplateIndex, words: np.ndarray, band: int, min_coverage: float) -> list[tuple[int, int, int, int]]:
    """(template, matched words, first word, end) of the occurrences that cover enough of a template."""
    out = []
    for t, hits in sorted(index.hits(words).items()):
        template = index.words[t]
        groups: list[list[int]] = []  # lowest and highest diagonal, first and last template position
        for d, p in sorted(set(hits)):
            if groups and d - groups[-1][1] <= band and d - groups[-1][0] <= 4 * band:
                groups[-1] = [groups[-1][0], d, min(groups[-1][2], p), max(groups[-1][3], p)]
            else:
                groups.append([d, d, p, p])
        found, bands = [], {(low, high) for low, high, _, _ in groups}
        for low, high in sorted(bands) + sorted(chains(groups, len(template)) - bands):
            a = max(low - band, 0)
            part = words[a : max(high + band + len(template), 0)].tolist()
            got = align(part, template.tolist(), low - band - a, high + band - a)
            if got and got[1] >= min_coverage * len(template):
                found.append((got[0], got[1], a + got[2], a + got[3]))
        taken: list[tuple[int, int, int]] = []
        for _, matched, start, end in sorted(found, key=lambda x: (-x[0], x[2])):
            if all(end <= s or start >= e for _, s, e in taken):
                taken.append((matched, start, end))
        out += [(t, *x) for x in sorted(taken, key=lambda x: x[1])]
    return out


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: Mapping[str, str] = TEMPLATES,
    min_coverage: float = 0.8,
    band: int = 4,
    gram: int = 4,
    window: int = 2,
) -> DataFrame:
    """One row per occurrence: doc_id, license, occurrence (from 0), matched_words, template_words, coverage, start, end.

    Words are runs of ASCII letters and digits, without regard to case. An occurrence counts if at
    least `min_coverage` of the template's words are matched in order within the band; start and end
    are code points of the original text. Occurrences of one template never overlap: the better one
    stays. Repeated rows are scanned each; null and empty texts and empty tables give no rows. It is
    row-local: one pass over the scan, no shuffle, whole texts.
    """
    index = TemplateIndex.of(templates, gram, window)
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = (
        f"doc_id {id_type}, license string, occurrence int, matched_words int, template_words int, coverage double, "
        "start long, end long"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = index.numbers.get
        for batch in batches:
            rows, ids = [], []
            for i, value in enumerate(batch.column(1)):
                data = (value.as_py() or "").encode("utf-8", "surrogatepass").lower()
                found = WORDS.findall(data)
                words = np.array([number(w, -1) for w in found], np.int64)
                hits = occurrences(index, words, band, min_coverage)
                places = _places(data, {w for _, _, start, end in hits for w in (start, end - 1)}) if hits else {}
                for n, (t, matched, start, end) in _numbered(hits):
                    size = len(index.words[t])
                    ids.append(i)
                    rows.append((index.names[t], n, matched, size, matched / size, places[start][0], places[end - 1][1]))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 7
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(ids, pa.int64())), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                ["doc_id", "license", "occurrence", "matched_words", "template_words", "coverage", "start", "end"],
            )

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def _numbered(found):
    seen = defaultdict(int)
    for x in found:
        yield seen[x[0]], x
        seen[x[0]] += 1


def _places(data: bytes, wanted: set[int]) -> dict[int, tuple[int, int]]:
    """Code points where each wanted word begins and ends, in one pass."""
    out, at, chars = {}, 0, 0
    for i, m in enumerate(WORDS.finditer(data)):
        if i in wanted:
            chars += len(data[at : m.start()].decode("utf-8", "surrogatepass"))
            out[i] = chars, chars + m.end() - m.start()
            at, chars = m.end(), chars + m.end() - m.start()
    return out
