"""Licence scans: normalised text against licence templates by Dice coefficient over word bigrams.

Texts and templates are normalised to lower-case words of letters and digits. For a
template of m bigrams and a threshold t, a passage of n bigrams can reach Dice >= t only
if t / (2 - t) * m <= n <= (2 - t) / t * m; passages are windows between two shared
bigrams within these bounds, so a template is compared only where enough of its bigrams
lie close together. Of overlapping findings the best stays.

Scale: a map over rows; templates are a small fixed table.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.schemas import plus

THRESHOLD = 0.8
WORD = re.compile(r"[^\W_]+")

# Wording of common licence statements, notices and short licences, by SPDX name.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                   "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
                   "either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
            "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
            "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
            "Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
            "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
            "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE "
            "OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
            "copyright notice and this permission notice appear in all copies."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
                     "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
                     "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
                     "documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
                     "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
                     "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
                     "documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its "
                     "contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                "the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
                "file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
)


class Scanner:
    """Templates as counts of word bigrams; words outside all templates have number 0."""

    def __init__(self, templates: tuple[tuple[str, str], ...], threshold: float = THRESHOLD):
        if not 0 < threshold <= 1:
            raise ValueError("a threshold over 0, up to 1")
        self.threshold = threshold
        self.names = [name for name, _ in templates]
        texts = [WORD.findall(text.lower()) for _, text in templates]
        self.number = {w: i + 1 for i, w in enumerate(sorted({w for t in texts for w in t}))}
        self.base = len(self.number) + 1
        self.counts = [Counter(self.bigrams(np.array([self.number[w] for w in t])).tolist()) for t in texts]
        self.size = [sum(c.values()) for c in self.counts]
        known = sorted({b for c in self.counts for b in c})
        self.known = np.array(known, dtype=np.int64)
        self.users = {b: [k for k, c in enumerate(self.counts) if b in c] for b in known}

    def bigrams(self, numbers: np.ndarray) -> np.ndarray:
        numbers = numbers.astype(np.int64)
        both = (numbers[:-1] > 0) & (numbers[1:] > 0)
        return np.where(both, numbers[:-1] * self.base + numbers[1:], 0)

    def scan(self, text: str | None) -> list[tuple[int, float, int, int]]:
        """(template, Dice, first character, end) of the findings in a whole text, in text order."""
        low = (text or "").lower()
        if len(low) != len(text or ""):  # lower case of another length would shift the places
            low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        get = self.number.get
        numbers = np.array([get(w, 0) for w in WORD.findall(low)], dtype=np.int64)
        if numbers.size < 2:
            return []
        pairs = self.bigrams(numbers)
        places = np.flatnonzero(np.isin(pairs, self.known)) if pairs.any() else np.empty(0, np.int64)
        if not places.size:
            return []
        found = []
        of = [self.users[b] for b in pairs[places].tolist()]
        for k in sorted({k for users in of for k in users}):
            mine = places[[k in users for users in of]]
            found += [(dice, k, a, b) for dice, a, b in self.windows(k, mine, pairs[mine])]
        found.sort(key=lambda f: (-f[0], -self.size[f[1]], f[2], f[1]))
        taken: list[tuple[float, int, int, int]] = []
        for f in found:
            if all(f[3] < t[2] or f[2] > t[3] for t in taken):
                taken.append(f)
        if not taken:
            return []
        spans = [m.span() for m in WORD.finditer(low)]
        return sorted(((k, dice, spans[a][0], spans[b + 1][1]) for dice, k, a, b in taken), key=lambda f: f[2])

    def windows(self, k: int, at: np.ndarray, pairs: np.ndarray) -> list[tuple[float, int, int]]:
        """(Dice, first bigram, last bigram): per start the best window that reaches the threshold."""
        t, m, need = self.threshold, self.size[k], self.counts[k]
        longest, shortest = int((2 - t) / t * m + 1e-9), t / (2 - t) * m - 1e-9
        names, number = np.unique(pairs, return_inverse=True)
        limit = np.array([need[b] for b in names.tolist()])
        # how many equal bigrams stand before each one
        order = np.argsort(number, kind="stable")
        first = np.searchsorted(number[order], np.arange(names.size))
        rank = np.empty(at.size, dtype=np.int64)
        rank[order] = np.arange(at.size) - first[number[order]]
        out, passed = [], np.zeros(names.size, dtype=np.int64)
        for s in range(at.size):
            e = int(np.searchsorted(at, at[s] + longest, side="left"))
            if e - s >= shortest * t:  # Dice * (n + m) / 2 shared bigrams are needed, n >= shortest
                hit = (rank[s:e] - passed[number[s:e]]) < limit[number[s:e]]
                length = at[s:e] - at[s] + 1
                dice = 2 * np.cumsum(hit) / (length + m)
                dice[length < shortest] = 0
                best = int(np.argmax(dice))
                if dice[best] >= t:
                    out.append((float(dice[best]), int(at[s]), int(at[s + best])))
            passed[number[s]] += 1
        return out


def scan_licenses(docs: DataFrame, text_col: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES,
                  threshold: float = THRESHOLD, out: str = "licenses") -> DataFrame:
    """``docs`` without the text, then ``out``: array of (license, dice, begin, end) in
    text order, places in code points. Null and empty texts and texts without findings
    have an empty array. One output row per input row; a column named like ``out`` is
    replaced. Templates of fewer than two words never match."""
    carried = [c for c in docs.columns if c not in (text_col, out)]
    scanner = Scanner(templates, threshold)
    item = pa.struct([("license", pa.string()), ("dice", pa.float64()), ("begin", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[{"license": scanner.names[k], "dice": d, "begin": a, "end": b} for k, d, a, b in scanner.scan(t.as_py())]
                     for t in batch.column(len(carried))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(carried)], pa.array(found, pa.list_(item))], [*carried, out])

    source = docs.select(*carried, F.col(text_col).cast("string").alias(text_col))
    schema = plus(source.select(*carried).schema, f"`{out}` array<struct<license:string,dice:double,begin:bigint,end:bigint>>")
    return source.mapInArrow(run, schema)
