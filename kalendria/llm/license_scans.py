"""License scans: Dice coefficient over word bigrams against license templates.

Texts are normalised to lower-case ASCII words, so that line breaks, comment signs
and punctuation do not count. A passage is a run of words whose first and last
bigrams are the template's; its coefficient is that of its distinct bigrams and the
template's. With t the threshold and b the template's bigrams, the smaller side must
be at least t / (2 - t) of the larger: so only passages of b times (2 - t) / t
bigrams at most are looked at, and only from places behind which so many of the
template's distinct bigrams follow. Bigrams are looked up in an index of all
templates; most words of a text are in none, and cost one failed lookup each.

One pass, a row at a time, no shuffle.

Edge cases: null and empty texts, and those under two words, match nothing; ids may
be null or repeat, each row keeps its own result; of equal coefficients the passage
that begins first, then the shorter, stands for its template, and the template that
is listed first for its license; extra columns are not read; texts are read whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# License notices and short license texts, by SPDX name.
TEMPLATES: dict[str, list[str]] = {
    "AGPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the License.",
    ],
    "BSD-2-Clause": [
        "Licensed under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
        "in the documentation and/or other materials provided with the distribution.",
    ],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
        "in the documentation and/or other materials provided with the distribution. "
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission.",
    ],
    "BSL-1.0": [
        "Distributed under the Boost Software License, Version 1.0. See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "LGPL-2.1": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
        "as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ],
    "LGPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING '
        "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
        "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
        "arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely, subject to the following restrictions.",
    ],
}

#: Least Dice coefficient of a match.
THRESHOLD = 0.8
WORDS = re.compile(r"[a-z0-9]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.translate(FOLD) if not text.isascii() else text.lower())


def size_bounds(b: int, threshold: float) -> tuple[int, int]:
    """Least number of shared bigrams, and greatest of a passage's, with which a template of ``b`` can match."""
    ratio = threshold / (2 - threshold)
    return -int(-(b * ratio - 1e-9) // 1), int(b / ratio + 1e-9)


class LicenseIndex:
    """Templates by name, and for each bigram the templates that hold it."""

    def __init__(self, templates: dict[str, list[str]] | None = None, threshold: float = THRESHOLD):
        self.threshold = threshold
        flat = [(name, words_of(t)) for name, ts in sorted((templates or TEMPLATES).items()) for t in ts]
        self.names = [n for n, _ in flat]
        self.number = {w: i for i, w in enumerate(sorted({w for _, ws in flat for w in ws}))}
        self.bigrams = [{(self.number[a], self.number[b]) for a, b in zip(ws, ws[1:], strict=False)} for _, ws in flat]
        self.bounds = [size_bounds(len(b), threshold) for b in self.bigrams]
        self.holders: dict[tuple[int, int], list[int]] = {}
        for i, b in enumerate(self.bigrams):
            for g in b:
                self.holders.setdefault(g, []).append(i)

    def scan(self, text: str | None) -> list[tuple[str, float, int, int, str]]:
        """(name, coefficient, first word, end, passage) of each license's best passage that matches, in order of name."""
        words = words_of(text) if text else []
        at: dict[int, list[int]] = {}
        ids = list(map(self.number.get, words))
        for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False)):
            if a is not None and b is not None:
                for t in self.holders.get((a, b), ()):
                    at.setdefault(t, []).append(i)
        best: dict[str, tuple[float, int, int]] = {}
        for t in sorted(at):
            found = self._best(t, at[t], words, ids)
            name = self.names[t]
            if found and (name not in best or found[0] > best[name][0]):
                best[name] = found
        return [(n, s, i, j, " ".join(words[i:j])) for n, (s, i, j) in sorted(best.items())]

    def _best(self, t: int, places: list[int], words: list[str], ids: list[int | None]) -> tuple[float, int, int] | None:
        """(coefficient, first word, end) of the template's best passage."""
        (least, most), own = self.bounds[t], self.bigrams[t]
        if len(places) < least:
            return None
        best, ahead, upto = None, Counter(), 0
        for k, start in enumerate(places):
            while upto < len(places) and places[upto] < start + most:
                ahead[ids[places[upto]], ids[places[upto] + 1]] += 1
                upto += 1
            if len(ahead) >= least:
                seen, shared = set(), 0
                for p in range(start, places[upto - 1] + 1):
                    g = words[p], words[p + 1]
                    held = (ids[p], ids[p + 1]) in own
                    if g not in seen:
                        seen.add(g)
                        shared += held
                    if held and shared >= least:
                        score = 2 * shared / (len(seen) + len(own))
                        if score >= self.threshold and (best is None or score > best[0]):
                            best = score, start, p + 2
                if best and best[0] == 1.0:
                    return best
            first = ids[places[k]], ids[places[k] + 1]
            ahead[first] -= 1
            if not ahead[first]:
                del ahead[first]
        return best


MATCH = "array<struct<license:string,score:double,start:int,end:int,passage:string>>"


def scan_licenses(docs: DataFrame, templates: dict[str, list[str]] | None = None, threshold: float = THRESHOLD, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, matches) for each row of ``docs``: the best passage of each license, by falling coefficient and then name; places are in normalised words."""
    fields = [("license", pa.string()), ("score", pa.float64()), ("start", pa.int32()), ("end", pa.int32()), ("passage", pa.string())]
    kind_of = pa.list_(pa.struct(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = LicenseIndex(templates, threshold)
        for b in batches:
            found = [[dict(zip([n for n, _ in fields], m, strict=True)) for m in sorted(index.scan(x.as_py()), key=lambda m: (-m[1], m[0]))] for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, kind_of)], ["doc_id", "matches"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, matches {MATCH}")
