"""License scans: winnowed fingerprints pick candidates, banded alignment measures them.

Templates and texts are read as words of letters and digits, ASCII case ignored. Of a template's K-word
fingerprints the least in each window of SPAN is kept, in an inverted index; a text is probed with all of
its own, so that any run of K + SPAN - 1 equal words is found. Hits of one diagonal make a piece. Pieces of one
template that follow each other in template and text, with no more words between than the template has, are chained,
and aligned in bands around their diagonals. Coverage is the share of the template's words that the chain matches.
A chain with fewer than one in SPARSE of the template's fingerprints is not aligned: so many hits come by chance
where a long body shares phrases with a text. Of matches of several templates in the same words the one is told whose
matched words exceed the template's other words by most.

Texts are read whole; null and empty texts match nothing. Rows stand alone: a repeated row is reported
again. The index holds the templates only; its size does not depend on the texts.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from itertools import accumulate
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strataline.llm.shingles import _LOWER, blocks, mix, word_hashes

K, SPAN, BAND = 3, 2, 4
#: Hits with more words between them are two pieces of a chain.
GAP = 16
LEAST_COVERAGE = 0.75
SPARSE = 16

#: Permission texts, disclaimers and notices of public licenses.
MIT_PERMISSION = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
MIT_DISCLAIMER = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
BSD_CONDITIONS = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
BSD_NAMES = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
BSD_DISCLAIMER = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
ISC_PERMISSION = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
ISC_DISCLAIMER = "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."

#: Whole texts of the short licenses, and their parts, which are reported where the whole is not there.
TEMPLATES = {
    "0BSD": f"Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. {ISC_DISCLAIMER}",
    "AGPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "BSD-2-Clause": f"{BSD_CONDITIONS} {BSD_DISCLAIMER}",
    "BSD-3-Clause": f"{BSD_CONDITIONS} {BSD_NAMES} {BSD_DISCLAIMER}",
    "BSD-conditions": BSD_CONDITIONS,
    "BSD-disclaimer": BSD_DISCLAIMER,
    "BSL-1.0": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0-notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-NC-ND-4.0-notice": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "CC-BY-NC-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "CC-BY-ND-4.0-notice": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "CC-BY-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0-notice": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty.",
    "GPL-2.0-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-disclaimer": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "ISC": f"{ISC_PERMISSION} {ISC_DISCLAIMER}",
    "ISC-permission": ISC_PERMISSION,
    "LGPL-2.1-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "LGPL-3.0-header": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MIT": "Released under the MIT License.",
    "MIT-text": f"{MIT_PERMISSION} {MIT_DISCLAIMER}",
    "MIT-permission": MIT_PERMISSION,
    "MIT-disclaimer": MIT_DISCLAIMER,
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. This notice may not be removed or altered from any source distribution.",
}

#: Words of notices that tell a license from others; a match without one of them is none.
REQUIRED = {
    "AGPL-3.0-header": "affero 3",
    "Apache-2.0": "apache 2 0",
    "CC-BY-4.0": "commons attribution 4 0",
    "CC-BY-NC-4.0": "cc by nc 4 0",
    "CC-BY-NC-4.0-notice": "attribution noncommercial 4 0",
    "CC-BY-NC-ND-4.0-notice": "attribution noncommercial noderivatives 4 0",
    "CC-BY-NC-SA-4.0-notice": "attribution noncommercial sharealike 4 0",
    "CC-BY-ND-4.0-notice": "attribution noderivatives 4 0",
    "CC-BY-SA-4.0-notice": "attribution sharealike 4 0",
    "GPL-2.0-header": "gnu 2",
    "GPL-3.0": "gnu general public 3",
    "GPL-3.0-header": "gnu 3",
    "LGPL-2.1-header": "lesser 2 1",
    "LGPL-3.0-header": "lesser 3",
    "MIT": "mit",
}


def templates_in(folder: str) -> dict[str, str]:
    """Texts of the files in a folder by file name without ``.txt``, as ``templates`` of scan(): for whole bodies."""
    return {f.name.removesuffix(".txt"): f.read_text(encoding="utf-8", errors="replace") for f in sorted(Path(folder).iterdir()) if f.is_file()}


_PLAIN = _LOWER.copy()
_PLAIN[[b for b in range(128) if not chr(b).isalnum()]] = 0x20


def _words(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes(_PLAIN[np.frombuffer(raw + b" ", np.uint8)])


def _grams(words: np.ndarray) -> np.ndarray:
    n = max(0, len(words) - K + 1)
    out = np.zeros(n, np.uint64)
    for k in range(K):
        out = mix(out + words[k : k + n])
    return out


class Index:
    """Templates by their winnowed fingerprints."""

    def __init__(self, templates: dict[str, str]) -> None:
        self.names = list(templates)
        self.places: dict[int, list[tuple[int, int]]] = defaultdict(list)
        with np.errstate(over="ignore"):
            self.words = [_words(t.encode("utf-8", "replace"))[1] for t in templates.values()]
            wanted = [_words(REQUIRED.get(name, "").encode())[1] if t is TEMPLATES.get(name) else [] for name, t in templates.items()]
            self.required = [set(np.flatnonzero(np.isin(w, x)).tolist()) for w, x in zip(self.words, wanted, strict=True)]
            self.fewest = []
            for t, w in enumerate(self.words):
                g = _grams(w)
                kept = {i + int(np.argmin(g[i : i + SPAN])) for i in range(max(1, len(g) - SPAN + 1))} if len(g) else set()
                self.fewest.append(-(-len(kept) // SPARSE))
                for i in sorted(kept):
                    self.places[int(g[i])].append((t, i))
        self.keys = np.array(sorted(self.places), np.uint64)

    def hits(self, grams: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.keys[np.minimum(np.searchsorted(self.keys, grams), len(self.keys) - 1)] == grams)


def aligned(template: np.ndarray, text: np.ndarray, diagonal: int) -> list[tuple[int, int]]:
    """Longest common subsequence within BAND of a diagonal, as (template word, text word) pairs."""
    m, width = len(template), 2 * BAND + 1
    best = np.zeros((m + 1, width + 2), np.int32)
    at = diagonal + np.arange(-BAND, BAND + 1)
    for i in range(m - 1, -1, -1):
        j = i + at
        inside = (j >= 0) & (j < len(text))
        same = np.zeros(width, bool)
        same[inside] = text[j[inside]] == template[i]
        row = np.where(same, best[i + 1, 1:-1] + 1, best[i + 1, :-2])  # without the template's word: one diagonal less
        for k in range(width - 1, -1, -1):  # without the text's word: one diagonal more
            row[k] = max(row[k], best[i, k + 2])
            best[i, k + 1] = row[k]
    pairs, i, k = [], 0, 1 + int(np.argmax(best[0, 1:-1]))
    while i < m and best[i, k]:
        j = i + at[k - 1]
        if 0 <= j < len(text) and text[j] == template[i] and best[i, k] == best[i + 1, k] + 1:
            pairs.append((i, int(j)))
            i += 1
        elif k < width and best[i, k] == best[i, k + 1]:
            k += 1
        else:
            i, k = i + 1, k - 1
            if k < 1:
                break
    return pairs


def chains(pieces: list[tuple[int, int, int, int, int, int]], most_between: int) -> list[list[int]]:
    """Pieces (first and last text word, first and last template word, hits, diagonal), by text, in chains.

    The chain of most hits first; each piece is in one chain.
    """
    best, before = [p[4] for p in pieces], [-1] * len(pieces)
    low = 0
    reach = list(accumulate((p[1] for p in pieces), max))
    for b, (j0, _, i0, i1, hits, _) in enumerate(pieces):
        while reach[low] + most_between < j0:
            low += 1
        for a in range(low, b):
            pj0, pj1, pi0, pi1, _, _ = pieces[a]
            # They may overlap by the words of a hit, as at a place where words are missing.
            if pj0 < j0 <= pj1 + most_between and j0 > pj1 - K and pi0 < i0 and i0 > pi1 - K and i1 > pi1 and best[a] + hits > best[b]:
                best[b], before[b] = best[a] + hits, a
    out, used = [], set()
    for b in sorted(range(len(pieces)), key=lambda k: (-best[k], k)):
        chain = []
        while b >= 0 and b not in used:
            used.add(b)
            chain.append(b)
            b = before[b]
        if chain:
            out.append(chain[::-1])
    return out


def bands(diagonals: set[int]) -> list[int]:
    """Middles of so many bands that each diagonal lies in one."""
    out: list[int] = []
    for d in sorted(diagonals):
        if not out or d > out[-1] + BAND:
            near = [x for x in diagonals if d <= x <= d + 2 * BAND]
            out.append(min((d + max(near)) // 2, d + BAND))
    return out


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The most of the pairs that ascend in both numbers."""
    ends: list[int] = []
    tails: list[int] = []
    before: list[int] = []
    ordered = sorted(set(pairs), key=lambda p: (p[1], -p[0]))
    for n, (i, _) in enumerate(ordered):
        k = bisect_left(ends, i)
        before.append(tails[k - 1] if k else -1)
        ends[k : k + 1], tails[k : k + 1] = [i], [n]
    out, n = [], tails[-1] if tails else -1
    while n >= 0:
        out.append(ordered[n])
        n = before[n]
    return out[::-1]


def matches(index: Index, words: np.ndarray, grams: np.ndarray, least: float) -> list[tuple[str, float, int, int]]:
    """(template, coverage, first word, last word) of what a text holds."""
    diagonals: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for place in index.hits(grams):
        for t, i in index.places[int(grams[place])]:
            diagonals[t].append((int(place) - i, i))
    found_all = []
    for t, found in sorted(diagonals.items()):
        # Hits of one diagonal are a piece, or several where many words are between them.
        found.sort()
        cuts = [n for n in range(1, len(found)) if found[n][0] != found[n - 1][0] or found[n][1] - found[n - 1][1] > GAP]
        pieces = []
        for a, b in zip([0, *cuts], [*cuts, len(found)], strict=True):
            (d, i0), i1 = found[a], found[b - 1][1]
            pieces.append((d + i0, d + i1 + K - 1, i0, i1 + K - 1, b - a, d))
        pieces.sort()
        seen: list[tuple[int, int]] = []
        for chain in chains(pieces, len(index.words[t])):
            if sum(pieces[k][4] for k in chain) < index.fewest[t]:
                continue
            parts = [aligned(index.words[t], words, d) for d in bands({pieces[k][5] for k in chain})]
            pairs = parts[0] if len(parts) == 1 else increasing([p for part in parts for p in part])
            coverage = len(pairs) / len(index.words[t])
            if pairs and coverage >= least and index.required[t] <= {i for i, _ in pairs} and not any(a <= pairs[-1][1] and pairs[0][1] <= b for a, b in seen):
                seen.append((pairs[0][1], pairs[-1][1]))
                found_all.append((2 * len(pairs) - len(index.words[t]), coverage, t, np.array([j for _, j in pairs])))
    out, told = [], np.zeros(len(words), bool)
    for _, coverage, t, at in sorted(found_all, key=lambda m: (-m[0], -m[1], m[2], m[3][0])):
        if 2 * np.count_nonzero(told[at]) < len(at):
            told[at] = True
            out.append((t, coverage, int(at[0]), int(at[-1])))
    return [(index.names[t], *rest) for t, *rest in sorted(out)]


def scan(docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST_COVERAGE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per match: doc_id, license, coverage, begin and end (code points of the text)."""
    templates = TEMPLATES if templates is None else templates

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates)
        with np.errstate(over="ignore"):
            for batch in batches:
                texts, rows, found = batch.column("text").to_pylist(), [], []
                for some in blocks(texts):
                    coded = [(texts[i] or "").encode("utf-8", "replace") for i in some]
                    starts, words = _words(b" ".join(coded))
                    grams = _grams(words)
                    bounds = np.searchsorted(starts, np.cumsum([0, *[len(c) + 1 for c in coded]]))
                    holders = np.unique(np.searchsorted(bounds, index.hits(grams), side="right") - 1)
                    for k in holders:
                        raw, (at, own) = coded[k], _words(coded[k])
                        for name, coverage, first, last in matches(index, own, _grams(own), least):
                            end = int(at[last])
                            while end < len(raw) and _PLAIN[raw[end]] != 0x20:
                                end += 1
                            rows.append(some[k])
                            found.append((name, coverage, len(raw[: at[first]].decode("utf-8")), len(raw[:end].decode("utf-8"))))
                kinds = (pa.string(), pa.float64(), pa.int64(), pa.int64())
                # Ids of any type are picked, not converted.
                ids = batch.column("doc_id").take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, *[pa.array([m[k] for m in found], kind) for k, kind in enumerate(kinds)]], ["doc_id", "license", "coverage", "begin", "end"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, f"doc_id {kind}, license string, coverage double, begin bigint, end bigint")
