"""License scans: MinHash bands over overlapping windows retrieve templates, exact containment verifies.

A template's windows are `slack` of its length longer than it and start that much apart, so each occurrence lies whole in
some window. Words are lower-cased and lose marks at their ends; shingles are `shingle` words. The bands of a
window are its least hashes under `bands` x `rows` hash functions; `bands` is set so that a window
of the least similarity a true match can have to its template misses every band with probability `miss` at most.
A window without any shingle of any template shares no least hash with one, so only the others
are hashed: that loses nothing. A retrieved template is verified by the exact share of its shingles
in the window; the best window of each text counts.

Nulls: a null text is empty and matches nothing; a null doc_id stays null. Repeated rows match each. Texts under
`shingle` words match nothing. An empty table gives an empty result; extra columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .store import arrow_limits, documents
from .toxicity import trimmed
from .words import Sequences, U, Words, chunks, column, mix

#: Whole texts of short public licenses, the notices of long ones, and characteristic passages.
TEMPLATES = {
    "0BSD-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "AGPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "BSD-2-Clause-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "BSD-3-Clause-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "BSD-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "BSL-1.0-text": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "LGPL-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
    "MIT": "Released under the MIT License.",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "Unlicense-text": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.",
    "Zlib-text": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
}


@dataclass(frozen=True)
class Scan:
    shingle: int = 3
    slack: float = 0.25
    rows: int = 2
    containment: float = 0.8
    miss: float = 1e-4
    seed: int = 11


def bands_for(similarity: float, rows: int, miss: float) -> int:
    """The least number of bands of so many rows that miss a pair of this similarity no oftener than asked."""
    return int(np.ceil(np.log(miss) / np.log1p(-(similarity**rows))))


class Shingles:
    """Shingle hashes of the trimmed words of a chunk; words that are only marks don't count."""

    def __init__(self, arr: pa.Array, k: int):
        w = Words(arr, lower=True)
        starts, ends = trimmed(w)
        digits = w.ends > w.starts
        # a word without letters stands as it is without its marks at the ends, such as 4.0
        bare = starts >= ends
        starts, ends = np.where(bare, w.starts, starts), np.where(bare, w.ends, ends)
        if len(w.data):
            mark = np.isin(w.data, np.frombuffer(b".,;:!?()\"'", np.uint8))
            while len(more := np.flatnonzero(bare & (starts < ends) & mark[np.maximum(ends - 1, 0)])):
                ends[more] -= 1
        keep = digits & (ends > starts)
        self.word = np.flatnonzero(keep)
        h = w.span_hash(starts[keep], ends[keep]) if keep.any() else np.zeros(0, U)
        self.doc = w.doc()[keep]
        self.first = np.searchsorted(self.doc, np.arange(w.rows + 1))
        at = np.arange(max(len(h) - k + 1, 0))
        self.h = Sequences(h).hashes(at, at + k)
        self.inside = self.doc[at] == self.doc[at + k - 1] if len(at) else np.zeros(0, bool)
        self.n = np.diff(self.first)
        self.own = self.word - w.first[self.doc]  # the number of the word in its text


class Templates:
    def __init__(self, texts: dict[str, str], s: Scan):
        self.names = sorted(texts)
        sh = Shingles(pa.array([texts[n] for n in self.names], pa.string()), s.shingle)
        self.sets = [np.unique(sh.h[a : max(a, b - s.shingle + 1)]) for a, b in zip(sh.first[:-1], sh.first[1:], strict=True)]
        self.length = np.diff(sh.first)
        if (self.length < s.shingle).any():
            raise ValueError("a template has fewer words than a shingle")
        self.stride = np.maximum(1, (self.length * s.slack).astype(int))
        self.window = self.length + self.stride
        self.all = np.unique(np.concatenate(self.sets))
        # shingles of a window: at most its words less k, and one; of a match, this share is the template's
        least = [s.containment * len(x) / (len(x) * (1 - s.containment) + self.window[i] - s.shingle + 1) for i, x in enumerate(self.sets)]
        self.bands = bands_for(min(least), s.rows, s.miss)
        self.salts = np.random.Generator(np.random.PCG64(s.seed)).integers(0, 1 << 63, self.bands * s.rows, dtype=np.uint64)
        self.keys = [self.band_keys([x], s)[0] for x in self.sets]

    def band_keys(self, sets: list[np.ndarray], s: Scan) -> np.ndarray:
        out = np.empty((len(sets), self.bands), U)
        for i, x in enumerate(sets):
            least = mix(x[None, :] ^ self.salts[:, None]).min(1).reshape(self.bands, s.rows)
            key = np.arange(self.bands).astype(U)
            for r in range(s.rows):
                key = mix(key * U(0x9E3779B97F4A7C15) + least[:, r])
            out[i] = key
        return out


def _matches(t: Templates, s: Scan, sh: Shingles) -> list[tuple[int, int, float, int, int, int]]:
    """(text, template, containment, first word, words, windows) of the best window of each text and template."""
    known = np.minimum(np.searchsorted(t.all, sh.h), len(t.all) - 1)
    spots = np.flatnonzero((t.all[known] == sh.h) & sh.inside)
    if not len(spots):
        return []
    best: dict[tuple[int, int], tuple] = {}
    doc = sh.doc[spots]
    own = spots - sh.first[doc]
    for window, stride in sorted({(int(a), int(b)) for a, b in zip(t.window, t.stride, strict=True)}):
        mine = [i for i in range(len(t.names)) if (t.window[i], t.stride[i]) == (window, stride)]
        # all windows that hold a known shingle: starts are multiples of the stride
        low = np.maximum(-(-(own + s.shingle - window) // stride), 0)
        high = own // stride
        n = np.maximum(high - low + 1, 0)
        at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        pairs = np.unique(np.stack((np.repeat(doc, n), at * stride), 1), axis=0)
        for d, a in pairs.tolist():
            end = min(a + window, int(sh.n[d]))
            part = np.unique(sh.h[sh.first[d] + a : sh.first[d] + max(a, end - s.shingle + 1)])
            if not len(part):
                continue
            keys = t.band_keys([part], s)[0]
            for i in mine:
                if (keys == t.keys[i]).any():
                    share = len(np.intersect1d(part, t.sets[i], assume_unique=True)) / len(t.sets[i])
                    if share >= s.containment:
                        held = best.get((d, i))
                        seen = held[5] if held else 0
                        if held is None or share > held[2]:
                            held = (d, i, share, int(sh.own[sh.first[d] + a]), end - a, 0)
                        best[d, i] = (*held[:5], seen + 1)
    return [best[k] for k in sorted(best)]


def scan(docs: DataFrame, texts: dict[str, str] | None = None, s: Scan = Scan()) -> DataFrame:
    """One row for each text and template that it holds: doc_id, license, containment, first_word, n_words, n_windows."""
    texts = texts or TEMPLATES
    arrow_limits(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = Templates(texts, s)
        for b in batches:
            for c in chunks(b):
                rows = _matches(t, s, Shingles(column(c, "text"), s.shingle))
                if rows:
                    ids = column(c, "doc_id").cast(pa.int64()).take(pa.array([r[0] for r in rows], pa.int64()))
                    yield pa.RecordBatch.from_arrays([ids, pa.array([t.names[r[1]] for r in rows]), *(pa.array([r[i] for r in rows], pa.float64() if i == 2 else pa.int64()) for i in (2, 3, 4, 5))], ["doc_id", "license", "containment", "first_word", "n_words", "n_windows"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, license string, containment double, first_word long, n_words long, n_windows long")


def op5_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))
