"""License scans: MinHash bands over overlapping text windows, then exact shingle containment."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelpline.llm.bytetools import buffers, hash_words, shingles, slices, words

#: Well-known license notices, by identifier. More, or others, can be given to ``scan_licenses``.
TEMPLATES: dict[str, str] = {
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "MIT-line": "Released under the MIT License.",
    "MIT": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "GPL-2.0-line": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "LGPL-2.1-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
    "AGPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.",
    "BSD-3-Clause": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "CC0-1.0": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    "BSL-1.0": 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so.',
    "WTFPL": "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
}

#: One hash a band: a window of up to four times a template's shingles that holds 0.8 of them has a Jaccard
#: similarity of 0.19 at least, and meets it in one of 64 bands with probability 1 - 0.81**64 > 0.999998.
BANDS = 64
#: Shingles in a block; a window is two neighbouring blocks of 4, 8, 16 ... shingles, stepping by one block.
BLOCK = 4
CONTAINMENT = 0.8

_rng = np.random.default_rng(20)
_XOR = _rng.integers(0, 1 << 32, BANDS, dtype=np.uint32)
_ODD = _rng.integers(0, 1 << 31, BANDS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


@dataclass
class Templates:
    """Distinct shingles of each template, grouped by the block size that covers its whole length; ``variants`` share half of either's."""

    names: list[str]
    sets: list[np.ndarray]
    levels: list[int]
    signatures: np.ndarray
    variants: list[list[str]]


def _signature(values: np.ndarray) -> np.ndarray:
    low = (values >> np.uint64(32)).astype(np.uint32)
    return ((low[None, :] ^ _XOR[:, None]) * _ODD[:, None]).min(1)


def prepare(templates: Mapping[str, str]) -> Templates:
    """Templates of at least one word; one of fewer than five words is a single shingle of all its words."""
    names, sets, lengths = [], [], []
    for name, text in sorted(templates.items()):
        h = hash_words([text])[0]
        values, _ = shingles(h, np.zeros(len(h), np.int64), 1)
        if len(values):
            names.append(name)
            sets.append(np.unique(values))
            lengths.append(len(values))
    levels = [max(0, int(np.ceil(np.log2(n / BLOCK)))) for n in lengths]
    variants = [[names[j] for j, b in enumerate(sets) if j != i and 2 * np.isin(a, b).sum() >= min(len(a), len(b))] for i, a in enumerate(sets)]
    return Templates(names, sets, levels, np.array([_signature(s) for s in sets]).reshape(-1, BANDS), variants)


def _windows(values: np.ndarray, of: np.ndarray, known: Templates) -> list[tuple[int, int, int]]:
    """Candidates (first shingle, past the last, template): windows that share a band's minimum with a template of their size."""
    if not len(values) or not known.names:
        return []
    heads = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    starts = np.concatenate([np.arange(a, b, BLOCK) for a, b in zip(heads, [*heads[1:], len(values)], strict=True)])
    low = (values >> np.uint64(32)).astype(np.uint32)
    ends, text = np.append(starts[1:], len(values)), of[starts]
    top = max(known.levels)
    levels = [(starts, ends, text)]
    for _ in range(top):
        s, e, t = levels[-1]
        # every other block of a text starts a block of the next size
        first = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
        order = np.arange(len(s)) - np.repeat(first, np.diff(np.append(first, len(s))))
        lead = np.flatnonzero(order % 2 == 0)
        levels.append((s[lead], np.append(s[lead][1:], len(values)), t[lead]))
    found: set[tuple[int, int, int]] = set()
    for band in range(BANDS):
        x = (low ^ _XOR[band]) * _ODD[band]
        mins = np.minimum.reduceat(x, levels[0][0])
        for level in range(top + 1):
            s, e, t = levels[level]
            if level:
                at = np.searchsorted(levels[level - 1][0], s)
                mins = np.minimum.reduceat(mins, at)
            own = np.flatnonzero(np.array(known.levels) == level)
            if not len(own):
                continue
            signs = np.sort(known.signatures[own, band])
            hit = np.flatnonzero(signs[np.minimum(np.searchsorted(signs, mins), len(signs) - 1)] == mins)
            for b in hit.tolist():
                # the block may be either half of the window
                for lo in (b - 1, b):
                    hi = lo + 1
                    if lo < 0 or t[lo] != t[b]:
                        lo = b
                    if hi >= len(s) or t[hi] != t[b]:
                        hi = b
                    found.update((int(s[lo]), int(e[hi]), int(k)) for k in own[known.signatures[own, band] == mins[b]])
    return sorted(found)


def _matches(part: pa.RecordBatch, known: Templates, containment: float) -> tuple[np.ndarray, list[dict[str, float]]]:
    hashes, owner, _, _ = words(*buffers(part.column("text")))
    values, of = shingles(hashes, owner, part.num_rows)
    best: list[dict[str, float]] = [{} for _ in range(part.num_rows)]
    for a, b, k in _windows(values, of, known):
        share = float(np.isin(known.sets[k], values[a:b]).mean())
        if share >= containment:
            name = known.names[k]
            best[of[a]][name] = max(share, best[of[a]].get(name, 0.0))
    for names in best:
        # of variants of one text that which fits best, as each holds most of the other's words
        weaker = [n for n in names if any(names.get(v, 0.0) > names[n] for v in known.variants[known.names.index(n)])]
        for n in weaker:
            del names[n]
    return np.bincount(owner, minlength=part.num_rows), best


def scan_licenses(df: DataFrame, *, templates: Mapping[str, str] = TEMPLATES, containment: float = CONTAINMENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, licenses (template ids in order) and containment (the share of each one's shingles found in one window).

    Shingles are five words, A-Z as a-z, punctuation aside. A window of two neighbouring blocks is as long
    as twice its templates, so wherever a template stands, some window holds all of it. A band's
    minimum over a window is the smaller of its blocks', so a window meets a template where either
    block does. What is retrieved is verified by exact containment in the window. Of templates that share half of their
    shingles, such as versions of one notice, those are left out that a text holds less of than of another.

    Null and empty texts have no words and no licenses; a text of fewer than five words is one shingle of
    all its words; equal rows are separate rows; columns that are not named are ignored.
    """
    known = prepare(templates)
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            n_words, best = _matches(part, known, containment)
            names = [sorted(x) for x in best]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(names, pa.list_(pa.string())), pa.array([[x[n] for n in k] for x, k in zip(best, names, strict=True)], pa.list_(pa.float64()))], names=["doc_id", "n_words", "licenses", "containment"])

    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("n_words", T.LongType()), T.StructField("licenses", T.ArrayType(T.StringType())), T.StructField("containment", T.ArrayType(T.DoubleType()))])
    return rows.mapInArrow(run, schema)
