"""License notices found by MinHash bands over overlapping windows.

Texts and templates are cut into shingles of five words (a shorter template is
one shingle). Windows of a template's length overlap by seven eighths; a window
without any template shingle cannot match and is not signed. Signatures of 32
MinHashes in 16 bands of 2 retrieve templates: a window that holds 0.8 of a
template and is off by a sixteenth of its length has a Jaccard similarity of
0.584 or more, so it collides in some band with probability 0.9987 or more. A
retrieved template is then verified by the exact share of its shingles in the
window. Licenses of one family differ in a word, a number or a clause, which that
share cannot see. So where a template departs from a similar one of another
license, the word that comes next must stand in the window behind the same word,
and so must every word with a digit. Where a template lies within another's, the
longer one counts if both match at a place.
"""

from __future__ import annotations

import difflib
from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright.llm.arrays import NOT_ALNUM, mixed, range_hashes, slices, words

SHINGLE = 5
CONTAINMENT = 0.8
BANDS, ROWS = 16, 2

#: Notices by SPDX identifier.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Apache License Version 2.0, January 2004",
        "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "MIT-0": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
        "GNU General Public License Version 2, June 1991",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "GNU General Public License Version 3, 29 June 2007",
        "The GNU General Public License is a free, copyleft license for software and other kinds of works. The licenses for most software and other practical works are designed to take away your freedom to share and change the works.",
    ),
    "LGPL-2.1": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "GNU Lesser General Public License Version 2.1, February 1999",
    ),
    "LGPL-3.0": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "GNU Lesser General Public License Version 3, 29 June 2007",
    ),
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "GNU Affero General Public License Version 3, 19 November 2007",
        "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed to ensure cooperation with the community in the case of network server software.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
        "Licensed under the Mozilla Public License, version 2.0.",
    ),
    "BSD-2-Clause": (
        "Licensed under the BSD 2-Clause License.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS",
    ),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    "BSD-4-Clause": (
        "All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by",
    ),
    "0BSD": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "Zlib": (
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    "BSL-1.0": ("Distributed under the Boost Software License, Version 1.0.",),
    "EPL-2.0": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",),
    "CC0-1.0": ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-NC-SA-4.0": ("Licensed under CC BY-NC-SA 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    "all-rights-reserved": ("All rights reserved.",),
}
#: A machine-readable line that names a license.
TAG = "SPDX-License-Identifier: {}"
#: Templates whose words are this similar (difflib's ratio) are looked at for what tells them apart.
ALIKE = 0.5
#: Words that two templates share before they depart from each other, unless they begin so.
COMMON = 3


def notices(texts: Mapping[str, Sequence[str]] = TEMPLATES) -> list[tuple[str, list[str]]]:
    """License and words of each template, with a tag for each license of an SPDX identifier. Templates without words are left out."""
    out = []
    for license_id, several in texts.items():
        for text in (*several, *([TAG.format(license_id)] if license_id != "all-rights-reserved" else [])):
            found = words(pa.array([text]), NOT_ALNUM)
            named = [found.data[a:b].tobytes().decode(errors="replace") for a, b in zip(found.starts, found.ends, strict=True)]
            out += [(license_id, named)] if named else []
    return out


def telling(named: list[tuple[str, list[str]]]) -> list[list[int]]:
    """Places of each template's telling words: those with a digit, and the first after words that it shares with an alike template of another license."""
    out = []
    for license_id, mine in named:
        places = {i for i, w in enumerate(mine) if i and any(c.isdigit() for c in w)}
        for other_id, other in named:
            if other_id != license_id:
                match = difflib.SequenceMatcher(None, mine, other, autojunk=False)
                if match.quick_ratio() >= ALIKE and match.ratio() >= ALIKE:
                    ends = {m.a + m.size for m in match.get_matching_blocks() if m.size >= COMMON or m.size and not m.a}
                    places |= {at for at in ends if at < len(mine)}
        out.append(sorted(places))
    return out


class Template(NamedTuple):
    license_id: str
    size: int  # words of a shingle
    shingles: np.ndarray  # sorted
    telling: np.ndarray  # telling words, each with the word before it
    within: frozenset[str] = frozenset()  # licenses of longer templates that this one is a part of


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    first = np.arange(max(len(hashes) - size + 1, 0))
    return range_hashes(hashes, first, first + size)


def templates(texts: Mapping[str, Sequence[str]]) -> list[Template]:
    named, out = notices(texts), []
    for (license_id, mine), at in zip(named, telling(named), strict=True):
        hashes, size = words(pa.array([" ".join(mine)]), NOT_ALNUM).hashes(), min(SHINGLE, len(mine))
        longer = frozenset(i for i, other in named if i != license_id and len(other) > len(mine) and any(other[k : k + len(mine)] == mine for k in range(len(other) - len(mine) + 1)))
        at = np.array(at, np.int64)
        out.append(Template(license_id, size, np.unique(shingles(hashes, size)), range_hashes(hashes, at - 1, at + 1), longer))
    return out


def band_keys(members: np.ndarray) -> list[int]:
    """Keys of the bands of a set's MinHash signature."""
    salts = mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64))
    signature = mixed(members[:, None] ^ salts[None, :]).min(0).reshape(BANDS, ROWS)
    keys = signature[:, 0] * np.uint64(31) + signature[:, 1]
    return mixed(keys + np.arange(BANDS, dtype=np.uint64)).tolist()


class Index:
    """Bands of the templates; small, as templates are a parameter and no data."""

    def __init__(self, found: list[Template]):
        self.templates = found
        self.known = {size: np.unique(np.concatenate([t.shingles for t in found if t.size == size])) for size in {t.size for t in found}}
        self.lengths = sorted({(t.size, len(t.shingles)) for t in found})
        self.bands: dict[tuple[int, int, int], list[int]] = {}
        for number, t in enumerate(found):
            for key in band_keys(t.shingles):
                self.bands.setdefault((t.size, len(t.shingles), key), []).append(number)

    def matches(self, hashes: np.ndarray, least: float) -> list[tuple[str, float, int]]:
        """license, containment and first word of each window of a text that holds enough of a template, and none of a longer one at the same place."""
        found = list(self._windows(hashes, least))
        spans: dict[str, list[tuple[int, int]]] = {}
        for t, _, start, stop in found:
            spans.setdefault(t.license_id, []).append((start, stop))
        beaten = lambda t, start, stop: any(a <= stop and start <= b for other in t.within for a, b in spans.get(other, ()))
        return [(t.license_id, held, start) for t, held, start, stop in found if not beaten(t, start, stop)]

    def _windows(self, hashes: np.ndarray, least: float) -> Iterator[tuple[Template, float, int, int]]:
        pairs = shingles(hashes, 2)
        for size, known in self.known.items():
            mine = shingles(hashes, size)
            hits = np.flatnonzero(np.isin(mine, known))
            for length in [n for k, n in self.lengths if k == size and len(hits)]:
                step = max(1, length // 8)
                offsets = np.arange(-(-length // step)) * step
                starts = np.unique(np.maximum(hits[:, None] // step * step - offsets[None, :], 0))
                starts = starts[np.searchsorted(hits, starts) < np.searchsorted(hits, starts + length)]
                for start in starts.tolist():
                    window = mine[start : start + length]
                    retrieved = {n for key in band_keys(window) for n in self.bands.get((size, length, key), ())}
                    for number in sorted(retrieved):
                        template, first, last = self.templates[number], max(0, start - step), start + length + step
                        held = float(np.isin(template.shingles, mine[first:last]).mean())
                        if held >= least and np.isin(template.telling, pairs[first : last + size - 2]).all():
                            yield template, held, start, last


def license_scan(docs: DataFrame, texts: Mapping[str, Sequence[str]] = TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, license_id, containment (the best), n_windows, first_word: a row for each license found in a document.

    Case and punctuation do not count. Null and empty texts hold nothing. Rows
    that repeat an id are scanned each and reported together; so are rows of a
    null id. An empty table gives an empty result. Other columns are ignored.
    """
    index = Index(templates(texts))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = words(batch.column("text"), NOT_ALNUM)
            hashes = found.hashes()
            likely = np.zeros(len(found.bounds) - 1, bool)
            for size, known in index.known.items():
                first = np.arange(max(len(hashes) - size + 1, 0))
                spots = np.flatnonzero(np.isin(range_hashes(hashes, first, first + size), known))
                likely[np.searchsorted(found.bounds, spots, side="right") - 1] = True
            out = [(n, *m) for n in np.flatnonzero(likely).tolist() for m in index.matches(hashes[found.bounds[n] : found.bounds[n + 1]], containment)]
            at, ids, held, start = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(at, pa.int64())), pa.array(ids, pa.string()), pa.array(held, pa.float64()), pa.array(start, pa.int64())],
                ["doc_id", "license_id", "held", "start"],
            )

    columns = F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    found = docs.select(*columns).mapInArrow(rows, "doc_id long, license_id string, held double, start long")
    best = F.max("held").alias("containment"), F.count(F.lit(1)).alias("n_windows"), F.min("start").alias("first_word")
    return found.groupBy("doc_id", "license_id").agg(*best)
