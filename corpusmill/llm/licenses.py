"""License scans: MinHash over overlapping windows retrieves templates, exact shingle containment confirms them.

Texts and templates are cut into 5-word shingles. A template of m shingles belongs to level L, the power of two with
L/2 < m <= L; the windows of that level are 2L shingles long and start every L, so any run of m shingles lies whole in one window.
A window that holds ``CONTAINED`` of the template has a Jaccard similarity of 0.19 or more, and with ``COORDINATES`` bands of
one row shares one with probability 1 - 0.81^64 > 0.999998; with all of the template, 1 - 0.75^64 > 0.99999998.
Coordinates are circulant: two permutations, the second shifted. The minima of a level come from those of the level below.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, whole_text

SHINGLE = 5
CONTAINED = 0.8
COORDINATES = 64
PLACES = 1 << 20
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+(?:[.'\-][0-9A-Za-z\x80-\xff]+)*")

#: Notices of public licenses, as they are published or commonly written.
TEMPLATES = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "mit-notice": "Released under the MIT License.",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "bsd-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
}


def words(data: bytes) -> list[bytes]:
    return _WORD.findall(data.lower())


def shingles(data: bytes) -> list[tuple]:
    """In text order; none with fewer than five words."""
    w = words(data)
    return list(zip(*(w[i:] for i in range(SHINGLE)), strict=False))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Scanner:
    #: Shingles that are sketched at a time; a multiple of every level.
    STEP = 4096

    def __init__(self, templates: dict[str, str]):
        rng = np.random.default_rng(90210)
        ranks = rng.permutation(PLACES).astype(np.uint32)
        self.slices = np.lib.stride_tricks.sliding_window_view(np.concatenate([ranks, ranks[:COORDINATES]]), COORDINATES)
        self.memo: dict[bytes, int] = {}
        self.levels: dict[int, list[tuple[str, frozenset, np.ndarray]]] = {}
        self.ranks: dict[int, np.ndarray] = {}
        for name, text in templates.items():
            s = shingles(text.encode())
            if not s:
                raise ValueError(f"template {name} has fewer than {SHINGLE} words")
            level = 1 << (len(s) - 1).bit_length()
            if self.STEP % level:
                raise ValueError(f"template {name} is longer than {self.STEP} shingles")
            sig = self.slices[self.places(words(text.encode()))].min(axis=0)
            self.levels.setdefault(level, []).append((name, frozenset(s), sig))
            self.ranks.setdefault(level, np.zeros(PLACES, dtype=bool))[sig] = True

    def places(self, w: list[bytes]) -> np.ndarray:
        memo = self.memo
        if len(memo) > 400_000:
            memo.clear()
        for x in set(w).difference(memo):
            memo[x] = xxhash.xxh3_64_intdigest(x)
        h = np.fromiter(map(memo.__getitem__, w), dtype=np.uint64, count=len(w))
        n = max(0, len(w) - SHINGLE + 1)
        x = np.zeros(n, dtype=np.uint64)
        for i in range(SHINGLE if n else 0):
            x = x * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n]
        return (_mixed(x) >> np.uint64(44)).astype(np.int64)

    def scan(self, data: bytes) -> dict[str, tuple[int, int]]:
        """Template to (shingles matched, first word of the window), of the best window; the earliest of equals."""
        w = words(data)
        places, out = self.places(w), {}
        if not len(places):
            return out
        for at in range(0, len(places), self.STEP):  # each step sees the one level's length more that its last windows reach
            self._scan_step(w, places, at, out)
        return out

    def _scan_step(self, w: list[bytes], places: np.ndarray, at: int, out: dict) -> None:
        reach = places[at : at + 2 * self.STEP] if len(places) - at <= 2 * self.STEP else places[at : at + self.STEP + max(self.levels)]
        low, level = self.slices[reach], 1
        while True:
            if level in self.levels:
                n = min(len(low), -(-self.STEP // level))
                after = np.concatenate([low[1 : n + 1], np.full((n + 1 - len(low[: n + 1]), COORDINATES), PLACES, dtype=np.uint32)]) if len(low) <= n else low[1 : n + 1]
                mins = np.minimum(low[:n], after)
                for k in np.flatnonzero(self.ranks[level][np.minimum(mins, PLACES - 1)].any(axis=1)).tolist():
                    first = at + k * level
                    for name, own, sig in self.levels[level]:
                        if (mins[k] == sig).any():
                            window = w[first : first + 2 * level + SHINGLE - 1]
                            found = len(own.intersection(zip(*(window[i:] for i in range(SHINGLE)), strict=False)))
                            if found >= CONTAINED * len(own) and found > out.get(name, (0, 0))[0]:
                                out[name] = found, first
            if level >= max(self.levels):
                return
            if len(low) % 2:
                low = np.concatenate([low, low[-1:]])
            low, level = np.minimum(low[::2], low[1::2]), 2 * level


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_licenses, licenses (names, sorted, joined by commas), matches (name:shingles:word, joined likewise).

    Every whole text is scanned, whatever its length. Null and empty texts, and texts of fewer than five words, match nothing;
    repeated rows are scanned each; extra columns are ignored; an empty table gives an empty table.
    """

    def rows(it: Iterator[tuple]) -> Iterable[tuple]:
        s = Scanner(templates)
        for i, d in it:
            found = sorted(s.scan(d).items())
            yield i, len(found), ",".join(k for k, _ in found), ",".join(f"{k}:{n}:{at}" for k, (n, at) in found)

    return map_rows(docs, [F.col(doc_id).alias("doc_id"), whole_text(text)], f"doc_id {dict(docs.dtypes)[doc_id]}, n_licenses long, licenses string, matches string", rows)
