"""License scan: MinHash bands over overlapping text windows retrieve templates, exact shingle
containment verifies them.

Text and templates are folded alike: ASCII letters lowered, every other ASCII character that is not a
digit is a break, words are what stands between. A template of n words is looked for in windows of n
words that start every n // STEP words. A window and a template have a signature of
``BANDS * ROWS`` minima over their five-word shingles; a template is retrieved where one band is
equal. With 16 bands of 2 rows a window at Jaccard 0.5 is retrieved with probability
1 - (1 - 0.5**2)**16 = 0.99, one at 0.67 with 0.9999, and a true copy always has a window within
n // (2 * STEP) words of it, at 0.77 or more. Only windows that hold a shingle of some template
can share a band with one, so the others are skipped without loss.

A retrieved template is verified on the words themselves: the window, widened by its step on both
sides, must contain at least ``CONTAINMENT`` of the template's shingles. Overlapping
verified windows are one match, reported with the words from its best window's first shared shingle to the last.

Defined results: null and empty texts have no match; a text shorter than a template is one
window; templates shorter than a shingle are one shingle; rows with a null id and repeated rows
are matched like all others; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plateau.llm.common import batches, column_of, mix64, text_bytes

SHINGLE = 5
CONTAINMENT = 0.8
BANDS, ROWS = 16, 2
STEP = 8

# Notices as their licenses word them (fixed values).
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See "
        "the License for the specific language governing permissions and limitations under the License."),
    "MIT": "Released under the MIT License",
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."),
    "BSD-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"),
    "ISC-permission": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "MPL-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0-deed": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "all-rights-reserved-line": "All rights reserved",
    "all-rights-reserved": "All rights reserved. No part of this publication may be reproduced",
}

_FOLD = bytes(ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else (b if b >= 128 else 32) for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def shingle_hashes(words: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """64-bit hashes of the word shingles, in text order; fewer words than ``size`` are one."""
    w = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    if not len(w):
        return w
    size = min(size, len(w))
    w, n = mix64(w), len(w) - size + 1
    with np.errstate(over="ignore"):
        h = w[:n].copy()
        for j in range(1, size):
            h = h * np.uint64(0x9E3779B97F4A7C15) + w[j:n + j]
    return mix64(h)


def shingles(words: list[bytes], size: int = SHINGLE) -> set[bytes]:
    size = min(size, len(words))
    return {b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)} if words else set()


_SEEDS = mix64(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


def signature(h: np.ndarray) -> np.ndarray:
    """Minima of the hashed shingles along the last axis; one per band row."""
    return np.stack([mix64(h ^ s).min(-1) for s in _SEEDS], -1)


@dataclass
class Template:
    name: str
    n: int                 # words
    size: int              # words in a shingle
    hashes: np.ndarray
    parts: set[bytes]
    bands: list[bytes]


class Scanner:
    def __init__(self, templates: dict[str, str]):
        self.items: list[Template] = []
        for name, text in templates.items():
            words = words_of(text.encode())
            if words:
                size = min(SHINGLE, len(words))
                h = shingle_hashes(words, size)
                self.items.append(Template(name, len(words), size, np.unique(h), shingles(words, size), self._bands(signature(h))))
        self.flag: dict[int, np.ndarray] = {}
        for size in {t.size for t in self.items}:
            table = np.zeros(1 << 16, bool)
            for t in self.items:
                if t.size == size:
                    table[(t.hashes & np.uint64(0xFFFF)).astype(int)] = True
            self.flag[size] = table

    @staticmethod
    def _bands(sig: np.ndarray) -> list[bytes]:
        return [sig[b * ROWS:(b + 1) * ROWS].tobytes() for b in range(BANDS)]

    def scan(self, text: bytes) -> list[tuple[str, float, int, int, int]]:
        """(template, containment, first word, end word, matches) of the verified templates."""
        words = words_of(text)
        out = []
        for size, table in self.flag.items():
            h = shingle_hashes(words, size)
            if not len(h) or len(words) < size:
                continue
            maybe = np.flatnonzero(table[(h & np.uint64(0xFFFF)).astype(int)])
            if not len(maybe):
                continue
            for t in self.items:
                if t.size == size:
                    out += self._matches(t, words, h, maybe[np.isin(h[maybe], t.hashes)])
        return out

    def _matches(self, t: Template, words: list[bytes], h: np.ndarray, hits: np.ndarray):
        if not len(hits):
            return []
        step, span = max(1, t.n // STEP), t.n - t.size + 1   # shingles in a window
        last = max(0, len(h) - span)
        # Windows start at multiples of the step, and at the end of the text; those with a hit.
        lo, hi = np.maximum(0, -(-(hits - span + 1) // step)), np.minimum(hits, last) // step
        starts = {min(s * step, last) for a, b in zip(lo.tolist(), hi.tolist()) for s in range(a, b + 1)}
        starts |= {last} if (hits >= last).any() else set()
        found = []
        for s in sorted(starts):
            bands = self._bands(signature(h[s:s + span]))
            if any(x == y for x, y in zip(bands, t.bands)):
                a, b = max(0, s - step), min(len(words), s + t.n + step)
                at = [j for j in range(a, b - t.size + 1) if b" ".join(words[j:j + t.size]) in t.parts]
                c = len({b" ".join(words[j:j + t.size]) for j in at}) / len(t.parts)
                if c >= CONTAINMENT:
                    found.append((at[0], at[-1] + t.size, c))
        runs: list[list[tuple[int, int, float]]] = []
        for f in found:
            if runs and f[0] < runs[-1][-1][1]:
                runs[-1].append(f)
            else:
                runs.append([f])
        if not runs:
            return []
        s, e, c = max(found, key=lambda f: (f[2], -f[0]))
        return [(t.name, c, s, e, len(runs))]


_OUT = pa.schema([("doc_id", pa.int64()), ("license_id", pa.string()), ("containment", pa.float64()),
                  ("first_word", pa.int64()), ("end_word", pa.int64()), ("n_matches", pa.int64())])


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per (document, template) that the document holds."""
    templates = dict(templates if templates is not None else TEMPLATES)

    def run(it):
        scanner = Scanner(templates)

        def rows():
            for b in it:
                for i, t in zip(column_of(b, "id"), column_of(b, "t")):
                    for m in scanner.scan(t):
                        yield (i, *m)
        yield from batches(rows(), _OUT)

    return (docs.select(F.col(id_col).cast("bigint").alias("id"), text_bytes(text_col).alias("t"))
            .mapInArrow(run, "doc_id bigint, license_id string, containment double, first_word bigint, end_word bigint, "
                             "n_matches bigint"))
