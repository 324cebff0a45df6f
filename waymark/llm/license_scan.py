"""License scans: MinHash bands over overlapping windows retrieve templates, exact containment verifies them.

Texts and templates are runs of lower-cased words without punctuation, as shingles of five words. Windows of 4, 8, 16
... shingles overlap by half; a template belongs to the smallest window that holds it whole wherever it lies, so a
window around a match of containment 0.8 has a Jaccard similarity of at least 1/6 with it. With ``BANDS`` bands of one
row each, such a window is missed with probability (5/6) ** BANDS, about 3e-8 for 96. Windows sharing a band with a
template are verified: at least ``CONTAINMENT`` of the template's shingles must be in the window, and of the words that
tell a licence from its siblings (``TELLING``) each phrase of the template in one of those shingles. A match whose
shingles all lie in a longer match of another licence is part of that one and left out.

One pass over the whole texts, no shuffle; templates are fixed and few. Defined results: null and empty texts match
nothing; repeated rows match alike; a match found in several windows is one row, its place that of the best, then
first window; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.text import Chunk, chunks, mixed, owners, shingles

BANDS = 96
WORDS = 5
CONTAINMENT = 0.8

#: Public license notices, by SPDX identifier.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-4.0": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "BSD-3-Clause": [
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
    ],
    "BSD-2-Clause OR BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "Apache-1.1": ["Licensed under the Apache License, Version 1.1."],
    "MPL-1.1": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.",
        "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not "
        "use this file except in compliance with the License.",
    ],
    **{name: [f"This work is licensed under the GNU {title}, version {version}.",
              f"This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {title} "
              f"as published by the Free Software Foundation, either version {version} of the License, or (at your "
              "option) any later version."] for name, title, version, what in (
        ("GPL-2.0", "General Public License", "2", "program"),
        ("LGPL-2.0", "Library General Public License", "2", "library"),
        ("LGPL-2.1", "Lesser General Public License", "2.1", "library"),
        ("LGPL-3.0", "Lesser General Public License", "3", "program"),
        ("AGPL-3.0", "Affero General Public License", "3", "program"))},
    **{f"CC-{short}-4.0": [f"Licensed under CC {short} 4.0.",
                           f"This work is licensed under a Creative Commons {title} 4.0 International License."]
       for short, title in (("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
                            ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
                            ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))},
}

#: Phrases that tell a licence from its siblings, by SPDX identifier; they hold for templates they occur in.
TELLING = {
    "Apache-2.0": ["license version 2"],
    "Apache-1.1": ["version 1 1"],
    "GPL-2.0": ["gnu general", "version 2"],
    "GPL-3.0": ["gnu general", "version 3"],
    "LGPL-2.0": ["gnu library", "version 2"],
    "LGPL-2.1": ["gnu lesser", "version 2 1"],
    "LGPL-3.0": ["gnu lesser", "version 3"],
    "AGPL-3.0": ["gnu affero", "version 3"],
    "MPL-2.0": ["license v 2"],
    "MPL-1.1": ["v 1 1", "version 1 1"],
    "BSD-2-Clause": ["distribution this software"],
    "BSD-3-Clause": ["neither the name"],
    "CC-BY-4.0": ["attribution 4"],
    "CC-BY-NC-4.0": ["by nc 4", "noncommercial 4"],
    "CC-BY-SA-4.0": ["by sa 4", "attribution sharealike 4"],
    "CC-BY-ND-4.0": ["by nd 4", "attribution noderivatives 4"],
    "CC-BY-NC-SA-4.0": ["nc sa 4", "noncommercial sharealike 4"],
    "CC-BY-NC-ND-4.0": ["nc nd 4", "noncommercial noderivatives 4"],
}

_PLAIN = np.arange(256, dtype=np.uint8)
for _b in range(128):
    if not chr(_b).isalnum() and _b != 10:
        _PLAIN[_b] = 32
_FACTORS = mixed(np.arange(1, BANDS + 1, dtype=np.uint64)) | np.uint64(1)


def _runs(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles of a chunk, the first word of each within its document, and where each document's shingles begin."""
    chunk.lowered()
    chunk.data = _PLAIN[chunk.data]
    begin, end, bounds = chunk.words()
    run, at = shingles(chunk.hashes(begin, end), bounds, WORDS)
    own = owners(bounds)[at]
    return run, at - bounds[own], np.append(np.searchsorted(own, np.arange(chunk.n)), len(run))


def _telling(text: str, run: np.ndarray, phrases) -> list[np.ndarray]:
    """Of each phrase that the text holds, the shingles with the whole phrase."""
    words = bytes(_PLAIN[np.frombuffer(text.lower().encode(), np.uint8)]).split()
    out = []
    for phrase in (p.encode().split() for p in phrases):
        at = [k for k in range(len(words)) if words[k:k + len(phrase)] == phrase]
        held = [run[max(0, k + len(phrase) - WORDS):k + 1] for k in at]
        if held:
            out.append(np.unique(np.concatenate(held)))
    return out


class Templates:
    """Shingle sets and band values of the templates, by window size."""

    def __init__(self, templates: dict[str, list[str]]):
        self.names, self.sets, self.level, self.length, self.telling = [], [], [], [], []
        for name, texts in templates.items():
            for text in texts:
                (chunk,) = chunks(pa.array([text]))
                run, _, _ = _runs(chunk)
                if len(run):
                    self.names.append(name)
                    self.sets.append(np.unique(run))
                    self.length.append(len(run))
                    self.telling.append(_telling(text, run, TELLING.get(name, ())))
                    self.level.append(next(c for c in range(60) if len(run) <= (2 << c) + 1))
        self.levels = max(self.level) + 1
        # per level and band: the templates' minima, sorted, and a table of their low 16 bits that skips most windows
        self.minima = [[np.array([(self.sets[t] * f).min() for t in self._of(c)], np.uint64) for f in _FACTORS]
                       for c in range(self.levels)]
        self.maybe = []
        for c in range(self.levels):
            table = np.zeros((BANDS, 1 << 16), bool)
            for b in range(BANDS):
                table[b, (self.minima[c][b] & np.uint64(0xFFFF)).astype(np.int64)] = True
            self.maybe.append(table)

    def _of(self, level: int) -> list[int]:
        return [t for t, own in enumerate(self.level) if own == level]


def scan(chunk: Chunk, known: Templates) -> list[tuple[int, int, int, float]]:
    """(document, template, first word, containment) of the best window of each template that a document holds."""
    run, word, bounds = _runs(chunk)
    if not len(run):
        return []
    # blocks of 2 << level shingles in each document; a window is a block and the next of the same document
    grids, starts, docs = [], None, None
    for level in range(known.levels):
        if level == 0:
            count = -(-np.diff(bounds) // 2)
            first = np.repeat(bounds[:-1], count)
        else:
            count = -(-np.diff(edges) // 2)
            first = np.repeat(edges[:-1], count)
        edges = np.concatenate(([0], np.cumsum(count)))
        docs = np.repeat(np.arange(chunk.n), count)
        starts = first + 2 * (np.arange(len(docs)) - edges[docs])
        joined = np.append(docs[1:] == docs[:-1], False)
        grids.append((starts, docs, joined))
    met: set[tuple[int, int, int]] = set()
    for b, factor in enumerate(_FACTORS):
        low = run * factor
        for level, (starts, _, joined) in enumerate(grids):
            low = np.minimum.reduceat(low, starts)
            window = low.copy()
            window[:-1] = np.where(joined[:-1], np.minimum(low[:-1], low[1:]), low[:-1])
            for k in np.flatnonzero(known.maybe[level][b][(window & np.uint64(0xFFFF)).astype(np.int64)]):
                for t, least in zip(known._of(level), known.minima[level][b], strict=True):
                    if least == window[k]:
                        met.add((level, int(k), t))
    best: dict[tuple[int, int], tuple[float, int, np.ndarray]] = {}
    for level, k, t in met:
        doc = int(grids[level][1][k])
        index = int(k - np.searchsorted(grids[level][1], doc))
        a = bounds[doc] + index * (2 << level)
        inside = run[a:min(a + (4 << level), bounds[doc + 1])]
        held = np.isin(known.sets[t], inside)
        share = float(held.mean())
        if share >= CONTAINMENT and all(np.isin(told, inside).any() for told in known.telling[t]):
            places = a + np.flatnonzero(np.isin(inside, known.sets[t]))
            at = int(word[places[0]])
            old = best.get((doc, t))
            if old is None or (-share, at) < (-old[0], old[1]):
                best[doc, t] = (share, at, places)
    return [(doc, t, at, share) for (doc, t), (share, at, places) in sorted(best.items(), key=lambda m: m[0])
            if not _part_of_another(doc, t, places, best, known)]


def _part_of_another(doc: int, t: int, places: np.ndarray, best: dict, known: Templates) -> bool:
    return any((doc, other) in best and known.names[other] != known.names[t] and known.length[other] > known.length[t]
               and np.isin(places, best[doc, other][2]).all() for other in range(len(known.names)))


def matches(docs: DataFrame, key: str = "doc_id", text: str = "text",
            templates: dict[str, list[str]] | None = None) -> DataFrame:
    """``key``, license, template (its number), first_word, n_words and containment, a row per template found."""
    chosen = templates or TEMPLATES
    source = docs.select(F.col(f"`{key}`"), F.col(f"`{text}`").cast("binary").alias("__text"))
    kind = source.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(chosen)
        for batch in batches:
            for chunk in chunks(batch.column(1), 1_000_000):
                found = scan(chunk, known)
                doc, t, at, share = (np.array(c) for c in zip(*found, strict=True)) if found else [np.zeros(0)] * 4
                t = t.astype(int)
                keys = batch.column(0).slice(chunk.first, chunk.n).take(pa.array(doc.astype(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array([known.names[x] for x in t], pa.string()), pa.array(t, pa.int32()),
                     pa.array(at.astype(np.int64)), pa.array([known.length[x] + WORDS - 1 for x in t], pa.int64()),
                     pa.array(share.astype(float))],
                    names=[key, "license", "template", "first_word", "n_words", "containment"])

    return source.mapInArrow(run, f"`{key}` {kind}, license string, template int, first_word long, n_words long, "
                                  "containment double")
