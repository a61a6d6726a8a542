"""Operator 8: licence scan by the Dice coefficient over word bigrams.

A text is compared line by line and as a whole. Each unit and each licence
template is normalised (lower case, runs of letters and digits as words) and
taken as its set of word bigrams. Dice >= t needs t/(2-t) <= |A|/|B| <= (2-t)/t,
so a template is only compared with units whose bigram count lies in its size
bounds, and units outside every template's bounds are dropped before any
bigram is looked up. The templates are a fixed list, so they travel with the task.

Defined results: null and empty texts have no match; units of one word have no
bigrams and match nothing; a line that is the whole text counts once; repeated
rows each get their row; of equally similar templates the least name is the best; a
very long text is one unit more, in memory proportional to it; a null doc_id comes back
null; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.llm import textarrays as TA

THRESHOLD = 0.8
_NOT_WORD = np.ones(256, dtype=bool)
_NOT_WORD[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = False

# Licence notices and short licence texts (public wording), id -> text.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                         "except in compliance with the License. You may obtain a copy of the License at "
                         "http://www.apache.org/licenses/LICENSE-2.0",
    "MIT": "Released under the MIT License.",
    "MIT-notice": "Licensed under the MIT License. See LICENSE file in the project root for full license information.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                 "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
                 "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
                 "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
                 "furnished to do so, subject to the following conditions:",
    "BSD-notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "BSD-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                 "provided that the following conditions are met:",
    "ISC-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
                 "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
                 "in all copies.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the "
                      "GNU General Public License as published by the Free Software Foundation, either version 3 of "
                      "the License, or (at your option) any later version.",
    "GPL-2.0-notice": "This program is free software; you can redistribute it and/or modify it under the terms of the "
                      "GNU General Public License as published by the Free Software Foundation; either version 2 of "
                      "the License, or (at your option) any later version.",
    "LGPL-2.1-notice": "This library is free software; you can redistribute it and/or modify it under the terms of "
                       "the GNU Lesser General Public License as published by the Free Software Foundation; either "
                       "version 2.1 of the License, or (at your option) any later version.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
               "MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring "
               "rights to this work.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def bigrams(text: str) -> list[str]:
    words = re.findall(r"[a-z0-9]+", text.lower())
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def size_bounds(n: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """Least and greatest bigram count of a unit that can reach ``threshold`` with a template of ``n`` bigrams."""
    return (math.ceil(n * threshold / (2 - threshold) - 1e-9), math.floor(n * (2 - threshold) / threshold + 1e-9))


def _bigram_hashes(c: TA.Chunk, w: TA.Words) -> np.ndarray:
    h = TA.word_hashes(c, w)
    return TA.mix(h[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + h[1:])


class Templates:
    """Template bigrams as a sorted hash list; each entry names one template that has it."""

    def __init__(self, templates: dict[str, str], threshold: float):
        self.names = sorted(templates)
        grams, owner, size = [], [], []
        for i, name in enumerate(self.names):
            c = next(TA.text_chunks(pa.array([templates[name].lower()])))
            g = np.unique(_bigram_hashes(c, TA.words_of(c, _NOT_WORD)))
            grams.append(g)
            owner.append(np.full(len(g), i))
            size.append(len(g))
        order = np.argsort(np.concatenate(grams), kind="stable")
        self.gram, self.owner = np.concatenate(grams)[order], np.concatenate(owner)[order]
        self.size = np.array(size)
        self.threshold = threshold
        bounds = [size_bounds(n, threshold) for n in size]
        self.low, self.high = (np.array(x) for x in zip(*bounds))

    def match(self, unit: np.ndarray, gram: np.ndarray, n_units: int):
        """(unit, template, dice) at or above the threshold, for distinct (unit, gram) pairs."""
        n = np.bincount(unit, minlength=n_units)
        fits = (n >= self.low.min()) & (n <= self.high.max())
        keep = fits[unit]
        unit, gram = unit[keep], gram[keep]
        a = np.searchsorted(self.gram, gram, side="left")
        times = np.searchsorted(self.gram, gram, side="right") - a
        entry = np.repeat(a, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        k = len(self.names)
        pair, inter = np.unique(np.repeat(unit, times) * k + self.owner[entry], return_counts=True)
        unit, template = pair // k, pair % k
        inside = (n[unit] >= self.low[template]) & (n[unit] <= self.high[template])
        dice = 2.0 * inter / (n[unit] + self.size[template])
        good = inside & (dice >= self.threshold - 1e-12)
        return unit[good], template[good], dice[good]


def _scanner(templates: dict[str, str], threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = Templates(templates, threshold)
        for batch in batches:
            for c in TA.text_chunks(batch.column("text")):
                w = TA.words_of(c, _NOT_WORD)
                found: list[dict[str, float]] = [{} for _ in range(c.n)]
                if len(w.start) > 1:
                    newline = np.concatenate([[0], np.cumsum(c.data[:c.size] == 0x0A)])
                    gram = _bigram_hashes(c, w)
                    line = newline[w.start] + w.text  # distinct for the lines of one text and of neighbours
                    line = np.cumsum(np.concatenate([[0], line[1:] != line[:-1]]))
                    for unit, owner in ((line, None), (w.text, w.text)):
                        ok = np.flatnonzero(unit[1:] == unit[:-1])
                        names, first = np.unique(unit, return_index=True)
                        u = np.searchsorted(names, unit[ok])
                        g, rank = np.unique(gram[ok], return_inverse=True)
                        pair = np.unique(u * np.int64(len(g) + 1) + rank)
                        got = t.match(pair // (len(g) + 1), g[pair % (len(g) + 1)], len(names))
                        for x, m, dice in zip(*(y.tolist() for y in got)):
                            best = found[int(w.text[first[x]])]
                            best[t.names[m]] = max(best.get(t.names[m], 0.0), dice)
                best = [min(((-d, n) for n, d in f.items()), default=(0.0, None)) for f in found]
                part = batch.slice(c.lo, c.n)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(f) for f in found], pa.int64()),
                     pa.array([sorted(f) for f in found], pa.list_(pa.string())),
                     pa.array([b[1] for b in best], pa.string()), pa.array([round(-b[0], 6) for b in best], pa.float64())],
                    ["doc_id", "n_licences", "licences", "best_licence", "best_dice"])
    return run


def scan_licences(docs: DataFrame, threshold: float = THRESHOLD, templates: dict[str, str] | None = None) -> DataFrame:
    """One row per document: doc_id, n_licences, licences (sorted), best_licence, best_dice (6 places; 0 without a match)."""
    return docs.select("doc_id", F.lower("text").alias("text")).mapInArrow(
        _scanner(templates or TEMPLATES, threshold),
        "doc_id long, n_licences long, licences array<string>, best_licence string, best_dice double")
