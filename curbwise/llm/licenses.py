"""Operator 10: licence scans by MinHash over overlapping windows of text.

Templates and texts are read as runs of five words (a template of fewer words
is one run). Each template belongs to the smallest window length L with
t <= 3/4 L + 1 for its t runs; windows of L runs start every L/4 runs, so some
window holds a whole occurrence. With the least share of a template that counts
(``CONTAINMENT``) and t > 3/16 L, window and template have a Jaccard index of
0.125 or more; bands are single hashes, and with 64 of them the chance that
none collides is below (1 - 0.125) ** 64 = 2e-4. A colliding window retrieves
the template, and the exact share of the template's runs found in the window's
neighbourhood decides, on the words themselves. Besides the share, a run with
each distinguishing wording of the licence (``MARKS``: its version, its name) must
be found, so that a sibling's text does not count. Of matches of different
licences that lie mostly in each other the best share is reported, then the
widest; the opening of the BSD licences is BSD-3 where its third clause follows.

Window minima come from block minima, so every run is hashed once per band
whatever the number of lengths. Templates are a short list given by the caller.

Defined results: null and empty texts and texts shorter than a template's words
have no match from it; repeated rows each get their own result; a match names
the template, the share found, and the words (first, end exclusive) it spans.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from xxhash import xxh3_64_intdigest

from curbwise.llm.batches import arrow_pass, ship_package, words_of

RUN = 5
CONTAINMENT = 0.8
BANDS = 64
FIRST_WINDOW = 8
KEPT_WORDS = 400_000

# Licence names with wordings that announce them.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met"""),
    ("CC-BY-4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("GPL-3.0", "licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or
        (at your option) any later version"""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies"""),
    ("MIT", "Released under the MIT License"),
    ("MIT", "licensed under the MIT License"),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction"""),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)

_FREE = """{0} you can redistribute it and/or modify it under the terms of the GNU {1} General Public License as
    published by the Free Software Foundation{2} either version {3} of the License, or (at your option) any later version"""
TEMPLATES += (
    ("GPL-2.0", "licensed under the GNU General Public License, version 2"),
    ("GPL-2.0", _FREE.format("This program is free software;", "", ";", "2")),
    ("LGPL-2.1", "licensed under the GNU Lesser General Public License, version 2.1"),
    ("LGPL-2.1", _FREE.format("This library is free software;", "Lesser", ";", "2.1")),
    ("LGPL-3.0", "licensed under the GNU Lesser General Public License, version 3"),
    ("LGPL-3.0", _FREE.format("This library is free software:", "Lesser", ",", "3")),
    ("AGPL-3.0", "licensed under the GNU Affero General Public License, version 3"),
    ("AGPL-3.0", _FREE.format("This program is free software:", "Affero", ",", "3")),
    ("MPL-1.1", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1"),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1"),
    ("BSD-3-Clause", """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
        promote products derived from this software without specific prior written permission"""),
    ("CC0-1.0", "Licensed under CC0 1.0 Universal"),
    ("CC0-1.0", """To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring
        rights to this software to the public domain worldwide"""),
)

#: Wordings without which a text is not of the licence, where a template has them.
MARKS = {
    "Apache-2.0": ("version 2 0",), "CC-BY-4.0": ("attribution 4 0",), "CC-BY-SA-4.0": ("sharealike 4 0", "sa 4 0"),
    "CC-BY-NC-4.0": ("nc 4 0",), "GPL-2.0": ("gnu general public", "version 2"),
    "GPL-3.0": ("gnu general public", "version 3"), "LGPL-2.1": ("lesser general public", "version 2 1"),
    "LGPL-3.0": ("lesser general public", "version 3"), "AGPL-3.0": ("affero general public", "version 3"),
    "MPL-1.1": ("1 1",), "MPL-2.0": ("v 2 0",), "CC0-1.0": ("cc0 1 0",),
}
#: Words between the opening of the BSD licences and the third clause, at most.
BSD_REACH = 150

Match = tuple[str, float, int, int]


def window_length(runs: int) -> int:
    length = FIRST_WINDOW
    while runs > 3 * length // 4 + 1:
        length *= 4
    return length


class Scanner:
    """The templates' runs and band values, ready to be held against texts."""

    def __init__(self, templates=TEMPLATES) -> None:
        draw = np.random.Generator(np.random.PCG64(7))
        self.factors = draw.integers(0, 2**32, BANDS, np.uint32) | np.uint32(1)
        self.offsets = draw.integers(0, 2**32, BANDS, np.uint32)
        self.known: dict[bytes, int] = {}
        self.templates: list[tuple[str, int, frozenset[tuple[bytes, ...]]]] = []
        #: Per template, for each of its marks the runs that have it.
        self.carriers: list[list[frozenset[tuple[bytes, ...]]]] = []
        self.lengths: dict[int, list[int]] = defaultdict(list)
        by_class: dict[int, list[np.ndarray]] = defaultdict(list)
        for name, text in templates:
            words = words_of(text.encode("utf-8"))
            if not words:
                continue
            size = min(RUN, len(words))
            runs = [tuple(words[at:at + size]) for at in range(len(words) - size + 1)]
            length = window_length(len(runs))
            self.lengths[length].append(len(self.templates))
            by_class[length].append(self.minima(self.hash_runs(words, size)))
            self.templates.append((name, size, frozenset(runs)))
            carriers = [frozenset(run for run in runs if self.holds(run, mark)) for mark in MARKS.get(name, ())]
            self.carriers.append([each for each in carriers if each])
        # Per length and band: the templates' minima, and a table over their upper halves.
        self.values = {length: np.stack(rows, axis=1) for length, rows in by_class.items()}
        self.tables = {}
        for length, values in self.values.items():
            table = np.zeros((BANDS, 1 << 16), bool)
            for band in range(BANDS):
                table[band, values[band] >> np.uint32(16)] = True
            self.tables[length] = table
        self.sizes = sorted({size for _, size, _ in self.templates})

    @staticmethod
    def holds(run: tuple[bytes, ...], mark: str) -> bool:
        words = tuple(words_of(mark.encode()))
        return any(run[at:at + len(words)] == words for at in range(len(run) - len(words) + 1))

    def hash_runs(self, words: list[bytes], size: int) -> np.ndarray:
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        for word in set(words).difference(self.known):
            self.known[word] = xxh3_64_intdigest(word)
        codes = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        count = max(0, len(codes) - size + 1)
        hashed = np.full(count, size, np.uint64)
        for at in range(size):
            hashed = (hashed ^ codes[at:at + count]) * np.uint64(0x9E3779B97F4A7C15)
            hashed ^= hashed >> np.uint64(29)
        return (hashed >> np.uint64(32)).astype(np.uint32)

    def band(self, runs: np.ndarray, band: int) -> np.ndarray:
        mixed = runs * self.factors[band] + self.offsets[band]
        return (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)

    def minima(self, runs: np.ndarray) -> np.ndarray:
        return np.array([self.band(runs, band).min() for band in range(BANDS)], np.uint32)

    def candidates(self, runs: np.ndarray) -> set[tuple[int, int, int]]:
        """(window length, first run, template) of every window that shares a band with a template."""
        found: set[tuple[int, int, int]] = set()
        if not len(runs):
            return found
        top = np.uint32(0xFFFFFFFF)
        for band in range(BANDS):
            blocks, step = self.band(runs, band), 1
            for length in sorted(self.lengths):
                while step < length // 4:
                    factor = 2 if step == 1 else 4
                    spare = -len(blocks) % factor
                    if spare:
                        blocks = np.concatenate([blocks, np.full(spare, top, np.uint32)])
                    blocks = blocks.reshape(-1, factor).min(axis=1)
                    step *= factor
                minima = blocks.copy()
                for shift in (1, 2, 3):
                    if shift < len(blocks):
                        np.minimum(minima[:-shift], blocks[shift:], out=minima[:-shift])
                values = self.values[length][band]
                for at in np.flatnonzero(self.tables[length][band][minima >> np.uint32(16)]):
                    for column in np.flatnonzero(values == minima[at]):
                        found.add((length, int(at) * step, self.lengths[length][column]))
        return found

    def verify(self, words: list[bytes], length: int, first: int, template: int) -> Match | None:
        name, size, runs = self.templates[template]
        start, end = max(0, first - length // 4), min(len(words), first + length + length // 4 + size - 1)
        places = [at for at in range(start, end - size + 1) if tuple(words[at:at + size]) in runs]
        found = {tuple(words[at:at + size]) for at in places}
        if any(found.isdisjoint(each) for each in self.carriers[template]):
            return None
        share = len(found) / len(runs)
        return (name, share, places[0], places[-1] + size) if share >= CONTAINMENT else None

    def scan(self, rows: list[list[bytes]]) -> list[list[Match]]:
        """Each text's matches: of one template and place the best, ordered by place and name."""
        matches: list[set[Match]] = [set() for _ in rows]
        for size in self.sizes:
            hashed = [self.hash_runs(words, size) for words in rows]
            ends = np.cumsum([len(each) for each in hashed])
            starts = ends - [len(each) for each in hashed]
            for length, first, template in self.candidates(np.concatenate(hashed) if hashed else np.empty(0, np.uint32)):
                if self.templates[template][1] != size:
                    continue
                # A window of the joined texts may reach over several short ones.
                low = int(np.searchsorted(ends, first, side="right"))
                high = int(np.searchsorted(starts, first + length, side="left"))
                for row in range(low, min(high, len(rows))):
                    match = self.verify(rows[row], length, first - int(starts[row]), template)
                    if match:
                        matches[row].add(match)
        return [self.merged(found) for found in matches]

    @staticmethod
    def merged(found: set[Match]) -> list[Match]:
        """Overlapping matches of one licence become the widest of them; of several licences the best stays."""
        kept: list[Match] = []
        for match in sorted(found, key=lambda m: (m[0], m[2], -m[3])):
            if kept and kept[-1][0] == match[0] and match[2] < kept[-1][3]:
                last = kept.pop()
                match = (match[0], max(last[1], match[1]), last[2], max(last[3], match[3]))
            kept.append(match)
        best: list[Match] = []
        for match in sorted(kept, key=lambda m: (-m[1], m[2] - m[3], m[0])):
            inside = lambda other: 2 * (min(match[3], other[3]) - max(match[2], other[2]))
            if all(inside(other) <= min(match[3] - match[2], other[3] - other[2]) for other in best):
                best.append(match)
        thirds = [m[2] for m in best if m[0] == "BSD-3-Clause"]
        kept = [m for m in best if m[0] != "BSD-2-Clause" or not any(0 <= at - m[3] <= BSD_REACH for at in thirds)]
        return sorted(kept, key=lambda m: (m[2], m[0], m[3]))


MATCHES = "array<struct<license:string,containment:double,first_word:int,end_word:int>>"


def scan(docs: DataFrame, templates=TEMPLATES, drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with a column ``matches``. No shuffle."""
    ship_package(docs.sparkSession)
    kind = pa.list_(pa.struct([
        ("license", pa.string()), ("containment", pa.float64()), ("first_word", pa.int32()), ("end_word", pa.int32()),
    ]))

    def make():
        scanner = Scanner(templates)

        def compute(part: pa.RecordBatch) -> list:
            rows = [words_of(data) for data in part.column("text").cast(pa.binary()).to_pylist()]
            names = ("license", "containment", "first_word", "end_word")
            found = [[dict(zip(names, match, strict=True)) for match in matches] for matches in scanner.scan(rows)]
            return [pa.array(found, kind)]

        return compute

    return arrow_pass(docs, f"matches {MATCHES}", make, drop)
