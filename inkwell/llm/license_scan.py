"""License scans: MinHash bands over overlapping windows retrieve templates, then exact check.

A text's shingles are its windows of five words (lower case, without punctuation). Over the
shingles run windows of 1, 2, 4 ... 32 of them, each a quarter of its size after the one before.
A template has windows of the largest of these sizes that fits, at every place. So a copy of a
template has a window with at most an eighth of its shingles on either side not shared, a Jaccard
similarity of 0.77 or more, and 8 bands of 2 hash functions meet with probability 0.999 or more.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkwell.llm.common import batch_rows, text_or_empty
from inkwell.llm.order_minhash import WordHashes, mixed, windows

# Notices of public licenses, as their texts ask for.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so"
    ),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-text": (
        "you may not use this file except in compliance with the License. You may obtain a copy of the "
        "License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-text": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation"
    ),
    "BSD-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met"
    ),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-text": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License",
    "LGPL-text": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the "
        "GNU Lesser General Public License as published by the Free Software Foundation"
    ),
    "AGPL-text": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU Affero General Public License as published by the Free Software Foundation"
    ),
    "CC-BY-SA-text": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"
    ),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
        "in all copies"
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse "
        "Public License 2.0"
    ),
    "all-rights-reserved": "All rights reserved.",
}
# Letters and digits of ASCII, and all characters beyond it.
WORDS = re.compile(rb"[a-z0-9_\x80-\xff]+")


@dataclass(frozen=True)
class LicenseScan:
    """k: words of a shingle; containment: least share of a template's shingles found together;
    bands of rows hash functions each; largest: shingles of the largest window.
    """

    k: int = 5
    containment: float = 0.8
    bands: int = 8
    rows: int = 2
    largest: int = 32
    seed: int = 5


def words_of(text: str) -> list[bytes]:
    return WORDS.findall(text.lower().encode("utf-8", "surrogatepass"))


def window_minima(shingles: np.ndarray, functions: np.ndarray, largest: int) -> dict[int, np.ndarray]:
    """By window size (1, 2, 4, ...) the minimum of each hash function, for all windows."""
    low = (shingles[None, :] ^ functions[:, None]) * np.uint64(0xBF58476D1CE4E5B9)
    low ^= low >> np.uint64(31)
    out, size = {}, 1
    while low.shape[1]:
        out[size] = low
        if size == largest:
            break
        low = np.minimum(low[:, :-size], low[:, size:])
        size *= 2
    return out


def band_values(minima: np.ndarray, rows: int) -> np.ndarray:
    """bands x windows."""
    out = minima[0::rows]
    for i in range(1, rows):
        out = mixed(out + minima[i::rows] * np.uint64(0x9E3779B97F4A7C15))
    return out


class _Group:
    """Templates with the same words per shingle: their bands by window size."""

    def __init__(self, k: int, functions: np.ndarray, scan: LicenseScan):
        self.k, self.functions, self.scan = k, functions, scan
        self.bands: dict[int, dict[tuple[int, int], set[str]]] = {}
        self.quick: dict[int, np.ndarray] = {}
        self.names: dict[int, set[str]] = {}

    def add(self, name: str, shingles: np.ndarray) -> None:
        size = 1
        while size * 2 <= min(len(shingles), self.scan.largest):
            size *= 2
        values = band_values(window_minima(shingles, self.functions, size)[size], self.scan.rows)
        self.names.setdefault(size, set()).add(name)
        known = self.bands.setdefault(size, {})
        bits = self.quick.setdefault(size, np.zeros(1 << 18, bool))
        # Windows of one shingle agree in all bands or in none.
        for band, row in enumerate(values[:1] if size == 1 else values):
            bits[(row & np.uint64(0x3FFFF)).astype(np.int64)] = True
            for value in row.tolist():
                known.setdefault((band, value), set()).add(name)

    def hits(self, shingles: np.ndarray) -> set[tuple[str, int, int]]:
        """(template, first shingle, window size) where a band of a window meets, or the text is short."""
        found = set()
        most = max(self.bands)
        minima = window_minima(shingles, self.functions[: self.scan.rows] if most == 1 else self.functions, most)
        for size, known in self.bands.items():
            if size not in minima:
                # A text shorter than the window may still hold most of a template: all are verified.
                found.update((name, 0, len(shingles)) for name in self.names[size])
                continue
            step = max(1, size // 4)
            used = minima[size][: self.scan.rows] if size == 1 else minima[size][:, ::step]
            values = band_values(used, self.scan.rows)
            maybe = self.quick[size][(values & np.uint64(0x3FFFF)).astype(np.int64)]
            for band, at in zip(*np.nonzero(maybe), strict=True):
                for name in known.get((int(band), int(values[band, at])), ()):
                    found.add((name, int(at) * step, size))
        return found


class Scanner:
    """Templates ready to be looked for."""

    def __init__(self, templates: dict[str, str], scan: LicenseScan):
        self.scan, self.hashes = scan, WordHashes()
        functions = np.random.default_rng(scan.seed).integers(1 << 63, size=scan.bands * scan.rows, dtype=np.uint64)
        self.shingles: dict[str, set[tuple[bytes, ...]]] = {}
        self.groups: dict[int, _Group] = {}
        for name, text in templates.items():
            words = words_of(text)
            if not words:
                continue
            k = min(scan.k, len(words))
            self.shingles[name] = {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}
            group = self.groups.setdefault(k, _Group(k, functions, scan))
            group.add(name, windows(self.hashes.of(words), k))

    def find(self, text: str) -> list[tuple[str, float, int, int]]:
        """(template, best containment, first word of the best place, number of places)."""
        words = words_of(text)
        if not words:
            return []
        hashed = self.hashes.of(words)
        found: dict[str, list[tuple[float, int, int]]] = {}
        for k, group in self.groups.items():
            if len(words) < k:
                continue
            for name, at, size in sorted(group.hits(windows(hashed, k))):
                places = found.setdefault(name, [])
                if places and at < places[-1][2]:
                    continue  # inside the place found last
                wanted = self.shingles[name]
                room = len(wanted)
                begin, end = max(at - room, 0), at + size + room
                here = [tuple(words[i : i + k]) for i in range(begin, min(end, len(words) - k + 1))]
                share = len(wanted.intersection(here)) / len(wanted)
                if share >= self.scan.containment:
                    first = begin + next(i for i, s in enumerate(here) if s in wanted)
                    last = begin + max(i for i, s in enumerate(here) if s in wanted)
                    if not places or first >= places[-1][2]:
                        places.append((share, first, last + 1))
        out = []
        for name, places in sorted(found.items()):
            if places:
                best = max(places, key=lambda p: (p[0], -p[1]))
                out.append((name, best[0], best[1], len(places)))
        return out


RESULT = pa.schema(
    [
        ("license", pa.string()),
        ("containment", pa.float64()),
        ("first_word", pa.int64()),
        ("places", pa.int64()),
    ]
)


def scan_licenses(
    documents: DataFrame,
    templates: dict[str, str] | None = None,
    scan: LicenseScan | None = None,
    text: str = "text",
) -> DataFrame:
    """A row per document and template that it holds, with the other columns of the document.

    The templates are a parameter and go to every task. Null and empty texts hold none; repeated
    rows come out each; of equal places the first counts. Texts of any length are read whole, those
    shorter than a template's window are held against it directly; an empty table gives no rows. Columns of ``documents`` with names of
    results are replaced.
    """
    templates, scan = templates or TEMPLATES, scan or LicenseScan()
    source = documents.drop(*RESULT.names).withColumn("_text", text_or_empty(text)).drop(text)
    schema = source.drop("_text").schema
    for name, kind in zip(
        RESULT.names, (T.StringType(), T.DoubleType(), T.LongType(), T.LongType()), strict=True
    ):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, scan)
        for whole in batches:
            for batch in batch_rows(whole):
                places, rows = [], []
                for i, value in enumerate(batch.column("_text").to_pylist()):
                    for row in scanner.find(value):
                        places.append(i)
                        rows.append(row)
                if not rows:
                    continue
                kept = batch.drop_columns(["_text"]).take(pa.array(places, pa.int64()))
                made = [pa.array(v, f.type) for v, f in zip(zip(*rows, strict=True), RESULT, strict=True)]
                yield pa.RecordBatch.from_arrays(kept.columns + made, names=kept.schema.names + RESULT.names)

    return source.mapInArrow(run, schema)
