"""License scan by patience alignment of texts with license templates.

Words are runs of letters and digits in lower case. Around each place where a
text may hold a template, text and template are anchored on the words that occur
once in both, the longest increasing run of anchors is kept, and the gaps
between anchors are aligned again; coverage is the share of the template's words
that are aligned. The places are the occurrences of the template's words that
are rarest in the text, as many words as may be missing and one more, so that
every alignment of the asked coverage holds one of them.

Defined results: null and empty texts hold nothing; a text with several copies
of a template gives a row for each that doesn't overlap a better one, the
earlier of equals; an alignment may not reach over more than twice the
template's words; empty templates match nothing; rows that repeat are scanned
alike; further columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import per_batch, texts

# Notices of public licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "MIT": "Released under the MIT License",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
}

WORDS = re.compile(r"[^\W_]+")


def longest_increasing(values: list[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence, by patience piles."""
    tops: list[int] = []
    piles: list[int] = []
    below = [-1] * len(values)
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        below[i] = piles[pile - 1] if pile else -1
        if pile == len(tops):
            tops.append(v), piles.append(i)
        else:
            tops[pile], piles[pile] = v, i
    found, i = [], piles[-1] if piles else -1
    while i >= 0:
        found.append(i)
        i = below[i]
    return found[::-1]


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Pairs of equal words, ascending in both: anchors, then the gaps between them."""
    pairs: list[tuple[int, int]] = []
    todo = [(0, len(text), 0, len(template))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and text[a] == template[c]:
            pairs.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            pairs.append((b, d))
        if a >= b or c >= d:
            continue
        ours, theirs = Counter(text[a:b]), Counter(template[c:d])
        at = {w: i for i, w in enumerate(text[a:b], a) if ours[w] == 1}
        anchors = [(at[w], j) for j, w in enumerate(template[c:d], c) if theirs[w] == 1 and w in at]
        kept = [anchors[i] for i in longest_increasing([i for i, _ in anchors])]
        if not kept:
            continue
        pairs += kept
        edges = [(a - 1, c - 1), *kept, (b, d)]
        todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:]) if k > i + 1 and m > j + 1]
    return sorted(pairs)


def densest(words: list[str], low: int, high: int, template: list[str]) -> tuple[int, int, int]:
    """Most aligned words that lie within twice the template, their first and last place."""
    near = [(i + low, j) for i, j in align(words[low:high], template)]
    best, left = (0, 0, 0), 0
    for right in range(len(near)):
        while near[right][0] - near[left][0] >= 2 * len(template):
            left += 1
        if right - left + 1 > best[0]:
            best = right - left + 1, near[left][0], near[right][0]
    return best


def scan(text: str, templates: dict[str, list[str]], least: float) -> list[tuple[str, float, int, int]]:
    """``(name, coverage, start, end)`` with the span in characters."""
    found = list(WORDS.finditer(text))
    words = [m[0].lower() for m in found]
    places: dict[str, list[int]] | None = None
    known = set(words)
    out = []
    for name, template in templates.items():
        size = len(template)
        missing = size - -(-int(least * 1000) * size // 1000)
        if not size or sum(w in known for w in template) < size - missing:
            continue
        if places is None:
            places = {}
            for i, w in enumerate(words):
                places.setdefault(w, []).append(i)
        rarest, allowed = [], missing
        for w, n in sorted(Counter(template).items(), key=lambda x: (len(places.get(x[0], ())), x[0])):
            rarest.append(w)
            allowed -= n
            if allowed < 0:
                break
        matches, seen = [], -1
        for at, word in sorted((i, w) for w in rarest for i in places.get(w, ())):
            if at <= seen:
                continue
            # close around where the template would lie, so that a copy next to it doesn't blur the anchors; else wider
            spots = [(at - j - missing, at - j + size + missing) for j, w in enumerate(template) if w == word]
            for low, high in [*spots, (at - 2 * size, at + 2 * size)]:
                best, start, end = densest(words, max(0, low), min(len(words), high), template)
                if best >= size - missing:
                    matches.append((best / size, start, end))
                    if best == size == end - start + 1:
                        seen = end
                        break
        taken: list[tuple[int, int]] = []
        for coverage, start, end in sorted(set(matches), key=lambda m: (-m[0], m[2] - m[1], m[1])):
            if all(end < a or start > b for a, b in taken):
                taken.append((start, end))
                out.append((name, coverage, found[start].start(), found[end].end()))
    return sorted(out, key=lambda m: (m[2], m[3], m[0]))


def license_scan(documents: DataFrame, templates: dict[str, str] | None = None, least: float = 0.8) -> DataFrame:
    """``doc_id, license, coverage, start_char, end_char`` of each notice found. The templates go along with the task."""
    split = {n: [w.lower() for w in WORDS.findall(t)] for n, t in (TEMPLATES if templates is None else templates).items()}

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [
            (i, *m)
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True)
            for m in scan(text, split, least)
        ]
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        types = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "license", "coverage", "start_char", "end_char"])

    return per_batch(texts(documents), work, "doc_id long, license string, coverage double, start_char long, end_char long")
