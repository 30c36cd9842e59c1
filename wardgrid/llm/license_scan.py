"""License scans: winnowed template fingerprints pick candidates, chains of equal runs report what matched.

Templates are cut into words (lower case, letters and digits); of each ``WINDOW`` neighbouring runs of
``GRAM`` words the one with the least hash becomes a fingerprint in an inverted index.  Any run of
``WINDOW + GRAM - 1`` template words that a document repeats therefore hits the index (shorter templates
keep all runs, those of one or two words are looked up whole).  The runs of ``GRAM`` or more words that a
document shares with a template found so are chained in the order of both, over edits of any width; one
alignment in each gap and at both ends counts the shorter runs, and coverage is judged on the whole chain.

The template table is a parameter of bounded size that travels with the task; documents are read once,
whole, without a shuffle.  Defined results: NULL or empty text has no match; repeated rows are reported
each; a span runs from the first to the last matched word; of matches that share words the one with the greatest coverage (then most words, then name) stays;
an empty template table finds nothing; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardgrid.llm import textbytes

GRAM = 3
WINDOW = 2
BAND = 8  # words added to a template that an alignment beside a run of equal words follows
REACH = 512  # words beside a run in which runs shorter than GRAM are looked for
UNIT = 1 << 20
MIN_PERCENT = 80

WORD_BYTES = np.zeros(256, bool)
for _low, _high in ((48, 58), (65, 91), (97, 123), (128, 256)):
    WORD_BYTES[_low:_high] = True

# Wording of public license notices.
TEMPLATES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions: The above copyright notice and this permission notice shall be included in all copies
        or substantial portions of the Software.""",
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
        in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0""",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "BSD-clauses": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: Redistributions of source code must retain the above
        copyright notice, this list of conditions and the following disclaimer.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "GPL-2.0-or-later": """This program is free software; you can redistribute it and/or modify it under the terms of
        the GNU General Public License as published by the Free Software Foundation; either version 2 of the License,
        or (at your option) any later version.""",
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify it under the terms of
        the GNU General Public License as published by the Free Software Foundation, either version 3 of the License,
        or (at your option) any later version.""",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
        MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "all-rights-reserved": "All rights reserved.",
}

FOUND = "doc_id bigint, license string, coverage double, matched_words int, template_words int, start bigint, end bigint"


def words_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words, and the words before each text."""
    lowered = textbytes.LOWER[data]
    starts, ends, before = textbytes.spans(lowered, bounds, WORD_BYTES)
    return textbytes.hash_spans(lowered, starts, ends), starts, ends, before


class Index:
    """Winnowed fingerprints of the templates: sorted hashes and, for each, (template, word position)."""

    def __init__(self, templates: dict[str, str]):
        self.names = sorted(templates)
        self.words, self.grams, places = [], [], defaultdict(list)
        self.short: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))  # by words, then by hash
        for k, name in enumerate(self.names):
            data = np.frombuffer(templates[name].encode(), np.uint8)
            words = words_of(data, np.array([0, len(data)]))[0]
            self.words.append(words)
            grams = textbytes.gram_hash(words, min(GRAM, max(len(words), 1)))
            order = np.argsort(grams, kind="stable")
            self.grams.append((grams[order], order))
            if 0 < len(words) < GRAM:
                self.short[len(words)][int(grams[0])].append(k)
                continue
            for at in winnow(grams, WINDOW) if len(words) >= WINDOW + GRAM - 1 else range(len(grams)):
                places[int(grams[at])].append((k, int(at)))
        self.hashes = np.array(sorted(places), np.uint64)
        self.places = [places[int(h)] for h in self.hashes]


def winnow(hashes: np.ndarray, window: int) -> list[int]:
    """Positions of the least hash of every window, the rightmost of equals."""
    chosen = set()
    for at in range(len(hashes) - window + 1):
        part = hashes[at : at + window]
        chosen.add(at + window - 1 - int(np.argmin(part[::-1])))
    return sorted(chosen)


def runs_of(grams: np.ndarray, given: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first document word, first template word, words) of the longest equal runs; ``given`` are the template's sorted grams."""
    low, high = np.searchsorted(given, grams), np.searchsorted(given, grams, side="right")
    n = high - low
    at = np.repeat(np.arange(len(grams)), n)
    place = places[np.arange(len(at)) + np.repeat(low - (np.cumsum(n) - n), n)]
    order = np.lexsort((at, at - place))
    at, place = at[order], place[order]
    first = np.flatnonzero(np.concatenate(([True], (np.diff(at) != 1) | (np.diff(place) != 1)))) if len(at) else np.zeros(0, int)
    length = np.diff(np.append(first, len(at))) + GRAM - 1
    order = np.lexsort((place[first], at[first]))
    return at[first][order], place[first][order], length[order]


def chains(at: np.ndarray, place: np.ndarray, length: np.ndarray, size: int, gap: float) -> Iterator[list[tuple[int, int, int, int]]]:
    """Runs in order of both texts, best chain first: lists of (run, document word, template word, words).

    A step costs the logarithm of the words it skips, so that no edit is too wide and no far chance run joins;
    a step over more than ``gap`` words is not taken.  Overlaps are cut from the later run.  For each end in the
    template the latest and the best run so far are open, so a run costs the same in any document.
    """
    score, back, cut = length.astype(float), np.full(len(at), -1), np.zeros(len(at), int)
    ends, open_score, open_at, open_run = np.arange(size + 1), np.full((2, size + 1), -np.inf), np.zeros((2, size + 1), int), np.full((2, size + 1), -1)
    for k, (a, b, n) in enumerate(zip(at.tolist(), place.tolist(), length.tolist(), strict=True)):
        over = np.maximum(np.maximum(ends - b, open_at - a), 0)
        skipped = np.maximum(np.maximum(a + over - open_at, b + over - ends), 0)
        step = np.where((over < n) & (skipped <= gap), open_score + (n - over) - np.log2(1 + skipped), -np.inf)
        best = int(np.argmax(step))
        if step.flat[best] > n:
            score[k], back[k], cut[k] = step.flat[best], open_run.flat[best], over.flat[best]
        for t in (0, 1):
            if t == 0 or score[k] >= open_score[1, b + n]:
                open_score[t, b + n], open_at[t, b + n], open_run[t, b + n] = score[k], a + n, k
    done = np.zeros(len(at), bool)
    for k in np.argsort(-score, kind="stable").tolist():
        chain = []
        while k >= 0 and not done[k]:
            chain.append((k, int(at[k] + cut[k]), int(place[k] + cut[k]), int(length[k] - cut[k])))
            k = int(back[k])
        if k < 0 and chain:
            yield chain[::-1]
        done[[c[0] for c in chain]] = True


def extend(template: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Best ``score * UNIT + matched words`` from the start of both to each pair of places: a match gains 1, an edit costs 1."""
    steps = UNIT * np.arange(len(words) + 1)
    out = np.empty((len(template) + 1, len(words) + 1), np.int64)
    out[0] = -steps
    for i in range(len(template)):
        out[i + 1, 0] = -UNIT * (i + 1)
        out[i + 1, 1:] = np.maximum(out[i, :-1] + np.where(words == template[i], UNIT + 1, -UNIT), out[i, 1:] - UNIT)
        out[i + 1] = np.maximum.accumulate(out[i + 1] + steps) - steps
    return out


def ends_of(words: np.ndarray, most: int, mark: int) -> np.ndarray:
    """``words``, or both their ends around a word that nothing equals."""
    return words if len(words) <= 2 * most + 1 else np.concatenate((words[:most], [np.uint64(mark)], words[-most:]))


def between(template: np.ndarray, words: np.ndarray) -> int:
    """Matched words between two runs: along edits from either side, with one wide edit in the middle free."""
    template, words = ends_of(template, REACH, 1), ends_of(words, min(len(template) + BAND, REACH), 0)
    if not len(template) or not len(words):
        return 0
    ahead = np.maximum.accumulate(np.maximum.accumulate(extend(template, words), 0), 1)
    return int((ahead + extend(template[::-1], words[::-1])[::-1, ::-1]).max()) % UNIT


def beyond(template: np.ndarray, words: np.ndarray) -> tuple[int, int]:
    """(matched words, document words) after the last run."""
    template = template[:REACH]
    value = extend(template, words[: len(template) + BAND])
    return int(value.max()) % UNIT, int(np.argmax(value)) % value.shape[1]


def measured(template: np.ndarray, words: np.ndarray, chain: list[tuple[int, int, int, int]]) -> tuple[int, list[tuple[int, int]]]:
    """Matched words of a chain, and the stretches of the document (first, last word) that hold them."""
    (_, a, b, n), (_, a2, b2, n2) = chain[0], chain[-1]
    before, lead = beyond(template[:b][::-1], words[max(0, a - b - BAND) : a][::-1])
    after, trail = beyond(template[b2 + n2 :], words[a2 + n2 :])
    matched, parts = before + after + n, [[a - lead, a + n - 1]]
    for (_, a, b, n), (_, a2, b2, n2) in zip(chain, chain[1:], strict=False):
        matched += n2 + between(template[b + n : b2], words[a + n : a2])
        if a2 - (a + n) <= BAND:
            parts[-1][1] = a2 + n2 - 1
        else:
            parts.append([a2, a2 + n2 - 1])
    parts[-1][1] += trail
    return matched, [(f, e) for f, e in parts]


Match = tuple[int, int, int, int, list[tuple[int, int]]]


def find(index: Index, template: int, words: np.ndarray, percent: int) -> list[Match]:
    """All matches of one template in the words of a document: near ones first, then those with wide edits."""
    own, found = index.words[template], []
    for gap in (max(BAND, len(own) // 4), np.inf):
        took = True
        while took:  # a document may hold the template several times
            took, free = False, words.copy()
            for chain in chains(*runs_of(textbytes.gram_hash(words, GRAM), *index.grams[template]), len(own), gap):
                sure = sum(n for *_, n in chain)
                # Runs of GRAM words are in chains, so at most GRAM - 1 of GRAM other words match.
                if 100 * (sure + (GRAM - 1) * (len(own) - sure) / GRAM + (GRAM - 1) * (len(chain) + 1)) < percent * len(own):
                    continue
                if any((words[a : a + n] != free[a : a + n]).any() for _, a, _, n in chain):
                    continue
                matched, parts = measured(own, free, chain)
                if 100 * matched >= percent * len(own):
                    found.append((template, matched, parts[0][0], parts[-1][1], parts))
                    for first, last in parts:
                        free[first : last + 1] = 0
                    took = True
            words = free
    return found


def scan_text(index: Index, words: np.ndarray, percent: int = MIN_PERCENT) -> list[tuple[int, int, int, int]]:
    """(template, matched words, first word, last word) of the matches in one document's words."""
    grams, templates, found = textbytes.gram_hash(words, GRAM), set(), []
    for hit in np.flatnonzero(np.isin(index.hashes, grams)).tolist():
        templates.update(t for t, _ in index.places[hit])
    for template in sorted(templates):
        found += find(index, template, words, percent)
    for n, short in index.short.items():
        for at, key in zip(*hits_of(textbytes.gram_hash(words, n), np.array(sorted(short), np.uint64)), strict=True):
            found += [(t, n, at, at + n - 1, [(at, at + n - 1)]) for t in short[key]]
    return best_apart(index, found, len(words))


def hits_of(grams: np.ndarray, hashes: np.ndarray) -> tuple[list[int], list[int]]:
    at = np.flatnonzero(np.isin(grams, hashes))
    return at.tolist(), grams[at].tolist()


def best_apart(index: Index, found: list[Match], size: int) -> list[tuple[int, int, int, int]]:
    """Matches that share no stretch with a better one, in the order of the text."""
    order = sorted(found, key=lambda m: (-m[1] / len(index.words[m[0]]), -m[1], m[0], m[2]))
    taken, kept = np.zeros(size, bool), []
    for match in order:
        if not any(taken[first : last + 1].any() for first, last in match[4]):
            kept.append(match[:4])
            for first, last in match[4]:
                taken[first : last + 1] = True
    return sorted(kept, key=lambda m: m[2])


def scan(docs: DataFrame, templates: dict[str, str] | None = None, percent: int = MIN_PERCENT) -> DataFrame:
    """One row per match: doc_id, license, coverage, word counts, and the span in code points of the text."""
    given = TEMPLATES if templates is None else templates

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(given)
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), []
            for row, _, data, bounds in textbytes.blocks(batch.column(1)):
                words, starts, ends, before = words_of(data, bounds)
                grams = textbytes.gram_hash(words, GRAM)
                near = np.flatnonzero(np.isin(grams, index.hashes))
                for n, short in index.short.items():
                    near = np.append(near, hits_of(textbytes.gram_hash(words, n), np.array(sorted(short), np.uint64))[0]).astype(int)
                for k in np.unique(np.searchsorted(before, near, side="right") - 1).tolist():
                    a, b = before[k], before[k + 1]
                    for template, matched, first, last in scan_text(index, words[a:b], percent):
                        begin, end = bounds[k], starts[a + first]
                        lead = int((data[begin:end] & 0xC0 != 0x80).sum())
                        span = int((data[end : ends[a + last]] & 0xC0 != 0x80).sum())
                        size = len(index.words[template])
                        out.append((ids[row + k], index.names[template], matched / size, matched, size, lead, lead + span))
            types = [pa.int64(), pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
            names = [f.split()[0] for f in FOUND.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in enumerate(types)], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, FOUND)
