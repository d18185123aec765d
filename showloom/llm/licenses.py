"""Licence notices in texts: winnowed fingerprints pick candidates, banded alignment measures them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import pieces, utf8
from .words import grams, hashed_words

#: Words of a fingerprint, and fingerprints of a window of which the least is kept.
GRAM, WINDOW = 3, 3
#: Templates of up to ``WHOLE`` words keep all fingerprints, so that whatever three quarters of their words are
#: there, one is; of up to ``SHORT`` words, where three words in a row may not be left, fingerprints have two.
WHOLE, SHORT = 40, 8
#: Words by which an alignment may leave its diagonal to either side.
BAND = 8
#: Share of a template's words that a match has in order.
COVERAGE = 0.75
SLICE_BYTES = 2_000_000

#: Wordings of notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "all-rights-reserved": "Copyright. All rights reserved.",
}


def winnowed(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places of the least hash of each window, the rightmost of equal ones; the least of all where there are fewer."""
    n = len(hashes)
    if not n:
        return np.zeros(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(hashes, min(window, n))
    least = view.shape[1] - 1 - np.argmin(view[:, ::-1], 1)
    return np.unique(least + np.arange(len(view)))


class TemplateIndex:
    """Inverted index: sorted fingerprints of three and of two words, each with a template and a place in it."""

    def __init__(self, names: list[str], words: list[np.ndarray], postings: dict[int, tuple[np.ndarray, ...]]):
        self.names, self.words, self.postings = names, words, postings

    @property
    def parts(self) -> tuple:
        """What the index is made of, as plain lists and arrays."""
        return self.names, self.words, self.postings

    @classmethod
    def over(cls, templates: dict[str, str]) -> TemplateIndex:
        words = hashed_words(*utf8(pa.array(list(templates.values()), pa.string())), lower=True, split="alnum")
        texts = [words.hashes[a:b] for a, b in zip(words.at[:-1], words.at[1:], strict=True)]
        found: dict[int, list] = {GRAM: [], GRAM - 1: []}
        for t, (name, w) in enumerate(zip(templates, texts, strict=True)):
            size = GRAM if len(w) > SHORT else GRAM - 1
            if len(w) < size:
                raise ValueError(f"a template needs {size} words: {name}")
            g = grams(w, size)
            at = np.arange(len(g)) if len(w) <= WHOLE else winnowed(g)
            found[size].append((g[at], np.full(len(at), t), at))
        postings = {}
        for size, lists in found.items():
            if lists:
                keys, template, place = (np.concatenate(c) for c in zip(*lists, strict=True))
                order = np.argsort(keys, kind="stable")
                postings[size] = keys[order], template[order], place[order]
        return cls(list(templates), texts, postings)

    def candidates(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Template and diagonal band (first word less place, in steps of ``BAND``) of all fingerprints that occur."""
        found = [np.zeros((0, 2), np.int64)]
        for size, (keys, template, place) in self.postings.items():
            g = grams(hashes, size)
            low, high = np.searchsorted(keys, g), np.searchsorted(keys, g, "right")
            n = high - low
            hit = np.repeat(np.arange(len(g)), n)
            entry = np.repeat(low, n) + np.arange(len(hit)) - np.repeat(np.cumsum(n) - n, n)
            found.append(np.stack([template[entry], (hit - place[entry]) // BAND], 1))
        both = np.unique(np.concatenate(found), axis=0)
        return both[:, 0], both[:, 1]


_BITS = 21


def aligned(template: np.ndarray, slices: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Longest common subsequence of a template and each row of ``slices`` within the band: words, first and last place.

    Column i + j of a row stands against template word i. A cell holds words, first place and least
    last place in one number, so that the greatest is the best.
    """
    rows, width = slices.shape[0], slices.shape[1] - len(template) + 1
    top = (1 << _BITS) - 1
    cell = np.zeros((rows, width), np.int64)
    for i, word in enumerate(template):
        place = np.arange(i, i + width)
        score, start = cell >> (2 * _BITS), (cell >> _BITS) & top
        step = ((score + 1) << (2 * _BITS)) | (np.where(score > 0, start, place) << _BITS) | (top - place)
        skip = np.zeros_like(cell)
        skip[:, :-1] = cell[:, 1:]
        cell = np.maximum(np.where(slices[:, i : i + width] == word, step, 0), skip)
        cell = np.maximum.accumulate(cell, 1)
    best = cell.max(1)
    return best >> (2 * _BITS), (best >> _BITS) & top, top - (best & top)


def matches(index: TemplateIndex, hashes: np.ndarray, coverage: float) -> list[tuple[int, int, int, int]]:
    """(template, words matched, first word, last word) of one text; of overlapping matches the one of most words and coverage."""
    template, band = index.candidates(hashes)
    found = []
    for t in np.unique(template).tolist():
        words = index.words[t]
        first = band[template == t] * BAND - BAND
        place = first[:, None] + np.arange(len(words) + 3 * BAND)
        inside = (place >= 0) & (place < len(hashes))
        outside = np.uint64(0)  # no word of the template
        while outside in words:
            outside += np.uint64(1)
        slices = np.where(inside, hashes[np.clip(place, 0, len(hashes) - 1)], outside)
        n, a, b = aligned(words, slices)
        for i in np.flatnonzero(n >= coverage * len(words)).tolist():
            found.append((-int(n[i]), -int(n[i]) / len(words), int(b[i] - a[i]), int(first[i] + a[i]), t))
    low = high = np.zeros(0, np.int64)  # ordered and apart
    out = []
    for score, _, span, start, t in sorted(found):
        i = int(np.searchsorted(high, start))
        if i == len(low) or low[i] > start + span:
            low, high = np.insert(low, i, start), np.insert(high, i, start + span)
            out.append((t, -score, start, start + span))
    return sorted(out, key=lambda x: x[2])


SCHEMA = "doc_id long, license string, start long, end long, n_matched long, coverage double"


def scan(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """Matches in every row of ``docs``: doc_id, license, start and end (bytes of the UTF-8 text), n_matched words and coverage.

    Words are letters and digits, A-Z in lower case. A match has at least ``coverage`` of the template's words
    in order, inside a band of ``BAND`` words. Matches do not overlap: most words win, then coverage, then the shorter span. The templates go to
    every task; texts are never shuffled. Null, empty and clean texts have no row; a null doc_id stays null;
    repeated rows repeat their matches. Without templates there is no match.
    """
    index = TemplateIndex.over(TEMPLATES if templates is None else templates)
    least = min(index.postings, default=GRAM)
    sent = docs.sparkSession.sparkContext.broadcast(index.parts)
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = TemplateIndex(*sent.value)
        for part in (x for b in batches for x in pieces(b, "text", SLICE_BYTES)):
            raw, at = utf8(part.column("text"))
            words = hashed_words(raw, at, lower=True, split="alnum")
            ids, rows = part.column("doc_id").to_pylist(), []
            for i in np.flatnonzero(np.diff(words.at) >= least).tolist():
                a, b = int(words.at[i]), int(words.at[i + 1])
                for t, n, low, high in matches(index, words.hashes[a:b], coverage):
                    rows.append((
                        ids[i], index.names[t], int(words.first[a + low] - at[i]), int(words.last[a + high] - at[i]),
                        n, n / len(index.words[t]),
                    ))
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
            types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, SCHEMA)
