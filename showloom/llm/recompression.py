"""Removing long word passages that occur in an earlier document, by recompression.

Rounds name runs of one symbol and pairs of two, each round over the symbols of the last. A name
is a function of what it stands for, so it is the same in every task and document, and two
symbols of one name stand for the same words. Which neighbours become a pair depends on
nothing but these two: a bit of each name says whether it can be a left or a right half.
Symbols too long for a round wait, which bounds how far an edge can change the symbols beside
it. So equal passages have equal symbols in their interior.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import mixed, runs, utf8
from .repeats import Runs, covered, one_text, without_repeats
from .words import _BASE, hashed_words, powers

#: Rounds: what is named, and the longest symbol (in words) that takes part.
ROUNDS = (("runs", 1), ("pairs", 1), ("pairs", 1), ("pairs", 2), ("pairs", 2), ("pairs", 3), ("pairs", 4))
#: Words of the longest run that is named; a longer one keeps its symbols.
LONGEST_RUN = 3
#: Base of the second hash of a run or window.
_OTHER_BASE = 0xC2B2AE3D27D4EB4F


def longest_symbol(rounds=ROUNDS) -> int:
    longest = 1
    for kind, most in rounds:
        longest = max(longest, LONGEST_RUN if kind == "runs" else 2 * most)
    return longest


def margin(rounds=ROUNDS) -> int:
    """Words from either edge of a passage beyond which its symbols depend on the passage alone.

    In a round of pairs a boundary can change only within ``most`` words of the last round's margin; in a
    round of runs, within a run and the symbol beside it.
    """
    return sum(LONGEST_RUN + most if kind == "runs" else most for kind, most in rounds)


def merged(names: np.ndarray, lengths: np.ndarray, owner: np.ndarray, kind: str, most: int, number: int):
    """Names, lengths and texts of the symbols after one round."""
    n = len(names)
    if n < 2:
        return names, lengths, owner
    small = lengths <= most
    near = owner[1:] == owner[:-1]
    if kind == "pairs":
        right = (mixed(names + np.uint64(2 * number + 1)) & np.uint64(1)).astype(bool)
        joins = near & small[:-1] & small[1:] & ~right[:-1] & right[1:]
        head = np.append(joins, False)
        tail = np.append(False, joins)
        second = np.append(names[1:], np.uint64(0))
        new = np.where(head, mixed(mixed(names + np.uint64(0x9E37)) * np.uint64(3) + second), names)
        length = lengths + np.where(head, np.append(lengths[1:], 0), 0)
        return new[~tail], length[~tail], owner[~tail]
    same = near & (names[1:] == names[:-1]) & small[1:]
    start = np.append(True, ~same)
    at = np.flatnonzero(start)
    times = np.diff(np.append(at, n))
    total = times * lengths[at]
    named = (times > 1) & (total <= LONGEST_RUN)
    keep = start | ~np.repeat(named, times)
    new, length = names.copy(), lengths.copy()
    new[at[named]] = mixed(mixed(names[at[named]] + np.uint64(0x85EB)) + times[named].astype(np.uint64))
    length[at[named]] = total[named]
    return new[keep], length[keep], owner[keep]


def symbols(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names, first words and texts of the symbols that all rounds leave."""
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    names, lengths = words, np.ones(len(words), np.int64)
    for number, (kind, most) in enumerate(ROUNDS):
        names, lengths, owner = merged(names, lengths, owner, kind, most, number)
    return names, np.cumsum(lengths) - lengths, owner


class PassageScheme:
    """Tokens are words between blanks. A window's anchor is the least name among the symbols of its interior."""

    def __init__(self, window: int = 50):
        self.window = window
        self.margin, longest = margin(), longest_symbol()
        self.span = window - 2 * self.margin - longest + 1  # places an interior symbol can start at
        if self.span < longest:
            raise ValueError(f"a window needs {2 * (self.margin + longest) - 1} words")

    def tokens(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words = hashed_words(*utf8(text), lower=False)
        return words.hashes, words.at

    def runs(self, tokens: np.ndarray, at: np.ndarray) -> Runs:
        n, size = len(tokens), self.window
        if n < size:
            none = np.zeros(0, np.int64)
            return Runs(none, none, none, *[none.view(np.uint64)] * 3)
        names, first, _ = symbols(tokens, at)
        low = np.uint64((1 << 24) - 1)
        keys = np.full(n, ~np.uint64(0))
        keys[first] = (mixed(names + np.uint64(11)) & ~low) | first.astype(np.uint64)
        name_at = np.zeros(n, np.uint64)
        name_at[first] = names
        have = 1
        while have < self.span:
            step = min(have, self.span - have)
            keys = np.minimum(keys[:-step], keys[step:])
            have += step
        windows = n - size + 1
        anchor = (keys[self.margin : self.margin + windows] & low).astype(np.int64)
        owner = np.repeat(np.arange(len(at) - 1), np.diff(at))[:windows]
        inside = np.arange(windows) + size <= at[1:][owner]
        new = np.ones(windows, bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1]) | ~inside[:-1]
        start = np.flatnonzero(new & inside)
        edges = np.append(np.flatnonzero(new | ~inside), windows)
        count = edges[np.searchsorted(edges, start, "right")] - start
        end = start + count - 1 + size
        shape = ((anchor[start] - start).astype(np.uint64) << np.uint64(32)) ^ count.astype(np.uint64)
        contents = []
        for base in (_BASE, _OTHER_BASE):
            prefix, back = _sums(tokens, base)
            contents.append(mixed(mixed((prefix[end] - prefix[start]) * back[start]) ^ shape))
        return Runs(owner[start], start, count, mixed(name_at[anchor[start]]), *contents)

    def contexts(self, tokens: np.ndarray, start: np.ndarray, count: np.ndarray) -> list[bytes]:
        """The names of the windows: two hashes of 64 bits each."""
        place = runs(start.astype(np.int64), count.astype(np.int64))
        both = []
        for base in (_BASE, _OTHER_BASE):
            prefix, back = _sums(tokens, base)
            both.append(mixed((prefix[place + self.window] - prefix[place]) * back[place]))
        raw = np.stack(both, 1).tobytes()
        edges = np.append(0, np.cumsum(count)) * 16
        return [raw[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]

    def repeated(self, contexts: list[bytes], count: np.ndarray, doc: np.ndarray) -> np.ndarray:
        names = np.frombuffer(b"".join(contexts), np.uint64).reshape(-1, 2)
        whose = np.repeat(doc, count)
        order = np.lexsort((whose, names[:, 1], names[:, 0]))
        new = np.ones(len(order), bool)
        new[1:] = (names[order][1:] != names[order][:-1]).any(1)
        least = whose[order][np.flatnonzero(new)][np.cumsum(new) - 1]
        out = np.zeros(len(order), bool)
        out[order] = whose[order] > least
        return out


def _sums(words: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    prefix = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers(len(words), base), out=prefix[1:])
    return prefix, powers(len(words) + 1, pow(base, -1, 2**64))


SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def remove_passages(docs: DataFrame, window: int = 50) -> DataFrame:
    """Every row of ``docs`` without the words covered by ``window`` words that also start in a document of smaller id.

    doc_id, n_words, n_removed, kept_sha256 and kept (words that stay, joined by one space).
    Words are what stands between ASCII blanks, unchanged. A null text has none; texts shorter
    than a window stay; matches are judged on the input and never cross documents. A row with a null
    doc_id stays whole. Rows with the same doc_id do not take words from one another. Other columns
    play no part.
    """

    def result(documents: pa.Table, row: np.ndarray, first: np.ndarray, count: np.ndarray) -> pa.Table:
        raw, at = utf8(one_text(documents))
        words = hashed_words(raw, at, lower=False)
        start = words.at[row] + first
        gone = covered(len(words.hashes), start, start + count - 1 + window)
        removed = np.append(0, np.cumsum(gone))[words.at]
        # kept words with one space behind each, cut into texts
        first_byte, size = words.first[~gone], (words.last - words.first)[~gone]
        sep = np.append(raw, np.uint8(32))
        place = runs(first_byte, size + 1)
        ends = np.cumsum(size + 1)
        place[ends - 1] = len(raw)
        text = sep[place].tobytes()
        edge = np.append(0, ends)[words.at - removed].tolist()
        kept = [text[a : max(a, b - 1)] for a, b in zip(edge[:-1], edge[1:], strict=True)]
        return pa.table({
            "doc_id": documents.column("doc_id"), "n_words": np.diff(words.at), "n_removed": np.diff(removed),
            "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
            "kept": pa.array([x.decode() for x in kept], pa.string()),
        })

    return without_repeats(docs, PassageScheme(window), result, SCHEMA)
