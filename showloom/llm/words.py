"""Words of whole texts as 64-bit hashes, for many texts at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .common import mixed

#: Byte classes: blank as in ``[\\x20\\x09-\\x0D]``; alphanumeric as in ``[0-9A-Za-z]`` or any byte of a non-ASCII character.
BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_CODES = np.arange(256)
ALNUM = (_CODES >= 0x80) | ((_CODES >= 48) & (_CODES <= 57)) | ((_CODES >= 65) & (_CODES <= 90)) | ((_CODES >= 97) & (_CODES <= 122))
LOWER = np.where((_CODES >= 65) & (_CODES <= 90), _CODES + 32, _CODES).astype(np.uint8)

#: Bytes that are hashed together.
BLOCK = 1 << 18

_BASE = 0x9E3779B97F4A7C15 | 1


@dataclass
class Words:
    """Words of several texts: hash, first and last byte (exclusive), and where each text's words start."""

    hashes: np.ndarray
    first: np.ndarray
    last: np.ndarray
    at: np.ndarray

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """1, base, base**2 ... modulo 2**64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def byte_values(seed: int) -> np.ndarray:
    """A fixed random 64-bit number for each byte."""
    return np.random.default_rng(seed).integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


def spans_of(raw: np.ndarray, at: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes with ``inside``, never across texts: starts, ends, and where each text's runs start."""
    n = len(raw)
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    before = np.empty(n + 1, bool)
    before[0], before[1:] = False, inside
    now = np.empty(n + 1, bool)
    now[:n], now[n] = inside, False
    first = np.flatnonzero(now & (~before | edge))
    last = np.flatnonzero(before & (~now | edge))
    return first, last, np.searchsorted(first, at)


def span_hashes(raw: np.ndarray, first: np.ndarray, last: np.ndarray, seed: int = 1) -> np.ndarray:
    """64-bit hashes of byte spans in order: differences of prefix sums, brought to one place by an inverse power.

    Works through blocks of spans, so that the sums of a long text need little memory.
    """
    out = np.zeros(len(first), np.uint64)
    values, size, i = byte_values(seed), 0, 0
    while i < len(first):
        j = max(i + 1, int(np.searchsorted(last, first[i] + BLOCK, "right")))
        low, high = int(first[i]), int(last[j - 1])
        if high - low > size:
            size = max(BLOCK, high - low)
            ahead, back = powers(size), powers(size + 1, pow(_BASE, -1, 2**64))
        prefix = np.zeros(high - low + 1, np.uint64)
        np.cumsum(values[raw[low:high]] * ahead[: high - low], out=prefix[1:])
        a, b = first[i:j] - low, last[i:j] - low
        out[i:j] = (prefix[b] - prefix[a]) * back[a] + (b - a).astype(np.uint64)
        i = j
    return mixed(out)


def hashed_words(raw: np.ndarray, at: np.ndarray, lower: bool, split: str = "blank") -> Words:
    """Words between blanks, or alphanumeric words, or (``both``) alphanumeric words and runs of other signs."""
    kept = LOWER[raw] if lower else raw
    if split == "blank":
        first, last, where = spans_of(raw, at, ~BLANK[raw])
    elif split == "alnum":
        first, last, where = spans_of(raw, at, ALNUM[raw])
    else:
        one, other = spans_of(raw, at, ALNUM[raw]), spans_of(raw, at, ~ALNUM[raw] & ~BLANK[raw])
        first, last = np.sort(np.concatenate([one[0], other[0]])), np.sort(np.concatenate([one[1], other[1]]))
        where = np.searchsorted(first, at)
    return Words(span_hashes(kept, first, last), first, last, where)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n consecutive words, one for each place where n words follow."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for i in range(n):
        out = mixed(out * np.uint64(0xD6E8FEB86659FD93) + hashes[i : i + m])
    return out
