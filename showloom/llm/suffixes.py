"""Removing byte strings that occur in an earlier document, by longest previous factors in suffix order."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mixed, runs, utf8
from .repeats import Runs, covered, one_text, without_repeats
from .words import _BASE, byte_values, powers

#: Bytes whose hashes choose a window's anchor: the least among all such strings of the window.
GRAM = 20
#: Base of the second hash of a run.
_OTHER_BASE = 0xC2B2AE3D27D4EB4F


def longest_previous(lcp: list[int], docs: list[int]) -> list[int]:
    """For suffixes in suffix order: the longest prefix shared with a suffix of a smaller document.

    ``lcp[i]`` is what suffixes i - 1 and i share. The best match of a suffix is the nearest one of a
    smaller document before it or behind it (previous and next smaller value); what it
    shares with that one is the least lcp between them.
    """
    n = len(docs)
    out = [0] * n
    for places in (range(n), range(n - 1, -1, -1)):
        step = 1 if places.step > 0 else 0
        stack: list[tuple[int, int]] = []  # documents, rising; least lcp between each and the next suffix
        for i in places:
            shared = (lcp[i] if step else lcp[i + 1] if i + 1 < n else 0) if stack else 0
            doc = docs[i]
            while stack:
                top, low = stack[-1]
                if low < shared:
                    shared = low
                if top < doc:
                    break
                stack.pop()
            if stack:
                if shared > out[i]:
                    out[i] = shared
                stack[-1] = (stack[-1][0], shared)
            stack.append((doc, 1 << 30))
    return out


def suffix_order(strings: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of byte strings of one length (rows), equal ones by document, and what neighbours share."""
    n, size = strings.shape
    padded = np.zeros((n, -(-size // 8) * 8), np.uint8)
    padded[:, :size] = strings
    words = padded.view(">u8").astype(np.uint64)
    order = np.lexsort((doc, *words.T[::-1]))
    lcp = np.zeros(n, np.int64)
    a, b = strings[order[:-1]], strings[order[1:]]
    differ = a != b
    lcp[1:] = np.where(differ.any(1), differ.argmax(1), size)
    return order, lcp


class SuffixScheme:
    """Tokens are bytes. A window's anchor is its string of ``GRAM`` bytes with the least hash, the leftmost of equal ones."""

    def __init__(self, window: int = 50):
        self.window, self.gram = window, min(GRAM, window)

    def tokens(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return utf8(text)

    def runs(self, tokens: np.ndarray, at: np.ndarray) -> Runs:
        n, k, size = len(tokens), self.gram, self.window
        if n < size:
            none = np.zeros(0, np.int64)
            return Runs(none, none, none, *[none.view(np.uint64)] * 3)
        back = powers(n + 1, pow(_BASE, -1, 2**64))
        prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(byte_values(3)[tokens] * powers(n), out=prefix[1:])
        names = mixed((prefix[k:] - prefix[:-k]) * back[: n - k + 1])
        keys = (names & ~np.uint64((1 << 24) - 1)) | np.arange(len(names), dtype=np.uint64)
        width, have = size - k + 1, 1
        while have < width:  # least key of 2, 4, 8 ... places
            step = min(have, width - have)
            keys = np.minimum(keys[:-step], keys[step:])
            have += step
        anchor = (keys & np.uint64((1 << 24) - 1)).astype(np.int64)
        owner = np.repeat(np.arange(len(at) - 1), np.diff(at))[: len(anchor)]
        inside = np.arange(len(anchor)) + size <= at[1:][owner]
        new = np.ones(len(anchor), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1]) | ~inside[:-1]
        start = np.flatnonzero(new & inside)
        edges = np.append(np.flatnonzero(new | ~inside), len(anchor))
        count = edges[np.searchsorted(edges, start, "right")] - start
        end = start + count - 1 + size
        shape = ((anchor[start] - start).astype(np.uint64) << np.uint64(32)) ^ count.astype(np.uint64)
        content = mixed(mixed((prefix[end] - prefix[start]) * back[start]) ^ shape)
        np.cumsum(byte_values(4)[tokens] * powers(n, _OTHER_BASE), out=prefix[1:])
        back = powers(n + 1, pow(_OTHER_BASE, -1, 2**64))
        second = mixed(mixed((prefix[end] - prefix[start]) * back[start]) ^ shape)
        return Runs(owner[start], start, count, names[anchor[start]], content, second)

    def contexts(self, tokens: np.ndarray, start: np.ndarray, count: np.ndarray) -> list[bytes]:
        raw = tokens.tobytes()
        return [raw[s : s + c + self.window - 1] for s, c in zip(start.tolist(), count.tolist(), strict=True)]

    def repeated(self, contexts: list[bytes], count: np.ndarray, doc: np.ndarray) -> np.ndarray:
        raw = np.frombuffer(b"".join(contexts), np.uint8)
        starts = np.cumsum(count + self.window - 1) - (count + self.window - 1)
        place = runs(starts.astype(np.int64), count.astype(np.int64))
        whose = np.repeat(doc, count)
        order, lcp = suffix_order(np.lib.stride_tricks.sliding_window_view(raw, self.window)[place], whose)
        factors = longest_previous(lcp.tolist(), whose[order].tolist())
        out = np.zeros(len(place), bool)
        out[order] = np.array(factors) >= self.window
        return out


SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, text_sha256 string"


def remove_repeats(docs: DataFrame, window: int = 50) -> DataFrame:
    """Every row of ``docs`` without the bytes covered by a string of ``window`` bytes that also starts in a document of smaller id.

    doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, kept (the bytes that stay, maybe not
    whole characters) and text_sha256 (of the whole text). A null text is empty; texts shorter than a window stay; matches are
    judged on the input and never cross documents. A null doc_id is smaller than none and
    larger than none: its row stays whole. Rows with the same doc_id do not take bytes from
    one another. Other columns play no part.
    """

    def result(documents: pa.Table, row: np.ndarray, first: np.ndarray, count: np.ndarray) -> pa.Table:
        raw, at = utf8(one_text(documents))
        start = at[row] + first
        gone = covered(len(raw), start, start + count - 1 + window)
        removed = np.append(0, np.cumsum(gone))[at]
        rising = gone & ~np.append(False, gone[:-1])
        rising[at[:-1][(at[:-1] < len(raw))]] |= gone[at[:-1][(at[:-1] < len(raw))]]
        spans = np.append(0, np.cumsum(rising))[at]
        kept_raw = raw[~gone].tobytes()
        where = (at - removed).tolist()
        kept = [kept_raw[a:b] for a, b in zip(where[:-1], where[1:], strict=True)]
        return pa.table({
            "doc_id": documents.column("doc_id"), "n_bytes": np.diff(at), "n_removed": np.diff(removed),
            "n_spans": np.diff(spans), "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
            "kept": pa.array(kept, pa.binary()), "text_sha256": [
                hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)
            ],
        })

    return without_repeats(docs, SuffixScheme(window), result, SCHEMA)


def without_copies(docs: DataFrame, window: int = 50) -> DataFrame:
    """``docs`` with all columns, where ``text`` has lost the strings that ``remove_repeats`` removes; no row goes.

    Bytes of a character that was cut at the edge of a removed string go with it. Rows without a removed byte
    stay as they are; ``n_chars``, where there is one, follows the text.
    """
    cut = remove_repeats(docs, window).filter("n_removed > 0").dropDuplicates(["doc_id", "text_sha256"])

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x.decode(errors="ignore") for x in batch.column("kept").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("cut_id"), batch.column("text_sha256"), pa.array(texts, pa.string())], ["cut_id", "text_sha256", "kept"])

    cut = cut.select(F.col("doc_id").alias("cut_id"), "text_sha256", "kept").mapInArrow(decoded, "cut_id long, text_sha256 string, kept string")
    key = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    rows = docs.alias("d").join(cut.alias("c"), (F.col("d.doc_id") == F.col("c.cut_id")) & (key == F.col("c.text_sha256")), "left")
    whole = F.col("c.cut_id").isNull()
    values = {"text": F.when(whole, F.col("d.text")).otherwise(F.col("c.kept"))}
    if "n_chars" in docs.columns:
        values["n_chars"] = F.when(whole, F.col("d.n_chars")).otherwise(F.length("c.kept").cast("long"))
    return rows.select(*[values.get(c, F.col(f"d.`{c}`")).alias(c) for c in docs.columns])
