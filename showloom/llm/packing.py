"""Packing documents into token sequences of balanced attention cost."""

from __future__ import annotations

import os
import sys
import types
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import pieces, runs, utf8

#: Tokens that are packed together, bytes after which they are counted, and bytes and chunks that are tokenized at once; they bound a task's memory.
BLOCK_TOKENS = 4_000_000
SLICE_BYTES, CODED_BYTES, CODED_CHUNKS = 8_000_000, 2_000_000, 1_000
#: Distinct chunks of text of which a Python worker remembers the ids, in each of two generations.
REMEMBERED = 300_000

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "cost double"
)


def chunks(raw: np.ndarray, at: np.ndarray, literals: tuple[bytes, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """Where texts can be cut without changing their byte-level BPE ids: starts of chunks, and of each text's chunks.

    A single space between two other signs belongs to what follows it, a single line break
    between two others is a token of its own, and a letter never shares a token with a
    punctuation mark behind it. All other signs stay with their neighbours. ``literals`` are the tokenizer's
    added tokens, which it finds in a text before all else: none is cut, nor parted from the sign before and the two behind it.
    """
    n = len(raw)
    # white space beyond ASCII starts with C2, E1, E2 or E3: no cut beside such characters
    wide = np.isin(raw, [0xC2, 0xE1, 0xE2, 0xE3])
    tail = raw >= 0x80
    tail[1:] &= wide[:-1] | np.append(False, wide[:-2])
    plain = (raw > 32) & ~wide & ~tail
    letter = ((raw | 32) >= 97) & ((raw | 32) <= 122) & (raw < 128)
    mark = (raw > 32) & (raw < 127) & ~letter & ~((raw >= 48) & (raw <= 57))
    cut = np.zeros(n + 1, bool)
    if n > 2:
        alone = plain[:-2] & plain[2:]
        cut[1 : n - 1] |= alone & (raw[1:-1] == 32)
        line = alone & (raw[1:-1] == 10)
        cut[1 : n - 1] |= line
        cut[2:n] |= line
        cut[1:n] |= letter[:-1] & mark[1:]
    data = raw.tobytes() if literals else b""
    for literal in literals:
        i = data.find(literal)
        while i >= 0:
            cut[i : i + len(literal) + 2] = False
            i = data.find(literal, i + 1)
    cut[at] = True
    starts = np.flatnonzero(cut[:n])
    return starts, np.searchsorted(starts, at)


class Encoder:
    """Token ids of many texts; chunks that occur again are not encoded again, also in later tasks of a worker."""

    def __init__(self, tokenizer_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs as many workers as there are cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.literals = tuple(t.content.encode() for t in added if t.content)
        lasting = sys.modules.setdefault("_showloom_packing", types.ModuleType("_showloom_packing")).__dict__
        self.recent, self.older = lasting.setdefault(tokenizer_path, ({}, {}))

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and where each text's ids start."""
        raw, at = utf8(text)
        starts, where = chunks(raw, at, self.literals)
        offsets = np.append(starts, len(raw)).astype(np.int64)
        data = pa.Array.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw.tobytes())]
        )
        coded = data.dictionary_encode()
        ids = self.known(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), np.uint32)
        begin = np.cumsum(sizes) - sizes
        code = np.asarray(coded.indices) if len(starts) else np.zeros(0, np.int64)
        out = flat[runs(begin[code], sizes[code])]
        per_chunk = np.append(0, np.cumsum(sizes[code]))
        return out, per_chunk[where]

    def known(self, distinct: list[bytes]) -> list[bytes]:
        """Ids of chunks. Of those met before, the ones used lately are remembered, in two generations."""
        recent, older = self.recent, self.older
        if len(recent) > REMEMBERED:
            older.clear()
            older.update(recent)
            recent.clear()
        new = []
        for c in distinct:
            if c not in recent:
                if c in older:
                    recent[c] = older[c]
                else:
                    new.append(c)
        for i in range(0, len(new), CODED_CHUNKS):
            part = new[i : i + CODED_CHUNKS]
            found = self.tokenizer.encode_batch_fast([c.decode() for c in part], add_special_tokens=False)
            recent.update((c, array("I", e.ids).tobytes()) for c, e in zip(part, found, strict=True))
        return [recent[c] for c in distinct]


def cost_of(length, linear: float, quadratic: float):
    """Estimated cost of attention over a piece."""
    return linear * length + quadratic * length * length


def assign(lengths: np.ndarray, size: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset): as few sequences as the tokens fill, none over ``size``.

    Whole sequences are cut off documents longer than one. What remains goes, the costliest
    first, to the sequence of lowest cost that has room for it; where none has, it is cut to
    fill the one of lowest cost that has any room.
    """
    out, sequence = [], 0
    for d in np.flatnonzero(lengths >= size).tolist():
        for k in range(int(lengths[d]) // size):
            out.append((d, k * size, size, sequence, 0))
            sequence += 1
    rest = lengths % size
    bins = -(-int(rest.sum()) // size)
    cost, room = np.zeros(bins), np.full(bins, size, np.int64)
    for d in np.argsort(-rest, kind="stable").tolist():
        left, start = int(rest[d]), int(lengths[d] - rest[d])
        while left:
            fits = room >= left
            if not fits.any():
                fits = room > 0
            b = int(np.argmin(np.where(fits, cost, np.inf)))
            take = min(left, int(room[b]))
            out.append((d, start, take, sequence + b, size - int(room[b])))
            cost[b] += cost_of(take, linear, quadratic)
            room[b] -= take
            start, left = start + take, left - take
    return out


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    size: int = 2048,
    linear: float = 1.0,
    quadratic: float = 1.0 / 2048,
) -> DataFrame:
    """Pieces of all documents (``doc_id``, ``text``) in sequences of at most ``size`` tokens.

    A document's tokens are the ids that the tokenizer as it is in its file gives its whole text (without special
    tokens added to it; the literal of one that a text holds is that token), with ``end_id`` behind them; a null or
    empty text has that one. Each id lies in one piece. Documents are packed where they are
    read, in blocks of about ``BLOCK_TOKENS`` tokens, so nothing is shuffled; at most one
    sequence of a block is not full. Sequence ids are the partition's number and a count.
    A null id stays null; rows with the same id are documents of their own.
    ``cost`` is the estimated cost of a piece.
    """
    wanted = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_path)
        base, held, tokens = TaskContext.get().partitionId() << 32, [], 0
        end = np.array([end_id], np.uint32)

        def flush():
            nonlocal base, held, tokens
            lengths = np.array([len(x) for _, x in held], np.int64)
            placed = assign(lengths, size, linear, quadratic)
            d = [p[0] for p in placed]
            columns = [
                pa.array([held[i][0] for i in d], pa.int64()),
                pa.array([p[1] for p in placed], pa.int64()),
                pa.array([p[2] for p in placed], pa.int64()),
                pa.array([zlib.crc32(held[p[0]][1][p[1] : p[1] + p[2]].astype("<u4").tobytes()) for p in placed], pa.int64()),
                pa.array(lengths[d] if d else [], pa.int64()),
                pa.array([base + p[3] for p in placed], pa.int64()),
                pa.array([p[4] for p in placed], pa.int64()),
                pa.array([cost_of(float(p[2]), linear, quadratic) for p in placed], pa.float64()),
            ]
            base += max((p[3] for p in placed), default=-1) + 1
            held, tokens = [], 0
            names = [f.split()[0] for f in SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            for part in pieces(batch, "text", SLICE_BYTES):
                for some in pieces(part, "text", CODED_BYTES):
                    ids, at = encoder.encode(some.column("text"))
                    for i, doc in enumerate(some.column("doc_id").to_pylist()):
                        held.append((doc, np.concatenate([ids[at[i] : at[i + 1]], end])))
                        tokens += len(held[-1][1])
                if tokens >= BLOCK_TOKENS:
                    yield flush()
        if held:
            yield flush()
        pa.default_memory_pool().release_unused()  # the worker stays, beside those of the stages that follow

    return wanted.mapInArrow(run, SCHEMA)
