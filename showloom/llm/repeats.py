"""Windows of tokens that also start in an earlier document, found in two rounds over anchored runs of windows.

Every window has an anchor, a place inside it that its tokens alone determine. Windows that
follow one another and share their anchor are a run; two equal windows have equal anchors
at the same distance. Round one brings together all runs by the name of their anchor, so a run that is equal to
one of an earlier document is settled. Round two is for what then remains, mostly the ends of
long repeats: runs that share an anchor's name with a different run of an earlier document. Their
windows are compared one by one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import long_values, packed, partitions, pieces, runs, stored, unpacked

#: Tokens that are looked at together; a longer text is looked at in parts.
PIECE = 1 << 20
#: Bytes of text whose runs are sorted together before they are sent.
BATCH_BYTES = 12_000_000
#: Groups that tasks work on one after the other, for each shuffle partition.
GROUPS = 8


@dataclass
class Runs:
    """Runs of windows: text, first window, number of windows, name of the anchor, 128 bits of hash of the whole run."""

    owner: np.ndarray
    first: np.ndarray
    count: np.ndarray
    name: np.ndarray
    content: np.ndarray
    second: np.ndarray

    def __len__(self) -> int:
        return len(self.owner)


class Scheme(Protocol):
    """How texts are cut into tokens, and how windows are anchored and compared."""

    window: int

    def tokens(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All tokens one after the other, and where each text's start."""

    def runs(self, tokens: np.ndarray, at: np.ndarray) -> Runs:
        """All runs; ``first`` counts from the first of all tokens."""

    def contexts(self, tokens: np.ndarray, start: np.ndarray, count: np.ndarray) -> list[bytes]:
        """What is needed to compare the windows ``start`` ... ``start + count - 1``."""

    def repeated(self, contexts: list[bytes], count: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """For each window of each context: does a context of a smaller document have an equal one?"""


def in_pieces(at: np.ndarray, window: int) -> Iterator[tuple[int, int, int, int]]:
    """Ranges (first text, last text, first token, last token) of at most about ``PIECE`` tokens.

    A longer text comes in parts that overlap by one token less than a window.
    """
    i, n = 0, len(at) - 1
    while i < n:
        if at[i + 1] - at[i] > PIECE:
            for s in range(int(at[i]), int(at[i + 1]) - window + 1, PIECE):
                yield i, i + 1, s, min(s + PIECE + window - 1, int(at[i + 1]))
            i += 1
            continue
        j = max(i + 1, int(np.searchsorted(at, at[i] + PIECE, "right")) - 1)
        yield i, j, int(at[i]), int(at[j])
        i = j


def all_runs(scheme: Scheme, tokens: np.ndarray, at: np.ndarray) -> Runs:
    """Runs of whole texts; ``first`` counts from the text's start."""
    found = []
    for i, j, low, high in in_pieces(at, scheme.window):
        part = scheme.runs(tokens[low:high], np.clip(at[i : j + 1], low, high) - low)
        part.owner = part.owner + i
        part.first = part.first + low - at[part.owner]
        found.append(part)
    if not found:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none, *[none.view(np.uint64)] * 3)
    return Runs(*(np.concatenate([getattr(x, f) for x in found]) for f in ("owner", "first", "count", "name", "content", "second")))


_TYPES = (np.uint64, np.uint64, np.uint64, np.int64, np.int32, np.int32, np.int32)  # name, content, second, doc, part, first, count


def _order(name, content, second, doc, part, first):
    return np.lexsort((first, part, doc, second, content, name))


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where a group of equal rows starts."""
    n = len(columns[0])
    new = np.ones(n, bool)
    if n:
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def _settled(name, content, second, doc) -> np.ndarray:
    """Of ordered runs: those equal to a run of a smaller document, by all bits of the anchor's name and of the content."""
    new = _changes(name, content, second)
    least = doc[np.flatnonzero(new)][np.cumsum(new) - 1] if len(doc) else doc
    return doc > least


def _asked(name, doc) -> np.ndarray:
    """Of ordered, unsettled runs: those of an anchor's name that has different runs in different documents."""
    if not len(name):
        return np.zeros(0, bool)
    new = _changes(name)
    start = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    return (np.minimum.reduceat(doc, start) < np.maximum.reduceat(doc, start))[group]


def numbered(docs: DataFrame) -> DataFrame:
    """doc_id, part, text: part tells apart rows with the same doc_id (0 for all others)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ids = rows.groupBy("doc_id").count().filter("doc_id IS NOT NULL AND count > 1")
    if ids.isEmpty():
        return rows.select("doc_id", F.lit(0).alias("part"), "text")
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy("text")) - 1
    return rows.select("doc_id", F.when(F.col("doc_id").isNull(), 0).otherwise(place).cast("int").alias("part"), "text")


def round_one(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """asked, name, doc_id, part, first, count: settled runs (asked false) and those left to round two."""
    groups = GROUPS * partitions(docs.sparkSession)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x for b in batches for x in pieces(b, "text", BATCH_BYTES)):
            ids = batch.column("doc_id")
            tokens, at = scheme.tokens(batch.column("text"))
            found = all_runs(scheme, tokens, at)
            del tokens
            keep = np.asarray(ids.is_valid())[found.owner]
            doc = long_values(ids)[found.owner]
            part = np.asarray(batch.column("part"))[found.owner].astype(np.int32)
            columns = (found.name, found.content, found.second, doc, part, found.first.astype(np.int32), found.count.astype(np.int32))
            columns = [c[keep] for c in columns]
            del found
            order = _order(*columns[:6])
            columns = [c[order] for c in columns]
            known = _settled(*columns[:4])  # within this batch: only the first document of equal runs is sent on
            to = (columns[0] % np.uint64(groups)).astype(np.int32)
            to[known] = columns[3][known] % groups
            where = np.argsort(to, kind="stable")
            columns, to, known = [c[where] for c in columns], to[where], known[where]
            edges = np.searchsorted(to, np.arange(groups + 1))
            rows = [], [], []
            for g in range(groups):
                s = slice(edges[g], edges[g + 1])
                if edges[g] < edges[g + 1]:
                    k = known[s]
                    rows[0].append(g)
                    rows[1].append(packed(*(c[s][~k] for c in columns)))
                    rows[2].append(packed(*(c[s][k] for c in columns[3:])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.binary()), pa.array(rows[2], pa.binary())],
                ["target", "open", "known"],
            )

    def settle(table: pa.Table) -> pa.Table:
        open_ = [unpacked(x, *_TYPES) for x in table.column("open").to_pylist()]
        columns = [np.concatenate(c) for c in zip(*open_, strict=True)]
        order = _order(*columns[:6])
        columns = [c[order] for c in columns]
        done = _settled(*columns[:4])
        left = [c[~done] for c in columns]
        asked = _asked(left[0], left[3])
        known = [np.concatenate(c) for c in zip(*(unpacked(x, *_TYPES[3:]) for x in table.column("known").to_pylist()), strict=True)]
        n_asked, n_done = int(asked.sum()), int(done.sum()) + len(known[0])
        rest = [np.concatenate([a[asked], b[done], c]) for a, b, c in zip(left[3:], columns[3:], known, strict=True)]
        name = np.concatenate([left[0][asked], np.zeros(n_done, np.uint64)]).view(np.int64)
        return pa.table({
            "asked": np.arange(n_asked + n_done) < n_asked, "name": name,
            "doc_id": rest[0], "part": rest[1], "first": rest[2], "count": rest[3],
        })

    sent = docs.mapInArrow(send, "target int, open binary, known binary")
    schema = "asked boolean, name long, doc_id long, part int, first int, count int"
    return stored(sent.groupBy("target").applyInArrow(settle, schema), "runs")


def _rows_of(docs: pa.Table, doc: np.ndarray, part: np.ndarray) -> np.ndarray:
    """The row of each (doc_id, part); the parts of an id are numbered from 0."""
    ids = long_values(docs.column("doc_id").combine_chunks(), -(2**63))
    order = np.lexsort((np.asarray(docs.column("part")), ids))
    return order[np.searchsorted(ids[order], doc) + part]


def one_text(table: pa.Table) -> pa.Array:
    return pa.concat_arrays(table.column("text").cast(pa.large_string()).chunks) if table.num_rows else pa.array([], pa.large_string())


def without_repeats(
    docs: DataFrame, scheme: Scheme, result: Callable[[pa.Table, np.ndarray, np.ndarray, np.ndarray], pa.Table], schema: str
) -> DataFrame:
    """``result(documents, row, first, count)`` over groups of documents with their repeated runs of windows.

    Rows with a null doc_id have no repeats and give none to others; rows that share a doc_id are
    compared with smaller ids, not with one another.
    """
    spark = docs.sparkSession
    groups = GROUPS * partitions(spark)
    docs = numbered(docs)
    runs_ = round_one(docs, scheme)
    group = F.pmod(F.xxhash64("doc_id"), F.lit(groups)).cast("int").alias("group")
    rows = docs.select(group, "doc_id", "part", "text")

    def extract(documents: pa.Table, asked: pa.Table) -> pa.Table:
        names, doc = np.asarray(asked.column("name")), np.asarray(asked.column("doc_id"))
        part, first, count = (np.asarray(asked.column(c)) for c in ("part", "first", "count"))
        found: list[bytes] = []
        order = np.zeros(0, np.int64)
        if asked.num_rows:
            row = _rows_of(documents, doc, part)
            order = np.lexsort((first, row))
            text, sorted_rows = one_text(documents), row[order]
            for r in range(0, documents.num_rows, 256):
                s = slice(*np.searchsorted(sorted_rows, [r, r + 256]))
                if s.start < s.stop:
                    tokens, at = scheme.tokens(text.slice(r, 256))
                    mine = order[s]
                    found += scheme.contexts(tokens, at[row[mine] - r] + first[mine], count[mine])
        return pa.table({
            "target": pa.array(names[order] % groups, pa.int32()), "doc_id": doc[order], "part": part[order],
            "first": first[order], "count": count[order], "context": pa.array(found, pa.binary()),
        })

    def compare(table: pa.Table) -> pa.Table:
        count, doc = np.asarray(table.column("count")), np.asarray(table.column("doc_id"))
        again = scheme.repeated(table.column("context").to_pylist(), count, doc)
        owner = np.repeat(np.arange(len(count)), count)
        place = runs(np.asarray(table.column("first")).astype(np.int64), count.astype(np.int64))
        # neighbours that are repeated are one run again
        start = again & ~(np.append(False, again[:-1]) & np.append(False, owner[1:] == owner[:-1]))
        at = np.flatnonzero(start)
        size = np.diff(np.append(np.cumsum(again)[at] - 1, again.sum())) if len(at) else at
        mine = owner[at]
        return pa.table({
            "group": pa.array(np.zeros(len(at)), pa.int32()), "doc_id": doc[mine], "part": np.asarray(table.column("part"))[mine],
            "first": pa.array(place[at], pa.int32()), "count": pa.array(size, pa.int32()),
        })

    def finish(documents: pa.Table, repeats: pa.Table) -> pa.Table:
        first, count = (np.asarray(repeats.column(c)).astype(np.int64) for c in ("first", "count"))
        row = np.zeros(0, np.int64)
        if repeats.num_rows:
            row = _rows_of(documents, np.asarray(repeats.column("doc_id")), np.asarray(repeats.column("part")))
        return result(documents, row, first, count)

    asked = runs_.filter("asked").select(group, "name", "doc_id", "part", "first", "count")
    contexts = rows.groupBy("group").cogroup(asked.groupBy("group")).applyInArrow(
        extract, "target int, doc_id long, part int, first int, count int, context binary"
    )
    late = contexts.groupBy("target").applyInArrow(compare, "group int, doc_id long, part int, first int, count int")
    repeats = runs_.filter("NOT asked").select("doc_id", "part", "first", "count").unionAll(
        late.select("doc_id", "part", "first", "count")
    ).select(group, "doc_id", "part", "first", "count")
    return rows.groupBy("group").cogroup(repeats.groupBy("group")).applyInArrow(finish, schema)


def covered(size: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of so many tokens lie in one of the ranges."""
    depth = np.zeros(size + 1, np.int32)
    np.add.at(depth, start, 1)
    np.add.at(depth, end, -1)
    return np.cumsum(depth[:-1]) > 0
