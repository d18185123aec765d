"""Prefix trie of conversations: every distinct beginning, with what shares it.

A conversation is the sequence of fingerprints of its turns, 16 bytes each, so that order of bytes
is an order in which the conversations of every trie node are neighbours. Spark sorts all of them into ranges.
In each range neighbours are joined by union-find over the lengths of their common prefixes, the longest first: each
merge makes a branching node (or adds a branch to one) whose subtree is complete by then. Nodes that are no
beginning of the first or last conversation of a range are final there. The others form a small forest for
each range, which is merged with those of the other ranges by the fingerprint of the beginning.

Turns are compared by 128 bits of SHA-256 of role and text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Bytes of a turn's fingerprint, and of its size.
MARK, SIZE = 16, 4


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``marks`` and ``sizes`` (32-bit text bytes) of each conversation's turns in order of ``turn``, null first.

    Equal turns are ordered by fingerprint. Rows without ``conv_id`` take no part. Turns are sorted over
    all tasks, so a conversation with very many comes as few fragments, never as rows of one group.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.substring(F.unhex(F.sha2(whole, 256)), 1, MARK).alias("mark"), F.octet_length(text).alias("size"),
    )
    order = ["conv_id", "turn", "mark"]
    fragments = turns.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _fragments, "conv_id long, turn long, mark binary, marks binary, sizes binary"
    )
    parts = F.sort_array(F.collect_list(F.struct("turn", "mark", "marks", "sizes")))
    joined = lambda field: F.reduce(F.col("parts")[field], F.lit(b""), lambda a, x: F.concat(a, x))
    return fragments.groupBy("conv_id").agg(parts.alias("parts")).select(
        "conv_id", joined("marks").alias("marks"), joined("sizes").alias("sizes")
    )


def _fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of sorted turns of one conversation as one row each."""
    held: list | None = None  # conversation, first turn, first mark, marks, sizes

    def row(rows):
        columns = zip(*((c, t, m, b"".join(marks), b"".join(sizes)) for c, t, m, marks, sizes in rows), strict=True)
        types = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
        names = ["conv_id", "turn", "mark", "marks", "sizes"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    for batch in batches:
        conv, turn = np.asarray(batch.column("conv_id")), batch.column("turn")
        marks, sizes = batch.column("mark").to_pylist(), np.asarray(batch.column("size")).astype("<i4")
        starts = [0, *(np.flatnonzero(conv[1:] != conv[:-1]) + 1).tolist()]
        done = []
        for a, b in zip(starts, [*starts[1:], len(conv)], strict=True):
            if b == a:
                continue
            if held is None or held[0] != conv[a]:
                if held is not None:
                    done.append(held)
                held = [int(conv[a]), turn[a].as_py(), marks[a], [], []]
            held[3].append(b"".join(marks[a:b]))
            held[4].append(sizes[a:b].tobytes())
        if done:
            yield row(done)
    if held is not None:
        yield row([held])


def rebuilt(convs: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """Each conversation with its first h turns replaced by the first h of its family's first conversation.

    h is the checksum of the decimal id modulo ``most``; the family of c begins with c - c % family. An absent one
    lends no turns.
    """
    heads = convs.filter(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("base"), F.substring("marks", 1, MARK * most).alias("m"), F.substring("sizes", 1, SIZE * most).alias("s")
    )
    h = (F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % most).cast("int")
    own = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % family).withColumn("h", h)

    def changed(head: str, whole: str, width: int):
        lent = F.coalesce(F.substring(F.col(head), F.lit(1), F.col("h") * width), F.lit(b""))
        rest = F.substring(F.col(whole), F.col("h") * width + 1, F.greatest(F.length(whole) - F.col("h") * width, F.lit(0)))
        return F.concat(lent, rest).alias(whole)

    return own.join(heads, "base", "left").select("conv_id", changed("m", "marks", MARK), changed("s", "sizes", SIZE))


@dataclass
class Vertex:
    """A trie node where a conversation ends or several go on; ``first`` to ``last`` are its conversations.

    ``leaves`` and ``saved`` sum up the finished subtrees below it.
    """

    depth: int
    first: int
    last: int
    least: int
    ends: int
    children: int = 0
    leaves: int = 0
    saved: int = 0
    open: bool = False


def common_turns(a: bytes, b: bytes) -> int:
    """How many turns two conversations begin with alike."""
    low, high = 0, min(len(a), len(b)) // MARK
    if a[: high * MARK] == b[: high * MARK]:
        return high
    while high - low > 1:
        mid = (low + high) // 2
        if a[low * MARK : mid * MARK] == b[low * MARK : mid * MARK]:
            low = mid
        else:
            high = mid
    return low


class Forest:
    """The trie of one sorted range of conversations."""

    NAMES = [
        "closed", "conv_id", "depth", "parent_conv_id", "node", "parent_node", "n_convs", "n_children", "n_leaves",
        "saved_tokens", "size", "first_end", "ends",
    ]
    SCHEMA = (
        "closed boolean, conv_id long, depth long, parent_conv_id long, node binary, parent_node binary, n_convs long, "
        "n_children long, n_leaves long, saved_tokens long, size long, first_end long, ends string"
    )
    TYPES = [
        pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(),
        pa.int64(), pa.int64(), pa.int64(), pa.string(),
    ]

    def __init__(self, convs: list[int], marks: list[bytes], sizes: list[bytes]):
        self.convs, self.marks = convs, marks
        self.sizes = [np.frombuffer(s, "<i4").tolist() for s in sizes]
        self.rows: list[list] = []
        self.hanging: list[tuple[int, Vertex]] = []  # rows whose parent was not complete yet
        self.ids = {0: _beginnings(marks[0]), len(marks) - 1: _beginnings(marks[-1])}

    def build(self) -> list[list]:
        n = len(self.marks)
        shared = np.array([common_turns(a, b) for a, b in zip(self.marks, self.marks[1:], strict=False)], np.int64)
        parent = list(range(n))
        tops = [Vertex(len(m) // MARK, i, i, c, 1) for i, (m, c) in enumerate(zip(self.marks, self.convs, strict=True))]

        def find(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        for edge in np.argsort(-shared, kind="stable").tolist():
            depth, a, b = int(shared[edge]), find(edge), find(edge + 1)
            left, right = tops[a], tops[b]
            if left.depth > depth:  # the two part here for the first time
                node = Vertex(depth, left.first, left.last, left.least, 0)
                self.finish(left, node)
            else:
                node = left
            if right.depth > depth:
                self.finish(right, node)
            else:  # the same conversation once more
                node.ends += right.ends
            node.last, node.least = right.last, min(node.least, right.least)
            parent[b] = a
            tops[a] = node
        self.finish(tops[find(0)], None)
        for row, node in self.hanging:
            if node.open:
                self.rows[row][5] = self.beginning(node.first, node.last)[node.depth]
            else:
                self.rows[row][3] = node.least
        return self.rows

    def beginning(self, first: int, last: int) -> list[bytes]:
        return self.ids[0] if first == 0 else self.ids[last]

    def finish(self, v: Vertex, above: Vertex | None) -> None:
        """Puts out a complete node and the unbranched ones between it and ``above``."""
        n, sizes = v.last - v.first + 1, self.sizes[v.first]
        v.open = v.first == 0 or v.last == len(self.marks) - 1
        stop = above.depth if above else -1
        ended = ",".join(map(str, self.convs[v.first : v.first + v.ends]))
        ends = {"first_end": self.convs[v.first] if v.ends else None, "ends": ended}
        if v.open:
            ids = self.beginning(v.first, v.last)
            for k in range(v.depth, stop, -1):
                own = k == v.depth
                self.rows.append([
                    False, v.least, k, None, ids[k], ids[k - 1] if k else None, n, v.children if own else 0, v.leaves if own else 0,
                    v.saved if own else 0, sizes[k - 1] if k else 0, ends["first_end"] if own else None, ended if own else "",
                ])
            return
        leaves, saved = v.leaves or 1, v.saved
        for k in range(v.depth, stop, -1):
            own = k == v.depth
            saved += (n - 1) * sizes[k - 1]
            self.rows.append([
                True, v.least, k, v.least, None, None, n, v.children if own else 1, leaves, saved, sizes[k - 1],
                ends["first_end"] if own else None, ended if own else "",
            ])
        self.rows[-1][3] = None
        self.hanging.append((len(self.rows) - 1, above))
        above.children += 1
        above.leaves += leaves
        above.saved += saved


def _beginnings(marks: bytes) -> list[bytes]:
    """Fingerprints of all beginnings of a conversation, the empty one first."""
    h = hashlib.blake2b(digest_size=MARK)
    out = [h.digest()]
    for i in range(0, len(marks), MARK):
        h.update(marks[i : i + MARK])
        out.append(h.copy().digest())
    return out


#: Nodes put out at once.
ROWS = 10_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    convs, marks, sizes = [], [], []
    for batch in batches:
        convs += batch.column("conv_id").to_pylist()
        marks += batch.column("marks").to_pylist()
        sizes += batch.column("sizes").to_pylist()
    if not convs:
        return
    rows = Forest(convs, marks, sizes).build()
    for a in range(0, len(rows), ROWS):
        columns = zip(*rows[a : a + ROWS], strict=True)
        arrays = [pa.array(c, t) for c, t in zip(columns, Forest.TYPES, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=Forest.NAMES)


def _merged_trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over the subtrees of the nodes that ranges share, the deepest first."""
    rows = [r for b in batches for r in b.to_pylist()]
    if not rows:
        return
    by_node = {r["node"]: r for r in rows}
    for r in sorted(rows, key=lambda r: -r["depth"]):
        r["n_leaves"] = r["n_leaves"] or (0 if r["n_children"] else 1)
        r["saved_tokens"] += (r["n_convs"] - 1) * r["size"]
        above = by_node.get(r["parent_node"])
        r["parent_conv_id"] = above["conv_id"] if above else None
        if above:
            above["n_children"] += 1
            above["n_leaves"] += r["n_leaves"]
            above["saved_tokens"] += r["saved_tokens"]
    yield pa.RecordBatch.from_pylist([{n: r[n] for n in _TREE_NAMES} for r in rows], schema=_TREE_SCHEMA)


_TREE_NAMES = ["node", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
_TREE_SCHEMA = pa.schema(
    [("node", pa.binary())] + [(n, pa.int64()) for n in _TREE_NAMES[1:-1]] + [("ends_sha256", pa.string())]
)
_TREE_TYPES = "node binary, " + ", ".join(f"{n} long" for n in _TREE_NAMES[1:-1]) + ", ends_sha256 string"


def trie(convs: DataFrame) -> DataFrame:
    """All nodes of the trie of ``convs(conv_id, marks, sizes)``, one row each.

    ``conv_id``: smallest member, ``depth``, ``parent_conv_id``: the parent's (root: null), ``n_convs``: members, ``n_children``,
    ``n_leaves``: childless nodes in its subtree, ``saved_tokens``: over its subtree the text bytes of a node's
    last turn that its other members need not store again, ``ends_sha256``: of the ids that end here, ascending.

    The nodes that ranges share go through one task: at most the beginnings of two conversations for each partition. The ids that
    end in one node are joined into one text, which its hash needs.
    """
    order = ["marks", "conv_id"]
    local = stored(convs.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_forest, Forest.SCHEMA), "forest")
    fragments = F.sort_array(F.collect_list(F.when(F.col("first_end").isNotNull(), F.struct("first_end", "ends"))))
    ends = F.sha2(F.array_join(F.transform(fragments, lambda f: f["ends"]), ","), 256)
    shared = stored(
        local.filter("NOT closed").groupBy("node", "depth").agg(
            F.min("conv_id").alias("conv_id"), F.first("parent_node").alias("parent_node"), F.sum("n_convs").alias("n_convs"),
            F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
            F.first("size").alias("size"), ends.alias("ends_sha256"),
        ),
        "shared",
    )
    top = stored(shared.repartition(1).mapInArrow(_merged_trees, _TREE_TYPES), "top")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    closed = local.filter("closed").withColumn("ends_sha256", F.sha2("ends", 256))
    above = top.select(F.col("node").alias("parent_node"), F.col("conv_id").alias("above"))
    hanging = closed.filter("parent_node IS NOT NULL").join(above, "parent_node").withColumn("parent_conv_id", F.col("above"))
    within = closed.filter("parent_node IS NULL")
    return top.select(*columns).unionByName(within.select(*columns)).unionByName(hanging.select(*columns))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of ``conversations(conv_id, turn, role, text)`` after ``rebuilt``.

    Null roles and texts count as empty; an empty table gives no rows; other columns are ignored.
    """
    return trie(rebuilt(stored(sequences(conversations), "sequences")))
