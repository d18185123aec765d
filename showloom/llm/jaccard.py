"""Exact joins of word n-gram sets by Jaccard similarity, skipping what relations between sets already tell.

Equal sets are one class. An inverted index holds the prefix of each class's set, the rarest shingles
first, with set size and position. Two relations save work. Between sets in a list: lists are
cut into blocks by size, and blocks are skipped whose sizes and positions cannot reach the threshold.
Between a set and a highly similar one: sets are compared with a pivot of their list first. Sets
that come to one component through it are compared whole with one reference of the component only; what any
two of them share follows from their differences to it. For the others the distances to a
common pivot bound the distance between them. All links come out, also those within a component.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import drop, gathered, long_values, mixed, packed, partitions, pieces, runs, stored, unpacked, utf8
from .words import grams, hashed_words

#: Words of a shingle; similarity from which two sets are linked, as a fraction.
SHINGLE, NUMERATOR, DENOMINATOR = 5, 3, 4
#: Bytes of text whose sets a task holds at once.
SLICE_BYTES = 4_000_000
#: Counters that order shingles by frequency. Shingles that share a counter are taken for equally frequent; no result depends on it.
COUNTERS, CHUNK = 1 << 20, 1 << 12
#: Lists that tasks work on one after the other, for each shuffle partition.
GROUPS = 8
#: Entries of a list's block; pairs of entries that a task looks at at once.
BLOCK, PAIRS = 256, 1 << 18
#: Bits of a set's sketch; entries from which a list has the sketches of its sets with it.
SKETCH, WIDE = 1024, 32
#: Rounds in which members of a list are compared with one pivot; whatever remains is compared in blocks.
PIVOT_ROUNDS = 3
#: Pivots of a list of more than ``BLOCK`` entries, of which each member is compared with the most similar one.
PIVOTS = 64


def shingle_sets(text: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text as sorted hashes, and where each text's start.

    Words stand between ASCII blanks, A-Z in lower case. Fewer words than ``size`` are one shingle; none are an empty set.
    """
    words = hashed_words(*utf8(text), lower=True)
    n = np.diff(words.at)
    short = np.flatnonzero((n > 0) & (n < size))
    owner = words.owner()
    hashes = grams(words.hashes, size)
    whose = owner[: len(hashes)]
    inside = owner[size - 1 :] == whose if len(hashes) else np.zeros(0, bool)
    few = np.array([grams(words.hashes[words.at[i] : words.at[i + 1]], int(n[i]))[0] for i in short.tolist()], np.uint64)
    hashes = np.concatenate([hashes[inside], mixed(few + n[short].astype(np.uint64))])
    whose = np.concatenate([whose[inside], short])
    order = np.argsort(whose, kind="stable")
    hashes, whose = hashes[order], whose[order]
    edges = np.searchsorted(whose, np.arange(len(n) + 1)).tolist()
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        hashes[a:b].sort()
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (whose[1:] != whose[:-1])
    hashes, whose = hashes[new], whose[new]
    return hashes, np.searchsorted(whose, np.arange(len(n) + 1))


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.diff(np.append(np.uint64(0), np.cumsum(values, dtype=np.uint64))[at])


def set_keys(sets: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit names of each set; equal sets have equal names."""
    one, two = _sums(mixed(sets), at), _sums(mixed(sets ^ np.uint64(0xA24BAED4963EE407)), at)
    return mixed(one).view(np.int64), mixed(two).view(np.int64)


def sketches(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A row of ``SKETCH`` bits for each set, each the parity of the shingles that fall to it.

    Two sets differ in at least as many shingles as their sketches do in bits.
    """
    out = np.zeros(((len(at) - 1), SKETCH // 64), np.uint64)
    bit = mixed(sets) % np.uint64(SKETCH)
    word = np.repeat(np.arange(len(at) - 1), np.diff(at)) * (SKETCH // 64) + (bit >> np.uint64(6)).astype(np.int64)
    np.bitwise_xor.at(out.reshape(-1), word, np.uint64(1) << (bit & np.uint64(63)))
    return out


def named_sets(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles and the set's names k1 and k2 of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (x for b in batches for x in pieces(b, "text", SLICE_BYTES)):
            sets, at = shingle_sets(part.column("text"), size)
            k1, k2 = set_keys(sets, at)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.diff(at)), pa.array(k1), pa.array(k2)], ["doc_id", "n_shingles", "k1", "k2"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_shingles long, k1 long, k2 long")


def class_texts(docs: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """node, text and sketch of the set of one document of each class; a repeated row may come more than once.

    Besides, rows with chunk and counts instead: how many of a task's sets have a shingle that falls to each of ``COUNTERS`` counters.
    """
    shift = np.uint64(64 - (COUNTERS.bit_length() - 1))
    wanted = classes.select("doc_id", "node", "k1", "k2")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted, "doc_id")

    names = ["node", "text", "sketch", "chunk", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(COUNTERS, np.int64)
        for part in (x for b in batches for x in pieces(b, "text", SLICE_BYTES)):
            sets, at = shingle_sets(part.column("text"), size)
            k1, k2 = set_keys(sets, at)
            same = (k1 == long_values(part.column("k1"))) & (k2 == long_values(part.column("k2")))
            table += np.bincount((sets[np.repeat(same, np.diff(at))] >> shift).astype(np.int64), minlength=COUNTERS)
            sketch = pa.array([x.tobytes() for x in sketches(sets, at)], pa.binary())
            none = [pa.nulls(len(same), pa.int32()), pa.nulls(len(same), pa.binary())]
            whole = pa.RecordBatch.from_arrays([part.column("node"), part.column("text"), sketch, *none], names)
            yield whole.filter(pa.array(same))
        counts = table.view(np.uint64).reshape(-1, CHUNK)
        used = np.flatnonzero(counts.any(1))
        none = [pa.nulls(len(used), t) for t in (pa.int64(), pa.string(), pa.binary())]
        found = [pa.array(used, pa.int32()), pa.array([packed(counts[i]) for i in used], pa.binary())]
        yield pa.RecordBatch.from_arrays([*none, *found], names)

    return rows.select("node", "text", "k1", "k2").mapInArrow(run, "node long, text string, sketch binary, chunk int, counts binary")


def counters(counted: DataFrame) -> np.ndarray:
    """How many sets have a shingle that falls to each of ``COUNTERS`` counters, over all tasks' rows of chunk and counts."""

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(CHUNK, np.uint64)
        for x in table.column("counts").to_pylist():
            total += unpacked(x, np.uint64)[0]
        return pa.table({"chunk": table.column("chunk").slice(0, 1), "counts": pa.array([packed(total)], pa.binary())})

    sums = counted.filter("chunk IS NOT NULL").select("chunk", "counts").groupBy("chunk").applyInArrow(add, "chunk int, counts binary")
    out = np.zeros((COUNTERS // CHUNK, CHUNK), np.uint64)
    for chunk, counts in sums.toLocalIterator():  # COUNTERS numbers in all
        out[chunk] = unpacked(bytes(counts), np.uint64)[0]
    return out.reshape(-1)


_TYPES = (np.uint64, np.int64, np.int32, np.int32)  # shingle, node, size, position


def index_lists(texts: DataFrame, frequency: np.ndarray, size: int) -> DataFrame:
    """shingle, node, size, pos, of: the inverted index over prefixes, lists of two sets or more; ``of`` is how many.

    A set of n shingles is ordered by frequency and hash; any set similar enough to it shares one of
    the first n - ceil(3/4 n) + 1 with the first ones of its own.
    """
    spark = texts.sparkSession
    groups, sent = GROUPS * partitions(spark), spark.sparkContext.broadcast(frequency)
    shift = np.uint64(64 - (COUNTERS.bit_length() - 1))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sent.value
        for part in (x for b in batches for x in pieces(b, "text", SLICE_BYTES)):
            sets, at = shingle_sets(part.column("text"), size)
            n = np.diff(at)
            often = counts[(sets >> shift).astype(np.int64)]
            order = np.arange(len(sets))
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):  # a set's shingles come in order of their hashes
                order[a:b] = a + np.argsort(often[a:b], kind="stable")
            length = n - (n * NUMERATOR + DENOMINATOR - 1) // DENOMINATOR + (n > 0)
            take = order[runs(at[:-1], length)]
            row = np.repeat(np.arange(len(n)), length)
            pos = (np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)).astype(np.int32)
            columns = (sets[take], long_values(part.column("node"))[row], n[row].astype(np.int32), pos)
            to = (columns[0] % np.uint64(groups)).astype(np.int32)
            where = np.lexsort((columns[0], to))
            edges = np.searchsorted(to[where], np.arange(groups + 1))
            columns = [c[where] for c in columns]
            used = np.flatnonzero(np.diff(edges))
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()), pa.array([packed(*(c[edges[g] : edges[g + 1]] for c in columns)) for g in used], pa.binary())],
                ["target", "entries"],
            )

    def shared(table: pa.Table) -> pa.Table:
        lists = [unpacked(x, *_TYPES) for x in table.column("entries").to_pylist()]
        columns = [np.concatenate(c) for c in zip(*lists, strict=True)]
        order = np.lexsort((columns[1], columns[0]))
        columns = [c[order] for c in columns]
        new = np.ones(len(order), bool)  # a repeated row has the same entries
        new[1:] = (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])
        columns = [c[new] for c in columns]
        same = columns[0][1:] == columns[0][:-1]
        keep = np.append(False, same) | np.append(same, False)
        columns = [c[keep] for c in columns]
        _, which, of = np.unique(columns[0], return_inverse=True, return_counts=True)
        return pa.table({"shingle": columns[0].view(np.int64), "node": columns[1], "size": columns[2], "pos": columns[3], "of": of[which].astype(np.int64)})

    # a task sends a row to each group, so that few tasks send fewer, longer ones
    entries = gathered(texts, 4).mapInArrow(send, "target int, entries binary")
    return entries.groupBy("target").applyInArrow(shared, "shingle long, node long, size int, pos int, of long")


def reaches(n: Column, p: Column, m: Column, q: Column) -> Column:
    """Can sets of n and m shingles whose first common one stands at p and q be similar enough?"""
    return F.least(n - p, m - q) * (NUMERATOR + DENOMINATOR) >= (n + m) * NUMERATOR


def labelled(nodes: DataFrame, components: DataFrame | None) -> DataFrame:
    """``nodes`` with ``comp``, the component of ``node``."""
    if components is None:
        return nodes.withColumn("comp", F.col("node"))
    return nodes.join(components, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def pivot_pairs(lists: DataFrame, seed: int) -> DataFrame:
    """Each member of a list with the list's pivot, where they are in different components. Grows with the lists, not with pairs."""
    entry = F.struct(F.xxhash64("node", F.lit(seed)).alias("rank"), "node", "size", "pos", "comp")
    pivots = lists.groupBy("shingle").agg(F.min(entry).alias("p"))
    far = (F.col("comp") != F.col("p.comp")) & reaches(F.col("size"), F.col("pos"), F.col("p.size"), F.col("p.pos"))
    pairs = lists.join(pivots, "shingle").filter(far)
    return pairs.select(F.least("node", "p.node").alias("a"), F.greatest("node", "p.node").alias("b")).distinct()


def entries_of(column: pa.Array) -> Iterator[tuple[list[np.ndarray], np.ndarray | None]]:
    """Of each list of entries node, size, pos and comp, and the sketches where all have one."""
    for entries in column:
        flat = entries.values
        found = flat.field("sketch")
        marks = None if found.null_count else np.frombuffer(b"".join(found.to_pylist()), np.uint64).reshape(len(found), -1)
        yield [np.asarray(flat.field(k)).astype(np.int64) for k in ("node", "size", "pos", "comp")], marks


def nearest_pivots(lists: DataFrame, members: DataFrame, seed: int) -> DataFrame:
    """Each member of a list with one of the list's ``PIVOTS`` pivots, where they are in different components: the one with the nearest sketch.

    So the sets of a large family find a similar one, even if any two of them are about as far apart as linked sets may be,
    and come to one component. One pair for each entry at most. Pivots are those of least rank among the members dealt to each slot.
    """
    entry = F.struct(F.xxhash64("node", F.lit(seed)).alias("rank"), "node", "size", "pos", "comp")
    slot = F.pmod(F.xxhash64("node", F.lit(-1 - seed)), F.lit(PIVOTS))
    sketch = members.select("node", "sketch")
    least = lists.groupBy("shingle", slot.alias("slot")).agg(F.min(entry).alias("p")).select("shingle", "p.node", "p.size", "p.pos", "p.comp")
    held = F.collect_list(F.struct("node", "size", "pos", "comp", "sketch"))
    pivots = least.join(sketch, "node").groupBy("shingle").agg(held.alias("f"))
    block = F.pmod(F.xxhash64("node"), F.ceil(F.col("of") / BLOCK))
    blocks = lists.join(sketch, "node").groupBy("shingle", block.alias("block")).agg(held.alias("e"))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ((a, n, p, c), x), ((b, m, q, d), y) in zip(entries_of(batch.column("e")), entries_of(batch.column("f")), strict=True):
                total = n[:, None] + m
                apart = sum(np.bitwise_count(x[:, None, k] ^ y[:, k]).astype(np.int64) for k in range(x.shape[1]))
                fit = (c[:, None] != d) & (np.minimum((n - p)[:, None], m - q) * (NUMERATOR + DENOMINATOR) >= total * NUMERATOR)
                fit &= apart * (NUMERATOR + DENOMINATOR) <= total * (DENOMINATOR - NUMERATOR)
                j = np.where(fit, apart / np.maximum(total, 1), np.inf).argmin(1)
                i = np.flatnonzero(fit.any(1))
                u, v = a[i], b[j[i]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], ["a", "b"])

    return blocks.join(pivots, "shingle").select("e", "f").mapInArrow(choose, "a long, b long").distinct()


def open_lists(lists: DataFrame, components: DataFrame | None) -> DataFrame:
    """shingle, node, size, pos, of and comp of the lists with sets of two components or more."""
    found = labelled(lists.select("shingle", "node", "size", "pos", "of"), components)
    if components is None:
        return found  # each set is its own component, and no list has fewer than two
    inside = Window.partitionBy("shingle")
    small = found.filter(F.col("of") <= BLOCK).withColumns({"c0": F.min("comp").over(inside), "c1": F.max("comp").over(inside)})
    large = found.filter(F.col("of") > BLOCK)  # too many sets for a window: what is grouped leaves each task as one row a list
    ends = large.groupBy("shingle").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).filter("c0 < c1")
    return small.filter("c0 < c1").drop("c0", "c1").unionByName(large.join(ends.select("shingle"), "shingle"))


def fitting(e: pa.ListArray, f: pa.ListArray, own: np.ndarray) -> Iterator[pa.RecordBatch]:
    """a and b of all pairs of an entry of a row's list ``e`` and one of its list ``f`` that are in different components and may be linked.

    Where ``own`` says that both are one list, each pair comes once. All rows are gone through at once, ``PAIRS`` pairs at a time.
    """
    sides = []
    for column in (e, f):
        flat, count = column.flatten(), np.asarray(column.value_lengths()).astype(np.int64)
        raw, at = utf8(flat.field("sketch"))
        sides.append((*(np.asarray(flat.field(k)).astype(np.int64) for k in ("node", "size", "pos", "comp")), raw, at, count))
    (a, n, p, c, x, x_at, many), (b, m, q, d, y, y_at, others) = sides
    bits = [z.view(np.uint64).reshape(-1, SKETCH // 64) for z in (x, y)]
    row = np.repeat(np.arange(len(many)), many)
    follow, start = others[row], (np.cumsum(others) - others)[row]
    so_far, i = np.cumsum(follow), 0
    while i < len(row):
        k = max(i + 1, int(np.searchsorted(so_far, (so_far[i - 1] if i else 0) + PAIRS, "right")))
        left, right = np.repeat(np.arange(i, k), follow[i:k]), runs(start[i:k], follow[i:k])
        fit = (c[left] != d[right]) & (np.minimum((n - p)[left], (m - q)[right]) * (NUMERATOR + DENOMINATOR) >= (n[left] + m[right]) * NUMERATOR)
        fit &= ~own[row[left]] | (a[left] < b[right])
        left, right, i = left[fit], right[fit], k
        known = np.flatnonzero((x_at[left + 1] > x_at[left]) & (y_at[right + 1] > y_at[right]))
        if len(known):
            u, v = left[known], right[known]
            apart = sum(np.bitwise_count(bits[0][x_at[u] * 8 // SKETCH, w] ^ bits[1][y_at[v] * 8 // SKETCH, w]).astype(np.int64) for w in range(SKETCH // 64))
            keep = np.ones(len(left), bool)
            keep[known] = apart * (NUMERATOR + DENOMINATOR) <= (n[u] + m[v]) * (DENOMINATOR - NUMERATOR)
            left, right = left[keep], right[keep]
        if len(left):
            u, v = a[left], b[right]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], ["a", "b"])


def block_pairs(lists: DataFrame, members: DataFrame) -> DataFrame:
    """All pairs of members of one list that are in different components and whose sizes and positions allow a link.

    ``of`` is how many entries a list has. In one of ``WIDE`` or more also their sketches must allow it: so a hot shingle makes few pairs besides links.

    Lists of more than ``BLOCK`` are ordered by size and cut into blocks; pairs of blocks are skipped by their least and greatest sizes and
    by the most shingles that any of their sets has left from its position on, and where both lie in one component.
    """
    known = lists.filter(F.col("of") >= WIDE).join(members.select("node", "sketch"), "node")
    bare = lists.filter(F.col("of") < WIDE).withColumn("sketch", F.lit(None).cast("binary"))
    marked = bare.unionByName(known)
    entry = F.struct("node", "size", "pos", "comp", "sketch")
    whole = marked.filter(F.col("of") <= BLOCK).groupBy("shingle").agg(F.collect_list(entry).alias("e")).select("e")
    place = F.row_number().over(Window.partitionBy("shingle").orderBy("size", "pos", "node")) - 1
    placed = marked.filter(F.col("of") > BLOCK).withColumn("block", F.floor(place / BLOCK).cast("int"))
    blocks = placed.groupBy("shingle", "block").agg(
        F.collect_list(entry).alias("entries"), F.min("size").alias("low"), F.max("size").alias("high"),
        F.max(F.col("size") - F.col("pos")).alias("room"), F.min("comp").alias("c0"), F.max("comp").alias("c1"),
    )
    x, y = blocks.alias("x"), blocks.alias("y")
    needed = (F.col("x.low") + F.col("y.low")) * NUMERATOR
    met = x.join(y, F.col("x.shingle") == F.col("y.shingle")).filter(
        (F.col("x.block") <= F.col("y.block"))
        & (F.col("x.high") * DENOMINATOR >= F.col("y.low") * NUMERATOR)
        & (F.least("x.room", "y.room") * (NUMERATOR + DENOMINATOR) >= needed)
        & ~((F.col("x.c0") == F.col("x.c1")) & (F.col("y.c0") == F.col("y.c1")) & (F.col("x.c0") == F.col("y.c0")))
    ).select((F.col("x.block") == F.col("y.block")).alias("own"), F.col("x.entries").alias("e"), F.col("y.entries").alias("f"))

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from fitting(batch.column("e"), batch.column("e"), np.ones(batch.num_rows, bool))

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from fitting(batch.column("e"), batch.column("f"), np.asarray(batch.column("own").to_pylist(), bool))

    pairs = whole.mapInArrow(inside, "a long, b long")
    if not lists.filter(F.col("of") > BLOCK).isEmpty():
        pairs = pairs.unionAll(met.mapInArrow(between, "a long, b long"))
    return pairs.distinct()


def overlaps(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """a, b, n, m and common: sizes of both sets and of their intersection, from whole texts."""
    one = texts.select(F.col("node").alias("a"), F.col("text").alias("text"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("other"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (y for b in batches for x in pieces(b, "text", SLICE_BYTES) for y in pieces(x, "other", SLICE_BYTES)):
            x, at = shingle_sets(part.column("text"), size)
            y, to = shingle_sets(part.column("other"), size)
            common = np.array([
                len(np.intersect1d(x[at[i] : at[i + 1]], y[to[i] : to[i + 1]], assume_unique=True)) for i in range(part.num_rows)
            ], np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column("a"), part.column("b"), pa.array(np.diff(at)), pa.array(np.diff(to)), pa.array(common)],
                ["a", "b", "n", "m", "common"],
            )

    return pairs.join(one, "a").join(two, "b").select("a", "b", "text", "other").mapInArrow(run, "a long, b long, n long, m long, common long")


def linked(compared: DataFrame) -> DataFrame:
    """Pairs that are similar enough."""
    return compared.filter(F.col("common") * (NUMERATOR + DENOMINATOR) >= (F.col("n") + F.col("m")) * NUMERATOR)


def told_apart(pairs: DataFrame, compared: DataFrame) -> DataFrame:
    """``pairs`` without those that the distances to a common pivot keep apart.

    The distance of two sets is the size of their symmetric difference, a metric; similar ones are at most a
    seventh of both sizes apart, and the distance of a and b is no less than the difference of
    their distances to a set that both were compared with.
    """
    distance = (F.col("n") + F.col("m") - 2 * F.col("common")).alias("d")
    sides = compared.select(F.col("a").alias("x"), F.col("b").alias("pivot"), distance, F.col("n").alias("size")).unionAll(
        compared.select(F.col("b").alias("x"), F.col("a").alias("pivot"), distance, F.col("m").alias("size"))
    )
    best = sides.groupBy("x").agg(F.min(F.struct("d", "pivot", "size")).alias("best"))
    one = best.select(F.col("x").alias("a"), F.col("best").alias("one"))
    two = best.select(F.col("x").alias("b"), F.col("best").alias("two"))
    apart = (F.col("one.pivot") == F.col("two.pivot")) & (
        F.abs(F.col("one.d") - F.col("two.d")) * (NUMERATOR + DENOMINATOR)
        > (F.col("one.size") + F.col("two.size")) * (DENOMINATOR - NUMERATOR)
    )
    return pairs.join(one, "a", "left").join(two, "b", "left").filter(~F.coalesce(apart, F.lit(False))).select("a", "b")


def connected(links: DataFrame) -> DataFrame:
    """node and comp (the least node it reaches) of all nodes with a link: least labels of neighbours, then labels of labels."""
    both = stored(gathered(links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()), "links")
    table = stored(gathered(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("comp")).withColumnRenamed("a", "node")), "labels")
    while True:
        labels = table.select("node", "comp")
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("comp").alias("least"))
        next_ = labels.join(near, labels.node == near.a).select("node", "comp", F.least("comp", "least").alias("least"))
        of = labels.select(F.col("node").alias("label"), F.col("comp").alias("jump"))
        next_ = next_.join(of, next_.least == of.label, "left").select(
            "node", F.least("least", F.coalesce("jump", "least")).alias("comp"), (F.least("least", F.coalesce("jump", "least")) != F.col("comp")).alias("moved")
        )
        next_ = stored(gathered(next_), "labels")
        drop(table)
        table = next_
        if next_.filter("moved").isEmpty():
            drop(both)
            out = next_.select("node", "comp")
            out.stored_at = next_.stored_at
            return out


def differences(components: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """comp, node, n, d and diff of all sets with a component: the d shingles in which it differs from the set ``comp`` is."""
    one = texts.select("node", "text")
    two = texts.select(F.col("node").alias("comp"), F.col("text").alias("other"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (y for b in batches for x in pieces(b, "text", SLICE_BYTES) for y in pieces(x, "other", SLICE_BYTES)):
            x, at = shingle_sets(part.column("text"), size)
            y, to = shingle_sets(part.column("other"), size)
            diff = [np.setxor1d(x[at[i] : at[i + 1]], y[to[i] : to[i + 1]], assume_unique=True) for i in range(part.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("comp"), part.column("node"), pa.array(np.diff(at)), pa.array(np.array([len(x) for x in diff], np.int64)),
                    pa.array([x.tobytes() for x in diff], pa.binary()),
                ],
                ["comp", "node", "n", "d", "diff"],
            )

    rows = components.join(one, "node").join(two, "comp").select("comp", "node", "text", "other")
    return rows.mapInArrow(run, "comp long, node long, n long, d long, diff binary")


def shared_counts(e: list[np.ndarray], f: list[np.ndarray]) -> np.ndarray:
    """How many values each of the sets ``e`` has in common with each of the sets ``f``."""
    out = np.zeros((len(e), len(f)), np.int64)
    x, y = np.concatenate(e), np.concatenate(f)
    both = np.intersect1d(x, y)
    owner = [np.repeat(np.arange(len(z)), [len(v) for v in z]) for z in (e, f)]
    for i in range(0, len(both), CHUNK):
        some = both[i : i + CHUNK]
        met = []
        for values, whose, n in ((x, owner[0], len(e)), (y, owner[1], len(f))):
            at = np.searchsorted(some, values).clip(0, len(some) - 1)
            there = some[at] == values
            table = np.zeros((n, len(some)), np.float32)
            table[whose[there], at[there]] = 1
            met.append(table)
        out += (met[0] @ met[1].T).astype(np.int64)
    return out


_LINKS = "a array<long>, b array<long>, n array<long>, m array<long>, common array<long>"
_SUMMARY = "comp long, block long, nodes array<long>, links array<long>"


def inner_links(components: DataFrame, texts: DataFrame, size: int, summary: bool) -> DataFrame:
    """All links between sets of one component, one row of arrays a, b, n, m and common for each pair of blocks.

    With ``summary`` the links are found, but not written one by one: the result is node and links, how many each set has in its component.

    Sets x and y differ in the shingles in which their differences to the reference do, so their texts are not read
    again. Blocks hold sets at about the same distance from the reference; pairs of blocks are skipped whose
    sizes or distances are too far apart.
    """
    rows = stored(differences(components, texts, size), "differences")
    sizes = rows.groupBy("comp").agg(F.count(F.lit(1)).alias("of"))
    level = F.when(F.col("of") > BLOCK, F.floor(4 * F.log2(F.col("d") + 1))).otherwise(0).cast("long")
    leveled = rows.withColumn("key", F.struct("comp")).join(sizes.select(F.struct("comp").alias("to"), "of"), F.col("key") == F.col("to"))
    leveled = leveled.select("comp", "node", "n", "d", "diff", level.alias("level"))
    counts = leveled.groupBy("comp", "level").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    counts = counts.select(F.struct("comp", "level").alias("to"), "blocks")
    placed = leveled.withColumn("key", F.struct("comp", "level")).join(counts, F.col("key") == F.col("to"))
    place = F.col("level") * F.lit(1 << 40) + F.pmod(F.xxhash64("node"), F.col("blocks"))
    blocks = placed.withColumn("block", place).groupBy("comp", "block").agg(
        F.collect_list(F.struct("node", "n", "d", "diff")).alias("entries"), F.min("n").alias("low"), F.max("n").alias("high"),
        F.min("d").alias("near"), F.max("d").alias("far"),
    )
    blocks = stored(blocks, "blocks")
    drop(rows)
    of = blocks.select("comp", "block", "low", "high", "near", "far")
    x, y = of.alias("x"), of.alias("y")
    gap = F.greatest(F.col("x.near") - F.col("y.far"), F.col("y.near") - F.col("x.far"))
    met = x.join(y, F.col("x.comp") == F.col("y.comp")).filter(
        (F.col("x.block") <= F.col("y.block"))
        & (F.col("x.high") * DENOMINATOR >= F.col("y.low") * NUMERATOR)
        & (F.col("y.high") * DENOMINATOR >= F.col("x.low") * NUMERATOR)
        & (gap * (NUMERATOR + DENOMINATOR) <= (F.col("x.high") + F.col("y.high")) * (DENOMINATOR - NUMERATOR))
    ).select(F.col("x.comp").alias("comp"), F.col("x.block").alias("i"), F.col("y.block").alias("j"))
    met = met.join(blocks.select("comp", F.col("block").alias("i"), F.col("entries").alias("e")), ["comp", "i"])
    met = met.join(blocks.select("comp", F.col("block").alias("j"), F.col("entries").alias("f")), ["comp", "j"])

    def sets(entries: pa.ListScalar) -> tuple:
        flat = entries.values
        node, n, d = (np.asarray(flat.field(k)) for k in ("node", "n", "d"))
        return node, n, d, [np.frombuffer(v, np.uint64) for v in flat.field("diff").to_pylist()]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("comp", "i", "j")), strict=True)
            for (comp, first, second), e, f in zip(keys, batch.column("e"), batch.column("f"), strict=True):
                (a, n, c, p), (b, m, d, q) = sets(e), sets(f)
                own = first == second
                total = n[:, None] + m[None]
                common = (total - (c[:, None] + d[None] - 2 * shared_counts(p, q))) // 2
                fit = common * (NUMERATOR + DENOMINATOR) >= total * NUMERATOR
                if own:
                    fit &= a[:, None] < b[None]
                if summary:
                    for at, nodes, count in ((first, a, fit.sum(1)), (second, b, fit.sum(0))):
                        if count.any():
                            yield _counted(comp, at, nodes, count)
                    continue
                i, j = np.nonzero(fit)
                if len(i):
                    turned = a[i] > b[j]
                    out = (
                        np.minimum(a[i], b[j]), np.maximum(a[i], b[j]), np.where(turned, m[j], n[i]), np.where(turned, n[i], m[j]), common[i, j],
                    )
                    yield _row(*out, names=["a", "b", "n", "m", "common"])

    pairs = met.select("comp", "i", "j", "e", "f")
    if summary:
        counts = pairs.mapInArrow(compare, _SUMMARY).groupBy("comp", "block").applyInArrow(_summed, "node long, links long")
        found = stored(counts, "inner")
    else:
        found = stored(pairs.mapInArrow(compare, _LINKS), "inner")
    drop(blocks)
    return found


def _counted(comp: int, block: int, nodes: np.ndarray, links: np.ndarray) -> pa.RecordBatch:
    """One row: how many links the sets of a block have with those of another."""
    lists = [pa.ListArray.from_arrays(pa.array([0, len(nodes)], pa.int32()), pa.array(v.astype(np.int64))) for v in (nodes, links)]
    return pa.RecordBatch.from_arrays([pa.array([comp], pa.int64()), pa.array([block], pa.int64()), *lists], ["comp", "block", "nodes", "links"])


def _summed(table):
    """The counts of one block, whose sets stand in the same order in all its rows, added up."""
    rows = table.column("links")
    total = sum(np.asarray(x.values) for x in rows)
    return pa.table({"node": pa.array(np.asarray(table.column("nodes")[0].values)), "links": pa.array(total)})


def _row(*columns: np.ndarray, names: list[str]) -> pa.RecordBatch:
    """One row of arrays."""
    lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v.astype(np.int64))) for v in columns]
    return pa.RecordBatch.from_arrays(lists, list(names))


def similar_classes(
    docs: DataFrame, size: int = SHINGLE, summary: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame | None, DataFrame | None, DataFrame | None]:
    """Named sets of all rows; classes of equal sets (node, k1, k2, doc_id: the smallest); all links of classes; components.

    Links come in two tables, both None if no two sets share a list: in rows of arrays (or as counts, ``summary``) those between sets that
    pivots bring to one component (``inner_links``), and one by one the others (a, b, n, m, common). The components (node, comp) are
    what links with pivots alone connect; other links can only join whole components. All are stored; tables
    that only lead to them are removed as soon as the next one is there.
    """
    sets = stored(named_sets(docs, size), "sets")
    usable = sets.filter("doc_id IS NOT NULL AND n_shingles > 0")
    classes = usable.groupBy("k1", "k2").agg(F.min("doc_id").alias("doc_id"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    counted = stored(class_texts(docs, classes, size), "texts")
    texts = counted.filter("chunk IS NULL").select("node", "text", "sketch")
    held = stored(index_lists(texts, counters(counted), size), "lists")
    members = stored(texts.join(held.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"]), "members")
    drop(counted)
    comparisons: list[DataFrame] = []
    components = outer = None
    for round_ in range(PIVOT_ROUNDS + 1):
        current = open_lists(held, components)
        if components is not None:
            current = stored(current, "open")
            drop(held)
            held = current
        if current.isEmpty():
            break
        last = round_ == PIVOT_ROUNDS
        if last:
            pairs = block_pairs(current, members)
        else:
            large = F.col("of") > BLOCK
            pairs = pivot_pairs(current.filter(~large), round_)
            if not current.filter(large).isEmpty():
                pairs = pairs.union(nearest_pivots(current.filter(large), members, round_)).distinct()
        if comparisons:
            compared = reduce(DataFrame.unionAll, comparisons)
            pairs = told_apart(pairs.join(compared.select("a", "b"), ["a", "b"], "left_anti"), compared)
        new = stored(overlaps(pairs, members, size), "compared")
        if last:
            outer = stored(linked(new), "outer")
            drop(new)
        else:
            comparisons.append(new)
            before, components = components, connected(linked(reduce(DataFrame.unionAll, comparisons)).select("a", "b"))
            drop(*[x for x in [before] if x is not None])
    drop(held, *comparisons)
    inner = None if components is None else inner_links(components, members, size, summary)
    drop(members)
    # without a last round no list has sets of two components, so there are no other links
    return sets, classes, inner, outer, components


def links(docs: DataFrame, size: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """The join: all pairs of classes of equal sets whose similarity is 3/4 or more, and the class of every row.

    First a, b, n, m and common: the classes, the sizes of their sets and how many shingles both have, each pair
    once with a < b. Then doc_id, n_shingles and node, the class (null for an empty set or a null doc_id); rows of one
    class are linked too. Rows are linked if their classes are.
    """
    sets, classes, inner, outer, _ = similar_classes(docs, size)
    names = ["a", "b", "n", "m", "common"]
    found = docs.sparkSession.createDataFrame([], "a long, b long, n long, m long, common long")
    if inner is not None:
        found = found.unionAll(inner.select(F.explode(F.arrays_zip(*names)).alias("x")).select("x.*").select(*names))
    if outer is not None:
        found = found.unionAll(outer.select(*names))
    member = sets.join(classes.select("k1", "k2", "node"), ["k1", "k2"], "left")
    return found, member.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("node")).alias("node"))


def grouped_classes(docs: DataFrame, size: int = SHINGLE) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Named sets of all rows, and of each class k1, k2, doc_id, ``component`` (least doc_id), ``links`` and ``first``.

    ``first`` marks the class that stands for its component: that with the least doc_id, then the least name. The third are
    stored tables that both are read from.
    """
    sets, classes, counts, outer, components = similar_classes(docs, size, summary=True)
    tables = [x for x in (sets, classes, counts, outer, components) if x is not None]
    if outer is not None:
        ends = outer.select(F.explode(F.array("a", "b")).alias("node"), F.lit(1).cast("long").alias("links"))
        edges = outer.select("a", "b")
        if components is not None:
            counts = counts.select("node", "links").unionAll(ends)
            edges = edges.unionAll(components.filter("node != comp").select(F.col("comp").alias("a"), F.col("node").alias("b")))
        else:
            counts = ends
        components = connected(edges)
        tables.append(components)
    known = labelled(classes, components)  # without components each class is its own
    name = F.struct("doc_id", "k1", "k2")
    least = known.groupBy("comp").agg(F.min(name).alias("least"))
    known = known.join(least, "comp").withColumns({"component": F.col("least.doc_id"), "first": name == F.col("least")})
    if counts is None:
        known = known.withColumn("links", F.lit(0).cast("long"))
    else:
        known = known.join(counts.groupBy("node").agg(F.sum("links").alias("links")), "node", "left").fillna(0, ["links"])
    return sets, known, tables


def near_duplicates(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links) and n_links of every row of ``docs``.

    Two documents are linked if the Jaccard similarity of their sets of word shingles is 3/4 or more; see
    ``shingle_sets``, and ``links`` for the links themselves, all of which are found here too; ``n_links`` is the number of other
    sets that a row's set is linked with. A document without words (null or blank text) has an empty set and no links:
    it is its own component. A row with a null doc_id has no links and a null component_id. Repeated rows are all
    returned; rows of one doc_id with different texts are compared like other documents. Other columns play no part.
    """
    sets, known, tables = grouped_classes(docs, size)
    out = sets.join(known.select("k1", "k2", "component", "links"), ["k1", "k2"], "left")
    takes_part = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    component = F.when(takes_part, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    count = F.when(takes_part, F.coalesce("links", F.lit(0))).otherwise(F.lit(0)).cast("long")
    out = stored(out.select("doc_id", "n_shingles", component.alias("component_id"), count.alias("n_links")), "components")
    drop(*tables)
    return out


def one_of_each(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """Rows of ``docs`` that stay if of each component of sets one row does.

    That is the row with the smallest doc_id; of several sets of that id the one with the smallest name, and of equal rows
    any. Rows with a null doc_id or without words all stay. Rows that share a doc_id but not their set are different documents.
    """
    sets, known, tables = grouped_classes(docs, size)
    kept = stored(known.filter("first").select("doc_id", "k1", "k2"), "kept")
    again = sets.filter("doc_id IS NOT NULL AND n_shingles > 0").groupBy("doc_id", "k1", "k2").count().filter("count > 1")
    repeated = not again.isEmpty()
    drop(*tables)
    names = ["__n", "__k1", "__k2"]
    schema = StructType([*docs.schema.fields, *[StructField(n, LongType()) for n in names]])

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (x for b in batches for x in pieces(b, "text", SLICE_BYTES)):
            found, at = shingle_sets(part.column("text"), size)
            added = [pa.array(np.diff(at)), *(pa.array(k) for k in set_keys(found, at))]
            yield pa.RecordBatch.from_arrays([*part.columns, *added], [*part.schema.names, *names])

    rows = docs.mapInArrow(named, schema).alias("d")
    to = kept.select(F.col("doc_id").alias("__id"), F.col("k1").alias("__a"), F.col("k2").alias("__b"))
    same = (F.col("d.doc_id").cast("long") == F.col("__id")) & (F.col("__k1") == F.col("__a")) & (F.col("__k2") == F.col("__b"))
    free = F.col("doc_id").isNull() | (F.col("__n") == 0)
    out = rows.join(to, same, "left").filter(free | F.col("__id").isNotNull())
    if repeated:
        single = F.when(free, F.monotonically_increasing_id()).otherwise(-1)
        out = out.withColumn("__single", single).dropDuplicates(["doc_id", "__k1", "__k2", "__single"])
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
