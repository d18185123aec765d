"""Spelling variants: words of a corpus one edit apart, found with bitsets per position and letter.

The vocabulary is dealt into blocks of words with the same first three or the same last four letters:
one edit leaves one of both as it is in words of seven letters or more. A block keeps, for each length,
one bitset over its words for each pair of position and letter. A word is looked up by going through its
letters once; sets of words without an error, and with one, are carried along for all words of
the block at once: replaced (same position), missing (next position) and added (previous position).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import partitions, stored

MIN_LETTERS = 7
HEAD, TAIL = 3, 4
#: Words of an index; a larger block is dealt into several, and its words are looked up in each.
INDEX_WORDS = 1 << 14
#: Small blocks are looked up together until they have this many words.
TOGETHER = 1 << 11
#: 64-bit words of one set of bitsets (for some looked-up words at once).
LOOKED_UP = 1 << 18
#: A form is at least so many times as frequent.
RATIO = 10

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = "A-Za-zÀ-ÿ"


def spelled(docs: DataFrame) -> DataFrame:
    """``word``: each run of letters, A-Z in lower case, as often as it occurs; only runs of seven letters or more.

    One in 31 (by the checksum of document and run) loses a letter, as the contract of the query says.
    """
    run = F.regexp_extract_all(F.col("text"), F.lit(f"[{LETTERS}]{{{MIN_LETTERS},}}"), F.lit(0))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(run).alias("run"))
    lowered = runs.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    h = F.crc32(F.encode(F.concat_ws(":", "id", "run"), "UTF-8"))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    shorter = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    word = F.when(F.col("h") % 31 == 0, shorter).otherwise(F.col("run"))
    return lowered.withColumn("h", h).select(word.alias("word")).filter(F.length("word") >= MIN_LETTERS)


def vocabulary(words: DataFrame, least: int = 2) -> DataFrame:
    """``word`` and how often it occurs (``n``), of words that occur often enough."""
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def _blocks() -> Column:
    """The two blocks of a word; the first sign tells heads from tails."""
    head = F.concat(F.lit("h"), F.col("word").substr(1, HEAD))
    return F.array(head, F.concat(F.lit("t"), F.col("word").substr(-TAIL, TAIL)))


class Index:
    """Bitsets of words of one length: ``bits[i]`` has one row for each letter at position i, then an empty one."""

    def __init__(self, letters: np.ndarray):
        self.words, self.length = letters.shape
        self.width = -(-self.words // 64)
        self.codes, self.bits = [], []
        for column in letters.T:
            codes, which = np.unique(column, return_inverse=True)
            table = np.zeros((len(codes) + 1, self.width * 64), np.uint8)
            table[which, np.arange(self.words)] = 1
            self.codes.append(codes)
            self.bits.append(np.packbits(table, axis=1, bitorder="little").view(np.uint64))
        self.all = np.packbits(np.arange(self.width * 64) < self.words, bitorder="little").view(np.uint64)

    def at(self, position: int, letter: np.ndarray) -> np.ndarray:
        """For each letter the set of words that have it there."""
        codes = self.codes[position]
        row = np.minimum(np.searchsorted(codes, letter), len(codes) - 1)
        return self.bits[position][np.where(codes[row] == letter, row, len(codes))]


def one_error(index: Index, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each looked-up word (rows of letters of one length): words exactly one edit away; words with its first letters."""
    n, length = asked.shape
    none = np.broadcast_to(index.all, (n, index.width)).copy()
    one = np.zeros_like(none)
    head = none
    for i in range(length):
        letter = asked[:, i]
        here = index.at(i, letter) if i < index.length else np.zeros_like(none)
        if index.length == length:  # another letter here
            one = (one & here) | (none & ~here)
        elif index.length > length:  # they have a letter more in front of this one
            one = (one | none) & index.at(i + 1, letter)
        else:  # this letter is one too many
            one = (one & index.at(i - 1, letter) if i else one) | none
        none = none & here
        if i + 1 == HEAD:
            head = none
    return (one | none if index.length > length else one), head


def _letters(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), length)


def near_counts(words: list[str], counts: np.ndarray, indexed: np.ndarray, by_head: bool):
    """How many indexed words are near each word, and the place of the most frequent of them (-1: none).

    In blocks by head only words with the same head count, in blocks by tail only others, so that a
    pair counts once. Ties go to the smaller word.
    """
    sizes = np.array([len(w) for w in words], np.int64)
    order = np.array(sorted(range(len(words)), key=lambda i: (-counts[i], words[i])), np.int64)
    near, best = np.zeros(len(words), np.int64), np.full(len(words), -1, np.int64)
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    by_length = {}
    for size in np.unique(sizes[indexed]).tolist():
        members = order[(sizes[order] == size) & indexed[order]]  # the most frequent word has the first bit
        by_length[size] = members, Index(_letters([words[i] for i in members], size))
    for size in np.unique(sizes).tolist():
        own = np.flatnonzero(sizes == size)
        letters = _letters([words[i] for i in own], size)
        for members, index in (by_length[s] for s in (size - 1, size, size + 1) if s in by_length):
            step = max(1, LOOKED_UP // index.width)
            for a in range(0, len(own), step):
                asked = own[a : a + step]
                found, same_head = one_error(index, letters[a : a + step])
                found &= same_head if by_head else ~same_head
                near[asked] += np.bitwise_count(found).sum(axis=1, dtype=np.int64)
                some = np.flatnonzero(found.any(axis=1))
                first = (found[some] != 0).argmax(axis=1)
                lowest = found[some, first]
                bit = np.bitwise_count((lowest & (~lowest + np.uint64(1))) - np.uint64(1))
                hit, asked = members[first * 64 + bit], asked[some]
                better = (best[asked] < 0) | (place[hit] < place[best[asked]])
                best[asked[better]] = hit[better]
    return near, best


def _groups(block: np.ndarray, part: np.ndarray, last: bool) -> list[tuple[int, int]]:
    """Ranges of sorted rows to look up: a dealt part alone, small blocks of one kind together; the last block only if it is whole."""
    n = len(block)
    starts = [0, *(np.flatnonzero((block[1:] != block[:-1]) | (part[1:] != part[:-1])) + 1).tolist()]
    out, s = [], 0
    for a, b in zip(starts, [*starts[1:], n], strict=True):
        if a > s and (part[a] >= 0 or b - s > TOGETHER or block[a][0] != block[s][0]):
            out.append((s, a))
            s = a
        if b == n and not last:
            return out
        if part[a] >= 0:
            out.append((a, b))
            s = b
    return [*out, (s, n)] if s < n else out


def _look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= TOGETHER:
            rows = pa.Table.from_batches(held).combine_chunks()
            held = yield from _found(rows, last=False)
    if held:
        yield from _found(pa.Table.from_batches(held).combine_chunks(), last=True)


def _found(table: pa.Table, last: bool):
    """Looks up whole groups of rows; returns the rows behind them."""
    block = table.column("block").to_numpy(zero_copy_only=False)
    groups = _groups(block, np.asarray(table.column("part").combine_chunks()), last)
    for a, b in groups:
        rows = table.slice(a, b - a).combine_chunks()
        words = rows.column("word").to_pylist()
        counts = np.array(rows.column("n").to_pylist(), np.int64)
        near, best = near_counts(words, counts, np.array(rows.column("indexed").to_pylist(), bool), block[a][0] == "h")
        some = np.flatnonzero(near)
        yield pa.RecordBatch.from_arrays(
            [pa.array([words[i] for i in some], pa.string()), pa.array(near[some], pa.int64()),
             pa.array(-counts[best[some]], pa.int64()), pa.array([words[i] for i in best[some]], pa.string())],
            names=["word", "n_near", "less", "form"],
        )
    return table.slice(groups[-1][1] if groups else 0).to_batches()


def neighbours(words: DataFrame) -> DataFrame:
    """``word``, ``n``, ``n_near`` and its most frequent near word ``best`` (``best_n``), of ``words(word, n)``.

    A block of more than ``INDEX_WORDS`` words is dealt into several indexes, in each of which all its words are looked up.
    """
    spark = words.sparkSession
    rows = words.select("word", "n", F.explode(_blocks()).alias("block"))
    # at most one large block for each INDEX_WORDS / 2 words: few, so it is sent to all tasks by Spark's own decision
    large = rows.groupBy("block").count().filter(F.col("count") > INDEX_WORDS)
    ways = stored(large.select("block", F.ceil(F.col("count") / INDEX_WORDS).cast("int").alias("ways")), "ways")
    own = F.pmod(F.xxhash64("word"), F.col("ways")).cast("int")
    parts = F.when(F.col("ways") > 1, F.sequence(F.lit(0), F.col("ways") - 1)).otherwise(F.array(F.lit(-1)))
    dealt = (
        rows.join(ways, "block", "left")
        .select("block", F.explode(parts).alias("part"), "word", "n", F.coalesce(own, F.lit(-1)).alias("own"))
        .withColumn("indexed", F.col("part") == F.col("own"))
        .drop("own")
    )
    sorted_rows = dealt.repartition(partitions(spark), "block", "part").sortWithinPartitions("block", "part")
    found = sorted_rows.mapInArrow(_look_up, "word string, n_near long, less long, form string")
    best = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("less", "form")).alias("b"))
    return words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.col("b.form").alias("best"), (-F.col("b.less")).alias("best_n"),
    )


def variants(words: DataFrame) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` of ``words(word, n)``.

    The form is the most frequent near word (ties: the smaller one), if at least ten times as frequent, else null; the root
    is the end of the chain of forms. Each form is ten times as frequent, so chains are short and their length is known beforehand.
    """
    clear = F.col("best_n") >= RATIO * F.col("n")
    forms = stored(
        neighbours(words).select(
            "word", "n", "n_near", F.when(clear, F.col("best")).alias("form"), F.when(clear, F.col("best_n")).alias("form_n")
        ),
        "forms",
    )
    links = forms.filter("form IS NOT NULL").select("word", F.col("form").alias("to"))
    most = forms.agg(F.max("n")).first()[0] or 1
    for _ in range(math.ceil(math.log2(max(1, math.log10(most))))):
        further = links.select(F.col("word").alias("to"), F.col("to").alias("next"))
        links = stored(links.join(further, "to", "left").select("word", F.coalesce("next", "to").alias("to")), "roots")
    return forms.join(links, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("to", "word").alias("root")
    )


def variant_groups(docs: DataFrame) -> DataFrame:
    """Spelling variants among the words of ``docs(doc_id, text)``: see ``variants``.

    Words have at least seven letters and occur at least twice. A null text has no words, an empty table
    gives no rows, repeated rows count each time, a null ``doc_id`` is an empty text in the checksum; other columns are ignored.
    """
    return variants(stored(vocabulary(spelled(docs)), "vocabulary"))
