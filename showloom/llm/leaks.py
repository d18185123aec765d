"""Benchmark passages in training texts, found through a positional inverted index. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Words a window has; a shorter item is one window.
WINDOW = 10
#: Lists that are intersected for each window, the rarest ones.
RAREST = 2
#: Rows of a benchmark table that are sent to every executor; a larger one is joined by its keys.
SENT_ROWS = 1_000_000

#: Signs between words, as regular expressions: of a text in lower case, and of one as it is.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
AS_IT_IS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of a text with A-Z in lower case; null has none."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), BETWEEN)
    skip = (F.element_at(parts, 1) == "").cast("int")
    drop = (F.element_at(parts, -1) == "").cast("int")
    return F.slice(parts, skip + 1, F.greatest(F.size(parts) - skip - drop, F.lit(0)))


def placed_words(docs: DataFrame) -> DataFrame:
    """One row for each of the ``words`` of each row of ``docs`` (doc_id, text, text_key): doc_id, text_key, place and word.

    A text is split once, and its words are lower-cased one by one: what ``posexplode`` is given in pieces, it computes
    anew for each piece. ``lower`` does for ASCII what ``translate`` does, and faster.
    """
    text = F.concat(F.lit(" "), F.coalesce("text", F.lit("")))  # so the first part is always empty
    parts = docs.select("doc_id", "text_key", F.posexplode(F.split(text, AS_IT_IS)).alias("at", "part"))
    ascii_ = F.octet_length("part") == F.length("part")
    word = F.when(ascii_, F.lower("part")).otherwise(F.translate("part", _UPPER, _LOWER))
    return parts.filter("part != ''").select("doc_id", "text_key", (F.col("at") - 1).alias("place"), word.alias("word"))


def _sent(df: DataFrame) -> DataFrame:
    """Marked for broadcast if it is small enough."""
    return F.broadcast(df) if df.count() <= SENT_ROWS else df


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and a key that tells apart rows with the same id."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key")
    )


class PhraseIndex:
    """Items, their terms, how often these occur in the documents, and the postings of those that are asked for.

    ``items``: item (a number for each distinct sequence of words), item_ids, words.
    ``terms``: term, word. ``frequencies``: term, count, of terms that occur. Stored are these three, whose size the
    items alone decide; ``postings`` goes through the texts. Items without an id or without words are left out.
    """

    def __init__(self, docs: DataFrame, benchmark: DataFrame):
        items = benchmark.select(F.col("item_id").alias("id"), words(F.col("text")).alias("words"))
        items = items.filter(F.col("id").isNotNull() & (F.size("words") > 0))
        items = items.groupBy("words").agg(F.collect_set("id").alias("item_ids"))
        self.items = stored(items.withColumn("item", F.monotonically_increasing_id()), "items")
        terms = self.items.select(F.explode("words").alias("word")).distinct()
        self.terms = stored(terms.withColumn("term", F.monotonically_increasing_id()), "terms")
        self.tokens = placed_words(keyed(docs))
        self.frequencies = stored(self.postings(self.terms.select("term")).groupBy("term").count(), "frequencies")

    def postings(self, lists: DataFrame) -> DataFrame:
        """``lists`` (term and any further columns) with doc_id, text_key and place of each occurrence of the term."""
        return self.tokens.join(_sent(lists.join(self.terms, "term")), "word").drop("word")

    def ranked(self, size: int) -> DataFrame:
        """item, start, size and terms (struct of frequency, offset and term, the rarest first) of all windows that can occur."""
        length = F.least(F.size("words"), F.lit(size))
        starts = F.sequence(F.lit(0), F.size("words") - length)
        windows = self.items.select("item", "words", length.alias("size"), F.explode(starts).alias("start"))
        offsets = windows.select(
            "item", "start", "size", F.posexplode(F.slice("words", F.col("start") + 1, F.col("size"))).alias("at", "word")
        )
        known = self.terms.join(self.frequencies, "term")
        found = offsets.join(known, "word").withColumn("offset", F.col("start") + F.col("at"))
        lists = found.groupBy("item", "start", "size").agg(
            F.sort_array(F.collect_list(F.struct(F.col("count"), "offset", "term"))).alias("terms")
        )
        return lists.filter(F.size("terms") == F.col("size"))


def phrase_candidates(index: PhraseIndex, size: int = WINDOW, rarest: int = RAREST) -> DataFrame:
    """Places where the rarest terms of a window stand as far apart as in the item.

    One row for each document, item and shift (place in the document less offset in the item):
    doc_id, text_key, item, shift and windows (start and size) whose lists meet there.
    """
    windows = index.ranked(size).withColumn("asked", F.slice("terms", 1, rarest))
    bit = F.expr("aggregate(asked, 0L, (m, x) -> m | shiftleft(1L, x.offset % 64))")
    windows = stored(windows.select("item", "start", "size", "asked", bit.alias("asked_bits")), "windows")
    lists = windows.select("item", F.explode("asked").alias("x")).select("item", "x.term", "x.offset").distinct()
    plans = windows.groupBy("item").agg(F.collect_list(F.struct("start", "size", "asked_bits")).alias("windows"))
    shifted = index.postings(lists).select(
        "doc_id", "text_key", "item", (F.col("place") - F.col("offset")).alias("shift"),
        F.expr("shiftleft(1L, offset % 64)").alias("bit"),
    )
    met = shifted.groupBy("doc_id", "text_key", "item", "shift").agg(F.bit_or("bit").alias("bits"))
    fitting = F.filter(
        "windows",
        lambda w: (w.asked_bits.bitwiseAND(F.col("bits")) == w.asked_bits) & (F.col("shift") + w.start >= 0),
    )
    out = met.join(_sent(plans), "item").select(
        "doc_id", "text_key", "item", "shift",
        F.transform(fitting, lambda w: F.struct(w.start.alias("start"), w.size.alias("size"))).alias("windows"),
    )
    return out.filter(F.size("windows") > 0)


def occurrences(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Each row of ``docs`` with its ``words`` and ``found``: start, size and item_ids of the windows that occur.

    A window is ``size`` consecutive words of an item, or all of a shorter one. Candidates come
    from the index; all words of a candidate are compared before it counts. A null or empty
    text has no words and no occurrence; rows with the same doc_id are told apart by their
    text, and repeated rows have the same occurrences.
    """
    index = PhraseIndex(docs, benchmark)
    hits = phrase_candidates(index, size).join(
        _sent(index.items.withColumnRenamed("words", "item_words")), "item"
    )
    hit = F.struct("shift", "windows", "item_ids", "item_words")
    by_doc = hits.groupBy("doc_id", "text_key").agg(F.collect_list(hit).alias("hits"))
    by_doc = by_doc.withColumnsRenamed({"doc_id": "hit_id", "text_key": "hit_key"})
    rows = keyed(docs)
    joined = rows.join(
        by_doc, rows.doc_id.eqNullSafe(by_doc.hit_id) & rows.text_key.eqNullSafe(by_doc.hit_key), "left"
    ).select("doc_id", rows.text_key, words(F.col("text")).alias("words"), "hits")

    def same(h, w):
        own = F.slice(F.col("words"), F.greatest(h.shift + w.start + 1, F.lit(1)), w.size)
        return own == F.slice(h.item_words, w.start + 1, w.size)

    found = F.transform(
        "hits",
        lambda h: F.transform(
            F.filter(h.windows, lambda w: same(h, w)),
            lambda w: F.struct((h.shift + w.start).alias("start"), w.size.alias("size"), h.item_ids.alias("item_ids")),
        ),
    )
    nothing = F.array().cast("array<struct<start:int,size:int,item_ids:array<string>>>")
    ids = F.transform(
        F.flatten(found),
        lambda x: F.struct(
            x.start.alias("start"), x.size.alias("size"), F.transform(x.item_ids, lambda i: i.cast("string")).alias("item_ids")
        ),
    )
    return joined.select("doc_id", "text_key", "words", F.coalesce(ids, nothing).alias("found"))


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, text_key (hash of the text), n_words, n_hit (words inside an occurrence), n_items, items (sorted ids) and contaminated."""
    found = occurrences(docs, benchmark, size)
    places = F.flatten(F.transform("found", lambda x: F.sequence(x.start, x.start + x.size - 1)))
    items = F.sort_array(F.array_distinct(F.flatten(F.transform("found", lambda x: x.item_ids))))
    return found.select(
        "doc_id",
        "text_key",
        F.size("words").cast("long").alias("n_words"),
        F.size(F.array_distinct(places)).cast("long").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        items.alias("items"),
        (F.size("found") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Rows of ``docs``, with all columns, in which no window of an item occurs."""
    found = contamination(docs, benchmark, size).filter("contaminated").select(
        F.col("doc_id").alias("bad_id"), F.col("text_key").alias("bad_key")
    )
    same = docs.doc_id.cast("long").eqNullSafe(found.bad_id) & (F.xxhash64(docs.text) == found.bad_key)
    return docs.join(found, same, "left_anti")


def near_matches(index: PhraseIndex, within: int, terms: int = 3) -> DataFrame:
    """Documents in which the rarest terms of an item stand within ``within`` words of one another, in any order.

    doc_id, text_key, item and place (the first of them, the smallest such place). Items of which a term never
    occurs have no match. Places are put together in blocks of ``within`` words and their
    successors, so what one row holds is bounded by the block, not by the document.
    """
    all_words = index.items.select("item", F.explode(F.array_distinct("words")).alias("word"))
    known = all_words.join(index.terms, "word").join(index.frequencies, "term", "left")
    ranked = known.groupBy("item").agg(
        F.slice(F.sort_array(F.collect_list(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "term"))), 1, terms).alias("asked")
    )
    ranked = ranked.filter(F.element_at("asked", 1)["count"] > 0)
    lists = ranked.select("item", F.size("asked").alias("needed"), F.explode("asked.term").alias("term"))
    placed = index.postings(lists)
    block = F.floor(F.col("place") / F.lit(within))
    blocks = placed.withColumn("block", F.explode(F.array(block, block - 1)))
    grouped = blocks.groupBy("doc_id", "text_key", "item", "needed", "block").agg(
        F.array_sort(F.collect_set(F.struct("place", "term"))).alias("places")
    )

    def closes(first):
        inside = F.filter("places", lambda p: (p.place >= first.place) & (p.place < first.place + within))
        return F.size(F.array_distinct(F.transform(inside, lambda p: p.term))) == F.col("needed")

    starts = F.filter("places", closes)
    return (
        grouped.withColumn("starts", starts).filter(F.size("starts") > 0)
        .groupBy("doc_id", "text_key", "item").agg(F.min(F.col("starts")[0]["place"]).alias("place"))
    )
