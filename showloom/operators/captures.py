"""Tables of captured pages: ``(page_id, url, html)``, a later capture having the higher id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from .diff import union_rows
from .keyfilter import cannot_hold, key_filter, may_hold

# The classes the listings are made of.
REGION_A = H.css(exact="region region-content")
BOX_A, ITEM_A = H.css(cls="alphabetical-container"), H.css(cls="alphabetical-item")
BOX_B, TITLE_B = H.css("div", exact="col-md-4 col-sm-6 col-xs-12 views-col"), H.css("div", cls="list-title")


def prepared(pages: DataFrame) -> DataFrame:
    """Pair the tags of each page once; every field is read out of the result, which takes the place of ``html``."""
    return pages.withColumn("html", H.page(F.col("html")))


def latest(records: DataFrame, key: str = "url", order: str = "page_id") -> DataFrame:
    """One row per key, the one captured last.

    Meant for extracted records, not for whole pages: only the fields are moved. Any number of
    copies of a page is reduced to one per input partition before the shuffle.
    """
    rest = [c for c in records.columns if c not in (key, order)]
    newest = F.max_by(F.struct(*rest), F.col(order)).alias("__r")
    return records.groupBy(key).agg(newest).select(key, "__r.*")


def repeated(*tables: DataFrame) -> DataFrame:
    """Which urls are captured more than once in one of the tables, or without a number, as a key filter.

    Only urls and numbers are read. One filter for all pages that a query reads is ready before any of them is parsed.
    """
    numbered = [t.select(F.lit(i).alias("__table"), "url", "page_id") for i, t in enumerate(tables)]
    per_url = union_rows(*numbered).groupBy("__table", "url").agg(F.count(F.lit(1)).alias("__n"), F.max("page_id").alias("__last"))
    return key_filter(per_url.filter("__n > 1 OR __last IS NULL"), ["url"])


def newest(pages: DataFrame, fields: dict[str, Column], key: str, again: DataFrame) -> DataFrame:
    """``key`` and the fields of the newest capture of each url, read where the pages are scanned. A null url is left out.

    What is captured once, by the filter ``again`` (``repeated``), is not grouped: it goes straight to the join it is read for, so
    that its fields are neither sorted nor moved before. Only the other urls go through ``latest``; they are scanned by themselves.
    """
    captured = pages.filter(F.col("url").isNotNull())
    read = [c.alias(n) for n, c in fields.items()]
    once, copies = (
        prepared(keep(captured, again, ["url"])).select("page_id", F.col("url").alias(key), *read) for keep in (cannot_hold, may_hold)
    )
    return once.drop("page_id").unionByName(latest(copies, key))


def wanted(pages: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Pages that the keys may ask for, picked before anything is read out of them.

    The same plan for any number of keys: they become a filter of fixed size that is broadcast, and no page is moved. Nearly
    all other pages go; the join on the extracted fields drops what is left of them.
    """
    return may_hold(pages, key_filter(keys, on), on)


def listing_a(pages: DataFrame) -> DataFrame:
    """Alphabetical listing -> ``show_url``, one row per item; an item without link gives null."""
    boxes = H.every(H.first(F.col("html"), REGION_A), BOX_A, _item_links)
    return prepared(pages).select(F.explode(F.flatten(boxes)).alias("show_url"))


def _item_links(box: Column) -> Column:
    linked = H.css("a", has="href")
    return H.every(box, ITEM_A, lambda e: H.first_attribute(e, linked, "href"))


def listing_b(pages: DataFrame, category: Column) -> DataFrame:
    """Listings by category -> ``(url, filter)``; a url listed under two categories stays twice.

    One pass over all listing pages: the category comes from the page itself, for example from
    its address, instead of one scan per category and a union.
    """
    def entry(e: Column) -> Column:
        titled = H.has(e, TITLE_B)
        return F.struct(titled.alias("titled"), H.first_attribute(e, H.css("a"), "href").alias("url"))

    entries = H.every(F.col("html"), BOX_B, entry)
    rows = prepared(pages).select(category.alias("filter"), F.explode(entries).alias("e"))
    return rows.filter("e.titled").select("e.url", "filter")


def category_of(url: Column) -> Column:
    """``.../show-type/<category>/...`` -> the category."""
    return F.nullif(F.regexp_extract(url, "/show-type/([^/?#]+)", 1), F.lit(""))


def tagged(listings: DataFrame, tag: str, name: str = "filter") -> DataFrame:
    """A constant tag column, for listings that are kept in tables of their own."""
    return listings.withColumn(name, F.lit(tag))
