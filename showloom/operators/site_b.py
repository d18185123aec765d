"""Catalogue B: show page and page of upcoming productions -> one wide row per show.

The functions over ``html`` expect a page whose tags are paired (``captures.prepared``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import nested as N
from ..functions import text as T
from ..functions.html import css
from . import captures
from .joins import look_up

# Section words of the community text.
COMMUNITY_HEADERS = {"sets": "Sets", "costumes": "Costumes", "props": "Props"}

COLUMNS = [
    "show_title", "show_type", "show_url", "book_and_music_by", "logo_url", "casting_info", "cast_list",
    "apply_for_license", "show_credits", "orchestral_information_list", "upcoming_productions", "songs_list",
    "related_shows_urls", "resources", "synopsis", "community",
]

_OVERVIEW = css("div", ident="show-overview")
_CASTING = css("div", ident="show-casting-information")


def authors(html: Column) -> Column:
    box = H.first(H.first(html, _OVERVIEW), css("ul", cls="list-unstyled"))
    return F.filter(H.texts(box, css("li", cls="author-info")), lambda t: T.has_text(t))


def casting_info(html: Column) -> Column:
    return T.keep_if_digit(H.stripped_text(H.first(H.first(html, _CASTING), css("p"))))


def license_link(html: Column) -> Column:
    """The second licence link."""

    def second(box: Column) -> Column:
        links = H.every(box, css("a", exact="btn btn-success btn-lg"), lambda e: H.attribute(e, "href"))
        return F.when(H.node_text(box) != "", N.nth_or_default(links, 1, "None"))

    return T.let(H.first(html, css("div", exact="pull-right extra-links")), second)


def paragraphs(html: Column, ident: str) -> Column:
    return H.every(H.first(html, css("div", ident=ident)), css("p"), H.node_text)


def resources(html: Column) -> Column:
    box = H.first(H.first(html, css("div", exact="sidebar-section additional-products")), css("ul", cls="list-unstyled"))
    items = H.link_structs(box, "resource_name", "resource_url", css("li"))
    return T.complete(items, lambda r: r["resource_url"].isNotNull())


def songs(html: Column) -> Column:
    box = H.first(H.first(html, css("div", cls="audio-wrapper")), css("ol", cls="audiojs-playlist"))
    return H.link_structs(box, "song_name", "song_url", css("li"), attr="data-src")


def related_links(html: Column) -> Column:
    """The first link behind the heading and the link next to it; nothing when one is missing."""

    def targets(m: H.Match) -> Column:
        return F.transform(H.next_and_sibling(m, "a"), lambda a: F.try_element_at(a, F.lit("href")))

    pairs = H.each_match(html, css("h3"), targets, string=["Related Shows"], within=_OVERVIEW)
    return F.get(pairs, F.lit(0))


def community(html: Column) -> Column:
    box = H.first(H.first(html, css("div", ident="show-community")), css("div", exact="resource clearfix"))
    lines = F.array_join(H.every(box, css("p"), H.node_text), "\n")
    return T.let(lines, lambda text: F.when(text.isNotNull(), N.sections(text, COMMUNITY_HEADERS)))


def productions(html: Column) -> Column:
    def production(e: Column) -> Column:
        start = H.stripped_text(H.first(e, css("span", cls="date-display-start")))
        end = H.stripped_text(H.first(e, css("span", cls="date-display-end")))
        location = H.stripped_text(H.first(e, css("h5")))
        return F.struct(T.date_range(start, end).alias("production_date"), location.alias("location"))

    items = H.every(html, css("div", cls="upcoming"), production)
    return T.complete(items, lambda p: p["production_date"].isNotNull() & p["location"].isNotNull())


def show_fields(html: Column) -> dict[str, Column]:
    """Empty text, empty lists and ``"None"`` all become null."""
    logo = H.first(html, css("header", exact="article-header show-header"))
    title = H.first(html, css("h1", exact="single-title custom-post-type-title"))
    return {
        "show_title": T.missing_to_null(H.node_text(title)),
        "book_and_music_by": T.empty_to_null(authors(html)),
        "logo_url": H.first_attribute(logo, css("img", cls="img-responsive"), "src"),
        "casting_info": T.missing_to_null(casting_info(html)),
        "cast_list": T.empty_to_null(H.texts(H.first(html, _CASTING), css("p"))),
        "apply_for_license": T.missing_to_null(license_link(html)),
        "show_credits": T.missing_to_null(H.node_text(H.first(html, css("div", ident="show-credits")))),
        "orchestral_information_list": T.empty_to_null(paragraphs(html, "show-orchestral-information")),
        "songs_list": T.empty_to_null(songs(html)),
        "related_shows_urls": related_links(html),
        "resources": T.empty_to_null(resources(html)),
        "synopsis": T.empty_to_null(paragraphs(html, "show-synopsis")),
        "community": community(html),
    }


def upcoming_url(show_url: Column) -> Column:
    return T.join_url(show_url, "/upcoming/")


def records(shows: DataFrame, pages: DataFrame, upcoming_pages: DataFrame | None = None) -> DataFrame:
    """Raw catalogue B for ``shows(url, filter)``: the row of a url listed twice comes twice."""
    html = F.col("html")
    if upcoming_pages is None:
        # the newest capture counts also where it has no productions any more
        upcoming_pages = pages.withColumn("html", F.when(html.contains("upcoming"), html).otherwise(F.lit("")))
    again = captures.repeated(pages, upcoming_pages)
    show_side = captures.newest(pages, show_fields(html), "show_url", again)
    coming = {"upcoming_productions": T.empty_to_null(productions(html))}
    upcoming_side = captures.newest(upcoming_pages, coming, "upcoming_url", again)
    listed = shows.select(F.col("url").alias("show_url"), F.col("filter").alias("show_type"))
    found = look_up(listed, show_side, "show_url", "inner").withColumn("upcoming_url", upcoming_url(F.col("show_url")))
    return look_up(found, upcoming_side, "upcoming_url", "left").select(*COLUMNS)
