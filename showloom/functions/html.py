"""Element, attribute and text extraction from HTML held in a column.

``page`` pairs the tags once, in one pass. What it gives is a fragment (``elements.PAGE``): the elements in order of their
start tags, with interval numbers, the text nodes in order, and which element it is. Everything else is native expressions
over these arrays: an element inside another has a number inside its interval, a sibling the same
element around it, the next one a greater number. So there is no limit of depth, and markup may be left open
or closed by an element around it.

All functions below ``page`` expect such a fragment and, where they give an element, return one. A fragment holds its own
elements and texts only: Spark copies what a lambda returns, so that a fragment costs what is in it and not its whole page.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import elements
from .elements import REST
from .entities import unescape
from .text import let, strip

_TAG = rf"</?[A-Za-z!?]{REST}>"


@dataclass(frozen=True)
class Selector:
    """``cls`` matches one class token, ``exact`` the whole class attribute, ``ident`` the id.

    ``has`` names an attribute that must be there, whatever its value.
    """

    tag: str | None = None
    cls: str | None = None
    exact: str | None = None
    ident: str | None = None
    has: str | None = None

    def matches(self, e: Column) -> Column:
        tests = []
        if self.tag:
            tests.append(e["tag"] == self.tag.lower())
        if self.cls:
            tests.append(e["cls"].contains(f" {self.cls} "))
        if self.exact:
            tests.append(e["cls"] == f" {' '.join(self.exact.split())} ")
        if self.ident:
            tests.append(e["attributes"]["id"] == self.ident)
        if self.has:
            tests.append(F.map_contains_key(e["attributes"], self.has))
        return reduce(lambda a, b: a & b, tests)


def css(tag=None, cls=None, exact=None, ident=None, has=None) -> Selector:
    return Selector(tag, cls, exact, ident, has)


def markup(html: Column) -> Column:
    """Blank comments, declarations and the content of script, style and template."""
    hidden = (
        r"(?is)<!--.*?(?:-->|\z)|<!doctype[^>]*>"
        r"|<(script|style|template)(?=[\s>])[^>]*>.*?(?:</\1\s*>|\z)"
    )
    return F.regexp_replace(html, hidden, "<!---->")


def visible_text(html: Column) -> Column:
    """Text nodes of a markup text stripped one by one and joined by a space; null gives ``""``."""
    nodes = F.transform(F.split(markup(html), _TAG), lambda t: strip(unescape(t)))
    return F.coalesce(F.array_join(F.filter(nodes, lambda t: t != ""), " "), F.lit(""))


def page(html: Column) -> Column:
    """The whole page, without what ``markup`` blanks, as a fragment, null for null. Keep it as a column of its own: it is not native."""
    return F.arrow_udf(elements.in_pieces, elements.PAGE)(html)


# --- elements -----------------------------------------------------------------------------


def _place(f: Column, pre: Column) -> Column:
    """Where the element with a number stands among the elements of a fragment, the first of which is the fragment itself."""
    return pre - f["at"]["pre"] + 1


def _below(f: Column, e: Column) -> Column:
    """The elements inside one of a fragment."""
    return F.slice(f["elements"], _place(f, e["pre"]) + 1, e["last"] - e["pre"])


def _inside(f: Column) -> Column:
    return F.slice(f["elements"], F.lit(2), f["at"]["last"] - f["at"]["pre"])


def _chain(f: Column, e: Column) -> Column:
    """An element of a fragment and those inside it."""
    return F.slice(f["elements"], _place(f, e["pre"]), e["last"] - e["pre"] + 1)


def _texts(f: Column, e: Column) -> Column:
    return F.slice(f["texts"], e["lo"] - f["at"]["lo"] + 1, e["hi"] - e["lo"])


def _cut(f: Column, e: Column) -> Column:
    """An element of a fragment as a fragment of its own, null for null."""
    return F.when(e.isNotNull(), F.struct(_chain(f, e).alias("elements"), _texts(f, e).alias("texts"), e.alias("at")))


def _found(f: Column, sel: Selector) -> Column:
    return F.filter(_inside(f), sel.matches)


def first(f: Column, sel: Selector) -> Column:
    """First element in document order, null if there is none."""
    return let(f, lambda f: let(F.get(_found(f, sel), F.lit(0)), lambda e: _cut(f, e)))


def has(f: Column, sel: Selector) -> Column:
    return let(f, lambda f: F.exists(_inside(f), lambda e: F.coalesce(sel.matches(e), F.lit(False))))


@dataclass(frozen=True)
class Match:
    """One matched element and the fragment it was found in."""

    fragment: Column
    found: Column


def each_match(f: Column, sel: Selector, body, string: list[str] | None = None, within: Selector | None = None) -> Column:
    """Array of ``body(match)`` in document order, nested matches included.

    With ``string`` only elements that hold one of these texts and nothing else, directly or in an only child. With ``within``
    only those in the first such element; ``body`` still sees the whole fragment.
    """

    def only(f: Column, e: Column) -> Column:
        alone = F.forall(_chain(f, e), lambda x: (x["last"] == e["last"]) & (x["hi"] - x["lo"] == 1))
        return alone & F.get(_texts(f, e), F.lit(0)).isin(*string)

    def matched(f: Column, region: Column) -> Column:
        inside = _inside(f) if region is None else _below(f, region)
        found = F.filter(inside, sel.matches)
        kept = F.filter(found, lambda e: only(f, e)) if string else found
        return F.transform(kept, lambda e: body(Match(f, e)))

    if within is None:
        return let(f, lambda f: matched(f, None))
    return let(f, lambda f: let(F.get(_found(f, within), F.lit(0)), lambda region: matched(f, region)))


def every(f: Column, sel: Selector, body=lambda e: e) -> Column:
    """All matching elements in document order, nested ones included, through ``body``."""
    return each_match(f, sel, lambda m: let(element(m), body))


def count(f: Column, sel: Selector) -> Column:
    return let(f, lambda f: F.size(_found(f, sel)))


def element(m: Match) -> Column:
    return _cut(m.fragment, m.found)


#: Neighbours are looked for among so many elements first, then among so many, and only then among all.
_NEAR, _FAR = 16, 256


def _next(m: Match, sel: Selector, sibling_of: Column | None = None) -> Column:
    """The first such element of the fragment searched that starts behind the match (or behind a sibling of its own)."""
    start = m.found if sibling_of is None else sibling_of
    every_one = m.fragment["elements"]
    behind = _place(m.fragment, start["pre"]) + 1

    def test(x: Column) -> Column:
        return sel.matches(x) if sibling_of is None else sel.matches(x) & (x["up"] == sibling_of["up"])

    def among(skipped: int, n: Column) -> Column:
        return F.get(F.filter(F.slice(every_one, behind + skipped, n), test), F.lit(0))

    return F.coalesce(among(0, F.lit(_NEAR)), among(_NEAR, F.lit(_FAR)), among(_NEAR + _FAR, F.size(every_one)))


def next_element(m: Match, sel: Selector) -> Column:
    """First ``sel`` that starts behind the matched start tag, inside the match or further on.

    Search the whole page with ``each_match`` (narrowed by ``within``) to look on behind an element of it.
    """
    return let(_next(m, sel), lambda e: _cut(m.fragment, e))


def next_and_sibling(m: Match, tag: str) -> Column:
    """Attributes of the next such element and of the sibling of that name behind it, null without both."""

    def pair(e: Column) -> Column:
        return let(_next(m, css(tag), e), lambda s: F.when(s.isNotNull(), F.array(e["attributes"], s["attributes"])))

    return let(_next(m, css(tag)), pair)


def previous_sibling(m: Match, tag: str) -> Column:
    """The last element of that name in front of the match with the same element around it, null if there is none."""
    up = m.found["up"]
    there = m.found["pre"] - up - 1

    def among(n: Column) -> Column:
        region = F.slice(m.fragment["elements"], _place(m.fragment, m.found["pre"]) - n, n)
        return F.try_element_at(F.filter(region, lambda x: (x["up"] == up) & css(tag).matches(x)), F.lit(-1))

    last = F.coalesce(*[among(F.least(there, F.lit(n))) for n in (_NEAR, _FAR)], among(there))
    return let(last, lambda e: _cut(m.fragment, e))


# --- text and attributes ------------------------------------------------------------------


def node_text(f: Column) -> Column:
    """All text nodes run together, nothing stripped."""
    return F.array_join(f["texts"], "")


def stripped_text(f: Column) -> Column:
    return strip(node_text(f))


def texts(f: Column, sel: Selector) -> Column:
    """Stripped text of every match."""
    return let(f, lambda f: F.transform(_found(f, sel), lambda e: strip(F.array_join(_texts(f, e), ""))))


def attribute(f: Column, name: str) -> Column:
    """Attribute of the element the fragment is, null if absent."""
    return F.try_element_at(f["at"]["attributes"], F.lit(name))


def first_attribute(f: Column, sel: Selector, name: str) -> Column:
    """Attribute of the first match; null without a match or without the attribute."""
    return let(f, lambda f: F.try_element_at(F.get(_found(f, sel), F.lit(0))["attributes"], F.lit(name)))


def link_structs(f: Column, name: str, url: str, sel: Selector = css("a"), attr: str = "href") -> Column:
    """``array<struct<name, url>>``: text of each match and an attribute of its first link."""

    def link(e: Column) -> Column:
        return F.struct(stripped_text(e).alias(name), first_attribute(e, css("a"), attr).alias(url))

    return every(f, sel, link)


def table_rows(table: Column, arity: int | None = None) -> Column:
    """Rows as arrays of stripped cell texts; with ``arity`` only rows of that many cells."""
    rows = every(table, css("tr"), lambda row: texts(row, css("td")))
    return rows if arity is None else F.filter(rows, lambda r: F.size(r) == arity)


def named_rows(table: Column, names: list[str]) -> Column:
    """Rows with exactly ``len(names)`` cells as structs."""
    return F.transform(
        table_rows(table, len(names)),
        lambda r: F.struct(*[F.get(r, F.lit(i)).alias(n) for i, n in enumerate(names)]),
    )
