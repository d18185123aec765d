"""Queries over the captured pages as they are, and over small fragments made of ``documents``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import nested as N
from ..functions.html import css
from ..operators import captures, site_a, site_b
from ..sources.tables import Tables
from . import rendered as R
from .registry import query


def _decoded(expr: str) -> str:
    """The references the pages hold; each of these names may do without its semicolon."""
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        expr = f"regexp_replace({expr}, '&{name};?', '{char}', 'g')"
    return expr


def _pages(t: Tables) -> DataFrame:
    return captures.prepared(t.spread("pages"))


def _made(t: Tables, html: Column) -> DataFrame:
    return captures.prepared(t.spread("documents").select("doc_id", html.alias("html")))


def _html() -> Column:
    return F.col("html")


@query(f"""
    SELECT page_id, regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang,
           trim({_decoded("regexp_extract(html, '<title>(.*?)</title>', 1)")}) AS title,
           trim({_decoded("regexp_extract(html, '<h1>(.*?)</h1>', 1)")}) AS heading
    FROM pages
""")
def html_title_extract(t: Tables) -> DataFrame:
    return _pages(t).select(
        "page_id",
        H.first_attribute(_html(), css("html"), "lang").alias("lang"),
        H.stripped_text(H.first(_html(), css("title"))).alias("title"),
        H.stripped_text(H.first(_html(), css("h1"))).alias("heading"),
    )


@query(f"""
    SELECT page_id, array_to_string(list_filter(list_transform(
        string_split_regex(
            regexp_replace(html, '(?is)<!--.*?-->|<!doctype[^>]*>|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', '<!---->', 'g'),
            '</?[A-Za-z!?][^>]*>'),
        lambda x: trim({_decoded('x')}, chr(10) || chr(9) || ' ')), lambda x: x <> ''), ' ') AS text
    FROM pages
""")
def html_visible_text(t: Tables) -> DataFrame:
    return t.spread("pages").select("page_id", H.visible_text(F.col("html")).alias("text"))


@query(f"""
    SELECT page_id,
           trim({_decoded("regexp_extract(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '<h1>(.*?)</h1>', 1)")}) AS heading,
           {_decoded("regexp_extract(regexp_extract(html, '(?s)<nav>(.*)</nav>', 1), '<li><a[^>]*>(.*?)</a>', 1)")} AS first_item
    FROM pages
""")
def html_nested_extract(t: Tables) -> DataFrame:
    article, nav = H.first(_html(), css("article")), H.first(_html(), css("nav"))
    return _pages(t).select(
        "page_id",
        H.stripped_text(H.first(article, css("h1"))).alias("heading"),
        H.stripped_text(H.first(H.first(nav, css("ul")), css("li"))).alias("first_item"),
    )


@query(f"""
    WITH parts AS (
        SELECT page_id, string_split(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '<p>')[2:] AS p FROM pages
    ),
    texts AS (
        SELECT page_id, list_transform(p, lambda x, i: CASE WHEN contains(x, '</p>') THEN split_part(x, '</p>', 1)
                                                            ELSE array_to_string(p[i:], '') END) AS raw FROM parts
    ),
    clean AS (
        SELECT page_id, list_transform(raw, lambda x: trim({_decoded("regexp_replace(x, '<[^>]*>', '', 'g')")})) AS t FROM texts
    )
    SELECT page_id, CAST(len(t) AS BIGINT) AS n, CAST(list_sum(list_transform(t, lambda x: length(x))) AS BIGINT) AS n_chars,
           md5(array_to_string(t, chr(10))) AS digest
    FROM clean
""")
def html_paragraph_list(t: Tables) -> DataFrame:
    """All paragraphs of the article. One that is left open holds those behind it."""
    texts = H.texts(H.first(_html(), css("article")), css("p"))
    listed = _pages(t).select("page_id", texts.alias("t"))
    joined = F.array_join("t", "\n")
    return listed.select(
        "page_id",
        F.size("t").cast("bigint").alias("n"),
        (F.length(joined) - F.size("t") + 1).cast("bigint").alias("n_chars"),
        F.md5(joined.cast("binary")).alias("digest"),
    )


_NAV_SQL = f"""
    WITH nav AS (SELECT page_id, regexp_extract(html, '(?s)<nav>(.*)</nav>', 1) AS nav FROM pages),
    links AS (
        SELECT page_id, list_transform(regexp_extract_all(nav, 'href="([^"]*)"', 1), lambda x: {_decoded('x')}) AS urls,
               list_transform(regexp_extract_all(nav, '<a[^>]*>(.*?)</a>', 1), lambda x: {_decoded('x')}) AS names
        FROM nav
    )
"""


def _nav_links(t: Tables) -> DataFrame:
    nav = H.first(_html(), css("nav"))
    return _pages(t).select("page_id", H.link_structs(nav, "name", "url", css("li")).alias("links"))


@query(_NAV_SQL + "SELECT page_id, unnest(range(len(urls))) AS pos, unnest(urls) AS url FROM links")
def html_nav_links(t: Tables) -> DataFrame:
    links = _nav_links(t).select("page_id", F.posexplode_outer("links.url").alias("pos", "url"))
    return links.withColumn("pos", F.col("pos").cast("bigint"))


@query(_NAV_SQL + """
    SELECT page_id, array_to_string(list_transform(range(1, len(urls) + 1), lambda i: names[i] || ' -> ' || urls[i]), ' | ') AS links
    FROM links
""")
def html_link_structs(t: Tables) -> DataFrame:
    shown = F.transform("links", lambda x: F.concat(x["name"], F.lit(" -> "), x["url"]))
    return _nav_links(t).select("page_id", F.array_join(shown, " | ").alias("links"))


@query(_NAV_SQL + "SELECT page_id, coalesce(urls[2], 'None') AS second, coalesce(urls[6], 'None') AS sixth FROM links")
def nth_or_default(t: Tables) -> DataFrame:
    return _nav_links(t).select(
        "page_id",
        N.nth_or_default(F.col("links.url"), 1, "None").alias("second"),
        N.nth_or_default(F.col("links.url"), 5, "None").alias("sixth"),
    )


@query(_NAV_SQL + """
    SELECT page_id, array_to_string(urls[1:2], ' ') AS related,
           CASE WHEN len(urls) >= 6 THEN array_to_string(urls[5:6], ' ') END AS last_two
    FROM links
""")
def first_two_links(t: Tables) -> DataFrame:
    urls = F.col("links.url")
    return _nav_links(t).select(
        "page_id",
        F.array_join(N.first_two(urls), " ").alias("related"),
        F.array_join(N.first_two(F.slice(urls, 5, 2)), " ").alias("last_two"),
    )


@query(f"""
    WITH nav AS (SELECT *, regexp_extract(html, '(?s)<nav>(.*)</nav>', 1) AS nav,
                        regexp_extract(html, '(?s)<article>(.*)</article>', 1) AS article FROM pages)
    SELECT page_id, url, regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang,
           trim({_decoded("regexp_extract(html, '<title>(.*?)</title>', 1)")}) AS title,
           trim({_decoded("regexp_extract(article, '<h1>(.*?)</h1>', 1)")}) AS heading,
           {_decoded("regexp_extract(html, '(?s)<div class=.ad.>(.*?)</div>', 1)")} AS ad,
           {_decoded("regexp_extract(html, '(?s)<footer>(.*?)</footer>', 1)")} AS footer,
           array_to_string(list_transform(regexp_extract_all(nav, '<a[^>]*>(.*?)</a>', 1), lambda x: {_decoded('x')}), '|') AS menu,
           CAST(len(regexp_extract_all(article, '<p>')) AS BIGINT) AS n_paragraphs,
           trim({_decoded("regexp_replace(article, '<[^>]*>', '', 'g')")}) AS body
    FROM nav
""")
def page_record_extract(t: Tables) -> DataFrame:
    """All fields of a page in one row."""
    article, nav = H.first(_html(), css("article")), H.first(_html(), css("nav"))
    return _pages(t).select(
        "page_id",
        "url",
        H.first_attribute(_html(), css("html"), "lang").alias("lang"),
        H.stripped_text(H.first(_html(), css("title"))).alias("title"),
        H.stripped_text(H.first(article, css("h1"))).alias("heading"),
        H.stripped_text(H.first(_html(), css("div", cls="ad"))).alias("ad"),
        H.stripped_text(H.first(_html(), css("footer"))).alias("footer"),
        F.array_join(H.texts(nav, css("a")), "|").alias("menu"),
        H.count(article, css("p")).cast("bigint").alias("n_paragraphs"),
        H.stripped_text(article).alias("body"),
    )


@query(R.LINES_SQL + """
    SELECT doc_id, CAST(len(lines) AS BIGINT) AS n,
           array_to_string(list_transform(lines, lambda l: trim(split_part(l, ' ', 1) || l) || '~' || trim(l)), '|') AS items,
           array_to_string(list_transform(lines, lambda l: trim(l)), '|') AS boxes,
           array_to_string(list_transform(lines, lambda l: '~' || trim(split_part(l, ' ', 1))), '|') AS cells
    FROM d
""")
def html_odd_markup(t: Tables) -> DataFrame:
    """Items left open, elements that close themselves, end tags that close nothing or too much."""
    made = _made(t, R.odd_markup())

    def shown(e: Column, sel: H.Selector) -> Column:
        return F.array_join(H.texts(e, sel), "~")

    lists = lambda sel, inner: F.array_join(H.every(_html(), sel, lambda e: shown(e, inner)), "|")
    return made.select(
        "doc_id",
        H.count(_html(), css("ul")).cast("bigint").alias("n"),
        lists(css("ul"), css("li")).alias("items"),
        F.array_join(H.texts(_html(), css("div", cls="x")), "|").alias("boxes"),
        lists(css("tr"), css("td")).alias("cells"),
    )


@query(R.LINES_SQL + """
    SELECT doc_id,
           array_to_string(list_transform(lines, lambda l: split_part(l, ' ', 1) || '~' || l), '|') AS behind,
           array_to_string(list_transform(lines, lambda l: l || '~' || split_part(l, ' ', 1)), '|') AS in_front
    FROM d
""")
def html_deep_neighbours(t: Tables) -> DataFrame:
    """What stands behind a heading and in front of a row, up to twelve levels down and with deeper decoys."""

    def behind(m: H.Match) -> Column:
        return F.concat(H.node_text(H.element(m)), F.lit("~"), H.node_text(H.next_element(m, css("p", cls="t"))))

    def in_front(m: H.Match) -> Column:
        return F.concat(H.node_text(H.element(m)), F.lit("~"), H.node_text(H.previous_sibling(m, "div")))

    return _made(t, R.deep_markup()).select(
        "doc_id",
        F.array_join(H.each_match(_html(), css("h3"), behind), "|").alias("behind"),
        F.array_join(H.each_match(_html(), css("div", cls="row"), in_front), "|").alias("in_front"),
    )


@query(R.LINES_SQL + """
    , cells AS (SELECT doc_id, list_transform(lines, lambda l: string_split(l, ', ')) AS rows FROM d),
    kept AS (SELECT doc_id, list_filter(rows, lambda r: len(r) = 2) AS two, list_filter(rows, lambda r: len(r) = 3) AS three FROM cells)
    SELECT doc_id, CAST(len(two) AS BIGINT) AS n_two, CAST(len(three) AS BIGINT) AS n_three,
           array_to_string(list_transform(two, lambda r: trim(r[1]) || ' x ' || trim(r[2])), '|') AS two,
           array_to_string(list_transform(three, lambda r: trim(r[1]) || ' x ' || trim(r[2]) || ' x ' || trim(r[3])), '|') AS three
    FROM kept
""")
def rows_by_arity(t: Tables) -> DataFrame:
    """A table with one row per line, a cell per comma; rows of two and of three cells are kept."""
    table = H.first(_html(), css("table", cls="table-styled"))
    tables = _made(t, R.table(R.lines()))
    kept = tables.select(
        "doc_id",
        H.named_rows(table, ["Resource", "Quantity"]).alias("two"),
        H.named_rows(table, ["Instrumentation", "Doubling", "Quantity"]).alias("three"),
    )
    return kept.select(
        "doc_id",
        F.size("two").cast("bigint").alias("n_two"),
        F.size("three").cast("bigint").alias("n_three"),
        F.array_join(F.transform("two", lambda r: F.concat_ws(" x ", r["Resource"], r["Quantity"])), "|").alias("two"),
        F.array_join(
            F.transform("three", lambda r: F.concat_ws(" x ", r["Instrumentation"], r["Doubling"], r["Quantity"])), "|"
        ).alias("three"),
    )


@query(R.LINES_SQL + """
    SELECT doc_id, CAST(len(lines) AS BIGINT) AS n,
           array_to_string(list_transform(lines, lambda l: split_part(l, ' ', 1) || ' ' ||
               CASE WHEN length(l) % 5 = 0 THEN '~' ELSE CAST(length(l) AS VARCHAR) END || ' ' ||
               CASE length(l) % 4 WHEN 0 THEN 'Male' WHEN 1 THEN 'FEMALE' WHEN 2 THEN 'any' ELSE '~' END || ' ' || l), '|') AS characters
    FROM d
""")
def collect_children(t: Tables) -> DataFrame:
    """Characters in page order; the name stands in front of its row."""
    cast = _made(t, R.character_rows())
    found = cast.select("doc_id", site_a.characters(_html()).alias("c"))
    return found.select("doc_id", F.size("c").cast("bigint").alias("n"), _shown_characters("c").alias("characters"))


def _shown_characters(name: str) -> Column:
    parts = ["Name", "Age", "Gender", "Description"]
    return F.array_join(
        F.transform(name, lambda c: F.concat_ws(" ", *[F.coalesce(c[p], F.lit("~")) for p in parts])), "|"
    )


def shown_map(name: str) -> Column:
    """Entries by key as text: ``key=a,b;key=c``."""
    entries = F.array_sort(F.map_entries(name))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], ","))), ";")


_GROUPS_SQL = R.LINES_SQL + """
    , groups AS (SELECT doc_id, list_transform(lines, lambda l: {'k': %s, 'v': replace(l, ', ', ',')}) AS g FROM d),
    last AS (SELECT doc_id, list_filter(g, lambda e, i: NOT list_contains(list_transform(g[i + 1:], lambda x: x.k), e.k)) AS g FROM groups)
    SELECT doc_id, CAST(len(g) AS BIGINT) AS n,
           array_to_string(list_transform(list_sort(g), lambda e: e.k || '=' || e.v), ';') AS %s
    FROM last
"""


@query(_GROUPS_SQL % ("split_part(l, ' ', 1)", "awards"))
def group_to_map(t: Tables) -> DataFrame:
    """Items under the label of their group."""
    made = _made(t, R.award_groups())
    found = made.select("doc_id", site_a.awards(_html()).alias("m"))
    return found.select("doc_id", F.size("m").cast("bigint").alias("n"), shown_map("m").alias("awards"))


@query(_GROUPS_SQL % ("'Role ' || (length(l) % 5)", "billing"))
def group_to_map_last_wins(t: Tables) -> DataFrame:
    """Names listed behind a label that comes again and again; its last list stays."""
    made = _made(t, R.credit_lists())
    found = made.select("doc_id", site_a.billing(_html()).alias("m"))
    return found.select("doc_id", F.size("m").cast("bigint").alias("n"), shown_map("m").alias("billing"))


@query(R.LINES_SQL + """
    , kinds AS (
        SELECT doc_id, '-' || unnest(lines) AS line, generate_subscripts(lines, 1) AS i,
               CASE unnest(list_transform(lines, lambda l: length(l) % 7)) WHEN 0 THEN 's' WHEN 1 THEN 'c' WHEN 2 THEN 'p' END AS head
        FROM d
    ),
    filled AS (
        SELECT doc_id, line, i, head, last_value(head IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i) AS section FROM kinds
    )
    SELECT doc_id,
           coalesce(string_agg(line, '|' ORDER BY i) FILTER (WHERE head IS NULL AND section = 's'), '') AS sets,
           coalesce(string_agg(line, '|' ORDER BY i) FILTER (WHERE head IS NULL AND section = 'c'), '') AS costumes,
           coalesce(string_agg(line, '|' ORDER BY i) FILTER (WHERE head IS NULL AND section = 'p'), '') AS props
    FROM filled GROUP BY doc_id
""")
def section_fill(t: Tables) -> DataFrame:
    """Lines under the header line that came last; those in front of the first are dropped."""
    made = _made(t, R.community())
    found = made.select("doc_id", site_b.community(_html()).alias("c"))
    return found.select("doc_id", *[F.array_join(f"c.{n}", "|").alias(n) for n in ("sets", "costumes", "props")])


@query(R.LINES_SQL + """
    , cells AS (SELECT doc_id, n_chars, list_transform(lines, lambda l: string_split(l, ', ')) AS rows FROM d),
    shown AS (
        SELECT doc_id, n_chars,
               array_to_string(list_transform(list_filter(rows, lambda r: len(r) = 2), lambda r: trim(r[1]) || ' x ' || trim(r[2])), '|') AS two,
               array_to_string(list_transform(list_filter(rows, lambda r: len(r) = 3),
                                              lambda r: trim(r[1]) || ' x ' || trim(r[2]) || ' x ' || trim(r[3])), '|') AS three
        FROM cells
    )
    SELECT doc_id, two AS materials, three AS standard, CASE WHEN n_chars % 2 = 0 THEN three END AS alternate FROM shown
""")
def heading_tables(t: Tables) -> DataFrame:
    """The table behind the title and those behind the orchestration headings."""
    made = _made(t, R.materials_page())
    found = made.select("doc_id", site_a.orchestration(_html()).alias("o"))
    return found.select("doc_id", *[c.alias(n) for n, c in shown_orchestration("o").items()])


def shown_orchestration(name: str) -> dict[str, Column]:
    def joined(rows: Column, parts: list[str]) -> Column:
        return F.array_join(F.transform(rows, lambda r: F.concat_ws(" x ", *[r[p] for p in parts])), "|")

    three = ["Instrumentation", "Doubling", "Quantity"]
    tables = F.col(f"{name}.Orchestration")
    return {
        "materials": joined(F.col(f"{name}.Materials"), ["Resource", "Quantity"]),
        "standard": joined(F.try_element_at(tables, F.lit("STANDARD ORCHESTRATION")), three),
        "alternate": joined(F.try_element_at(tables, F.lit("ALTERNATE ORCHESTRATION")), three),
    }
