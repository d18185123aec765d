"""Whole catalogues: extraction, joining, cleaning and ingest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions.html import css
from ..operators import captures, site_a, site_b, site_c
from ..operators.clean import clean_catalog as clean
from ..sources import commits
from ..sources import schemas as S
from ..sources import tables as tables_io
from ..sources.tables import Tables
from ..streaming.ingest import Ingest
from . import rendered as R
from .collect import Store, clean_job, collect_a, collect_b, collect_c
from .page_queries import _decoded, _shown_characters, shown_map, shown_orchestration
from .registry import QUERIES, query

_LABELS = ["Music by", "Book and Lyrics by", "Directed by"]


def raw_catalog(t: Tables) -> DataFrame:
    """Raw catalogue A in its text forms, one show per document, by projection alone."""
    label = F.get(F.array(*[F.lit(x) for x in _LABELS]), (F.col("n_chars") % 3).cast("int"))
    names = [F.concat(F.lit("'"), c, F.lit("'")) for c in (F.col("lang"), F.col("source"))]
    billing = F.when(
        F.col("n_chars") % 10 > 0, F.concat(F.lit("{'"), label, F.lit("': ["), names[0], F.lit(", "), names[1], F.lit("]}"))
    )
    cast_size = F.concat("source", F.lit(" "), F.when(F.col("n_chars") % 4 > 0, F.concat(F.lit("("), "lang", F.lit(" roles)"))).otherwise("cast"))
    number = F.col("doc_id").cast("string")
    tags = F.concat(F.lit("['"), F.col("lang"), F.lit("', '"), F.col("source"), F.lit("']"))
    nothing = F.lit(None).cast("string")
    given = {
        "show_title": F.get(R.lines(), F.lit(0)),
        "logo_url": nothing,
        "show_url": F.concat(F.lit("/shows/"), number),
        "brief_synopsis": nothing,
        "dance_requirement": nothing,
        "number_of_roles": F.size(R.lines()).cast("string"),
        "rating_of_show": F.col("lang"),
        "number_of_acts": (F.col("n_chars") % 3).cast("string"),
        "cast_size": cast_size,
        "cast_type": F.col("source"),
        "characters": F.when(F.col("n_chars") % 9 > 0, R.characters_json()),
        "songs": nothing,
        "billing": billing,
        "tags": tags,
        "full_synopsis": F.col("text"),
    }
    return t.spread("documents").select(*[given.get(n, nothing).alias(n) for n in site_a.COLUMNS])


def _joined(c: Column) -> Column:
    return F.array_join(c, ", ")


_EMPTY = [
    "logo_url", "brief_synopsis", "dance_requirement", "songs", "similar_shows", "orchestration_resources",
    "video_warning", "credit_requirements", "awards", "version", "available_resource", "synopsis_brief",
    "show_availability",
]
_PAIR = "lang || ', ' || source"


@query(R.LINES_SQL + f"""
    SELECT lines[1] AS show_title, '/shows/' || doc_id AS show_url, CAST(len(lines) AS VARCHAR) AS number_of_roles,
           lang AS rating_of_show, CAST(n_chars % 3 AS VARCHAR) AS number_of_acts,
           source || ' ' || CASE WHEN n_chars % 4 > 0 THEN '(' || lang || ' roles)' ELSE 'cast' END AS cast_size,
           source AS cast_type, text AS full_synopsis, '[''' || lang || ''', ''' || source || ''']' AS tags,
           CASE WHEN n_chars % 10 > 0 THEN '{{''' || CASE n_chars % 3 WHEN 0 THEN 'Music by' WHEN 1 THEN 'Book and Lyrics by'
               ELSE 'Directed by' END || ''': [''' || lang || ''', ''' || source || ''']}}' END AS billing,
           CASE WHEN n_chars % 9 > 0 THEN '[' || array_to_string(list_transform(lines, lambda l: to_json({{
               'Name': split_part(l, ' ', 1), 'Age': CAST(length(l) AS VARCHAR),
               'Gender': CASE length(l) % 4 WHEN 0 THEN 'Male' WHEN 1 THEN 'FEMALE' WHEN 2 THEN 'any' END,
               'Description': l}})), ',') || ']' END AS characters,
           {', '.join(f'CAST(NULL AS VARCHAR) AS {n}' for n in _EMPTY)},
           CASE WHEN n_chars % 4 > 0 THEN lang || ' roles' END AS cast_size_detail, source AS cast_size_category,
           CASE WHEN n_chars % 10 > 0 AND n_chars % 3 = 0 THEN {_PAIR} END AS music_by,
           CASE WHEN n_chars % 10 > 0 AND n_chars % 3 = 1 THEN {_PAIR} END AS lyrics_by,
           CASE WHEN n_chars % 10 > 0 AND n_chars % 3 = 1 THEN {_PAIR} END AS book_by,
           CASE WHEN n_chars % 10 > 0 AND n_chars % 3 = 2 THEN {_PAIR} END AS other_authors,
           CAST(CASE WHEN n_chars % 9 > 0 THEN len(list_filter(lines, lambda l: length(l) % 4 = 0)) ELSE 0 END AS INTEGER) AS male_character_count,
           CAST(CASE WHEN n_chars % 9 > 0 THEN len(list_filter(lines, lambda l: length(l) % 4 = 1)) ELSE 0 END AS INTEGER) AS female_character_count,
           CAST(CASE WHEN n_chars % 9 > 0 THEN len(list_filter(lines, lambda l: length(l) % 4 = 2)) ELSE 0 END AS INTEGER) AS other_character_count
    FROM d
""")
def clean_catalog(t: Tables) -> DataFrame:
    """All raw columns and the nine derived ones; name lists joined for comparison."""
    return _shown_clean(clean(raw_catalog(t)))


def _shown_clean(cleaned: DataFrame) -> DataFrame:
    lists = ["music_by", "lyrics_by", "book_by", "other_authors"]
    return cleaned.withColumns({n: _joined(F.col(n)) for n in lists})


def _pages(t: Tables, url: Column, html: Column) -> DataFrame:
    return R.pages_of(t.spread("documents"), url, html)


def _address(base: str) -> Column:
    return F.concat(F.lit(base), F.col("doc_id").cast("string"))


def raw_a(t: Tables) -> DataFrame:
    """Catalogue A out of show, print and materials pages."""
    shows = t.spread("documents").select(_address("https://shows.example.com/").alias("show_url"))
    return site_a.records(
        shows,
        _pages(t, _address("https://shows.example.com/"), R.show_page_a()),
        _pages(t, _address("https://www.mtishows.com/print/"), R.print_page_a()),
        _pages(t, _address("https://www.mtishows.com/materials/"), R.materials_page()),
    )


def _shown(name: str, *parts: str) -> Column:
    """Array of structs as text."""
    return F.array_join(
        F.transform(name, lambda x: F.concat_ws("~", *[F.coalesce(x[p].cast("string"), F.lit("-")) for p in parts])), "|"
    )


_FLAT = "trim(replace(text, chr(10), ' '))"
_GROUPED = """list_filter({g}, lambda e, i: NOT list_contains(list_transform({g}[i + 1:], lambda x: x.k), e.k))"""


@query(R.LINES_SQL + f"""
    , g AS (
        SELECT *, list_transform(lines, lambda l: {{'k': split_part(l, ' ', 1), 'v': replace(l, ', ', ',')}}) AS ga,
               list_transform(lines, lambda l: {{'k': 'Role ' || (length(l) % 5), 'v': replace(l, ', ', ',')}}) AS gb,
               list_transform(lines, lambda l: string_split(l, ', ')) AS rows
        FROM d
    ),
    h AS (
        SELECT *, {_GROUPED.format(g='ga')} AS la, {_GROUPED.format(g='gb')} AS lb,
               array_to_string(list_transform(list_filter(rows, lambda r: len(r) = 2), lambda r: trim(r[1]) || ' x ' || trim(r[2])), '|') AS two,
               array_to_string(list_transform(list_filter(rows, lambda r: len(r) = 3),
                                              lambda r: trim(r[1]) || ' x ' || trim(r[2]) || ' x ' || trim(r[3])), '|') AS three
        FROM g
    )
    SELECT 'https://shows.example.com/' || doc_id AS show_url, 'Show ' || doc_id AS show_title,
           '/logo/' || doc_id || '.png' AS logo_url, lines[1] AS brief_synopsis, lang AS dance_requirement,
           len(lines) || ' roles' AS number_of_roles, lang AS rating_of_show, CAST(n_chars % 3 AS VARCHAR) AS number_of_acts,
           lang || ' (' || source || ')' AS cast_size, CASE WHEN n_chars % 2 = 0 THEN source END AS cast_type,
           array_to_string(list_transform(lines, lambda l: split_part(l, ' ', 1) || ' ' ||
               CASE WHEN length(l) % 5 = 0 THEN '~' ELSE CAST(length(l) AS VARCHAR) END || ' ' ||
               CASE length(l) % 4 WHEN 0 THEN 'Male' WHEN 1 THEN 'FEMALE' WHEN 2 THEN 'any' ELSE '~' END || ' ' || l), '|') AS characters,
           array_to_string(list_transform(lines, lambda l, i: ' ' || split_part(l, ' ', 1) || '~/a/' || doc_id || '/' || (i - 1) || '.mp3?x=1&y'), '|') AS songs,
           CASE WHEN n_chars % 5 > 0 THEN lang || '|' || source END AS tags,
           'Show one~www.mtishows.com/shows/one-' || doc_id || '|Show two~www.mtishows.com/shows/two-' || doc_id AS similar_shows,
           CASE WHEN n_chars % 3 > 0 THEN two END AS materials, CASE WHEN n_chars % 3 > 0 THEN three END AS standard,
           CASE WHEN n_chars % 3 > 0 AND n_chars % 2 = 0 THEN three END AS alternate,
           trim(replace(text, chr(10), '')) AS video_warning, trim(replace(text, chr(10), ' ')) || ' ' || lang AS credit_requirements,
           array_to_string(list_transform(list_sort(la), lambda e: e.k || '=' || e.v), ';') AS awards,
           array_to_string(list_transform(list_sort(lb), lambda e: e.k || '=' || e.v), ';') AS billing,
           'Version ' || lang AS version, text AS full_synopsis, source AS show_availability,
           CASE WHEN n_chars % 2 = 0 THEN lines[1] END AS synopsis_brief,
           array_to_string(list_transform(lines, lambda l, i: split_part(l, ' ', 1) || '~/r/' || (i - 1) || '~' || l || '~Logo~/i.png'), '|') AS available_resource
    FROM h
""")
def site_a_records(t: Tables) -> DataFrame:
    """The 24 columns of raw catalogue A; nested ones shown as text, the tables as three columns."""
    raw = raw_a(t)
    shown = {
        "characters": _shown_characters("characters"),
        "songs": _shown("songs", "song_title", "song_url"),
        "billing": shown_map("billing"),
        "awards": shown_map("awards"),
        "tags": F.array_join("tags", "|"),
        "similar_shows": _shown("similar_shows", "show_name", "show_url"),
        "available_resource": _shown(
            "available_resource", "resource_name", "resource_link", "resource_description", "resource_type", "resource_logo"
        ),
        **shown_orchestration("orchestration_resources"),
    }
    return raw.withColumns(shown).drop("orchestration_resources")


@query(R.LINES_SQL + """
    , kinds AS (
        SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i,
               CASE unnest(list_transform(lines, lambda l: length(l) % 7)) WHEN 0 THEN 's' WHEN 1 THEN 'c' WHEN 2 THEN 'p' END AS head
        FROM d
    ),
    filled AS (SELECT *, last_value(head IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i) AS section FROM kinds),
    sections AS (
        SELECT doc_id,
               coalesce(string_agg('-' || line, '|' ORDER BY i) FILTER (WHERE head IS NULL AND section = 's'), '') AS sets,
               coalesce(string_agg('-' || line, '|' ORDER BY i) FILTER (WHERE head IS NULL AND section = 'c'), '') AS costumes,
               coalesce(string_agg('-' || line, '|' ORDER BY i) FILTER (WHERE head IS NULL AND section = 'p'), '') AS props
        FROM filled GROUP BY doc_id
    )
    SELECT 'Show ' || doc_id || ' ' AS show_title, lang AS show_type, 'https://shows.example.com/' || doc_id || '/' AS show_url,
           source || '|' || lang AS book_and_music_by, '/logo/' || doc_id || '.png' AS logo_url,
           CASE WHEN regexp_matches(lines[1], '[0-9]') THEN trim(lines[1]) END AS casting_info,
           array_to_string(lines, '|') AS cast_list, CASE WHEN n_chars % 2 = 0 THEN '/licence/' || doc_id END AS apply_for_license,
           text AS show_credits,
           CASE WHEN n_chars % 2 = 0 THEN array_to_string(list_transform(lines, lambda l: ' ' || l), '|') END AS orchestral_information_list,
           array_to_string(list_transform(lines, lambda l: 'start ' || length(l) || ' to end ' || length(l) || '~' || l), '|') AS upcoming_productions,
           array_to_string(list_transform(lines, lambda l: split_part(l, ' ', 1) || '~/s/' || length(l) || '.mp3'), '|') AS songs_list,
           CASE WHEN n_chars % 3 > 0 THEN '/x/' || doc_id || '|/y/' || doc_id END AS related_shows_urls,
           array_to_string(list_transform(lines, lambda l: split_part(l, ' ', 1) || '~/p/' || length(l)), '|') AS resources,
           array_to_string(list_transform(lines, lambda l: ' ' || l), '|') AS synopsis,
           sets, costumes, props
    FROM d JOIN sections USING (doc_id)
""")
def site_b_records(t: Tables) -> DataFrame:
    """The 16 columns of raw catalogue B; nested ones shown as text, the community as three columns."""
    url = F.concat(_address("https://shows.example.com/"), F.lit("/"))
    shows = t.spread("documents").select(url.alias("url"), F.col("lang").alias("filter"))
    upcoming = F.concat(_address("https://shows.example.com/"), F.lit("/upcoming/"))
    raw = site_b.records(shows, _pages(t, url, R.show_page_b()), _pages(t, upcoming, R.upcoming_page_b()))
    lists = ["book_and_music_by", "cast_list", "orchestral_information_list", "related_shows_urls", "synopsis"]
    shown = {
        **{n: F.array_join(n, "|") for n in lists},
        "upcoming_productions": _shown("upcoming_productions", "production_date", "location"),
        "songs_list": _shown("songs_list", "song_name", "song_url"),
        "resources": _shown("resources", "resource_name", "resource_url"),
        **{n: F.array_join(f"community.{n}", "|") for n in ("sets", "costumes", "props")},
    }
    return raw.withColumns(shown).drop("community")


_PRODUCTS_SQL = R.LINES_SQL + """
    , p AS (SELECT doc_id, lang, source, unnest(lines) AS l, generate_subscripts(lines, 1) AS i FROM d),
    products AS (
        SELECT doc_id * 1000000 + i AS sid, l AS show_title,
               'https://www.concordtheatricals.com/p/' || (doc_id * 1000000 + i) || '/show-' || (doc_id * 1000000 + i) AS show_url,
               length(l) || ' roles' AS cast_size, lang AS show_type, CASE WHEN length(l) % 3 = 0 THEN '' ELSE source END AS genre,
               (doc_id * 1000000 + i) || '~' || split_part(l, ' ', 1) || ' ' || source AS authors,
               replace(l, ', ', '|') AS themes,
               (doc_id * 1000000 + i) || '~poster~' || length(l) || '~/img/' || (doc_id * 1000000 + i) || '~-' AS image_urls,
               '<p>' || replace(replace(replace(replace(l, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') || '</p>' AS short_description
        FROM p
    )
"""
_DETAILS_SQL = """
    details AS (
        SELECT doc_id AS show_id, n_chars || ' minutes' AS duration, CASE WHEN doc_id % 3 > 0 THEN lang END AS target_audience,
               CASE WHEN doc_id % 5 > 0 THEN 'First |' || source || ' |Last' ELSE '' END AS awards,
               'https://license.concordtheatricals.com/performance-license/license?productId=' || doc_id AS apply_for_license,
               CASE WHEN doc_id % 4 > 0 THEN '$' || n_chars || ' per show' END AS minimum_license_fee,
               trim(lines[1]) AS brief_synopsis,
               array_to_string(list_filter(list_transform(lines, lambda l: trim(l)), lambda l: l <> ''), ' ') AS summary,
               array_to_string(list_filter(list_transform(lines, lambda l: trim(l)), lambda l: l <> ''), ' ') AS history,
               array_to_string(list_transform(lines, lambda l: split_part(l, ' ', 1)), '|') AS performance_groups
        FROM d
    )
"""


def _products(t: Tables) -> DataFrame:
    return site_c.products(t.spread("documents").select(R.listing_payload().alias("payload")))


def _details(t: Tables) -> DataFrame:
    return site_c.details(t.spread("documents").select(R.detail_payload().alias("payload")))


def _shown_products(df: DataFrame) -> DataFrame:
    images = ["image_id", "image_type", "image_height", "image_url", "image_credit"]
    return df.withColumns({
        "authors": _shown("authors", "author_id", "fullname"),
        "themes": F.array_join("themes", "|"),
        "image_urls": _shown("image_urls", *images),
    })


def _shown_details(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "awards": F.array_join(F.col("awards")["awards"], "|"),
        "performance_groups": F.array_join("performance_groups", "|"),
    })


@query(_PRODUCTS_SQL + "SELECT * FROM products")
def listing_products(t: Tables) -> DataFrame:
    """The ten listing columns of catalogue C."""
    return _shown_products(_products(t))


@query(R.LINES_SQL + ", " + _DETAILS_SQL + "SELECT * FROM details")
def product_details(t: Tables) -> DataFrame:
    """The ten detail columns of catalogue C."""
    return _shown_details(_details(t))


@query(_PRODUCTS_SQL + ", " + _DETAILS_SQL + """
    SELECT sid // 1000000 AS sid, show_id, show_title, show_type, genre, duration, minimum_license_fee, apply_for_license
    FROM products JOIN details ON sid // 1000000 = show_id
""")
def product_rows(t: Tables) -> DataFrame:
    """Listing and details side by side, listed products counted under their document's id."""
    listed = _products(t).withColumn("sid", F.expr("sid div 1000000"))
    both = site_c.listing_with_details(listed, _details(t))
    return both.select(
        "sid", "show_id", "show_title", "show_type", "genre", "duration", "minimum_license_fee", "apply_for_license"
    )


@query(R.LINES_SQL + """
    SELECT unnest(list_transform(lines, lambda l, i: CASE WHEN length(l) % 2 > 0 THEN '/shows/' || doc_id || '/' || i END)) AS show_url
    FROM d
    UNION ALL SELECT '/last' FROM d
""")
def alphabetical_listing(t: Tables) -> DataFrame:
    """Keys of catalogue A; items without a link are null keys."""
    return captures.listing_a(_pages(t, _address("/all/"), R.listing_page_a()))


@query(R.LINES_SQL + """
    SELECT '/show/' || (length(l) % 5) || '/' AS url, lang AS filter
    FROM (SELECT lang, unnest(lines) AS l FROM d) WHERE length(l) % 3 > 0
""")
def category_listing(t: Tables) -> DataFrame:
    """Keys of catalogue B under the category in the address of the listing; repeated ones stay."""
    address = F.concat(F.lit("https://b.example.com/show-type/"), F.col("lang"), F.lit("/?lang=en"))
    return captures.listing_b(_pages(t, address, R.listing_page_b()), captures.category_of(F.col("url")))


@query(R.LINES_SQL + ", " + _DETAILS_SQL + """
    SELECT show_id AS sid, show_id, text AS show_title, lang AS show_type, duration, apply_for_license
    FROM details JOIN documents ON doc_id = show_id
""")
def collected_products(t: Tables) -> DataFrame:
    """Catalogue C collected twice, first one language only, then all: every product is stored once."""
    store = Store(t.spark, tables_io.work_folder(t.spark, "collect"))
    documents = t.spread("documents")
    detail = documents.select(F.col("doc_id").alias("n"), R.detail_payload().alias("payload"))
    listings = (documents.filter(F.col("lang") == "en"), documents)
    for run_id, listed in enumerate(listings, start=1):
        collect_c(store, listed.select(R.product_payload().alias("payload")), detail, run_id, "n")
    columns = "sid bigint, show_id bigint, show_title string, show_type string, duration string, apply_for_license string"
    return store.read("rows", columns).drop("run_id")


_URL = "https://shows.example.com/"


@query(f"""
    WITH s AS (SELECT *, '{_URL}' || doc_id AS show_url, 'Show ' || doc_id AS show_title FROM documents)
    SELECT show_url, 1 AS run_id, show_title, lang AS version, text AS full_synopsis, 'listed' AS status FROM s WHERE doc_id % 3 < 2
    UNION ALL SELECT show_url, 2, show_title, lang, text, CASE doc_id % 3 WHEN 0 THEN 'gone' ELSE 'listed' END FROM s WHERE doc_id % 3 <> 1
""")
def collected_shows_a(t: Tables) -> DataFrame:
    """Catalogue A collected three times. In the second run a third is gone and another third new; in the third nothing changed, also for the gone ones."""
    store = Store(t.spark, tables_io.work_folder(t.spark, "shows-a"))
    documents = t.spread("documents")
    shows, prints = _pages(t, _address(_URL), R.short_show_page_a()), _pages(t, _address(f"{S.SITE_A}/print/"), R.short_print_page_a())
    for run_id, listed in enumerate(("doc_id % 3 < 2", "doc_id % 3 > 0", "doc_id % 3 > 0"), start=1):
        listing = R.pages_of(documents.filter(listed), _address("/all/"), R.entry_page_a(_address(_URL)))
        wrote = collect_a(store, listing, shows, run_id, prints, prints)
        if wrote != (run_id < 3):
            raise ValueError(f"run {run_id} wrote {wrote}")
    rows = store.read("rows", "show_url string, show_title string, version string, full_synopsis string")
    return rows.join(store.read("log", S.LOG_A), ["show_url", "run_id"]).withColumn("run_id", F.col("run_id").cast("int"))


@query(f"""
    SELECT '{_URL}' || doc_id || '/' AS show_url, CASE doc_id % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS run_id,
           'Show ' || doc_id AS show_title, lang AS show_type, text AS show_credits
    FROM documents
    UNION ALL SELECT '{_URL}' || doc_id || '/', 1, 'Show ' || doc_id, lang, text FROM documents WHERE doc_id % 3 = 0
""")
def collected_shows_b(t: Tables) -> DataFrame:
    """Catalogue B collected over several runs, one of which fails behind its rows, and is then run twice.

    What left the listing of the second run is new again in the third. The failed run has done nothing, the repeated one doubles nothing.
    """
    store = Store(t.spark, tables_io.work_folder(t.spark, "shows-b"))
    documents, url = t.spread("documents"), F.concat(_address(_URL), F.lit("/"))
    shows = _pages(t, url, R.short_show_page_b())

    def listing(which: str) -> DataFrame:
        address = F.concat(F.lit("https://b.example.com/show-type/"), F.col("lang"), F.lit("/"))
        return R.pages_of(documents.filter(which), address, R.entry_page_b(url))

    collect_b(store, listing("doc_id % 3 < 2"), shows, 1)
    unfinished = store.start(2)
    unfinished.write("rows", store.read("rows", "show_url string, show_title string, show_type string, show_credits string").drop("run_id"))
    for run_id, which in ((2, "doc_id % 3 > 0"), (2, "doc_id % 3 > 0"), (3, "true")):
        collect_b(store, listing(which), shows, run_id)
    rows = store.read("rows", "show_url string, show_title string, show_type string, show_credits string")
    return rows.withColumn("run_id", F.col("run_id").cast("int"))


@query("""
    SELECT CASE WHEN doc_id % 6 = 3 THEN NULL ELSE doc_id END AS doc_id,
           CASE doc_id % 6 WHEN 1 THEN 'syntax' WHEN 2 THEN 'type' WHEN 3 THEN 'missing' ELSE 'type' END AS reason
    FROM documents WHERE doc_id % 6 IN (1, 2, 3, 4)
""")
def payload_quarantine(t: Tables) -> DataFrame:
    """Detail payloads some of which are cut off, missing, or hold a text or a list where a number or an object belongs."""
    payload, number = R.detail_payload(), F.col("doc_id") % 6
    broken = (
        F.when(number == 1, F.regexp_replace(payload, ".$", ""))
        .when(number == 2, F.regexp_replace(payload, '^\\{"Id":([0-9]+)', '{"Id":"no $1"'))
        .when(number == 3, F.lit(None).cast("string"))
        .when(number == 4, F.regexp_replace(payload, '"TitleAttributeDisplayModel":', '"TitleAttributeDisplayModel":[3],"Other":'))
        .otherwise(payload)
    )
    bad = site_c.quarantined(t.spread("documents").select(broken.alias("payload")), S.DETAIL_PAYLOAD)
    number = F.nullif(F.regexp_extract("payload", '^\\{"Id":"?(?:no )?([0-9]+)', 1), F.lit(""))
    return bad.select(number.cast("bigint").alias("doc_id"), "reason")


_CSV_COLUMNS = "doc_id bigint, text string, tags array<string>, sizes map<string,bigint>, made struct<by:string,of:bigint>"


@query("""
    SELECT doc_id, text, lang || '|' || source AS tags, n_chars AS size, CASE WHEN doc_id % 4 > 0 THEN source END AS made_by, false AS bad FROM documents
    UNION ALL SELECT NULL, lang, NULL, NULL, NULL, true FROM documents WHERE doc_id % 10 = 7
""")
def csv_round_trip(t: Tables) -> DataFrame:
    """Nested rows with line breaks and quotes to CSV and back to their types, among rows that do not fit."""
    folder = tables_io.work_folder(t.spark, "csv")
    made = F.when(F.col("doc_id") % 4 > 0, F.struct(F.col("source").alias("by"), F.col("n_chars").alias("of")))
    rows = t.spread("documents").select(
        "doc_id", "text", F.array("lang", "source").alias("tags"), F.create_map(F.lit("n,"), "n_chars").alias("sizes"), made.alias("made")
    )
    tables_io.write_csv(rows, folder)
    text = F.concat(F.lit("n"), F.col("doc_id").cast("string"))  # no number in the first field
    odd = t.documents.filter("doc_id % 10 = 7").select(text.alias("doc_id"), F.col("lang").alias("text"), *[F.lit(None).cast("string").alias(n) for n in ("tags", "sizes", "made")])
    tables_io.write_csv(odd, folder, "append")
    back = tables_io.read_nested_csv(t.spark, folder, _CSV_COLUMNS)
    return back.select(
        "doc_id", "text", F.array_join("tags", "|").alias("tags"), F.col("sizes")["n,"].alias("size"), F.col("made.by").alias("made_by"),
        F.col(tables_io.BAD).isNotNull().alias("bad"),
    )


@query("SELECT count(doc_id) AS doc_id, count(text) AS text, count(lang) AS lang, count(source) AS source, count(n_chars) AS n_chars FROM documents")
def column_counts(t: Tables) -> DataFrame:
    """Non-null values per column, from the footers of the files."""
    return tables_io.stored_counts(t.spark, t.path("documents"))


@query(QUERIES["clean_catalog"].sql)
def published_catalog(t: Tables) -> DataFrame:
    """The clean catalogue published, published anew, and a third time with rows missing, which changes nothing."""
    folder = tables_io.work_folder(t.spark, "published")
    raw_catalog(t).write.parquet(f"{folder}/raw")
    for _ in range(2):
        clean_job(t.spark, f"{folder}/raw", f"{folder}/clean")
    short = commits.read_published(t.spark, f"{folder}/clean").limit(1)
    try:
        commits.publish(short, f"{folder}/clean", expected=short.count() + 1)
    except ValueError:
        return _shown_clean(commits.read_published(t.spark, f"{folder}/clean"))
    raise ValueError("a table with too few rows was published")


def page_fields(pages: DataFrame) -> DataFrame:
    """What the ingest keeps of a page."""
    paired = pages.select("page_id", "url", "html", H.page(F.col("html")).alias("page"))
    return paired.select(
        "page_id",
        "url",
        H.stripped_text(H.first(F.col("page"), css("title"))).alias("title"),
        H.visible_text(F.col("html")).alias("text"),
    )


@query(f"""
    SELECT url, trim({_decoded("regexp_extract(html, '<title>(.*?)</title>', 1)")}) AS title,
           md5(array_to_string(list_filter(list_transform(
               string_split_regex(
                   regexp_replace(html, '(?is)<!--.*?-->|<!doctype[^>]*>|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', '<!---->', 'g'),
                   '</?[A-Za-z!?][^>]*>'),
               lambda x: trim({_decoded('x')}, chr(10) || chr(9) || ' ')), lambda x: x <> ''), ' ')) AS digest
    FROM pages QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id DESC) = 1
""")
def incremental_ingest(t: Tables) -> DataFrame:
    """The pages taken in as a stream, then all of them once more by a second stream: nothing doubles."""
    ingest = Ingest(t.spark, tables_io.work_folder(t.spark, "ingest"), page_fields)
    for stream in ("first", "again"):
        ingest.run(t.stream_path("pages"), stream)
    return ingest.result().select("url", "title", F.md5(F.col("text").cast("binary")).alias("digest"))


@query(f"""
    WITH captures AS (
        SELECT page_id * 3 AS n, url, html FROM pages WHERE page_id % 4 > 0
        UNION ALL SELECT page_id * 3 + 2, url, replace(html, '<title>', '<title>Later ') FROM pages WHERE page_id % 3 = 0
        UNION ALL SELECT page_id * 3 + 1, url, replace(html, '<title>', '<title>Again ') FROM pages WHERE page_id % 2 = 0
    )
    SELECT url, n AS page_id, trim({_decoded("regexp_extract(html, '<title>(.*?)</title>', 1)")}) AS title
    FROM captures QUALIFY row_number() OVER (PARTITION BY url ORDER BY n DESC) = 1
""")
def ingest_batches(t: Tables) -> DataFrame:
    """Overlapping deliveries of pages, the newest not the last, taken in file by file and then all at once.

    Both ways give the same rows, or the query fails.
    """
    folder = tables_io.work_folder(t.spark, "batches")
    later = lambda word: F.replace(F.col("html"), F.lit("<title>"), F.lit(f"<title>{word} "))
    number = F.col("page_id") * 3
    deliveries = [
        (number + 2, "page_id % 3 = 0", later("Later")), (number, "page_id % 4 > 0", F.col("html")), (number + 1, "page_id % 2 = 0", later("Again")),
    ]
    for n, which, html in deliveries:
        t.pages.filter(which).select(n.alias("page_id"), "url", html.alias("html")).write.mode("append").parquet(f"{folder}/landing")
    fields = lambda pages: captures.prepared(pages).select("page_id", "url", H.stripped_text(H.first(F.col("html"), css("title"))).alias("title"))
    results = []
    for name, files in (("one", 1), ("all", None)):
        ingest = Ingest(t.spark, f"{folder}/{name}", fields)
        for stream in ("first", "again"):
            ingest.run(f"{folder}/landing", stream, files)
        results.append(ingest.result().select("url", "page_id", "title"))
    if not results[0].exceptAll(results[1]).isEmpty():
        raise ValueError("the result depends on the batches")
    return results[0]
