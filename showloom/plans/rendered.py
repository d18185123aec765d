"""Raw inputs written out of ``documents``, row by row: payloads, dict text and show pages.

The lines of a text become the characters, products, songs and so on of one show. Nothing is
grouped or joined, so the size of a value is bounded by its own document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import nested as N
from ..functions.entities import escape

LINES_SQL = "WITH d AS (SELECT *, string_split(text, chr(10)) AS lines FROM documents)"


def _id() -> Column:
    return F.col("doc_id").cast("string")


def lines() -> Column:
    return F.split("text", "\n", -1)


def _word(line: Column, i: int) -> Column:
    return F.get(F.split(line, " ", -1), F.lit(i))


def gender(line: Column) -> Column:
    kind = F.length(line) % 4
    return F.when(kind == 0, "Male").when(kind == 1, "FEMALE").when(kind == 2, "any")


def characters() -> Column:
    def one(line: Column) -> Column:
        return F.struct(
            _word(line, 0).alias("Name"),
            F.length(line).cast("string").alias("Age"),
            gender(line).alias("Gender"),
            line.alias("Description"),
        )

    return F.transform(lines(), one)


def characters_json() -> Column:
    return N.to_json(characters())


def authors() -> Column:
    return F.transform(
        lines(),
        lambda line, i: F.struct(
            (i + 1).cast("bigint").alias("Id"), _word(line, 0).alias("FirstName"), _word(line, 1).alias("LastName")
        ),
    )


def images() -> Column:
    def one(line: Column, i: Column) -> Column:
        url = F.concat(F.lit("/img/"), _id(), F.lit("/"), (i + 1).cast("string"), F.lit(".png"))
        return F.struct(
            (i + 1).cast("bigint").alias("Id"),
            F.lit("poster").alias("Type"),
            F.length(line).alias("Height"),
            url.alias("ImageUrl"),
            F.when(F.length(line) % 2 == 0, F.col("source")).alias("PhotoCredit"),
        )

    return F.transform(lines(), one)


def listing_payload() -> Column:
    """A page of a JSON listing: every line a product."""
    return _listing(lines(), lambda i: F.col("doc_id") * 1000000 + i + 1)


def product_payload() -> Column:
    """A page of a JSON listing with the whole text as its one product."""
    return _listing(F.array("text"), lambda i: F.col("doc_id") + i)


def _listing(items: Column, number_of) -> Column:
    def product(line: Column, i: Column) -> Column:
        number = number_of(i).cast("bigint")
        kind = F.when(F.length(line) % 3 == 0, F.col("lang")).otherwise(F.concat_ws(", ", "lang", "source", F.lit("more")))
        return F.struct(
            number.alias("Id"),
            line.alias("Name"),
            F.concat(F.lit("show-"), number.cast("string")).alias("SeName"),
            F.concat(F.length(line).cast("string"), F.lit(" roles")).alias("TitleCasting"),
            kind.alias("TitleTypeOfPlayAndGenre"),
            F.array(
                F.struct(number.alias("Id"), _word(line, 0).alias("FirstName"), F.col("source").alias("LastName"))
            ).alias("Authors"),
            F.split(line, ", ", -1).alias("Tags"),
            F.array(
                F.struct(
                    number.alias("Id"), F.lit("poster").alias("Type"), F.length(line).alias("Height"),
                    F.concat(F.lit("/img/"), number.cast("string")).alias("ImageUrl"),
                    F.lit(None).cast("string").alias("PhotoCredit"),
                )
            ).alias("ProductImages"),
            F.concat(F.lit("<p>"), escape(line), F.lit("</p>")).alias("ShortDescription"),
        )

    products = F.transform(items, product)
    return N.to_json(F.struct(F.size(items).cast("bigint").alias("ProductTotal"), products.alias("Products")))


def detail_payload() -> Column:
    """The JSON detail of one show; some fields missing for some documents."""
    number = F.col("doc_id")
    paragraphs = F.array_join(F.transform(lines(), lambda line: F.concat(F.lit("<p>"), escape(line), F.lit("</p>\n"))), "")
    fee = F.when(
        number % 4 > 0, F.concat(F.lit("<strong>Minimum Fee</strong>: $"), F.col("n_chars").cast("string"), F.lit(" per show"))
    ).otherwise("<strong>On request</strong>")
    more = F.struct(
        F.concat(F.col("n_chars").cast("string"), F.lit(" minutes")).alias("DescriptionDuration"),
        F.when(number % 3 > 0, F.col("lang")).alias("DescriptionTargetAudience"),
        F.when(number % 5 > 0, F.concat(F.lit("<b>First</b>, <i>"), F.col("source"), F.lit("</i>, Last"))).alias("DescriptionAwards"),
        F.concat(F.lit("<div>"), paragraphs, F.lit("<!-- end --></div>")).alias("DescriptionProductionInformation"),
        F.transform(lines(), lambda line: F.struct(_word(line, 0).alias("Name"))).alias("PerformanceGroups"),
    )
    return N.to_json(
        F.struct(
            number.alias("Id"),
            F.concat(F.lit("<p> "), escape(F.get(lines(), F.lit(0))), F.lit("&nbsp;</p>")).alias("ShortDescription"),
            paragraphs.alias("FullDescription"),
            fee.alias("LicensingFeeDisplay"),
            more.alias("TitleAttributeDisplayModel"),
        )
    )


# --- show pages ---------------------------------------------------------------------------


def _text(c: Column | str) -> Column:
    return F.lit(c) if isinstance(c, str) else c


def _all(*parts: Column | str) -> Column:
    return F.concat(*[_text(p) for p in parts])


def _div(cls: str, *content: Column | str) -> Column:
    return _all(f'<div class="{cls}">', *content, "</div>")


def _each(items: Column, fn) -> Column:
    return F.array_join(F.transform(items, fn), "")


def _length(line: Column) -> Column:
    return F.length(line).cast("string")


def table(items: Column) -> Column:
    """A row per line and a cell per comma."""

    def row(line: Column) -> Column:
        return _all("<tr class='r'>\n", _each(F.split(line, ", ", -1), lambda c: _all("<td> ", escape(c), "\n</td>")), "</tr>")

    return _all('<TABLE class="wide table-styled">', _each(items, row), "</TABLE>")


def character_rows() -> Column:
    def row(line: Column) -> Column:
        age = F.when(F.length(line) % 5 > 0, _div("character__age", "Age: ", _length(line), ": x")).otherwise("")
        of = F.when(gender(line).isNotNull(), _div("character__gender", "Gender: ", gender(line))).otherwise("")
        return _all(
            "<div>", escape(_word(line, 0)), "</div>\n",
            _div("row character__row", age, of, _div("character__description", escape(line))),
        )

    return _div("characters", _each(lines(), row))


def award_groups() -> Column:
    def group(line: Column) -> Column:
        items = _each(F.split(line, ", ", -1), lambda w: _all("<li class='awards__item'> ", escape(w), " </li>"))
        return _div("show-awards__group", "<h4 class='awards_type_group'> ", escape(_word(line, 0)), "\n</h4><ul>", items, "</ul>")

    return _div("show_awards_container", _each(lines(), group))


def credit_lists() -> Column:
    def credit(line: Column) -> Column:
        label = _all("Role ", (F.length(line) % 5).cast("string"))
        names = _each(F.split(line, ", ", -1), lambda w: _all("<li><a href='/n'>", escape(w), "</a></li>"))
        return _all(_div("field field-attribution-label", label, " "), "<p>by</p>", _div("item-list", "<ul>", names, "</ul>"))

    return _each(lines(), credit)


def community() -> Column:
    """Lines in paragraphs; the length of a line makes some of them headers."""

    def paragraph(line: Column) -> Column:
        kind = F.length(line) % 7
        head = F.when(kind == 0, "Sets").when(kind == 1, "Costumes").when(kind == 2, "Props")
        return _all("<p> ", F.coalesce(_all(head, ": ", escape(line)), _all("-", escape(line))), "</p>")

    block = _all('<div class="resource clearfix">', _each(lines(), paragraph), "</div>")
    return _all('<div id="show-community"><div>', block, "</div></div>")


def materials_page() -> Column:
    alternate = F.when(F.col("n_chars") % 2 == 0, _all("<h3>ALTERNATE ORCHESTRATION</h3>", table(lines()))).otherwise("")
    return _all(
        "<html><body><!-- <h1>old</h1><table class='table-styled'></table> --><h1>Materials</h1><div>", table(lines()),
        "</div><h3>Notes</h3><h3>STANDARD ORCHESTRATION</h3>\n<p>for</p>", table(lines()), alternate, "</body></html>",
    )


def odd_markup() -> Column:
    """For each line a list whose items stay open, a box with one that closes itself, and a row with an empty cell."""

    def one(line: Column) -> Column:
        return _all(
            "<ul><li>", escape(_word(line, 0)), "<li>", escape(line), "</b></ul>tail",
            '<div class="x"><div class="clear"/>', escape(line), "</i></div>B<p>C</p>", "<tr><td/><td>", escape(_word(line, 0)), "</tr></td>",
        )

    return _each(lines(), one)


def deep_markup() -> Column:
    """Headings and rows among elements that are nested as deep as the length of a line says."""

    def one(line: Column) -> Column:
        levels = F.length(line) % 13
        nest, end = F.repeat(F.lit("<div>"), levels), F.repeat(F.lit("</div>"), levels)
        first = escape(_word(line, 0))
        return _all(
            "<section><h3>", first, "</h3>", nest, "<p class='t'>", escape(line), "</p>", end, "<p class='t'>no</p>",
            nest, "<div>", first, nest, end, "</div> <p>x</p><div class='row'>", escape(line), "</div><div>no</div>", end, "</section>",
        )

    return _each(lines(), one)


def short_show_page_a() -> Column:
    return _all('<html><a class="mti-print-button" href="/print/', _id(), '">p</a>', _div("field-name-field-show-version", F.col("lang")), "</html>")


def short_print_page_a() -> Column:
    return _all(
        "<html>", _div("field-name-field-show-title-full", " Show ", _id(), "\n"),
        _div("field-name-field-show-synopsis-long", escape(F.col("text"))), "</html>",
    )


def short_show_page_b() -> Column:
    return _all(
        '<h1 class="single-title custom-post-type-title">Show ', _id(), '</h1><div id="show-credits">', escape(F.col("text")), "</div>"
    )


def entry_page_a(url: Column) -> Column:
    """An alphabetical listing of one show."""
    item = _div("alphabetical-item", '<a href="', url, '">x</a>')
    return _div("region region-content", _div("alphabetical-container", item))


def entry_page_b(url: Column) -> Column:
    """A category listing of one show."""
    return _div("col-md-4 col-sm-6 col-xs-12 views-col", '<a href="', url, '">x</a>', _div("list-title", "<h3>t</h3>"))


def listing_page_a() -> Column:
    """An item per line, in boxes; an item whose line is even in length has no link."""

    def item(line: Column, i: Column) -> Column:
        link = _all('<a name="x">-</a><a class="l" href="/shows/', _id(), "/", (i + 1).cast("string"), '">', escape(line), "</a>")
        return _div("item alphabetical-item", F.when(F.length(line) % 2 > 0, link).otherwise(escape(line)))

    return _all(
        '<html><body><div class="alphabetical-container"><div class="alphabetical-item"><a href="/no">no</a></div></div>',
        '<div class="region region-content">', _div("alphabetical-container", _each(lines(), item)),
        _div("alphabetical-container", _div("alphabetical-item", "<a href='/last'>z</a>")), "</div></body></html>",
    )


def listing_page_b() -> Column:
    """A box per line; a box without a title is no show."""

    def box(line: Column, i: Column) -> Column:
        title = F.when(F.length(line) % 3 > 0, _div("list-title", "<h3>", escape(line), "</h3>")).otherwise("")
        link = _all("<a href='/show/", (F.length(line) % 5).cast("string"), "/'>x</a>")
        return _all('<div class="col-md-4 col-sm-6 col-xs-12 views-col"><div>', link, "</div>", title, "</div>")

    return _all("<html><body><div class='views-col'>", _each(lines(), box), "</div></body></html>")


def show_page_a() -> Column:
    def song(line: Column, i: Column) -> Column:
        source = _all('<audio controls><source type="audio/mpeg" src="/a/', _id(), "/", i.cast("string"), '.mp3?x=1&amp;y"></audio>')
        return _div("field field-name-field-show-songs", _div("field-show-song-title", " ", escape(_word(line, 0))), source)

    def resource(line: Column, i: Column) -> Column:
        return _div(
            "resource-results-view-content",
            _div("resource-view-title", f"<a href='/r/", i.cast("string"), "'> ", escape(_word(line, 0)), "</a> "),
            _div("resource-view-description", "<p>", escape(line), "</p>"),
            _div("resource-view-type-wrapper", _div("t", " Logo ")),
            _div("resource-view-image", '<img alt="" src="/i.png">'),
        )

    tags = _all(*[_div("field-type-taxonomy-term-reference", "\n", c, " ") for c in (F.col("lang"), F.col("source"))])
    similar = [
        _div("field-name-field-show-similar-shows", f"<b><a class='s' href='/shows/{n}-", _id(), f"'> Show {n}</a></b>")
        for n in ("one", "two")
    ]
    return _all(
        "<!DOCTYPE html><html><body><script>var t='<div class=\"group-tags\">';</script>",
        '<a class="btn mti-print-button" href="/print/', _id(), '">Print</a>',
        F.when(F.col("n_chars") % 3 > 0, _all("<a href='/materials/", _id(), "' class='mti-show-materials'>M</a>")).otherwise(""),
        _each(lines(), song),
        F.when(F.col("n_chars") % 5 > 0, _div("group-tags", tags)).otherwise(""),
        *similar,
        _div("field-name-field-show-version", "<div> Version ", F.col("lang"), "</div>"),
        _div("field-name-field-show-availability-message", F.col("source"), " "),
        F.when(F.col("n_chars") % 2 == 0, _div("field-name-field-show-synopsis-brief", "<p>", escape(F.get(lines(), F.lit(0))), "</p>")).otherwise(""),
        _div("resource-results-view", _each(lines(), resource)),
        "</body></html>",
    )


def print_page_a() -> Column:
    first_line = escape(F.get(lines(), F.lit(0)))
    whole = escape(F.col("text"))
    info = lambda kind, value: _div(f"infographic__{kind}", "<i>x</i>", _div("infographic__value", " ", value, "\n"))
    return _all(
        "<html><body><style>p{}</style>",
        _div("field-name-field-show-title-full", "\n<h2>Show ", _id(), "</h2>\n"),
        _div("field-name-field-show-logo", "<a><img src='/logo/", _id(), ".png'/></a>"),
        _div("field-name-field-show-synopsis-summary", "<div><div><div><div><div>", first_line, "</div></div></div></div></div>"),
        _div("infographic__roles", " ", F.size(lines()).cast("string"), " roles "),
        info("rated", F.col("lang")), info("acts", (F.col("n_chars") % 3).cast("string")),
        _div("cast-info__name-size", "<b>Cast Size</b>: ", F.col("lang"), " (", F.col("source"), ")"),
        _div("cast-info__name-type", "Cast Type", F.when(F.col("n_chars") % 2 == 0, ": ").otherwise(" - "), F.col("source")),
        _div("cast-info__name-requirements", "Dance: ", F.col("lang"), ": more"),
        character_rows(), award_groups(), credit_lists(),
        _div("show-billing__video-warning", "\n<h4>Video Warning</h4>\r\n<p>", whole, "</p>"),
        _div("show-billing__rider-wrapper", "<h4>Requirements</h4>\n\n", whole, "&nbsp;&nbsp;", F.col("lang")),
        _div("field-name-field-show-synopsis-long", " ", whole, "\n"),
        "</body></html>",
    )


def show_page_b() -> Column:
    def items(tag: str, fn) -> Column:
        return _each(lines(), lambda line: _all(f"<{tag}> ", fn(line), f"</{tag}>"))

    paragraphs = items("p", escape)
    related = F.when(
        F.col("n_chars") % 3 > 0, _all("<h3>Related Shows</h3>\n<a href='/x/", _id(), "'>x</a><br><span>,</span> <a href='/y/", _id(), "'>y</a>")
    ).otherwise("<h3>Related Shows</h3><p><a href='/x'>x</a></p><a href='/z'>z</a>")
    links = F.when(F.col("n_chars") % 2 == 0, _all("<a class='btn btn-success btn-lg' href='/licence/", _id(), "'>2</a>")).otherwise("")
    return _all(
        "<!DOCTYPE html><html><body><header class='article-header show-header'><img class='img-responsive big' src='/logo/", _id(), ".png'>",
        '</header><h1 class="single-title custom-post-type-title">Show ', _id(), " </h1>",
        '<div class="pull-right extra-links"><a class="btn">0</a><a class="btn btn-success btn-lg" href="/perusal">1</a>', links, "</div>",
        '<div id="show-overview"><ul class="list-unstyled"><li class="author-info"> ', F.col("source"),
        ' </li><li class="author-info"> </li><li>no</li><li class="x author-info">', F.col("lang"), "</li></ul>", related, "</div>",
        '<div id="show-casting-information">', paragraphs, "</div>",
        '<div id="show-credits">', escape(F.col("text")), "</div>",
        '<div id="show-orchestral-information">', F.when(F.col("n_chars") % 2 == 0, paragraphs).otherwise(""), "</div>",
        '<div class="sidebar-section additional-products"><ul class="list-unstyled">',
        items("li", lambda line: _all("<a href='/p/", _length(line), "'>", escape(_word(line, 0)), "</a> ")), "</ul></div>",
        '<div class="audio-wrapper"><ol class="audiojs-playlist">',
        items("li", lambda line: _all("<a href='#' data-src='/s/", _length(line), ".mp3'>", escape(_word(line, 0)), "</a>")), "</ol></div>",
        '<div id="show-synopsis">', paragraphs, "</div>", community(), "</body></html>",
    )


def upcoming_page_b() -> Column:
    def production(line: Column) -> Column:
        dates = [f"<span class='date-display-{which}'> {which} " for which in ("start", "end")]
        return _div("upcoming", "<h5> ", escape(line), "</h5>", dates[0], _length(line), "</span>", dates[1], _length(line), " </span>")

    return _all("<html><body>", _each(lines(), production), "</body></html>")


def pages_of(documents: DataFrame, url: Column, html: Column) -> DataFrame:
    return documents.select(F.col("doc_id").alias("page_id"), url.alias("url"), html.alias("html"))
