"""Broken markup and payloads give nulls and never fail a run."""

import random

import pytest
from pyspark.sql import functions as F

from showloom.functions import html as H
from showloom.functions import nested as N
from showloom.functions.entities import unescape
from showloom.operators import captures, site_a, site_b, site_c
from showloom.operators.clean import clean_catalog

TOKENS = [
    "character__row", "character__age", "character__description", "field-attribution-label", "item-list", "awards__item",
    "show_awards_container", "show-awards__group", "awards_type_group", "infographic__rated", "infographic__value",
    "cast-info__name-size", "show-billing__video-warning", "show-billing__rider-wrapper", "group-tags", "upcoming",
    "field-type-taxonomy-term-reference", "field-name-field-show-songs", "resource-results-view", "resource-results-view-content",
    "resource-view-title", "table-styled", "audio-wrapper", "audiojs-playlist", "list-unstyled", "author-info",
    "article-header show-header", "pull-right extra-links", "btn btn-success btn-lg", "resource clearfix",
    "sidebar-section additional-products", "date-display-start", "single-title custom-post-type-title",
]
IDS = ["show-overview", "show-casting-information", "show-credits", "show-synopsis", "show-community", "show-orchestral-information"]
TEXTS = [
    "Age: 9", "a: b: c", "Sets", "\nProps\n", "&#xD800;", "&#99999999999;", "&", "<", ">", "\"", "'", "\\", "\xa0", "Video Warning", "é😀",
    "Related Shows</h3>", "STANDARD ORCHESTRATION</h3>", "<!--", "-->", "<script>", "</script>", "<style", "$1", "{", "[", "(", "\x00", "%",
]


def soup(rng):
    pieces = []
    for _ in range(rng.randint(0, 60)):
        kind = rng.random()
        tag = rng.choice(["div", "div", "p", "ul", "li", "a", "h1", "h3", "table", "tr", "td", "span", "img", "header", "audio", "source"])
        if kind < 0.45:
            pieces.append(f"<{tag} class='{rng.choice(TOKENS)}' id=\"{rng.choice(IDS)}\" href='/x' src=/y>")
        elif kind < 0.5:
            pieces.append(rng.choice([f"<{tag}", f"<{tag} class=", f"<{tag} class='", f"<{tag} {rng.choice(TOKENS)}>", f"</{tag}", "< div>"]))
        elif kind < 0.75:
            pieces.append(f"</{tag}>")
        else:
            pieces.append(rng.choice(TEXTS))
    return "".join(pieces)


@pytest.fixture(scope="module")
def broken(spark, tmp_path_factory):
    rng = random.Random(11)
    folder = str(tmp_path_factory.mktemp("broken") / "t")
    rows = [(i, soup(rng)) for i in range(400)] + [(-1, None), (-2, "")]
    spark.createDataFrame(rows, "i int, html string").write.parquet(folder)
    return spark.read.parquet(folder)


@pytest.mark.parametrize("fields", [site_a.show_fields, site_a.print_fields, site_b.show_fields], ids=["a", "a print", "b"])
def test_broken_pages(broken, fields):
    read = captures.prepared(broken).select("i", *[c.alias(n) for n, c in fields(F.col("html")).items()])
    rows = {r.i: r.asDict() for r in read.collect()}
    assert len(rows) == 402
    assert all(v is None for n, v in rows[-1].items() if n != "i")


def test_other_broken_pages(broken):
    html = F.col("html")
    read = captures.prepared(broken).select("i", site_a.orchestration(html), site_b.productions(html))
    assert read.count() == len(read.collect()) == 402
    assert len(broken.select(unescape(html), H.visible_text(html)).collect()) == 402


def test_broken_texts(broken):
    text = F.col("html")
    payloads = broken.select(F.concat(F.lit('{"ProductTotal": '), text, F.lit("}")).alias("payload"))
    assert len(site_c.listing_totals(payloads).collect()) == 402
    assert site_c.products(payloads).collect() == [] and len(site_c.details(payloads).collect()) == 402
    literals = broken.select("i", F.concat(F.lit("{'M': ['"), text, F.lit("']}")).alias("c"))
    assert len(literals.select(N.credit_buckets(N.literal_map(F.col("c")))).collect()) == 402
    raw = broken.select(text.alias("characters"), text.alias("billing"), text.alias("cast_size"))
    assert len(clean_catalog(raw).collect()) == 402
