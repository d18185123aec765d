import html
import random
from html.entities import html5

import pytest
from pyspark.sql import functions as F

from showloom.functions import text as T
from showloom.functions.entities import escape, unescape
from showloom.operators.clean import cast_size


@pytest.mark.parametrize("given, detail, category", [
    ("Medium (11 to 20 performers)", "11 to 20 performers", "Medium"),
    ("Flexible", None, "Flexible"),
    (" Small (x)", "x", ""),
    ("", None, ""),
    (None, None, None),
    ("Big (a) (b)", "a", "Big"),
    ("Large (no close", None, "Large"),
    ("A (x\ny) z", None, "A"),
    ("Small\n", None, "Small"),
    ("Empty () x", None, "Empty"),
])
def test_cast_size(value, given, detail, category):
    got = value(lambda c: F.struct(*[e.alias(n) for n, e in cast_size(c).items()]), given)
    assert (got["cast_size_detail"], got["cast_size_category"]) == (detail, category)


@pytest.mark.parametrize("given, expected", [
    ("Age: 20: 30", "20"), ("none", None), (None, None), ("Age: ", ""), ("Age:20", None), ("a: b: c: d", "b"),
])
def test_after_delimiter(value, given, expected):
    assert value(T.after_delimiter, given) == expected


@pytest.mark.parametrize("given", [
    "\xa0 a b\t\n", "", "x", " x　", "\x1cx\x85", None, " \n ", "​x",
])
def test_strip_is_pythons(value, given):
    assert value(T.strip, given) == (None if given is None else given.strip())


@pytest.mark.parametrize("given, expected", [
    ("Play, Comedy, Farce", ("Play", "Comedy")), ("Musical", ("Musical", "")), ("", ("", "")), (None, (None, None)),
    ("a,b", ("a,b", "")),
])
def test_type_and_genre(value, given, expected):
    got = value(lambda c: F.struct(*[x.alias(n) for n, x in zip("ab", T.type_and_genre(c))]), given)
    assert tuple(got) == expected


@pytest.mark.parametrize("given, expected", [
    ("<strong>Fee</strong>: $10 per show", "$10 per show"), ("<strong>On request</strong>", None),
    ("Fee: a: b", "a"), (None, None), (":\xa0x\n", "x"),
])
def test_fee(value, given, expected):
    assert value(T.fee_amount, given) == expected


def test_headings_go_once(value):
    text = " Video Warning\r\n\r\nA Video Warning\nshall stay\n"
    assert value(T.warning_text, text) == "A Video Warningshall stay"
    text = "\n Requirements\n\n\nA\xa0\xa0B Requirements \xa0"
    assert value(T.requirement_text, text) == "A B Requirements"
    assert value(T.warning_text, None) is None


def test_missing_values(value):
    assert [value(T.missing_to_null, x) for x in ("", "None", None, "a", " ")] == [None, None, None, "a", " "]
    assert [value(lambda c: T.default_to(c, "d"), x) for x in ("", "None", None, "a")] == ["d", "d", "d", "a"]
    assert [value(T.has_text, x) for x in ("", " \xa0", None, " a")] == [False, False, False, True]
    assert value(T.empty_to_null, [], "array<string>") is None
    assert [value(T.keep_if_digit, x) for x in ("a1", "a", "٣", "")] == ["a1", "", "٣", ""]


def test_urls_and_ranges(value):
    assert value(lambda c: T.join_url(c, "/upcoming/"), "https://x.example.com/a/") == "https://x.example.com/a/upcoming/"
    assert value(lambda c: T.date_range(c, F.lit("b")), "a") == "a to b"
    assert value(lambda c: T.date_range(c, F.lit("b")), None) is None
    assert [value(lambda c: T.page_count(c, 150), n, "bigint") for n in (0, 1, 150, 151)] == [0, 1, 1, 2]


@pytest.mark.parametrize("given, expected", [
    ("a &amp;lt; b", "a &lt; b"), ("&#233;&#xE9;&eacute;", "ééé"), ("&#x1F600;", "😀"), ("&unknown; & &;", "&unknown; & &;"),
    ("&nbsp;&yuml;&copy;", "\xa0ÿ©"), ("no", "no"), (None, None), ("AT&T &quot;&apos;", "AT&T \"'"), ("&&amp;&", "&&&"),
])
def test_entities(value, given, expected):
    assert value(unescape, given) == expected


@pytest.mark.parametrize("given, expected", [
    ("&#xD800;&#0;&#1114112;&#99999999999999;", "\ufffd" * 4), ("&#150;&#x80;&#x0000041;", "–€A"), ("&#129;", "\x81"),
    ("&copy 2&copy;&lt;&#169 x&#xe9", "© 2©<© xé"), ("R&D &bogus &bogus; &lt.x &amp;copy", "R&D &bogus &bogus; <.x &copy"),
    ("A &amp B &copy 2024 &alpha; &hearts; &alpha &notit; &notin;", "A & B © 2024 α ♥ &alpha ¬it; ∉"), ("&NotEqualTilde;&ampamp;", "≂̸&amp;"),
])
def test_bare_and_odd_references(value, given, expected):
    assert value(unescape, given) == expected


def test_references_are_those_of_the_standard(spark):
    rng = random.Random(3)
    parts = [*html5, "a", "1", ";", " ", "&", "&", "&", "&", "#", "x", "é", "&#77", "&#x4d;", "&Aacute", "notin"]
    given = ["&" + "".join(rng.choice(parts) for _ in range(rng.randint(1, 6))) for _ in range(3000)]
    rows = spark.createDataFrame([(g,) for g in given], "c string").select("c", unescape(F.col("c")).alias("v")).collect()
    assert [(r.c, r.v) for r in rows] == [(r.c, html.unescape(r.c)) for r in rows]


def test_escape_round_trip(value):
    text = "a < b & \"c\" > d &lt;"
    assert value(lambda c: unescape(escape(c)), text) == text
