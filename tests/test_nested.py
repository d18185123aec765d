import ast
import json
import random

import pytest
from pyspark.sql import functions as F

from showloom.functions import nested as N
from showloom.functions.html import visible_text
from showloom.operators.clean import clean_catalog
from showloom.operators.site_a import COLUMNS
from showloom.sources import schemas as S


@pytest.mark.parametrize("given, genders, counts", [
    ('[{"Name":"a","Gender":"Male"},{"Name":"b","Gender":null}]', ["Male", None], (1, 0, 0)),
    ('{"Name":"solo","Gender":"Female"}', ["Female"], (0, 1, 0)),
    ('[{"Name":"x"', None, (0, 0, 0)),
    ("", None, (0, 0, 0)),
    (None, None, (0, 0, 0)),
    ("[]", [], (0, 0, 0)),
    ('[{"name":"lower","gender":"Male"}]', [None], (0, 0, 0)),
    ('[null,{"Gender":"Male"}]', [None, "Male"], (1, 0, 0)),
    ('[{"Gender":3}]', ["3"], (0, 0, 1)),
    ('[{"Gender":"Male\\n"},{"Gender":""}]', ["Male\n", ""], (0, 0, 2)),
    ('[{"Gender":"MALE"},{"Gender":"fEmale"},{"Gender":"any"}]', ["MALE", "fEmale", "any"], (1, 1, 1)),
])
def test_characters_and_counts(value, given, genders, counts):
    parsed = lambda c: F.from_json(c, S.CHARACTERS)["Gender"]
    assert value(parsed, given) == genders
    got = value(lambda c: F.struct(*[x.alias(n) for n, x in N.gender_counts(parsed(c)).items()]), given)
    assert tuple(got) == counts


@pytest.mark.parametrize("given, expected", [
    ("{'Music by': ['A', 'B'], 'Book and Lyrics by': [\"O'Neil\"]}", (["A", "B"], ["O'Neil"], ["O'Neil"], None)),
    ("{'M': [None]}", (None,) * 4),
    ("{'M': ['a'], 'Music': ['b', None]}", (None,) * 4),
    ("{'M': ['a\\xa0b']}", (None, None, None, ["a\xa0b"])),
    ("{'M': ['It\\'s \"q\"']}", (None, None, None, ['It\'s "q"'])),
    ("{}", (None,) * 4),
    ("None", (None,) * 4),
    ("", (None,) * 4),
    (None, (None,) * 4),
    ("{'M': [nan]}", (None,) * 4),
    ("{'M': 'str'}", (None,) * 4),
    ("{'M': ['a'", (None,) * 4),
    ("{'Musical by': ['A'], 'Based on the BOOK by': ['B']}", (["A"], None, ["B"], None)),
    ("{'Music, Lyrics & Book': ['A'], 'Music': ['B']}", (["A", "B"], ["A"], ["A"], None)),
    ("{'Music': [], 'X': ['a']}", (None, None, None, ["a"])),
    ("{'X': ['None', 'A, None]', '[None,']}", (None, None, None, ["None", "A, None]", "[None,"])),
])
def test_credit_buckets(value, given, expected):
    got = value(lambda c: N.credit_buckets(N.literal_map(c)), given)
    assert (tuple(got) if got else (None,) * 4) == expected


@pytest.mark.parametrize("names", [
    ["plain"], ["O'Neil"], ['say "hi"'], ["both ' and \""], ["back\\slash"], ["end\\"], ["tab\there\nline"],
    ["nbsp\xa0", "é", "\x80\x81", " "], ["\\xa0 literal"], ["None", "[None]", "None, None"], ["😀"], ["\\'", "\\\""],
])
def test_literal_text_round_trip(value, names):
    assert value(N.literal_map, repr({"la'bel": names})) == {"la'bel": names}


def test_literal_list_and_tags(value):
    assert value(N.literal_list, "['b', 'a', 'b']") == ["b", "a", "b"]
    assert value(lambda c: N.distinct_tags(N.literal_list(c)), "['b', 'a', 'b']") == ["a", "b"]
    assert value(N.distinct_tags, None, "array<string>") is None


def test_json_keeps_nulls(value):
    text = value(lambda c: N.to_json(F.array(F.struct(c.alias("a"), F.lit(1).alias("b")))), None)
    assert json.loads(text) == [{"a": None, "b": 1}]


def test_last_wins(value):
    type_ = "array<struct<key:string,value:array<string>>>"
    rng = random.Random(1)
    for n in (0, 1, 3, 40):
        entries = [(rng.choice("dcab"), [str(i)]) for i in range(n)]
        expected = {}
        for k, v in entries:
            expected[k] = v
        got = value(lambda c: F.map_entries(N.last_wins_map(c)), entries, type_)
        assert [tuple(e) for e in got] == list(expected.items())
    assert value(N.last_wins_map, None, type_) is None
    assert value(N.last_wins_map, [("b", None), ("a", ["x", None])], type_) == {"b": None, "a": ["x", None]}


def python_sections(text):
    """The meaning in plain Python, line by line."""
    found, current = {"sets": [], "costumes": [], "props": []}, None
    for line in (x.strip() for x in text.split("\n")):
        opened = next((n for n, w in HEADERS.items() if line.startswith(w)), None)
        if opened:
            current = opened
        elif current:
            found[current].append(line)
    return found


HEADERS = {"sets": "Sets", "costumes": "Costumes", "props": "Props"}


@pytest.mark.parametrize("text", [
    "", "a\nb", "Sets", "Sets\n", "pre\n Sets\na\n\nb \nProps x\n\n  Costumes\nc\nSets again\nz\n",
    "Sets\n\n\nProps\n\n", "\xa0Props\n x \xa0\nSetsuna\nCostumes: a\nnot Sets\nsets", "\nSets\nProps\nCostumes\nx",
])
def test_sections(value, text):
    assert value(lambda c: N.sections(c, HEADERS), text).asDict() == python_sections(text)


def test_awards(value):
    assert value(lambda c: N.awards_map(visible_text(c)), "<b>A</b>, B, <i>C</i>") == {"awards": ["A ", "B", "C"]}
    assert value(lambda c: N.awards_map(visible_text(c)), None) == {"awards": [""]}


def test_positions(value):
    assert [value(lambda c: N.nth_or_default(c, 1, "None"), x, "array<string>") for x in (["a"], ["a", "b"], [], None)] == [
        "None", "b", "None", "None",
    ]
    assert [value(N.first_two, x, "array<string>") for x in (["a"], ["a", "b", "c"], [], None)] == [None, ["a", "b"], None, None]


def test_properties_of_buckets_and_counts(spark):
    rng = random.Random(5)
    labels = ["Music", "lyrics by", "Book", "Music and BOOK", "Director", "Lyrics/Book/Music", "bookmark", ""]
    genders = ["Male", "female", "FEMALE", "x", "", None]
    made = []
    for i in range(300):
        credits = {k: [f"{k}{j}" for j in range(rng.randint(0, 3))] for k in rng.sample(labels, rng.randint(0, 5))}
        made.append((i, repr(credits), json.dumps([{"Gender": rng.choice(genders)} for _ in range(rng.randint(0, 6))])))
    frame = spark.createDataFrame(made, "i int, c string, g string")
    parsed = F.from_json("g", S.CHARACTERS)["Gender"]
    rows = frame.select(
        "c", "g", N.credit_buckets(N.literal_map(F.col("c"))).alias("b"),
        *[c.alias(n) for n, c in N.gender_counts(parsed).items()],
    ).collect()
    for row in rows:
        credits = ast.literal_eval(row.c)
        for role in N.CREDIT_ROLES:
            expected = [n for k, names in credits.items() if role in k.lower() for n in names]
            assert (row.b[role] or []) == expected
        assert (row.b.others or []) == [n for k, v in credits.items() if not any(r in k.lower() for r in N.CREDIT_ROLES) for n in v]
        given = [x["Gender"] for x in json.loads(row.g) if x["Gender"] is not None]
        assert row.male + row.female + row.other == len(given)
        assert row.female == sum(x.lower() == "female" for x in given)


def test_clean_catalog_takes_text_and_nested(spark):
    names = [c if c != "billing" else "Billing" for c in COLUMNS]  # names match whatever their case
    row = {c: None for c in names} | {
        "cast_size": "Small (4)", "characters": '[{"Name":"a","Gender":"male"}]', "Billing": "{'Music by': ['A']}",
    }
    raw = spark.createDataFrame([tuple(row[c] for c in names)], ", ".join(f"{c} string" for c in names))
    clean = clean_catalog(raw)
    assert clean.columns == names + [
        "cast_size_detail", "cast_size_category", "music_by", "lyrics_by", "book_by", "other_authors",
        "male_character_count", "female_character_count", "other_character_count",
    ]
    got = clean.first()
    assert (got.cast_size_detail, got.cast_size_category, got.music_by, got.male_character_count) == ("4", "Small", ["A"], 1)

    typed = raw.withColumn("characters", F.from_json("characters", S.CHARACTERS)).withColumn("Billing", N.literal_map(F.col("Billing")))
    assert clean_catalog(typed).select(clean.columns[24:]).first() == clean.select(clean.columns[24:]).first()
