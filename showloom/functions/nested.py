"""JSON, dict text, arrays and maps inside one row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import empty_to_null, let, strip

CREDIT_MAP = "map<string,array<string>>"
CREDIT_ROLES = ("music", "lyrics", "book")


def to_json(c: Column) -> Column:
    """JSON text that keeps null fields."""
    return F.to_json(c, {"ignoreNullFields": "false"})


# --- text of Python literals ---------------------------------------------------------------

_LITERAL_TOKEN = r"""('(?:[^'\\]++|\\.)*+'|"(?:[^"\\]++|\\.)*+"|[^'"]++|['"])"""

# an even number of backslashes: what follows is not itself escaped
_UNESCAPED = r"(?<!\\)((?:\\\\)*)"


def literal_to_json(c: Column) -> Column:
    """Rewrite the text of a Python literal as JSON text.

    Quoted pieces and the text between them are treated apart, so a ``None`` inside a name
    stays a name.
    """

    def quoted(t: Column) -> Column:
        body = F.substr(t, F.lit(2), F.length(t) - 2)
        body = F.regexp_replace(body, _UNESCAPED + r"\\x([0-9a-fA-F]{2})", r"$1\\u00$2")
        body = F.regexp_replace(body, _UNESCAPED + r"\\'", "$1'")
        # a bare double quote can only stand in a single-quoted piece
        body = F.when(t.startswith("'"), F.regexp_replace(body, _UNESCAPED + '"', r'$1\\"')).otherwise(body)
        return F.concat(F.lit('"'), body, F.lit('"'))

    def bare(t: Column) -> Column:
        for word, json_word in (("None", "null"), ("True", "true"), ("False", "false")):
            t = F.regexp_replace(t, rf"\b{word}\b", json_word)
        return t

    def token(t: Column) -> Column:
        whole = (F.length(t) > 1) & t.rlike("^['\"]")
        return F.when(whole, quoted(t)).otherwise(bare(t))

    tokens = F.regexp_extract_all(c, F.lit("(?s)" + _LITERAL_TOKEN), F.lit(0))
    return F.array_join(F.transform(tokens, token), "")


def literal_map(c: Column) -> Column:
    """``{'label': ['name', ...]}`` text -> map; anything that does not parse is null."""
    return F.from_json(literal_to_json(c), CREDIT_MAP)


def literal_list(c: Column) -> Column:
    """``['a', 'b']`` text -> array, by dropping brackets and quotes."""
    return F.split(F.regexp_replace(c, r"[\[\]']", ""), ", ", -1)


# --- credits ------------------------------------------------------------------------------


def credit_buckets(credits: Column) -> Column:
    """Names by the role words in their label: struct of music, lyrics, book, and others.

    A label with several role words counts for each, one without any for the others. A null
    among the names, or no credits at all, makes all four null.
    """

    def usable(m: Column) -> Column:
        poisoned = F.exists(F.flatten(F.map_values(m)), lambda name: name.isNull())
        return F.when(~F.coalesce(poisoned, F.lit(True)), m)

    def buckets(m: Column) -> Column:
        def names(test) -> Column:
            kept = F.map_filter(m, lambda label, _: test(F.lower(label)))
            return empty_to_null(F.flatten(F.map_values(kept)))

        of = {role: names(lambda label, role=role: label.contains(role)) for role in CREDIT_ROLES}
        of["others"] = names(lambda label: ~label.rlike("|".join(CREDIT_ROLES)))
        return F.struct(*[c.alias(n) for n, c in of.items()])

    return let(let(credits, usable), buckets)


def bracketed(names: Column) -> Column:
    """``[A, B]``, the text the published table of the earlier system holds for a name list."""
    return F.concat(F.lit("["), F.array_join(names, ", "), F.lit("]"))


# --- counts and sets ----------------------------------------------------------------------


def gender_counts(genders: Column) -> dict[str, Column]:
    """Male, female and other elements, whatever their case; a null element counts nowhere."""

    def count(test) -> Column:
        return F.coalesce(F.size(F.filter(genders, lambda g: g.isNotNull() & test(F.lower(g)))), F.lit(0))

    # a null array has the size -1 outside ANSI mode
    def clamp(c: Column) -> Column:
        return F.greatest(c, F.lit(0)).cast("int")

    return {
        "male": clamp(count(lambda g: g == "male")),
        "female": clamp(count(lambda g: g == "female")),
        "other": clamp(count(lambda g: ~g.isin("male", "female"))),
    }


def distinct_tags(tags: Column) -> Column:
    """Distinct elements in a fixed order."""
    return F.array_sort(F.array_distinct(tags))


def full_name(first: Column, last: Column) -> Column:
    return F.concat(first, F.lit(" "), last)


def awards_map(text: Column) -> Column:
    """Comma list under one key; empty text gives one empty name."""
    return F.create_map(F.lit("awards"), F.split(text, ", ", -1))


def nth_or_default(array: Column, index: int, default: str) -> Column:
    return F.coalesce(F.get(array, F.lit(index)), F.lit(default))


def first_two(array: Column) -> Column:
    """The first two elements, or nothing when there are fewer."""
    return let(array, lambda a: F.when(F.size(a) >= 2, F.slice(a, 1, 2)))


# --- grouping inside a row ----------------------------------------------------------------


def last_wins_map(entries: Column) -> Column:
    """``array<struct<key, value>>`` -> map.

    A repeated key keeps its last value at its first place. Equal keys are brought together by
    sorting, so that many labels cost little more than few.
    """

    def by_key(e: Column, i: Column) -> Column:
        return F.struct(e["key"].alias("key"), i.alias("place"), e["value"].alias("value"))

    def merged(es: Column) -> Column:
        firsts = F.filter(es, lambda e, i: (i == 0) | (F.get(es, i - 1)["key"] != e["key"]))
        lasts = F.filter(es, lambda e, i: (i == F.size(es) - 1) | (F.get(es, i + 1)["key"] != e["key"]))
        pairs = F.zip_with(
            firsts, lasts, lambda f, l: F.struct(f["place"].alias("place"), l["key"].alias("key"), l["value"].alias("value"))
        )
        in_order = F.transform(F.array_sort(pairs), lambda p: F.struct(p["key"].alias("key"), p["value"].alias("value")))
        return F.map_from_entries(in_order)

    return let(F.array_sort(F.transform(entries, by_key)), merged)


# --- sections -----------------------------------------------------------------------------


def sections(text: Column, headers: dict[str, str]) -> Column:
    """Lines under headers, as a struct with one array of stripped lines per header.

    A line starting with a header word opens its section and is not kept itself; lines before
    the first header are dropped; a header may come again and adds to its section.
    """
    words = "|".join(headers.values())
    blank = r"[[\s\x1c-\x1f]&&[^\n]]"
    pieces = F.split(text, rf"(?U)(?<=\A|\n)(?={blank}*(?:{words}))", -1)

    # all but the last block end in the newline in front of the next header
    def blocks(ps: Column) -> Column:
        return F.transform(ps, lambda p, i: F.when(i < F.size(ps) - 1, F.regexp_replace(p, r"\n\z", "")).otherwise(p))

    def lines_under(word: str):
        def of(bs: Column) -> Column:
            mine = F.filter(bs, lambda b: strip(b).startswith(word))
            return F.flatten(F.transform(mine, _lines_behind_first))

        return of

    def split_up(ps: Column) -> Column:
        return F.struct(*[lines_under(word)(ps).alias(name) for name, word in headers.items()])

    return let(let(pieces, blocks), split_up)


def _lines_behind_first(block: Column) -> Column:
    lines = F.split(block, "\n", -1)
    return F.transform(F.slice(lines, 2, F.size(lines)), strip)
