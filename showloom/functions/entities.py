"""HTML character references."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

# The standard's name table as the standard library has it: names with their semicolon, and the old ones that may do without.
_USUAL = ["amp;", "nbsp;", "quot;", "lt;", "gt;", "apos;"]  # looked at first
_TABLE = {f"&{n}": html5[n] for n in [*_USUAL, *sorted(n for n in html5 if n.endswith(";") and n not in _USUAL)]}
_BARE = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))

# What the references 128 to 159 stand for; five of them stand for nothing else.
_C1 = [chr(i) for i in range(0x80, 0xA0)]
_C1_MEANING = [bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(0x80, 0xA0)]

# Text runs, references and stray ampersands; together they cover the whole input.
_TOKEN = r"([^&]++|&(?:#[0-9]++|#[xX][0-9a-fA-F]++|[A-Za-z][A-Za-z0-9]*+);?|&)"


def _map(table: dict[str, str]) -> Column:
    """A constant map; as one literal it is folded and quick to plan."""
    return F.from_json(F.lit(json.dumps(table)), "map<string,string>")


def _character(code: Column) -> Column:
    """Code point as text; the replacement character where it is none."""
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return F.when(valid, F.translate(char, "".join(_C1), "".join(_C1_MEANING))).otherwise("\ufffd")


def unescape(c: Column) -> Column:
    """Decode named and numeric references in one pass, so ``&amp;lt;`` gives ``&lt;``.

    A reference may do without its semicolon if its name is one of the old ones; then the longest
    name that the text begins with counts, as in ``&notit;``, which is ``\u00acit;``. Other names stay as they are.
    """

    def number(t: Column) -> Column:
        # nothing beyond nine digits is a code point
        digits = F.regexp_extract(t, "#[xX]?0*([0-9a-fA-F]{1,9});?$", 1)
        value = F.when(t.rlike("^&#[xX]"), F.conv(digits, 16, 10)).otherwise(digits)
        return F.when(digits != "", value).cast("bigint")

    def named(t: Column) -> Column:
        whole = F.when(t.endswith(";"), F.try_element_at(_map(_TABLE), t))
        return F.coalesce(whole, let(F.regexp_extract(t, f"^&({'|'.join(_BARE)})", 1), lambda old: bare(t, old)))

    def bare(t: Column, old: Column) -> Column:
        char = F.try_element_at(_map({n: html5[n] for n in _BARE}), old)
        return F.when(old == "", t).otherwise(F.concat(char, F.substr(t, F.length(old) + 2)))

    def token(t: Column) -> Column:
        return F.when(~t.startswith("&"), t).when(t.startswith("&#"), let(number(t), _character)).otherwise(named(t))

    def decoded(text: Column) -> Column:
        return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)), token), "")

    return let(c, lambda text: F.when(text.contains("&"), decoded(text)).otherwise(text))


def escape(c: Column) -> Column:
    """The reverse for text put into markup."""
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(char), F.lit(name))
    return c
