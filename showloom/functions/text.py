"""Plain-text column functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
PYTHON_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a lambda variable.

    It is the start of a sum over nothing, as Spark copies what a transform returns, and not what a sum ends in.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda start, _: start, body)


def none_if_empty(c: Column) -> Column:
    return let(c, lambda text: F.when(text != "", text))


def strip(c: Column) -> Column:
    """Both ends, with Python's idea of white space (Spark's ``trim`` takes spaces only)."""
    return F.btrim(c, F.lit(PYTHON_SPACE))


def paren_text(c: Column) -> Column:
    """Text inside the first parentheses, null when there are none."""
    return none_if_empty(F.regexp_extract(c, r"\((.*?)\)", 1))


def first_word(c: Column) -> Column:
    """First piece of a white-space split; a leading space gives the empty string."""
    return F.get(F.split(c, r"\s+", 2), F.lit(0))


def after_delimiter(c: Column, delimiter: str = ": ") -> Column:
    """Second piece of a split on a literal delimiter, null when the delimiter is absent."""
    return F.get(split_literal(c, delimiter), F.lit(1))


def split_literal(c: Column, delimiter: str) -> Column:
    return F.split(c, r"\Q" + delimiter + r"\E", -1)


def type_and_genre(c: Column) -> tuple[Column, Column]:
    """``"Type, Genre, ..."`` -> (type, genre); the genre is ``""`` when there is none."""
    parts = split_literal(c, ", ")
    genre = F.coalesce(F.get(parts, F.lit(1)), F.lit(""))
    return F.get(parts, F.lit(0)), F.when(c.isNotNull(), genre)


def fee_amount(c: Column) -> Column:
    """``"<strong>Label</strong>: amount"`` -> ``"amount"``, null without a colon."""
    bare = F.replace(F.replace(c, F.lit("<strong>"), F.lit("")), F.lit("</strong>"), F.lit(""))
    return strip(after_delimiter(bare, ":"))


def drop_first(c: Column, word: str) -> Column:
    """Remove the first occurrence of ``word`` only."""

    def cut(text: Column) -> Column:
        at = F.instr(text, word)
        rest = F.concat(F.substr(text, F.lit(1), at - 1), F.substr(text, at + len(word)))
        return F.when(at > 0, rest).otherwise(text)

    return let(c, cut)


def drop_line_breaks(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\n"), F.lit("")), F.lit("\r"), F.lit(""))


def squeeze(c: Column, char: str) -> Column:
    """Runs of one character become a single space."""
    return F.regexp_replace(c, char + "+", " ")


def warning_text(c: Column) -> Column:
    """Stripped, line breaks removed, heading removed once, stripped again."""
    return strip(drop_first(drop_line_breaks(strip(c)), "Video Warning"))


def requirement_text(c: Column) -> Column:
    """Stripped, runs of newlines and of NBSP to a space, heading removed once, stripped again."""
    flat = squeeze(squeeze(strip(c), "\n"), "\u00a0")
    return strip(drop_first(flat, "Requirements"))


def missing_to_null(c: Column) -> Column:
    """The text forms of "missing" (empty and ``"None"``) become null."""
    return let(c, lambda text: F.when(~text.isin("", "None"), text))


def empty_to_null(array: Column) -> Column:
    return let(array, lambda a: F.when(F.size(a) > 0, a))


def complete(rows: Column, test) -> Column:
    """The rows, or null when one of them lacks a required part."""
    return let(rows, lambda rs: F.when(F.forall(rs, test), rs))


def default_to(c: Column, value: str) -> Column:
    """Fallback for null, empty or ``"None"`` text."""
    return F.coalesce(missing_to_null(c), F.lit(value))


def has_text(c: Column) -> Column:
    return F.coalesce(F.length(strip(c)) > 0, F.lit(False))


def keep_if_digit(c: Column) -> Column:
    """The text itself when it holds a digit, else ``""``."""
    return let(c, lambda text: F.when(text.rlike(r"(?U)\d"), text).otherwise(""))


def date_range(start: Column, end: Column) -> Column:
    """``"<from> to <to>"``, null when either end is missing."""
    return F.concat(start, F.lit(" to "), end)


def join_url(base: Column | str, *parts: Column | str) -> Column:
    """Concatenate a base without its trailing slashes and literal or column parts."""
    head = F.lit(base) if isinstance(base, str) else base
    tail = [F.lit(p) if isinstance(p, str) else p for p in parts]
    return F.concat(F.rtrim(head, F.lit("/")), *tail)


def page_count(total: Column, page_size: int) -> Column:
    return F.ceil(total / F.lit(page_size)).cast("bigint")


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
