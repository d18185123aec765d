"""Pairing the tags of a page in one pass.

Which start tag an end tag closes depends on all tags in front of it, so this is the one step of
reading a page that no native expression can do in linear time: a stack, in Python, over Arrow
batches. Its result is plain data, and all that is read out of it is read by native expressions. What ``html.markup``
blanks is blanked here before, with the tags of a text found by one call; equal start tags are read once for each batch.

An end tag closes the last open element of its name and with it all that are open inside; one that
closes nothing is ignored. Elements that are void or end in ``/>`` have no content. What is left open
ends with the element around it.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from html import unescape
from html.entities import html5

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import cloudpickle

# the function below travels with the plan; executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Elements without content.
VOID_TAGS = "area base br col embed hr img input link meta param source track wbr".split()

#: The rest of a tag behind its name: quotes hide a ">" only where they enclose a value.
REST = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+"""

_TAG = re.compile(rf"<(?:[!?]{REST}|(/?)([A-Za-z][^\s/>]*+)({REST}))>")
#: Comments, declarations and the content of script, style and template, as ``html.markup`` has them.
_HIDDEN = re.compile(
    r"<!--(?:[^-]++|-(?!->))*+(?:-->|\Z)|<!doctype[^>]*>"
    r"|<(script|style|template)(?=[\s>])[^>]*>(?:[^<]++|<(?!/\1\s*>))*+(?:</\1\s*>|\Z)",
    re.ASCII | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"""([^\s=/>][^\s=/>]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?""")
_REFERENCE = re.compile(r"&(?:#[0-9]++;?|#[xX][0-9a-fA-F]++;?|[A-Za-z][A-Za-z0-9]*+(?:;|(?!=)))")
_BARE_VALUE = re.compile(r"=\s*+[^\s\"'][^\s>]*$")

#: One element. ``pre`` counts start tags, ``last`` is the last element inside (itself without any), ``up`` the one around;
#: its text is that of the text nodes from ``lo`` up to ``hi``. ``cls`` is the class, each name between blanks.
ELEMENT = "struct<pre:int,last:int,up:int,lo:int,hi:int,tag:string,cls:string,attributes:map<string,string>>"
#: A fragment of a page: all its elements and texts, and the element that the fragment is (0, the page itself, here).
PAGE = f"struct<elements:array<{ELEMENT}>,texts:array<string>,at:{ELEMENT}>"

#: Bytes of pages that are held as Python objects at a time; a longer page comes alone.
PIECE_BYTES = 1 << 20


class Batch:
    """Elements and texts of several pages in flat lists."""

    def __init__(self):
        self.first: list[int] = []  # of each page, where its elements and its texts begin
        self.first_text: list[int] = []
        self.kind, self.up, self.last, self.lo, self.hi = [], [], [], [], []
        self.texts: list[str] = []
        self.kinds: dict[tuple[str, str], tuple[int, str, bool]] = {}  # of a start tag, by name and rest: number, name, no content
        self.tag, self.cls = [], []  # of each kind
        self.keys, self.values, self.ends = [], [], [0]  # attributes of all kinds, and where each one's end
        self._kind("", "")

    def add(self, html: str) -> None:
        """The page as element 0, then its elements in order of their start tags."""
        kind, up, last, lo, hi, texts, kinds = self.kind, self.up, self.last, self.lo, self.hi, self.texts, self.kinds
        first, first_text = len(kind), len(texts)
        self.first.append(first)
        self.first_text.append(first_text)
        kind.append(0)
        up.append(-1)
        last.append(0)
        lo.append(0)
        hi.append(0)
        html = _HIDDEN.sub("<!---->", html)
        end = html.rfind(">") + 1
        parts = _TAG.split(html[:end])  # a text, then for each tag a slash, its name and rest, and the text behind it
        parts[-1] += html[end:]
        stack, names, counts = [0], [""], {}
        n = t = 0  # start tags and texts so far
        if parts[0]:
            texts.append(unescape(parts[0]) if "&" in parts[0] else parts[0])
            t = 1
        for slash, name, rest, text in zip(parts[1::4], parts[2::4], parts[3::4], parts[4::4], strict=True):
            if slash:
                name = name.lower()
                if counts.get(name):
                    closed = None
                    while closed != name:
                        i, closed = first + stack.pop(), names.pop()
                        counts[closed] -= 1
                        last[i] = n
                        hi[i] = t
            elif name is not None:
                known = kinds.get((name, rest)) or self._kind(name, rest)
                number, name, empty = known
                n += 1
                kind.append(number)
                up.append(stack[-1])
                last.append(n)
                lo.append(t)
                hi.append(t)
                if not empty:
                    stack.append(n)
                    names.append(name)
                    counts[name] = counts.get(name, 0) + 1
            if text:
                texts.append(unescape(text) if "&" in text else text)
                t += 1
        for i in stack:
            last[first + i] = n
            hi[first + i] = t

    def _kind(self, name: str, rest: str) -> tuple[int, str, bool]:
        tag = name.lower()
        empty = tag in _VOID or (rest.endswith("/") and not _BARE_VALUE.search(rest))
        known = self.kinds[name, rest] = len(self.tag), tag, empty
        found = _attributes(rest) if rest else {}
        cls = found.get("class")
        self.tag.append(tag)
        self.cls.append(None if cls is None else f" {' '.join(cls.split())} ")
        self.keys += found
        self.values += found.values()
        self.ends.append(len(self.keys))
        return known


_VOID = frozenset(VOID_TAGS)


def _attributes(rest: str) -> dict[str, str]:
    """Attributes by lower-case name, references decoded; the first of one name counts, one without a value is empty."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(rest):
        value = m[2] if m[2] is not None else m[3] if m[3] is not None else m[4] or ""
        found.setdefault(m[1].lower(), _REFERENCE.sub(_character, value) if "&" in value else value)
    return found


def _character(m: re.Match) -> str:
    """A reference in an attribute, where a name has to be followed by something that cannot belong to it."""
    return unescape(m[0]) if m[0][1] == "#" else html5.get(m[0][1:], m[0])


def pages(html: pa.Array) -> pa.Array:
    """``PAGE`` of each text, null for null."""
    batch = Batch()
    for text in html.to_pylist():
        if text is not None:
            batch.add(text)
    there = html.is_valid().to_numpy(zero_copy_only=False)
    starts, offsets = [], []  # of the pages there are, then of all rows
    for first, whole in ((batch.first, batch.kind), (batch.first_text, batch.texts)):
        starts.append(np.array([*first, len(whole)], np.int32))
        offsets.append(pa.array(starts[-1][np.concatenate([[0], np.cumsum(there)])]))
    pre = np.arange(len(batch.kind), dtype=np.int32) - np.repeat(starts[0][:-1], np.diff(starts[0]))
    numbers = [pa.array(pre), *[pa.array(c, pa.int32()) for c in (batch.last, batch.up, batch.lo, batch.hi)]]
    strings = [pa.array(c, pa.string()) for c in (batch.keys, batch.values)]
    attributes = pa.MapArray.from_arrays(pa.array(np.array(batch.ends, np.int32)), *strings)
    kind = pa.array(batch.kind, pa.int32())
    of_kind = [c.take(kind) for c in (pa.array(batch.tag, pa.string()), pa.array(batch.cls, pa.string()), attributes)]
    flat = pa.StructArray.from_arrays([*numbers, *of_kind], ["pre", "last", "up", "lo", "hi", "tag", "cls", "attributes"])
    columns = [
        pa.ListArray.from_arrays(offsets[0], flat),
        pa.ListArray.from_arrays(offsets[1], pa.array(batch.texts, pa.string())),
        flat.take(pa.compute.if_else(html.is_null(), pa.scalar(None, pa.int32()), offsets[0][:-1])),
    ]
    return pa.StructArray.from_arrays(columns, ["elements", "texts", "at"], mask=html.is_null())


def in_pieces(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """``pages`` of every batch, a piece of at most ``PIECE_BYTES`` at a time, so that memory does not grow with the rows of a batch."""
    for html in batches:
        ends = np.cumsum(pa.compute.binary_length(html).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        start, before = 0, 0
        while start < len(html):
            stop = max(int(np.searchsorted(ends, before + PIECE_BYTES, "right")), start + 1)
            yield pages(html[start:stop])
            start, before = stop, ends[stop - 1]
        if not len(html):
            yield pages(html)
