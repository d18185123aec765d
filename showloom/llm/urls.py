"""Allow and block rules for urls, looked up in a sorted array of digests."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of rules that are sent to every executor; a longer list is looked up in several parts.
PART_BYTES = 64_000_000

_FILE_HEADER = 8


@dataclass(frozen=True)
class Rule:
    """Fits urls whose host is ``host`` or below it and whose path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def digest(text: str) -> int:
    return xxhash.xxh64_intdigest(text)


def packed_rules(rules: list[Rule]) -> bytes:
    """One image: count, sorted digests, ends of the rule strings, verdict bytes, all rule strings."""
    ordered = sorted({r.text: r for r in rules}.values(), key=lambda r: (digest(r.text), r.text))
    strings = [r.text.encode() for r in ordered]
    return b"".join([
        np.array([len(ordered)], np.int64).tobytes(),
        np.array([digest(r.text) for r in ordered], np.uint64).tobytes(),
        np.cumsum([len(x) for x in strings]).astype(np.int64).tobytes(),
        bytes(r.verdict == "block" for r in ordered),
        *strings,
    ])


class DigestArray:
    """Rules in a memory-mapped image: binary search on the digests, then comparison of whole strings."""

    def __init__(self, image: bytes):
        with tempfile.TemporaryFile() as file:  # has no name; goes with the mapping
            file.write(image)
            file.flush()
            whole = np.memmap(file, np.uint8, "r")
        n = int(whole[:_FILE_HEADER].view(np.int64)[0])
        a, b = _FILE_HEADER + 8 * n, _FILE_HEADER + 16 * n
        self.digests, self.ends = whole[_FILE_HEADER:a].view(np.uint64), whole[a:b].view(np.int64)
        self.blocked, self.strings = whole[b : b + n], whole[b + n :]

    def rule(self, i: int) -> str:
        start = int(self.ends[i - 1]) if i else 0
        return self.strings[start : int(self.ends[i])].tobytes().decode()

    def find(self, texts: list[str]) -> np.ndarray:
        """The rule equal to each text, or -1."""
        keys = np.array([digest(t) for t in texts], np.uint64)
        out = np.full(len(texts), -1, np.int64)
        at = np.searchsorted(self.digests, keys)
        step = 0
        open_ = np.flatnonzero(at < len(self.digests))
        while len(open_):  # texts whose digest is in the array; again where another string has the same
            open_ = open_[(at[open_] + step < len(self.digests))]
            open_ = open_[self.digests[at[open_] + step] == keys[open_]]
            same = np.array([self.rule(int(at[i]) + step) == texts[i] for i in open_.tolist()], bool)
            out[open_[same]] = at[open_[same]] + step
            open_, step = open_[~same] if len(open_) else open_, step + 1
        return out


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host: behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; path: from there up to ``?``, ``#`` or the end."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    for sign in "?#":
        rest = rest.split(sign, 1)[0]
    host, slash, path = rest.partition("/")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), slash + path


def candidates(host: str, path: str, lengths: list[int]) -> list[str]:
    """All rule strings that would fit, the longest first: each end of the host at a dot, each length of path."""
    labels = host.split(".") if host else []
    ends = [".".join(labels[i:]) for i in range(len(labels))]
    heads = [path[:n] for n in lengths if n <= len(path)]
    return sorted((e + h for e in ends for h in heads), key=lambda x: (-len(x), x))


def judge(pages: DataFrame, rules: list[Rule], default: str = "allow") -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` of each page's ``url``.

    The longest rule that fits decides; of two of one length the first in order of text.
    Without one, rule is null and the verdict ``default``. A null url, or one without ``://``,
    has empty host and path, which no rule fits. Pages are never shuffled; a null page_id and
    repeated rows stay as they are. Of rules with the same text the last counts.
    """
    sc = pages.sparkSession.sparkContext
    parts: list[list[Rule]] = [[]]
    size = 0
    for r in rules:
        size += len(r.text.encode()) + 17
        if size > PART_BYTES:
            parts.append([])
            size = 0
        parts[-1].append(r)
    images = [sc.broadcast(packed_rules(p)) for p in parts]
    lengths = sorted({len(r.path) for r in rules})
    schema = "page_id long, url string, host string, path string, rule string, verdict string"

    def look_up(image):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            array = DigestArray(image.value)
            for batch in batches:
                rows = [host_and_path(u) for u in batch.column("url").to_pylist()]
                asked = [candidates(h, p, lengths) for h, p in rows]
                found = array.find([c for x in asked for c in x])
                at, before = 0, zip(batch.column("rule").to_pylist(), batch.column("verdict").to_pylist(), strict=True)
                rule, verdict = [], []
                for x, (old, judged) in zip(asked, before, strict=True):
                    hit = found[at : at + len(x)]
                    at += len(x)
                    best = int(hit[np.argmax(hit >= 0)]) if (hit >= 0).any() else -1
                    text = array.rule(best) if best >= 0 else None
                    if text is not None and (old is None or (-len(text), text) < (-len(old), old)):
                        rule.append(text)
                        verdict.append("block" if array.blocked[best] else "allow")
                    else:
                        rule.append(old)
                        verdict.append(judged)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("page_id"), batch.column("url"), pa.array([h for h, _ in rows], pa.string()),
                     pa.array([p for _, p in rows], pa.string()), pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                    schema=batch.schema,
                )

        return run

    nothing = F.lit(None).cast("string")
    out = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", nothing.alias("host"), nothing.alias("path"),
        nothing.alias("rule"), F.concat(F.lit(default), F.substring(F.lit(""), 1, 0)).alias("verdict"),
    )
    for image in images:
        out = out.mapInArrow(look_up(image), schema)
    return out.drop("url")
