"""Spelling variants against a comparison of all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from showloom.llm import spelling


def words_of(rows):
    out = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows):
    counts = words_of(rows)
    form, out = {}, {}
    for w, n in counts.items():
        close = [v for v in counts if v != w and abs(len(v) - len(w)) < 2 and near(v, w)]
        best = min(close, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * n else None
        out[w] = (w, n, len(close), form[w], counts[form[w]] if form[w] else None)
    rooted = []
    for w, row in out.items():
        root = w
        while form[root]:
            root = form[root]
        rooted.append((*row, root))
    return sorted(rooted)


def got(df):
    return sorted(tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect())


def changed(rng, word, letters):
    i, kind = rng.randrange(len(word) + 1), rng.randrange(3)
    return word[:i] + (rng.choice(letters) if kind < 2 else "") + word[i + (kind > 0) :]


def corpus(seed):
    """Families of words with one and two edits, some of them very frequent."""
    rng = random.Random(seed)
    letters = "abcÉßÿé"
    bases = ["".join(rng.choice(letters) for _ in range(rng.choice([7, 7, 8, 9, 12]))) for _ in range(12)]
    pool = []
    for b in bases:
        own = [changed(rng, b, letters) for _ in range(12)]
        pool += [b] * 300 + own * 25 + [changed(rng, w, letters) for w in own for _ in range(3)] * 2
    rng.shuffle(pool)
    return [(i, " ".join(pool[i::40]) + (", " if i % 2 else "-x9") + pool[i].upper()) for i in range(40)]


SCHEMA = "doc_id long, text string, word string, n long, id string, run string, h long"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "w", 1, "i", "r", 2) for d, t in rows], SCHEMA)


@pytest.mark.parametrize("limits", [None, (8, 4, 16)])
def test_variants(spark, monkeypatch, limits):
    if limits:
        for name, value in zip(("INDEX_WORDS", "TOGETHER", "LOOKED_UP"), limits, strict=True):
            monkeypatch.setattr(spelling, name, value)
    rows = corpus(1)
    wanted = plain(rows)
    assert got(spelling.variant_groups(frame(spark, rows).repartition(3))) == wanted
    assert sum(w[3] is not None for w in wanted) > 50
    assert any(w[3] not in (None, w[5]) for w in wanted)  # a chain of forms


def test_odd_texts(spark):
    long = "ab" * 1500
    rows = [
        (None, "Example example EXAMPLE exbmple exbmple"), (1, None), (2, ""), (2, "exampleé Exampleé exampl"), (2, "exampleé Exampleé exampl"),
        (-5, " ".join(["example"] * 30)), (7, f"{long} {long} {long}x {long}x"), (8, "12345678 _______ Ābcdefghi"), (9, "x" * 7 + "×" * 2),
        (10, "x" * 7 + "×" * 2),
    ]
    assert got(spelling.variant_groups(frame(spark, rows))) == plain(rows)


def test_ties_go_to_the_smaller_word(spark):
    rows = [("aaaaaab", 30), ("aaaaaac", 30), ("aaaaaad", 3), ("aaaaaaé", 30), ("baaaaad", 4)]
    df = spark.createDataFrame(rows, "word string, n long")
    assert got(spelling.variants(df))[2] == ("aaaaaad", 3, 4, "aaaaaab", 30, "aaaaaab")


def test_empty(spark):
    assert got(spelling.variant_groups(frame(spark, []))) == []


def test_whole_test_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    result = {r[0]: r for r in got(spelling.variant_groups(df))}
    counts = words_of([tuple(r) for r in df.collect()])
    assert {w: r[1] for w, r in result.items()} == counts
    some = random.Random(2).sample(sorted(counts), 300)
    sizes = {}
    for v in counts:
        sizes.setdefault(len(v), []).append(v)
    for w in some:
        close = [v for s in (-1, 0, 1) for v in sizes.get(len(w) + s, ()) if v != w and near(v, w)]
        assert result[w][2] == len(close)


def test_one_error_sets():
    index = spelling.Index(np.array([[ord(c) for c in w] for w in ("abcdefgh", "abcdefgx", "xbcdefgh")], np.uint32))
    found, head = spelling.one_error(index, np.array([[ord(c) for c in "abcdefg"]], np.uint32))
    assert found.tolist() == [[3]] and head.tolist() == [[3]]
